"""Crawl queues as streams of JSON files.

A queue is a folder; the checkpoint of a drain is the acknowledgement, so a message is processed
once even if executors or the driver are lost and the drain is started again.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Status codes and the number of attempts after which a link is given up.
DONE, TIMEOUT, TOO_MANY, FAILED = 200, 408, 429, 500
MAX_ATTEMPTS = 4
# End of fixed values.


def messages(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the JSON messages in a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def let_through(starts: list[int], ends: list[int], t: int, step: int) -> bool:
    """Whether a time is ``step`` or more away from all times let through before; if so it is recorded.

    The record is spans in ascending order.  Times less than two steps apart leave no room between them, so
    they are one span, and a key that keeps repeating holds two numbers however often it is let through.
    """
    at = bisect(starts, t)
    if (at and t - ends[at - 1] < step) or (at < len(starts) and starts[at] - t < step):
        return False
    before = at > 0 and t - ends[at - 1] < 2 * step
    after = at < len(starts) and starts[at] - t < 2 * step
    if before and after:
        ends[at - 1 : at + 1] = [ends[at]]
        del starts[at]
    elif before:
        ends[at - 1] = t
    elif after:
        starts[at] = t
    else:
        starts.insert(at, t)
        ends.insert(at, t)
    return True


def dedup(
    stream: DataFrame,
    key: str = "hash_id",
    ts: str = "ts",
    interval: str = "5 minutes",
) -> DataFrame:
    """Drop a message if one with its key was let through less than ``interval`` before or after it.

    Messages may come in any order: every key comes out at least once, however late, and again when it
    repeats after the interval.  The state of a key is the spans of time in which it was let through, closed
    up where nothing more can pass; it is kept as long as the checkpoint, because a key that was forgotten
    could not be told from a new one.  A null time counts as the epoch.
    """
    step = pd.Timedelta(interval) // pd.Timedelta(microseconds=1)

    def of_key(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        starts, ends = (list(x) for x in state.get) if state.exists else ([], [])
        for part in frames:
            times = part[ts].fillna(pd.Timestamp(0)).astype("datetime64[us]").astype("int64")
            kept = [row for row, t in times.sort_values(kind="stable").items() if let_through(starts, ends, int(t), step)]
            if kept:
                yield part.loc[kept]
        state.update((starts, ends))

    return stream.groupBy(key).applyInPandasWithState(
        of_key, stream.schema, "starts array<long>, ends array<long>", "append", GroupStateTimeout.NoTimeout
    )


def fan_out(stream: DataFrame, children: str, name: str) -> DataFrame:
    """One message per child link, with the key of that link."""
    rest = [c for c in stream.columns if c != children]
    rows = stream.select(*rest, F.explode(children).alias(name))
    return rows.withColumn("hash_id", F.sha2(F.col(name), 256))


def route_status(outcome: Column, times: Column) -> Column:
    """Status of an attempt: given up after four attempts, else by the outcome.

    ``outcome`` is ``ok``, ``timeout`` or ``error``; ``times`` is null for a fresh message.
    """
    return (
        F.when(times >= MAX_ATTEMPTS, TOO_MANY)
        .when(outcome == "error", FAILED)
        .when(outcome == "timeout", TIMEOUT)
        .otherwise(DONE)
    )


def route(attempts: DataFrame, outcome: str = "outcome", times: str = "times") -> DataFrame:
    """Add status, the new attempt count, and whether the link goes back to the queue.

    Works on tables and on streams.
    """
    status = route_status(F.col(outcome), F.col(times))
    counted = F.when(status == TOO_MANY, F.col(times)).when(
        status != FAILED, F.coalesce(times, F.lit(0)) + 1
    )
    return attempts.withColumns(
        {"status_code": status, "times_now": counted, "retry": status == TIMEOUT}
    )


def last_attempts(attempts: DataFrame, link: str = "link") -> DataFrame:
    """Newest attempt of every link."""
    rest = [c for c in attempts.columns if c != link]
    newest = F.max_by(F.struct(*rest), F.coalesce("times", F.lit(0)))
    return (
        attempts.groupBy(link)
        .agg(newest.alias("a"))
        .select(link, *[F.col(f"a.{c}").alias(c) for c in rest])
    )


def drain(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
) -> None:
    """Process everything that is in the queue now, then stop."""
    writer = stream.writeStream.format(fmt).option("path", out).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
