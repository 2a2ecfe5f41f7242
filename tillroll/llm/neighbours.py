"""Pairs of consecutive rows of a table of texts, without a join and with one shuffle of the texts.

Rows go to buckets of consecutive ids.  A bucket's bound is the largest id in it, which is the next row
of the last one in the bucket before; rows with a bound's id are therefore sent to both.  Each task
reads its bucket in order and holds two texts at a time.  Texts travel compressed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import arrow_batches

#: Rows in a bucket, as long as there are not more than MOST_BUCKETS.
BUCKET_ROWS = 2048
MOST_BUCKETS = 10_000
_NULLS = 0


def with_next(
    docs: DataFrame,
    id_column: str,
    text: str,
    work: Callable[[], Callable[[list, list[str], list[str]], pa.RecordBatch]],
    schema: str,
    bucket_rows: int = BUCKET_ROWS,
    rows_at_once: int = 256,
) -> DataFrame:
    """Hand every row's id and text, with the next row's text, to ``work()`` in lists.

    The next row is the one with the next smaller id (a whole number); null ids come last, ties go by
    a hash of the text, and after the last row comes the first.  A null text is an empty one.
    ``work`` makes one function per task; it gets ids, texts and next texts.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    n, nulls = own.agg(F.count(F.lit(1)), F.count_if(F.col("id").isNull())).first()
    buckets = int(min(MOST_BUCKETS, max(1, -(-n // bucket_rows))))
    shares = [(k + 1) / buckets for k in range(buckets)]
    cut = own.agg(F.percentile_approx("id", shares, 10 * buckets), F.max("id")).first()
    bounds = np.array(sorted({*(cut[0] or []), *([] if cut[1] is None else [cut[1]])}), np.int64)
    arrow_batches(spark)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            ids = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            empty = b.column(0).is_null().to_numpy(zero_copy_only=False)
            home = np.where(empty, _NULLS, 1 + np.searchsorted(bounds, ids))
            packed = pa.array([pack.compress(t.encode("utf-8", "replace")) for t in b.column(2).to_pylist()], pa.binary())
            # The first row of a bucket, in falling order, also ends the bucket before it.
            heads = ~empty & (np.isin(ids, bounds) if len(bounds) else False)
            before = home + 1
            if len(bounds):
                last = _NULLS if nulls else 1
                before = np.where(empty, 1, np.where(home == len(bounds), last, before))
                heads = heads | empty
            extra = np.flatnonzero(heads)
            at = np.concatenate([np.arange(len(ids)), extra])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([home, before[extra]]).astype(np.int32)),
                    pa.array(np.repeat([False, True], [len(ids), len(extra)])),
                    b.column(0).take(pa.array(at)),
                    b.column(1).take(pa.array(at)),
                    packed.take(pa.array(at)),
                ],
                names=["bucket", "ends", "id", "hash", "packed"],
            )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, run = zstandard.ZstdDecompressor(), work()
        ids, texts, nexts = [], [], []
        bucket = held = first = None
        for b in batches:
            for at, ends, key, packed in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if at != bucket:
                    if held is not None:  # only if all ids are null: the first row follows the last
                        ids, texts, nexts = [*ids, held[0]], [*texts, held[1]], [*nexts, first]
                    bucket, held, first = at, None, None
                elif held is None:
                    continue  # a further row with the id that ended the bucket
                text_now = unpack.decompress(packed).decode()
                if held is not None:
                    ids.append(held[0])
                    texts.append(held[1])
                    nexts.append(text_now)
                first = text_now if first is None else first
                held = None if ends else (key, text_now)
                if len(ids) >= rows_at_once:
                    yield run(ids, texts, nexts)
                    ids, texts, nexts = [], [], []
        if held is not None:
            ids, texts, nexts = [*ids, held[0]], [*texts, held[1]], [*nexts, first]
        if ids:
            yield run(ids, texts, nexts)

    dealt = own.select("id", F.xxhash64("text").alias("hash"), "text").mapInArrow(
        deal, "bucket int, ends boolean, id long, hash long, packed binary"
    )
    in_order = dealt.repartitionById(len(bounds) + 1, F.col("bucket")).sortWithinPartitions(
        "bucket", "ends", F.col("id").desc_nulls_last(), "hash"
    )
    return in_order.mapInArrow(read, schema)
