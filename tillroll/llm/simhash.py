"""Near copies by SimHash fingerprints, found with a generalised pigeonhole principle.

64 bits are cut into parts; correlated bits share a part.  Two fingerprints that differ in at most
``d`` bits agree up to ``t_i`` bits in some part ``i``, for any thresholds that sum up to
``d - parts + 1`` (-1 skips a part).  Each fingerprint picks its own thresholds by dynamic programming
over estimated candidate counts, probes the values within its thresholds, and every meeting is
verified by the number of differing bits.

Equal fingerprints are one point.  A bucket reports links that hang its rows together, at most a few
per row, never all pairs.  A bucket beyond ``BUCKET_ROWS`` is not compared at all: its members and
visitors meet at the values a bit flip away (visitors) and two flips away (members), which finds the
same links at a cost per row that does not depend on the bucket's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import arrow_batches, broadcast_keys, same
from tillroll.operators.density import connected_components
from tillroll.session import materialize

SHINGLE = 3
DISTANCE = 3
#: Seed of the shingle hash.
SEED = 42
#: Rows that are compared with each other in one bucket.
BUCKET_ROWS = 4096
#: Cells of the estimated histogram of a part's values.
CELLS = 1 << 16
#: A probe costs as much as so many candidates.
PROBE_COST = 64
#: No part is searched beyond this radius.
MAX_RADIUS = 2
_CHUNK = 1 << 16
_NEAR = 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 majority bits of the hashes of all shingles; 0 for a text without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _CHUNK):
        part = words[start : start + _CHUNK + shingle - 1]
        columns = [part[k:] for k in range(shingle)] if len(words) >= shingle else [[w] for w in words]
        every = map(xxhash.xxh64_intdigest, map(b" ".join, zip(*columns)), repeat(seed))
        hashes = np.fromiter(every, dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """``(id, text_hash, fp)`` per row; ``fp`` as a signed 64-bit number.  Null and empty texts get 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = np.array([fingerprint(t, shingle, seed) for t in b.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(made.view(np.int64))], names=["id", "text_hash", "fp"]
            )

    own = docs.select(
        F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("text")
    )
    kind = own.schema["id"].dataType.simpleString()
    arrow_batches(docs.sparkSession)
    return own.mapInArrow(run, f"id {kind}, text_hash long, fp long")


def bit_parts(points: DataFrame, parts: int) -> list[list[int]]:
    """Group the 64 bits into ``parts`` parts of nearly equal size, correlated bits together.

    One aggregate counts how often two bits are set together, over all points.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together, n = np.zeros((64, 64)), 0
        for b in batches:
            raw = b.column(0).to_numpy(zero_copy_only=False).astype(">i8").view(np.uint8)
            bits = np.unpackbits(raw).reshape(-1, 64)[:, ::-1].astype(np.float32)
            together, n = together + bits.T @ bits, n + len(bits)
        cells = np.append(together.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    sums = points.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = sums.orderBy("cell").toPandas()["n"].to_numpy(np.float64)  # 4097 numbers
    n = max(table[-1], 1.0)
    share = table[:-1].reshape(64, 64) / n
    mean = share.diagonal()
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    alike = np.abs((share - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(alike, 0)
    left, out = set(range(64)), []
    for p in range(parts):
        size = 64 // parts + (p < 64 % parts)
        inside = np.array(sorted(left))
        group = [int(inside[alike[np.ix_(inside, inside)].sum(1).argmax()])]
        while len(group) < size:
            rest = np.array(sorted(left - set(group)))
            group.append(int(rest[alike[np.ix_(rest, group)].sum(1).argmax()]))
        left -= set(group)
        out.append(sorted(group))
    return out


def _values(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The part's bits of every fingerprint, moved together."""
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def _flips(width: int, radius: int) -> np.ndarray:
    """Masks with exactly ``radius`` of ``width`` bits set."""
    masks = [sum(1 << k for k in c) for c in combinations(range(width), radius)]
    return np.array(masks, np.uint64)


def _cell(values: np.ndarray) -> np.ndarray:
    mixed = values * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(48)).astype(np.int64) % CELLS


def _histograms(points: DataFrame, layout: list[list[int]]) -> np.ndarray:
    """Hashed histogram of the values of each part, over all points: ``CELLS`` counts a part."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(layout), CELLS), np.int64)
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, bits in enumerate(layout):
                sums[i] += np.bincount(_cell(_values(fp, bits)), minlength=CELLS)
        cell = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(sums.ravel()[cell])], names=["cell", "n"])

    found = points.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(len(layout) * CELLS)
    cells = found.toPandas()  # at most CELLS rows a part
    out[cells["cell"].to_numpy(np.int64)] = cells["n"]
    return out.reshape(len(layout), CELLS)


def thresholds(
    fp: np.ndarray, layout: list[list[int]], counts: np.ndarray, distance: int, probe_cost: float = PROBE_COST
) -> np.ndarray:
    """Thresholds per fingerprint and part with the least estimated cost, summing to the pigeonhole.

    The cost of a part within radius ``t`` is the estimated number of candidates there plus the
    probes; the hashed histogram's mean is taken off as the share of foreign values.
    """
    parts = len(layout)
    target = distance - parts + 1
    most = max(MAX_RADIUS, -(-target // parts))
    background = counts.sum(1) / CELLS
    costs = np.zeros((parts, most + 2, len(fp)))  # by threshold + 1
    for i, bits in enumerate(layout):
        values, found, probes = _values(fp, bits), np.zeros(len(fp)), 0
        foreign = background[i] * (len(bits) > 16)
        for t in range(most + 1):
            masks = _flips(len(bits), t)
            for mask in masks:
                found += np.maximum(counts[i][_cell(values ^ mask)] - foreign, 0)
            probes += len(masks)
            costs[i, t + 1] = found + probe_cost * probes
    # best[s]: least cost of the parts so far whose thresholds + 1 sum to s
    need = target + parts
    best = np.full((need + 1, len(fp)), np.inf)
    best[0] = 0
    picks = []
    for i in range(parts):
        fresh, pick = np.full_like(best, np.inf), np.zeros(best.shape, np.int64)
        for s in range(need + 1):
            for t in range(min(s, most + 1) + 1):
                cost = best[s - t] + costs[i, t]
                better = cost < fresh[s]
                fresh[s] = np.where(better, cost, fresh[s])
                pick[s] = np.where(better, t, pick[s])
        best = fresh
        picks.append(pick)
    out, at, every = np.zeros((len(fp), parts), np.int64), np.full(len(fp), need), np.arange(len(fp))
    for i in reversed(range(parts)):
        out[:, i] = picks[i][at, every]
        at = at - out[:, i]
    return out - 1


def _rows(points: DataFrame, layout: list[list[int]], counts: np.ndarray, distance: int) -> DataFrame:
    """Members and visitors of buckets: ``(bucket, fp, visits)``.

    A fingerprint is a member of its own value's bucket in every part, and visits the values within
    its threshold; its own bucket needs no second row.
    """
    held = points.sparkSession.sparkContext.broadcast(counts)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for start in range(0, len(fp), _CHUNK):
                some = fp[start : start + _CHUNK]
                limit = thresholds(some, layout, held.value, distance)
                for i, bits in enumerate(layout):
                    values = _values(some, bits)
                    for t in range(limit[:, i].max() + 1):
                        goes = limit[:, i] >= t
                        for mask in _flips(len(bits), t):
                            if t:
                                yield _bucket_batch(i, values[goes] ^ mask, some[goes], True)
                    yield _bucket_batch(i, values, some, False)

    return points.select("fp").mapInArrow(put, "bucket long, fp long, visits boolean")


def _bucket_batch(part: int, values: np.ndarray, fp: np.ndarray, visits: bool) -> pa.RecordBatch:
    bucket = (values | np.uint64(part << 58)).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket), pa.array(fp.view(np.int64)), pa.array(np.full(len(fp), visits))],
        names=["bucket", "fp", "visits"],
    )


def _roots(close: np.ndarray) -> np.ndarray:
    """Component of every row of a symmetric boolean matrix, as its smallest position."""
    n = len(close)
    label = np.arange(n)
    while True:
        fresh = np.where(close, label[None, :], n).min(1)
        fresh = np.minimum(fresh[fresh], fresh)
        if (fresh == label).all():
            return label
        label = fresh


def _bucket_links(bucket: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within ``distance`` in each bucket; rows are sorted by bucket."""
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.array([], int)
    sizes = np.diff(np.append(starts, len(bucket)))
    a, b = [], []
    small = np.repeat(sizes <= _NEAR, sizes)
    for s in range(1, min(_NEAR, int(sizes.max(initial=0)))):
        pair = (bucket[s:] == bucket[:-s]) & small[s:]
        pair &= np.bitwise_count(fp[s:] ^ fp[:-s]) <= distance
        a.append(fp[s:][pair])
        b.append(fp[:-s][pair])
    for start, size in zip(starts[sizes > _NEAR], sizes[sizes > _NEAR]):
        own = np.unique(fp[start : start + size])
        close = np.empty((len(own), len(own)), bool)
        for k in range(0, len(own), 512):
            close[k : k + 512] = np.bitwise_count(own[k : k + 512, None] ^ own[None, :]) <= distance
        root = _roots(close)
        other = root != np.arange(len(own))
        a.append(own[other])
        b.append(own[root[other]])
    empty = [np.array([], np.uint64)]
    return np.concatenate(a or empty), np.concatenate(b or empty)


def _links(rows: DataFrame, distance: int) -> DataFrame:
    """``(a, b)``: links within buckets, whose rows are sorted in a task and read group by group.

    A root reported for a row is connected with it through the bucket; the pair itself may be further
    apart than ``distance``.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, fp = np.array([], np.int64), np.array([], np.uint64)
        for b in batches:
            if not b.num_rows:
                continue
            bucket = np.append(bucket, b.column(0).to_numpy(zero_copy_only=False))
            fp = np.append(fp, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
            whole = np.searchsorted(bucket, bucket[-1])  # the last bucket may go on
            yield _link_batch(*_bucket_links(bucket[:whole], fp[:whole], distance))
            bucket, fp = bucket[whole:], fp[whole:]
        yield _link_batch(*_bucket_links(bucket, fp, distance))

    dealt = rows.select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(read, "a long, b long")


def _link_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def _ball(points: DataFrame, radius: int) -> DataFrame:
    """``(at, fp)``: all values within ``radius`` flips of every point."""

    def flip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = np.concatenate([_flips(64, r) for r in range(radius + 1)])
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for start in range(0, len(fp), 256):
                some = fp[start : start + 256]
                at = (some[:, None] ^ masks[None, :]).ravel()
                own = np.repeat(some, len(masks))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.view(np.int64)), pa.array(own.view(np.int64))], names=["at", "fp"]
                )

    return points.select("fp").mapInArrow(flip, "at long, fp long")


def _hot_links(hot_rows: DataFrame, distance: int) -> DataFrame:
    """The same links for buckets that are too large to compare.

    A pair within ``distance`` shares a value that is ``distance // 2`` flips from the one and the rest
    from the other.  All that meet at a value are within ``distance`` of the smallest that is near it.
    """
    near = distance // 2
    members = hot_rows.select("fp").distinct()
    close = _ball(members, near)
    first = close.groupBy(F.col("at").alias("value")).agg(F.min("fp").alias("a"))
    reached = _ball(members, distance - near)
    return (
        reached.join(first, F.col("at") == F.col("value"))
        .filter(F.col("a") != F.col("fp"))
        .select("a", F.col("fp").alias("b"))
        .distinct()
    )


def links(points: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs within ``distance`` bits.

    ``points``: distinct fingerprints ``fp``.  The number of parts follows the number of points: more
    points need wider parts, so that a bucket keeps few of them.
    """
    n = points.count()
    wide = max(1, int(np.ceil(np.log2(max(2, n / PROBE_COST)))))
    parts = max(1, min(distance + 1, max(2, 64 // wide)))
    layout = bit_parts(points, parts)
    rows = materialize(_rows(points, layout, _histograms(points, layout), distance))
    hot = materialize(
        rows.groupBy(F.col("bucket").alias("hot")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket_rows)
    )
    if hot.limit(1).count() == 0:
        return _links(rows, distance)
    is_hot = F.col("bucket") == F.col("hot")
    calm = _links(rows.join(hot, is_hot, "left_anti"), distance)
    return calm.unionAll(_hot_links(rows.join(hot, is_hot, "left_semi"), distance))


def _components(marked: DataFrame, distance: int, bucket_rows: int) -> DataFrame:
    """``(point, component)`` for every distinct fingerprint; a component is named by a fingerprint."""
    points = materialize(marked.select("fp").distinct())
    found = materialize(links(points, distance, bucket_rows).distinct())
    linked = found.select(F.col("a").alias("id")).unionAll(found.select("b")).distinct()
    labels = connected_components(linked, found).withColumnRenamed("id", "linked")
    return points.join(labels, F.col("fp") == F.col("linked"), "left").select(
        F.col("fp").alias("point"), F.coalesce("component", "fp").alias("component")
    )


def near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per document row: ``(id, fp, component_id)``.

    ``component_id`` is the smallest id that links of at most ``distance`` bits reach.  Texts without
    words have fingerprint 0 and are linked like any other.  A component of null ids only is null;
    otherwise null ids take part but name nothing.  Repeated rows stay repeated; an empty table gives
    no rows.
    """
    marked = materialize(fingerprints(docs, id_column, text, shingle, seed))
    first = marked.groupBy(F.col("fp").alias("of_fp")).agg(F.min("id").alias("first_id"))
    joined = _components(marked, distance, bucket_rows).join(first, F.col("point") == F.col("of_fp"))
    joined = materialize(joined.select("point", "component", "first_id"))
    named = joined.groupBy(F.col("component").alias("of")).agg(F.min("first_id").alias("component_id"))
    by_point = materialize(joined.join(named, F.col("component") == F.col("of")).select("point", "component_id"))
    return marked.join(by_point, F.col("fp") == F.col("point")).select(
        F.col("id").alias(id_column), "fp", "component_id"
    )


def hex_digits(fp: Column) -> Column:
    """16 lowercase hex digits of a fingerprint."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def drop_near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``docs`` with one row of each component, one with the smallest id; all columns unchanged.

    Ids need not be unique: rows are told apart by id and text, and among repeated rows one stays.
    Null ids come after all others.
    """
    marked = materialize(fingerprints(docs, id_column, text, shingle, seed))
    key = F.struct(F.col("id").isNull().alias("last"), "id", "text_hash")
    first = marked.groupBy(F.col("fp").alias("of_fp")).agg(F.min(key).alias("first_row"))
    joined = _components(marked, distance, bucket_rows).join(first, F.col("point") == F.col("of_fp"))
    joined = materialize(joined.select("point", "component", "first_row"))
    named = joined.groupBy(F.col("component").alias("of")).agg(F.min("first_row").alias("kept"))
    by_point = materialize(joined.join(named, F.col("component") == F.col("of")).select("point", "kept"))
    rows = marked.join(by_point, F.col("fp") == F.col("point"))
    dropped = materialize(
        rows.filter(key != F.col("kept")).select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    )
    left = docs.join(broadcast_keys(dropped), same(F.col(id_column), F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left_anti")
    repeated = rows.filter(key == F.col("kept")).groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    if repeated.filter("n > 1").limit(1).count() == 0:
        return left
    one = left.withColumn("__hash", F.xxhash64(text)).dropDuplicates([id_column, "__hash"])
    return one.drop("__hash")
