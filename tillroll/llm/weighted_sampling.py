"""Document fingerprints by consistent weighted sampling.

A document is a bag of weighted terms.  For each of ``SAMPLES`` samples every term draws gamma
variates that depend on the term and the sample only; the term with the smallest ``ln a`` and its
level ``t`` are the sample.  Two documents agree in a sample with a probability that equals their
generalised Jaccard similarity, sum of minima over sum of maxima of the weights.

The draws of a term and weight are kept while they last in a bounded cache, since words repeat.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import arrow_batches

SAMPLES = 64
#: Hex digits of a sample; 16 bits make a chance agreement as rare as 1 in 65,535.
DIGITS = 4
#: Rows of the cache of a task: terms with their weight.
CACHE_ROWS = 100_000
#: Terms that are reduced at a time.
_PIECE = 20_000


def terms(text: str | None) -> Counter:
    """Lower-cased runs without white space, with their counts."""
    return Counter((text or "").encode("utf-8", "replace").lower().split())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two uniforms in (0, 1) from every 64-bit number."""
    scale, half = np.float32(2.0**-23), np.float32(2.0**-24)
    low = (x & np.uint64(0x7FFFFF)).astype(np.float32) * scale + half
    return low, (x >> np.uint64(41)).astype(np.float32) * scale + half


class Sampler:
    """Draws of terms, and signatures of bags of terms."""

    def __init__(self, samples: int = SAMPLES, seed: int = 5, cache_rows: int = CACHE_ROWS) -> None:
        self.samples, self.cache_rows = samples, cache_rows
        self.streams = _mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        self.clear()

    def clear(self) -> None:
        self.place: dict[tuple[bytes, int], int] = {}
        self.level = np.empty((0, self.samples), np.float32)
        self.code = np.empty((0, self.samples), np.uint16)

    def draws(self, keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
        """``ln a`` and the code of ``(term, t)`` for every key ``(term, weight)`` and sample."""
        hashes = np.fromiter((xxhash.xxh64_intdigest(t) for t, _ in keys), np.uint64, len(keys))
        weight = np.log(np.fromiter((w for _, w in keys), np.float32, len(keys)))[:, None]
        base = hashes[:, None] ^ self.streams[None, :]
        u1, u2 = _uniform(_mix(base))
        u3, u4 = _uniform(_mix(base + np.uint64(0xA24BAED4963EE407)))
        beta, _ = _uniform(_mix(base + np.uint64(0x9FB21C651E98DF25)))
        r = -np.log(u1 * u2)  # gamma(2, 1)
        t = np.floor(weight / r + beta)
        level = np.log(-np.log(u3 * u4)) - r * (t - beta + 1)
        code = _mix(base ^ t.astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        return level, (code % np.uint64(0xFFFF) + np.uint64(1)).astype(np.uint16)

    def _fill(self, keys: list[tuple[bytes, int]]) -> None:
        level, code = [self.level], [self.code]
        for start in range(0, len(keys), 4096):
            some = self.draws(keys[start : start + 4096])
            level.append(some[0])
            code.append(some[1])
        self.level, self.code = np.concatenate(level), np.concatenate(code)

    def signatures(self, bags: list[Counter]) -> np.ndarray:
        """One row of sample codes per bag; zeros for a bag without terms."""
        best = np.full((len(bags), self.samples), np.inf, np.float32)
        out = np.zeros((len(bags), self.samples), np.uint16)
        every = np.arange(self.samples)
        waiting: list[tuple[int, list[int]]] = []
        fresh: list[tuple[bytes, int]] = []

        def reduce() -> None:
            self._fill(fresh)
            for at, rows in waiting:
                level = self.level[rows]
                first = level.argmin(0)
                low = level[first, every]
                better = low < best[at]
                best[at][better] = low[better]
                out[at][better] = self.code[np.asarray(rows)[first], every][better]
            waiting.clear()
            fresh.clear()
            if len(self.place) > self.cache_rows:
                self.clear()

        for at, bag in enumerate(bags):
            keys = list(bag.items())
            for start in range(0, len(keys), _PIECE):
                rows = []
                for key in keys[start : start + _PIECE]:
                    row = self.place.get(key)
                    if row is None:
                        row = self.place[key] = len(self.place)
                        fresh.append(key)
                    rows.append(row)
                waiting.append((at, rows))
                if len(fresh) > _PIECE:
                    reduce()
        reduce()
        return out


def hex_digits(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``(id, fingerprint)`` per row; a null text is an empty one, whose fingerprint is all zeros."""
    own = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    kind = own.schema["id"].dataType.simpleString()
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)
        for b in batches:
            found = sampler.signatures([terms(t) for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(hex_digits, found), pa.string())], names=["id", "fingerprint"])

    return own.mapInArrow(run, f"id {kind}, fingerprint string").withColumnRenamed("id", id_column)


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of samples in which two fingerprints agree."""
    same = [(F.substring(a, i * DIGITS + 1, DIGITS) == F.substring(b, i * DIGITS + 1, DIGITS)).cast("int") for i in range(samples)]
    return sum(same[1:], same[0]) / F.lit(float(samples))
