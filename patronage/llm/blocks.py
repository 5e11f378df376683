"""Documents dealt into blocks that stay together, and hashes of their byte strings.

A block is some megabytes of consecutive documents. Features of documents (strings, words) are
first gathered per block, joined with what the whole corpus says about them, and sent back to
the block, so a feature travels once per block and not once per occurrence, and no table of
features has to fit anywhere as a whole. Blocks are written once to the shared folder, bucketed
by block, so later passes find a block in one place without moving text again.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.staging import _application_folder

MAX_BUCKETS = 50_000


def stage_blocks(docs: DataFrame, size, block_bytes: int) -> DataFrame:
    """`docs` with a column `block`, written to the shared folder, bucketed by block.

    `size` is a column expression: bytes of a row. Rows of one block come from one input task,
    `block_bytes` / mean size of them, so a block holds about `block_bytes`.
    """
    spark = docs.sparkSession
    count, total = docs.agg(F.count("*"), F.sum(size)).first()
    rows = max(1, int(block_bytes * count / max(1, total or 1)))
    buckets = min(MAX_BUCKETS, max(1, math.ceil((total or 0) / block_bytes)))
    at = F.monotonically_increasing_id()
    block = F.shiftright(at, 33) * F.lit(1 << 33) + F.floor(at.bitwiseAND((1 << 33) - 1) / rows)
    name = f"blocks_{uuid.uuid4().hex}"
    (
        docs.withColumn("block", block.cast("long"))
        .write.format("parquet")
        .option("compression", "zstd")
        .option("path", f"{_application_folder(spark)}/{name}")
        .bucketBy(buckets, "block")
        .saveAsTable(name)
    )
    return spark.table(name)


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal numbers stay equal, near ones are scattered."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class ByteHash:
    """Hashes of any byte ranges of a text, each in constant time, by prefix sums.

    A range's hash is the sum of a random number per byte times a power of an odd multiplier
    by the byte's place in the range, modulo 2^64.
    """

    def __init__(self, seed: int):
        self.table = splitmix(np.arange(256, dtype=np.uint64) + np.uint64(seed * 1000))
        self.odd = (int(splitmix(np.array([seed], np.uint64))[0]) | 5) & ((1 << 64) - 1)
        self.inverse = pow(self.odd, -1, 1 << 64)
        self.forth = np.ones(1, np.uint64)
        self.back = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.forth) <= n:
            ones = np.full(n + 1, self.odd, np.uint64)
            ones[0] = 1
            self.forth = np.cumprod(ones, dtype=np.uint64)
            ones[1:] = np.uint64(self.inverse)
            self.back = np.cumprod(ones, dtype=np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.forth[: len(data)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.back[start]


def slices(lengths: np.ndarray, most: int):
    """Ranges of rows whose lengths sum to at most `most`, or of one longer row."""
    first, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            yield first, i
            first, total = i, 0
        total += int(n)
    if first < len(lengths):
        yield first, len(lengths)
