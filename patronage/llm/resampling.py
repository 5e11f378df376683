"""Importance resampling towards a target distribution of hashed word runs.

Features are runs of one to three words, hashed to a fixed number of buckets. A first pass counts
buckets of the raw and the target texts; the gain of a bucket is the logarithm of its ratio, and a
document weighs the sum of the gains of its features, looked up in one array. Adding a Gumbel
number drawn from the document's id turns "highest scores" into sampling without replacement.

The cut-off is found by weighted median of medians: each partition names the median of its keys
that are still in question, the weighted median of those medians splits all keys, and since it has
at least a quarter of them on either side, a fixed share is settled for good in every round. Only
winners are sorted.

A null text has no words: no features, weight 0, not drawn. A null doc_id counts as an empty one
in the draw and comes after all others in ties. Rows that repeat a doc_id are documents of their
own; ties between them fall to the smaller digest of the text, then to the order of the staged
table, where only equal rows are left. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.word_ids import slices, utf8
from patronage.staging import stage

BUCKETS = 10_000
LONGEST_RUN = 3
#: Bytes of text that are hashed at a time, or one longer text.
SLICE_BYTES = 1 << 20

#: Letters in lower case; all ASCII but letters and digits become blanks.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20


def _buckets(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, the row of each, and the number of words of each row."""
    folded = np.append(_FOLD[data], np.uint8(0x20))
    word = folded != 0x20
    before = np.concatenate([[False], word[:-1]])
    row_start = np.zeros(len(folded), bool)
    row_start[offsets] = True
    begin = np.flatnonzero(word & (~before | row_start))
    row = np.searchsorted(offsets, begin, "right") - 1
    # words of a row lie one blank apart in the packed text, so a run of words is a slice of it
    end = np.append(np.flatnonzero(~word), len(folded))
    end = np.minimum(end[np.searchsorted(end, begin)], offsets[row + 1])
    size = end - begin + 1
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    packed = folded[np.minimum(np.repeat(begin - at[:-1], size) + np.arange(at[-1]), len(folded) - 1)]
    packed[at[1:] - 1] = 0x20
    packed = packed.tobytes()
    crc = zlib.crc32
    found, rows = [], []
    low, high = at[:-1].tolist(), (at[1:] - 1).tolist()
    for n in range(1, LONGEST_RUN + 1):
        same = row[: len(row) - n + 1] == row[n - 1 :] if len(row) >= n else np.zeros(0, bool)
        values = np.fromiter([crc(packed[a:z]) for a, z in zip(low, high[n - 1 :])], np.int64, max(0, len(row) - n + 1))
        found.append(values[same] % buckets)
        rows.append(row[: len(same)][same])
    return np.concatenate(found), np.concatenate(rows), np.bincount(row, minlength=len(offsets) - 1)


def _hashed(column: pa.Array, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    data, offsets = utf8(column)
    for low, high in slices(offsets, SLICE_BYTES):
        part = data[offsets[low] : offsets[high]]
        yield low, high, *_buckets(part, offsets[low : high + 1] - offsets[low], buckets)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features per bucket over the column `text`; one row per task and bucket is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, found, _, _ in _hashed(batch.column(0), buckets):
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    text = texts.select(F.coalesce("text", F.lit("")).alias("text"))
    return text.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed ratio, target to raw, rounded down."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, table in ((s, raw), (t, target)):
        for row in bucket_counts(table, buckets).collect():  # at most one row per bucket
            counts[row["bucket"]] = row["n"]
    all_s, all_t = int(s.sum()), int(t.sum())
    return np.array(
        [math.floor(1000 * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets)))) for a, b in zip(s.tolist(), t.tolist())],
        np.int64,
    )


def gumbel(doc_id: int | None, seed: int) -> int:
    """Thousandths of the Gumbel number of a document, rounded down."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, seed: int = 42) -> DataFrame:
    """doc_id, n_features, n_words, weight, score, digest (of the text) per document."""
    buckets = len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, found, rows, words in _hashed(batch.column(1), buckets):
                n = high - low
                doc_id = batch.column(0).slice(low, n)
                order = np.argsort(rows, kind="stable")
                sums = np.concatenate([[0], np.cumsum(gain[found[order]])])
                n_features = np.bincount(rows, minlength=n)
                ends = np.cumsum(n_features)
                weight = sums[ends] - sums[ends - n_features]
                drawn = np.array([gumbel(i, seed) for i in doc_id.to_pylist()], np.int64)
                columns = [n_features, words, weight, weight + drawn]
                yield pa.RecordBatch.from_arrays(
                    [doc_id, *(pa.array(c.astype(np.int64)) for c in columns), batch.column(2).slice(low, n)],
                    names=["doc_id", "n_features", "n_words", "weight", "score", "digest"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("digest")
    )
    return rows.mapInArrow(score, "doc_id long, n_features long, n_words long, weight long, score long, digest long")


#: Sort order of keys: score falling, then doc_id with null last, digest and place in the staged table.
KEY = ["turned", "id_is_null", "id", "digest", "place"]


def _keys(scored: DataFrame) -> DataFrame:
    return scored.select(
        (-F.col("score")).alias("turned"),
        F.col("doc_id").isNull().cast("int").alias("id_is_null"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        "digest",
        "place",
    )


def _below(key: tuple, or_equal: bool = False):
    """Whether a row's key comes before `key`, column by column."""
    found = F.lit(or_equal)
    for name, value in reversed(list(zip(KEY, key))):
        found = (F.col(name) < F.lit(value)) | ((F.col(name) == F.lit(value)) & found)
    return found


def _medians(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The middle key of a partition and the number of its keys."""
    parts = list(batches)
    keys = pd.concat(parts) if parts else pd.DataFrame()
    if len(keys):
        order = np.lexsort([keys[c].to_numpy() for c in reversed(KEY)])
        yield keys.iloc[[order[(len(order) - 1) // 2]]].assign(n=len(keys))


#: Keys that one task sorts to end the search.
FINISH_KEYS = 50_000


def cutoff(keys: DataFrame, wanted: int, finish_keys: int = FINISH_KEYS) -> tuple | None:
    """The key of the `wanted`-th row in the order of KEY; None if no row is wanted.

    `keys` must be staged. The driver holds one median per partition, never keys. Once at most
    `finish_keys` are in question one task sorts them; the result is the same.
    """
    if wanted <= 0:
        return None
    low = high = None  # keys in question lie between `low` and `high`
    schema = keys.schema.simpleString()[len("struct<") : -1].replace(":", " ").replace(",", ", ") + ", n long"
    while True:
        left = keys
        if low is not None:
            left = left.where(~_below(low, or_equal=True))
        if high is not None:
            left = left.where(_below(high))
        medians = sorted(tuple(r) for r in left.mapInPandas(_medians, schema).collect())
        half, total = 0, sum(m[-1] for m in medians)
        if total <= finish_keys:
            return tuple(left.orderBy(*KEY).offset(wanted - 1).first())
        for *pivot, n in medians:
            half += n
            if 2 * half >= total:
                break
        pivot = tuple(pivot)
        before = left.where(_below(pivot)).count()
        if before == wanted - 1:
            return pivot
        if before >= wanted:
            high = pivot
        else:
            low, wanted = pivot, wanted - before - 1


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = BUCKETS
) -> DataFrame:
    """doc_id, n_features, n_words, weight, score, rank (null if not drawn) of every document.

    Of the documents with at least `least_words` words, `percent` of a hundred are drawn, rounded
    down: those of the highest scores.
    """
    scored = scores(docs, gains(docs, target, buckets), seed)
    scored = stage(scored.withColumn("place", F.monotonically_increasing_id()), "scored")
    keys = stage(_keys(scored.where(F.col("n_words") >= least_words)), "keys")
    last = cutoff(keys, percent * keys.count() // 100)
    winners = keys.where(_below(last, or_equal=True) if last else F.lit(False))
    # numbers of a sorted table: partition in the upper bits, place in it in the lower 33
    winners = stage(winners.orderBy(*KEY).select("place", F.monotonically_increasing_id().alias("at")), "winners")
    part, own = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = winners.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    ranks = winners.withColumn("part", part).join(F.broadcast(parts), "part").select("place", (F.col("base") + own + 1).alias("rank"))
    return scored.join(ranks, "place", "left").select("doc_id", "n_features", "n_words", "weight", "score", "rank")
