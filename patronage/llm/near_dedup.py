"""Near-duplicate documents by HyperMinHash.

A document's set holds its distinct `width`-word shingles. Sets are sketched by `REGISTERS`
buckets; a bucket keeps the leading zeros and ten mantissa bits of its least hash. Empty buckets
borrow from others in a fixed random order. Bands of compressed registers find candidates:

1. equal sets form one class, so copies cost one row each and no pairs;
2. in each bucket of a band every class is linked to the least one, and the components of these
   links are *clusters*: whatever meets in some bucket is in one cluster;
3. inside a cluster, pairs whose Jaccard estimate (corrected for chance collisions of registers)
   is not far below the limit are verified on full sets, unless they are connected already. A
   large cluster is dealt into chunks and each pair of chunks is a task of its own, which returns
   at most a spanning forest of the verified links, so there is no row per pair;
4. components of verified links are the groups.

Registers fall into bands as wide as the limit allows: a pair at the limit escapes all bands with
a chance of at most five in a million, and then still meets if it shares a cluster. Sets that are
too small to be linked to any unequal set (`smallest`: under six shingles at 85 %, under four at
80 %) need no bands.

Words are split at white space, A-Z in lower case. A text of fewer words is one shingle. Nulls
and texts without words are empty sets, alone in their groups. Rows that repeat a doc_id are
compared like others. Rows without doc_id get the group of their texts' class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.blocks import ByteHash, slices, splitmix
from patronage.llm.components import components
from patronage.staging import stage

REGISTERS = 252
MANTISSA = 10
#: Pairs whose estimate is this much under the limit are not verified: nine standard deviations.
SLACK = 0.25
#: Chance with which a pair at the limit may escape all bands.
ESCAPE = 5e-6
CHUNK_SHINGLES = 400_000
CHUNK_SETS = 700


def rows_per_band(percent: int) -> int:
    """Registers per band: the most that keep the chance to escape all bands under ESCAPE at the limit."""
    fit = [r for r in range(1, REGISTERS + 1) if REGISTERS % r == 0 and (1 - (percent / 100) ** r) ** (REGISTERS // r) <= ESCAPE]
    return max(fit, default=1)


def smallest(percent: int) -> int:
    """Least size of a set that can be linked to a larger one: all of it shared, one shingle more."""
    return max(1, -(-percent // (100 - percent))) if percent < 100 else 1 << 62


_hash, _check = ByteHash(31), ByteHash(32)
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_space = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, sorted, end to end; and how many each text has."""
    raw = b"\n".join((t or "").encode("utf-8", "replace") for t in texts) + b"\n"
    data = _lower[np.frombuffer(raw, np.uint8)]
    solid = ~_space[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]])))
    first, last = edges[::2], edges[1::2]
    words = splitmix(_hash.ranges(_hash.prefix(data), first, last))
    lengths = np.fromiter((len((t or "").encode("utf-8", "replace")) + 1 for t in texts), np.int64, len(texts))
    counts = np.diff(np.concatenate([[0], np.searchsorted(first, np.cumsum(lengths))]))
    start = np.cumsum(counts) - counts
    grams = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(grams)]
    grams = splitmix(grams)
    sets, sizes = [], np.zeros(len(texts), np.int64)
    for i, (s, n) in enumerate(zip(start, counts)):
        if n >= width:
            own = np.unique(grams[s : s + n - width + 1])
        elif n:
            total = np.uint64(n)
            with np.errstate(over="ignore"):
                for w in words[s : s + n]:
                    total = total * np.uint64(0x9E3779B97F4A7C15) + w
            own = splitmix(np.array([total]))
        else:
            continue
        sets.append(own)
        sizes[i] = len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), sizes


def sketches(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of REGISTERS compressed registers (uint16) per set that has elements."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bucket = (hashes >> np.uint64(48)) * np.uint64(REGISTERS) >> np.uint64(16)
    value = splitmix(hashes)
    least = np.full(len(sizes) * REGISTERS, np.uint64(0xFFFFFFFFFFFFFFFF))
    np.minimum.at(least, owner * REGISTERS + bucket.astype(np.int64), value)
    least = least.reshape(len(sizes), REGISTERS)
    filled = np.zeros(len(sizes) * REGISTERS, bool)
    filled[owner * REGISTERS + bucket.astype(np.int64)] = True
    filled = filled.reshape(len(sizes), REGISTERS)
    bits = np.maximum(least, np.uint64(1)).astype(np.float64).view(np.uint64)
    zeros = np.minimum(63, 63 - ((bits >> np.uint64(52)).astype(np.int64) - 1023)).clip(0)
    low = (bits >> np.uint64(52 - MANTISSA)).astype(np.int64) & ((1 << MANTISSA) - 1)
    registers = (zeros << MANTISSA | low).astype(np.uint16)
    row, column = np.nonzero(~filled & (sizes > 0)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        other = (splitmix(column.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(attempt)) % np.uint64(REGISTERS)).astype(np.int64)
        good = filled[row, other]
        registers[row[good], column[good]] = registers[row[good], other[good]]
        row, column = row[~good], column[~good]
    return registers


def estimate(one: np.ndarray, others: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
    """Jaccard estimates of one sketch with others, less the expected chance collisions."""
    equal = (others == one).mean(axis=1)
    ratio = np.maximum(size, sizes) / np.maximum(1, np.minimum(size, sizes))
    chance = 0.169919487159739 * 4 * ratio / (1 + ratio) ** 2 / (1 << MANTISSA)
    return (equal - chance) / (1 - chance)


def _digests(hashes: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """Sixteen bytes per set, equal for equal sets; None for empty ones."""
    ends = np.cumsum(sizes)
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(splitmix(hashes ^ np.uint64(s)))]) for s in (0x51, 0x7A3)]
    parts = np.stack([s[ends] - s[ends - sizes] for s in sums], axis=1)
    return [p.tobytes() if n else None for p, n in zip(parts, sizes)]


SIGNED = "doc_id long, n_shingles long, class binary, keys array<long>"


def _signed(width: int, percent: int):
    rows, least = rows_per_band(percent), smallest(percent)
    count = REGISTERS // rows
    powers = splitmix(np.arange(rows, dtype=np.uint64) + np.uint64(77)) | np.uint64(1)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, ids = pdf["text"].tolist(), pdf["doc_id"]
            for i, j in slices(np.fromiter((len(t or "") for t in texts), np.int64, len(texts)), 1 << 20):
                hashes, sizes = shingle_sets(texts[i:j], width)
                found = sketches(hashes, sizes).astype(np.uint64)
                bands = found.reshape(j - i, count, rows)
                keys = splitmix((bands * powers).sum(axis=2, dtype=np.uint64) + np.arange(count, dtype=np.uint64)).view(np.int64)
                own = {"digest": pdf["digest"][i:j]} if "digest" in pdf else {}
                yield pd.DataFrame({
                    "doc_id": ids[i:j].astype("Int64"), "n_shingles": sizes, "class": _digests(hashes, sizes),
                    "keys": [k if n >= least else None for k, n in zip(keys, sizes)],
                } | own)

    return sign


def _sets(width: int):
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.reset_index(drop=True)
            texts = pdf["text"].tolist()
            for i, j in slices(np.fromiter((len(t or "") for t in texts), np.int64, len(texts)), 1 << 20):
                hashes, sizes = shingle_sets(texts[i:j], width)
                ends = np.cumsum(sizes)
                part = pdf.iloc[i:j]
                same = [a == b for a, b in zip(_digests(hashes, sizes), part["class"])]
                body = [hashes[e - n : e].tobytes() for e, n in zip(ends, sizes)]
                part = part.assign(shingles=body)[same]
                yield part[["cluster", "node", "chunks", "shingles"]]

    return sets


#: Shingles from which on a set is large: its registers are hardly shared, so estimates hold.
ESTIMATED = 250


def _verified(percent: int):
    def verify(key, pdf: pd.DataFrame) -> pd.DataFrame:
        _, left, right = key
        pdf = pdf.drop_duplicates("node").sort_values("node")
        nodes, chunk = pdf["node"].to_numpy(np.int64), pdf["chunk"].to_numpy(np.int64)
        sets = [np.frombuffer(s, np.uint64) for s in pdf["shingles"]]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        whole, codes = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        registers = sketches(np.concatenate(sets), sizes)
        root = np.arange(len(nodes))
        mark = np.zeros(len(whole), bool)
        out = []
        for i in range(len(nodes)):
            later = np.arange(i + 1, len(nodes))
            if left != right:
                later = later[chunk[later] != chunk[i]]
            # sizes alone rule out what differs too much
            big, small = np.maximum(sizes[later], sizes[i]), np.minimum(sizes[later], sizes[i])
            later = later[(root[later] != root[i]) & (100 * small >= percent * big)]
            if not len(later):
                continue
            # registers of small sets repeat, so only large ones are ruled out by an estimate
            small = np.minimum(sizes[later], sizes[i]) < ESTIMATED
            later = later[small | (estimate(registers[i], registers[later], sizes[i], sizes[later]) >= percent / 100 - SLACK)]
            if not len(later):
                continue
            mark[codes[starts[i] : ends[i]]] = True
            for j in later:
                if root[j] == root[i]:
                    continue
                both = int(mark[codes[starts[j] : ends[j]]].sum())
                if 100 * both >= percent * int(sizes[i] + sizes[j] - both):
                    out.append((nodes[i], nodes[j]))
                    low, high = min(root[i], root[j]), max(root[i], root[j])
                    root[root == high] = low
            mark[codes[starts[i] : ends[i]]] = False
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return verify


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 85, digest: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document; with `digest`, that of the text too.

    Documents are linked if 100 x shared shingles >= `percent` x shingles of either. Rows without
    doc_id have no component and are not kept.
    """
    text = docs.select(F.col("doc_id").cast("long"), "text")
    extra = ["digest"] if digest else []
    signing = text.withColumn("digest", _text_digest()) if digest else text
    signed = stage(signing.mapInPandas(_signed(width, percent), SIGNED + ", digest binary" * digest), "signed")
    # A class is known by its least doc_id; classes without any doc_id have nothing to name a group by.
    classes = stage(
        signed.where("class is not null and doc_id is not null").groupBy("class").agg(
            F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys")
        ).withColumn("node", F.xxhash64("class")),
        "classes",
    )
    banded = classes.where("keys is not null").select("node", F.explode("keys").alias("key"))
    leaders = banded.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    leaders = stage(leaders, "leaders")
    stars = banded.join(leaders, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    clusters = components(stars, "clusters")
    members = clusters.join(classes.select("node", "class", "doc", "n_shingles"), "node")
    sizes = members.groupBy("component").agg(
        F.greatest(F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES), F.ceil(F.count("*") / CHUNK_SETS)).cast("int").alias("chunks")
    )
    sizes = stage(sizes, "cluster-sizes")
    wanted = members.join(sizes, "component").select(
        F.col("component").alias("cluster"), "node", "class", "doc", "chunks"
    )
    sets = text.join(wanted, F.col("doc_id") == F.col("doc")).select("cluster", "node", "chunks", "class", "text")
    sets = sets.mapInPandas(_sets(width), "cluster long, node long, chunks int, shingles binary")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    sets = sets.withColumn("chunk", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    sets = sets.select(
        "cluster", F.least("chunk", "other").alias("left"), F.greatest("chunk", "other").alias("right"), "node", "chunk", "shingles"
    )
    links = stage(sets.groupBy("cluster", "left", "right").applyInPandas(_verified(percent), "a long, b long"), "links")
    groups = components(links, "groups")
    named = groups.join(classes.select("node", "class", "doc"), "node")
    least = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    grouped = named.join(least, "component").select("class", "component_id")
    names = stage(
        classes.select("class", "doc").join(grouped, "class", "left")
        .select("class", F.coalesce("component_id", "doc").alias("component_id")),
        "group-names",
    )
    rows = signed.select("doc_id", "n_shingles", "class", *extra).join(names, "class", "left")
    group = F.coalesce("component_id", "doc_id")
    kept = F.coalesce(F.col("doc_id") == group, F.lit(False))
    return rows.select("doc_id", "n_shingles", group.alias("component_id"), kept.alias("kept"), *extra)


def _text_digest():
    """Of the whole text; a null one is told from an empty one."""
    return F.unhex(F.sha2(F.coalesce(F.concat(F.lit("="), F.col("text")), F.lit("")), 256))


def deduplicate(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one document of each group; rows without doc_id stay, repeated rows become one.

    A row is known by doc_id and text. Of a group's rows with its least doc_id the one with the
    least digest of the text stays; rows that share a doc_id but not the group are judged apart.
    Of rows equal in doc_id and text one stays, whatever their other columns.
    """
    rows = stage(near_duplicates(docs, width, percent, digest=True).where("doc_id is not null"), "near-duplicates")
    known = ["doc_id", "digest"]
    # rows without words are groups of their own
    leaders = rows.where("kept and n_shingles > 0").groupBy("component_id").agg(F.min("digest").alias("least"))
    judged = rows.groupBy(*known, "component_id", "n_shingles").agg(F.count("*").alias("times"), F.bool_or("kept").alias("kept"))
    judged = judged.join(leaders, "component_id", "left").withColumn(
        "stays", F.col("kept") & ((F.col("n_shingles") == 0) | (F.col("digest") == F.col("least")))
    )
    judged = stage(judged.where("not stays or times > 1").select(*known, "stays"), "judged")
    own = F.struct(F.col("rows.doc_id").cast("long").alias("doc_id"), _text_digest().alias("digest"))
    found = own == F.struct("judged.doc_id", "judged.digest")
    left = docs.alias("rows").join(judged.alias("judged"), found, "left_anti")
    again = docs.alias("rows").join(judged.where("stays").alias("judged"), found, "left_semi")
    return left.unionByName(_once(again))


def _once(rows: DataFrame) -> DataFrame:
    """One row for each doc_id and text."""
    whole = F.struct(*rows.columns)
    keys = [F.col("doc_id").cast("long").alias("key_id"), _text_digest().alias("key_digest")]
    least = rows.groupBy(*keys).agg(F.min_by(whole, F.to_json(whole)).alias("row"))
    return least.select("row.*")
