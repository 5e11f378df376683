"""Near-duplicate vectors by a flat graph with robust pruning.

Within a label, vectors with a cosine of `limit` or more are linked.

1. Equal vectors of a label are one node with a weight.
2. Each node goes to the shards of its `OVERLAP` nearest centroids; centroids are fitted on a
   sample of at most `SAMPLE` vectors, the index holds every vector. A shard of more than
   `CHUNK` nodes is dealt into chunks and each pair of chunks is a task, so no task is unbounded.
3. Each task builds a graph: of its nearest candidates a node keeps those that no kept one is
   clearly nearer to (robust pruning). Adjacency lists of a node from all its shards are united.
4. Each task searches its nodes in the united graph: greedily from the medoid, then through
   everything in range, from the nodes in range that were met and from the node itself. Every
   reported cosine is computed in double precision. A pair that meets in several shards is counted
   in the first one the two share, but joins components whichever shard finds it; a node has at
   least as many links as any one shard found.
5. Tasks return the weight of links per node and one tree edge per node; components follow by joins.

`recall` compares with brute force over a query set. Vectors that are null, empty, zero or hold
null or non-finite components, and those without label, link with nothing; so do vectors of
different length. Repeated vec_ids are counted as vectors of their own. Rows without vec_id get
a null component and are not kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.components import components
from patronage.staging import stage

SAMPLE = 20_000
#: Centroids at most, a tenth of the sample they are fitted on; shards beyond `CHUNK` are dealt into chunks.
CENTROIDS = SAMPLE // 10
OVERLAP = 3
CHUNK = 2_000
POOL, DEGREE, ALPHA = 48, 16, 1.2
QUERIES = 128


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    scale = np.abs(vectors).max(axis=1, keepdims=True)
    vectors = vectors / scale
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def fit_centroids(
    sample: list[list[float]], rows: int, shards: int | None = None, rounds: int = 6, seed: int = 3
) -> np.ndarray:
    """Unit centroids of a sample of vectors of one length."""
    if not sample:
        return np.zeros((0, 0))
    unit = _unit(np.array(sample))
    k = int(min(len(unit), shards or min(CENTROIDS, max(1, rows // (CHUNK // 2)))))
    centre = unit[np.random.default_rng(seed).choice(len(unit), k, replace=False)]
    for _ in range(rounds):
        own = np.argmax(unit @ centre.T, axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, own, unit)
        size = np.sqrt((total**2).sum(axis=1, keepdims=True))
        centre = np.where(size > 0, total / np.maximum(size, 1e-300), centre)
    return centre


def _assigned(centroids: np.ndarray):
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            shards = np.zeros((len(pdf), 1), np.int32)
            if len(centroids) > 1 and len(pdf):
                fits = (pdf["embedding"].str.len() == centroids.shape[1]).to_numpy()
                shards = np.zeros((len(pdf), min(OVERLAP, len(centroids))), np.int32)
                if fits.any():
                    near = _unit(np.stack(pdf["embedding"][fits].to_numpy())) @ centroids.T
                    shards[fits] = np.sort(np.argsort(-near, axis=1, kind="stable")[:, : shards.shape[1]], axis=1)
            pdf["shards"] = [np.unique(s) for s in shards]
            yield pdf

    return assign


def robust_prune(unit: np.ndarray, pool: np.ndarray, close: np.ndarray) -> np.ndarray:
    """Up to DEGREE neighbours per node out of its pool, nearest first; -1 where there are fewer."""
    n = len(unit)
    kept = np.full((n, DEGREE), -1, np.int64)
    alive = pool >= 0
    distance = np.where(alive, 2 - 2 * close, np.inf)
    for slot in range(DEGREE):
        best = np.argmin(distance, axis=1)
        rows = np.flatnonzero(np.isfinite(distance[np.arange(n), best]))
        if not len(rows):
            break
        chosen = pool[rows, best[rows]]
        kept[rows, slot] = chosen
        distance[rows, best[rows]] = np.inf
        for part in np.array_split(rows, max(1, len(rows) // 500)):
            between = 2 - 2 * np.einsum("ijk,ik->ij", unit[pool[part]], unit[kept[part, slot]])
            distance[part] = np.where(ALPHA * between <= distance[part], np.inf, distance[part])
    return kept


def build(unit: np.ndarray) -> tuple[np.ndarray, int]:
    """Adjacency (rows of node numbers, -1: none) and the medoid of some unit vectors."""
    n = len(unit)
    size = min(POOL, n - 1)
    medoid = int(np.argmax(unit @ unit.mean(axis=0)))
    if size <= 0:
        return np.full((n, 1), -1), medoid
    pool, close = np.zeros((n, size), np.int64), np.zeros((n, size))
    for i in range(0, n, 512):
        near = unit[i : i + 512] @ unit.T
        near[np.arange(len(near)), np.arange(i, i + len(near))] = -np.inf
        top = np.argpartition(-near, size - 1, axis=1)[:, :size]
        pool[i : i + 512], close[i : i + 512] = top, np.take_along_axis(near, top, axis=1)
    return robust_prune(unit, pool, close), medoid


#: Edges that are followed at a time.
FRONTIER = 20_000


@dataclass(frozen=True)
class Graph:
    """Adjacency of `n` nodes: the neighbours of a node are `target[offset[node] : offset[node + 1]]`."""

    offset: np.ndarray
    target: np.ndarray

    @staticmethod
    def of(source: np.ndarray, target: np.ndarray, n: int) -> Graph:
        """Edges in both directions, each once; a hub costs its edges and nothing else."""
        edges = np.unique(np.concatenate([source * n + target, target * n + source]))
        return Graph(np.searchsorted(edges, np.arange(n + 1) * n), edges % n)

    def parts(self, nodes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in `nodes`, neighbour) for all neighbours of `nodes`, a bounded number at a time."""
        first, count = self.offset[nodes], self.offset[nodes + 1] - self.offset[nodes]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        for low in range(0, total, FRONTIER):
            edge = np.arange(low, min(total, low + FRONTIER))
            place = np.searchsorted(ends, edge, "right")
            yield place, self.target[first[place] + edge - ends[place] + count[place]]


def range_search(unit: np.ndarray, graph: Graph, medoid: int, limit: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per batch of nodes: (query, found) pairs with cosine of `limit` or more, the query itself left out."""
    n = len(unit)
    for first in range(0, n, QUERIES):
        queries = np.arange(first, min(n, first + QUERIES))
        size = len(queries)
        seen = np.zeros((size, n), bool)
        near = np.zeros((size, n), bool)
        # greedy from the medoid
        at = np.full(size, medoid)
        best = np.einsum("ij,ij->i", unit[queries], unit[at])
        seen[np.arange(size), at] = True
        near[np.arange(size), at] = best >= limit
        moving = np.arange(size)
        while len(moving):
            step, value = at.copy(), best.copy()
            for place, node in graph.parts(at[moving]):
                row = moving[place]
                cosine = np.einsum("ij,ij->i", unit[node], unit[queries[row]])
                seen[row, node] = True
                near[row, node] |= cosine >= limit
                order = np.lexsort([cosine, row])
                last = order[np.append(row[order][1:] != row[order][:-1], True)]
                better = last[cosine[last] > value[row[last]]]
                step[row[better]], value[row[better]] = node[better], cosine[better]
            moving = moving[value[moving] > best[moving]]
            at, best = step, value
        # then outwards through what is in range
        seen[np.arange(size), queries] = near[np.arange(size), queries] = True
        row, node = np.nonzero(near)
        while len(row):
            fresh = np.zeros((size, n), bool)
            for place, neighbour in graph.parts(node):
                fresh[row[place], neighbour] = True
            fresh &= ~seen
            seen |= fresh
            row, node = np.nonzero(fresh)
            hit = np.zeros(len(row), bool)
            for low in range(0, len(row), FRONTIER):
                part = slice(low, low + FRONTIER)
                hit[part] = np.einsum("ij,ij->i", unit[queries[row[part]]], unit[node[part]]) >= limit
            row, node = row[hit], node[hit]
            near[row, node] = True
        near[np.arange(size), queries] = False
        row, node = np.nonzero(near)
        yield queries[row], node


def _ordered(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values("node").reset_index(drop=True)


def _built(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = _ordered(pdf)
    node = pdf["node"].to_numpy(np.int64)
    adjacency, _ = build(_unit(np.stack(pdf["embedding"].to_numpy())))
    return pd.DataFrame({"node": node, "near": [node[a[a >= 0]] for a in adjacency]})


def _searched(limit: float):
    def search(key, pdf: pd.DataFrame, graph: pd.DataFrame) -> pd.DataFrame:
        *_, shard, left, right = key
        pdf = _ordered(pdf)
        node, weight, chunk = (pdf[c].to_numpy(np.int64) for c in ("node", "weight", "chunk"))
        unit = _unit(np.stack(pdf["embedding"].to_numpy()))
        index = pd.Index(node)
        source = np.repeat(index.get_indexer(graph["node"].to_numpy(np.int64)), graph["near"].str.len().to_numpy(np.int64) if len(graph) else 0)
        target = index.get_indexer(np.concatenate([np.zeros(0, np.int64), *graph["near"]]).astype(np.int64))
        inside = (source >= 0) & (target >= 0)
        edges = Graph.of(source[inside], target[inside], len(node))
        medoid = int(np.argmax(unit @ unit.mean(axis=0)))
        shards = np.full((len(node), max(map(len, pdf["shards"]))), -1, np.int64)
        for i, s in enumerate(pdf["shards"]):
            shards[i, : len(s)] = s
        owned, whole, root = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64), np.arange(len(node))
        for query, found in range_search(unit, edges, medoid, limit):
            # whichever shard finds a link, it joins two components
            for q, start, end in zip(*_spans(query)):
                roots = np.unique(root[np.append(found[start:end], q)])
                if len(roots) > 1:
                    root[np.isin(root, roots[1:])] = roots[0]
            if left != right:
                cross = chunk[query] != chunk[found]
                query, found = query[cross], found[cross]
            np.add.at(whole, query, weight[found])
            # the first shard both lie in owns the pair
            first = np.full(len(query), np.iinfo(np.int64).max)
            for k in range(shards.shape[1]):
                own = shards[query, k]
                common = (own >= 0) & (shards[found] == own[:, None]).any(axis=1)
                first = np.minimum(first, np.where(common, own, first))
            mine = first == shard
            np.add.at(owned, query[mine], weight[found[mine]])
        some = (whole > 0) | (root != np.arange(len(node)))
        return pd.DataFrame({"node": node[some], "shard": np.int32(shard), "owned": owned[some], "whole": whole[some], "root": node[root[some]]})

    return search


def _spans(sorted_keys: np.ndarray):
    if not len(sorted_keys):
        return (), (), ()
    start = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return sorted_keys[start], start, np.append(start[1:], len(sorted_keys))


def vector_links(vectors: DataFrame, limit: float = 0.98, shards: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector.

    `shards` sets the number of centroids, which otherwise grows with the rows.
    """
    # doubles keep floats as they are, and make the arithmetic of the checks double
    numbers = F.col("embedding").cast("array<double>")
    fine = F.col("label").isNotNull() & (F.size(numbers) > 0) & F.forall(
        numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists(numbers, lambda x: x != 0)
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("int"), numbers.alias("embedding"), F.coalesce(fine, F.lit(False)).alias("fine")
    )
    same = F.when(F.col("fine"), F.sha2(F.concat_ws(",", "label", F.transform("embedding", lambda x: (x + F.lit(0.0)).cast("string"))).cast("binary"), 256))
    keyed = stage(rows.select("vec_id", "label", "embedding", same.alias("same")), "vectors")
    nodes = keyed.where("same is not null").groupBy("same").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    nodes = stage(nodes.withColumn("node", F.xxhash64("same")), "nodes")
    sample = nodes.select("embedding", F.size("embedding").alias("n")).orderBy(F.xxhash64("node")).limit(SAMPLE).collect()
    usual = max({r["n"] for r in sample}, key=[r["n"] for r in sample].count) if sample else 0
    centroids = fit_centroids([r["embedding"] for r in sample if r["n"] == usual], nodes.count(), shards)
    kept = [f for f in nodes.schema.fields if f.name in ("node", "label", "weight", "embedding")]
    placed = nodes.select(*[f.name for f in kept]).mapInPandas(
        _assigned(centroids), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", shards array<int>"
    )
    # vectors of different length never meet
    members = stage(placed.withColumn("shard", F.explode("shards")).withColumn("dims", F.size("embedding")), "members")
    where = ["label", "dims", "shard"]
    sizes = stage(members.groupBy(*where).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), "shards")
    members = members.join(sizes, where).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    members = members.withColumn("left", F.least("chunk", "other")).withColumn("right", F.greatest("chunk", "other"))
    members = stage(members.drop("chunks", "other"), "tasks")
    task = [*where, "left", "right"]
    lists = stage(members.groupBy(*task).applyInPandas(_built, "node long, near array<long>"), "adjacency")
    united = lists.select("node", F.explode("near").alias("n")).groupBy("node").agg(F.collect_set("n").alias("near"))
    graph = members.select(*[F.col(c).alias(f"{c}_") for c in task], F.col("node").alias("member")).join(
        united, F.col("member") == F.col("node")
    ).drop("member")
    found = members.groupBy(*task).cogroup(graph.groupBy(*[f"{c}_" for c in task])).applyInPandas(
        _searched(limit), "node long, shard int, owned long, whole long, root long"
    )
    found = stage(found, "vector-links")
    # every pair is owned by one shard; a single shard may still have found more than the owners did
    counts = found.groupBy("node", "shard").agg(F.sum("owned").alias("owned"), F.sum("whole").alias("whole"))
    counts = counts.groupBy("node").agg(F.greatest(F.sum("owned"), F.max("whole")).alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-groups")
    named = groups.join(nodes.select("node", "vec_id"), "node")
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    names = stage(
        nodes.select("same", "node", "vec_id", "weight").join(counts, "node", "left")
        .join(named.join(least, "component").select("node", "component_id"), "node", "left")
        .select("same", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")),
        "vector-names",
    )
    group = F.coalesce("component_id", "vec_id")
    kept = F.coalesce(F.col("vec_id") == group, F.lit(False))
    return keyed.select("vec_id", "same").join(names, "same", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), group).alias("component_id"), kept.alias("kept"),
    )


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and vector, in doubles, of the rows that can link."""
    numbers = F.col("embedding").cast("array<double>")
    fine = F.col("label").isNotNull() & (F.size(numbers) > 0) & F.forall(
        numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists(numbers, lambda x: x != 0)
    return vectors.where(fine).select(F.col("vec_id").cast("long"), F.col("label").cast("int"), numbers.alias("embedding"))


def recall(vectors: DataFrame, linked: DataFrame, limit: float = 0.98, every: int = 100, block: int = 500) -> float:
    """Share of brute-force links found, over all queries whose vec_id is divisible by `every`.

    Queries of one label and length are dealt into blocks of about `block`, and every row of the label and
    length meets each block in turn: a stated query set against all rows. Only counts leave a task.
    """
    rows = stage(_usable(vectors).withColumn("dims", F.size("embedding")), "usable")
    where = ["label", "dims"]
    queries = rows.where(F.col("vec_id") % every == 0)
    blocks = queries.groupBy(*where).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    blocks = stage(blocks, "query-blocks")
    queries = queries.join(blocks, where).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    parts = 16
    against = rows.join(blocks, where).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    against = against.withColumn("part", F.pmod(F.xxhash64("embedding"), F.lit(parts)).cast("int"))
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def count(pdf: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf) or not len(other):
            return pd.DataFrame({"n": np.zeros(0, np.int64)})
        unit, ids = _unit(np.stack(pdf["embedding"].to_numpy())), pdf["vec_id"].to_numpy()
        total = 0
        for low in range(0, len(other), 2_000):
            some = other.iloc[low : low + 2_000]
            near = unit @ _unit(np.stack(some["embedding"].to_numpy())).T >= limit
            total += int((near & (ids[:, None] != some["vec_id"].to_numpy())).sum())
        return pd.DataFrame({"n": [total]})

    task = [*where, "block", "part"]
    queries, against = stage(queries, "recall-queries"), stage(against, "recall-rows")
    true = queries.groupBy(*task).cogroup(against.groupBy(*task)).applyInPandas(count, "n long").agg(F.sum("n")).first()[0] or 0
    got = linked.where(F.col("vec_id") % every == 0).agg(F.sum("n_links")).first()[0] or 0
    return got / true if true else 1.0
