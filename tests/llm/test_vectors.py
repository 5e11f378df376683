"""Vector links against all pairs, over planted groups and many shards."""

from __future__ import annotations

import numpy as np
import pytest

from patronage.llm import vector_dedup
from patronage.llm.queries import op9_vector_links
from tests.llm.helpers import groups

SCHEMA = "vec_id long, embedding array<float>, label int, node long, shard int, weight long"


def brute_force(rows, limit=0.98):
    """Links per vector and its component, from all pairs of equal label and length."""
    usable = {}
    for place, (vec_id, vector, label) in enumerate(rows):
        v = np.array([np.nan if x is None else x for x in vector or []], float)
        if label is not None and len(v) and np.isfinite(v).all() and v.any():
            v = v / np.abs(v).max()
            usable.setdefault((label, len(v)), []).append((place, v / np.sqrt(v @ v)))
    links = set()
    for members in usable.values():
        places, units = [p for p, _ in members], np.stack([v for _, v in members])
        near = np.argwhere(np.triu(units @ units.T >= limit, 1))
        links |= {(places[a], places[b]) for a, b in near}
    return links


def planted(seed=1, dims=16):
    """Groups of near copies from two to 150 members in two labels, among scattered vectors."""
    random = np.random.default_rng(seed)
    rows = []
    for size in [2] * 60 + [5] * 30 + [20] * 6 + [150]:
        centre = random.normal(size=dims)
        for _ in range(size):
            noise = random.normal(size=dims) * random.choice([0.01, 0.05, 0.08])
            rows.append((centre + noise * np.linalg.norm(centre) / np.sqrt(dims), int(random.integers(2)) if size == 5 else 1))
    rows += [(random.normal(size=dims), int(random.integers(2))) for _ in range(700)]
    order = random.permutation(len(rows))
    return [(i, [float(np.float32(x)) for x in rows[j][0]], rows[j][1]) for i, j in enumerate(order)]


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, 3) for i, v, label in rows], SCHEMA)


@pytest.mark.parametrize("shards", [1, 25])
def test_planted_links_over_shards_and_chunks(spark, monkeypatch, shards):
    monkeypatch.setattr(vector_dedup, "CHUNK", 120)
    monkeypatch.setattr(vector_dedup, "FRONTIER", 500)
    rows = planted()
    links = brute_force(rows)
    assert len(links) > 1000
    vectors = table(spark, rows)
    linked = vector_dedup.vector_links(vectors, shards=shards).cache()
    found = {r.vec_id: r for r in linked.collect()}
    n = dict.fromkeys(range(len(rows)), 0)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert all(found[i].n_links <= n[i] for i in n)
    assert sum(r.n_links for r in found.values()) >= 0.99 * sum(n.values())
    component = groups(links, n)
    assert sum(found[i].component_id == component[i] for i in n) >= 0.99 * len(n)
    measured = vector_dedup.recall(vectors, linked, every=7, block=40)
    queried = [i for i in n if i % 7 == 0]
    assert measured == pytest.approx(sum(found[i].n_links for i in queried) / sum(n[i] for i in queried))
    linked.unpersist()


def test_odd_rows(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 4.01]
    rows = [
        (0, a, 1), (1, b, 1), (2, b, 2), (3, a, None), (4, None, 1), (5, [], 1), (6, [0.0] * 4, 1),
        (7, [1.0, None, 3.0, 4.0], 1), (8, [1.0, float("nan"), 3.0, 4.0], 1), (9, [float("inf"), 2.0, 3.0, 4.0], 1),
        (10, a[:3], 1), (11, [x * 1e30 for x in a], 1), (12, a, 1), (12, a, 1), (None, a, 1), (13, [-x for x in a], 1),
    ]
    found = sorted(map(tuple, vector_dedup.vector_links(table(spark, rows)).collect()), key=str)
    linked = {0, 1, 11, 12}
    assert len(found) == len(rows)
    for vec_id, n_links, component, kept in found:
        if vec_id is None:
            assert (n_links, component, kept) == (5, None, False)
        elif vec_id in linked:
            assert (n_links, component, kept) == (5, 0, vec_id == 0)
        else:
            assert (n_links, component, kept) == (0, vec_id, True)
    nothing = table(spark, rows).limit(0)
    assert vector_dedup.vector_links(nothing).count() == 0
    assert vector_dedup.recall(nothing, vector_dedup.vector_links(nothing)) == 1.0
    assert vector_dedup.recall(table(spark, rows), vector_dedup.vector_links(table(spark, rows)), every=1) > 0


def test_hub_of_near_copies(spark):
    """One group of a thousand: reverse edges of a hub are not padded to every node."""
    random = np.random.default_rng(2)
    centre = random.normal(size=32)
    rows = [(i, (centre + random.normal(size=32) * 0.02).astype(np.float32).astype(float).tolist(), 1) for i in range(1000)]
    links = brute_force(rows)
    found = vector_dedup.vector_links(table(spark, rows)).collect()
    assert sum(r.n_links for r in found) >= 0.99 * 2 * len(links) > 500_000
    assert {r.component_id for r in found} == {0}


def test_query_on_the_tables(spark, small):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    links = brute_force(rows)
    found = op9_vector_links(spark, small).collect()
    assert len(found) == len(rows)
    assert sum(r.n_links for r in found) <= 2 * len(links)
    assert sum(r.n_links for r in found) >= 0.9 * 2 * len(links)
