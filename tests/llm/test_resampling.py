"""Importance resampling against a plain version, and the search for the cut-off on its own."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from patronage.llm import resampling
from patronage.staging import stage
from tests.llm.helpers import LOWER, documents, edge_rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return [zlib.crc32(r.encode()) % 10_000 for r in runs], len(words)


def expected(docs, target, percent):
    s, t = Counter(), Counter()
    for _, text, _ in docs:
        s.update(features(text)[0])
    for text in target:
        t.update(features(text)[0])
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))

    rows = []
    for doc_id, text, _ in docs:
        found, n_words = features(text)
        weight = sum(map(gain, found))
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), n_words, weight, score))
    able = sorted(r[2] >= 20 and (-r[4], r[0] is None, r[0] or 0) for r in rows if r[2] >= 20)
    drawn = able[: percent * len(able) // 100]
    return rows, drawn


@pytest.mark.parametrize("percent", [0, 5, 60, 100])
def test_against_plain_version(spark, percent):
    generator = random.Random(3)
    vocabulary = [*(f"w{i}" for i in range(60)), "Ünï", "中文", "a-b", "\x00c", "9", "X\x7fy"]
    docs = [*edge_rows(), (None, "no id " * 30, "s")]
    docs += [(i, " ".join(generator.choices(vocabulary, k=generator.randint(0, 60))), "s") for i in range(100, 400)]
    target = [" ".join(generator.choices(vocabulary[:20], k=30)) for _ in range(20)] + [None, ""]
    items = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id long, text string, score long")
    found = resampling.resample(documents(spark, docs).repartition(5), items, percent=percent).collect()
    rows, drawn = expected(docs, target, percent)
    assert sorted(((r.doc_id, r.n_features, r.n_words, r.weight, r.score) for r in found), key=str) == sorted(rows, key=str)
    ranked = sorted((r.rank, r.doc_id, r.score) for r in found if r.rank is not None)
    assert [r for r, _, _ in ranked] == list(range(1, len(drawn) + 1))
    assert [(-s, i is None, i or 0) for _, i, s in ranked] == drawn


def test_texts_of_separators_and_empty_tables(spark):
    docs = documents(spark, [(1, "--- !!! \x00", "s"), (2, None, "s")])
    empty = documents(spark, [])
    assert {(r.n_features, r.weight, r.rank) for r in resampling.resample(docs, empty, percent=100).collect()} == {(0, 0, None)}
    assert resampling.resample(empty, docs).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_cutoff_by_medians_alone(spark, partitions):
    generator = random.Random(partitions)
    # a third of all keys share one score, and rows repeat whole
    rows = [(-generator.choice([5, 5, generator.randint(0, 900)]), 0, generator.randint(0, 300), 1, i) for i in range(900)]
    schema = "turned long, id_is_null int, id long, digest long, place long"
    keys = stage(spark.createDataFrame(rows, schema).repartition(partitions), "test-keys")
    ordered = sorted(rows)
    for wanted in (1, 2, 45, 450, 899, 900):
        assert resampling.cutoff(keys, wanted, finish_keys=0) == ordered[wanted - 1]
        assert resampling.cutoff(keys, wanted) == ordered[wanted - 1]
    assert resampling.cutoff(keys, 0) is None
    assert keys.where(resampling._below(ordered[44], or_equal=True)).agg(F.count("*")).first()[0] == 45
