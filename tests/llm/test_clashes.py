"""Extra columns whose names operators use themselves, repeated ids and rows, and the whole pipeline."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from patronage.llm import decontaminate, exact_dedup, mixing, near_dedup, quality, tokens
from patronage.staging import stage
from tests.llm.helpers import crc_mod, edge_rows, groups, shingles

#: Names that operators give to columns of their own.
NAMES = ("gone_id", "found_id", "size", "score", "digest", "class", "row", "place", "text_", "id", "n", "key", "weight", "rows", "judged", "span_", "row_")


def clashing(spark, rows):
    extra = ", ".join(f"`{n}` long" for n in NAMES)
    full = [(i, t, "en", s, None if t is None else len(t), *range(len(NAMES))) for i, t, s in rows]
    return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars int, {extra}")


def benchmark(spark, texts):
    rows = [(i, t, 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long, place long")


def test_clashing_columns(spark):
    docs = clashing(spark, edge_rows())
    items = benchmark(spark, [" ".join(f"word{i}" for i in range(20, 40)), None, "", "two words"])
    labels = spark.createDataFrame([(i, i % 2, 0, 9) for i in range(12)], "doc_id long, quality int, toxic int, score long")
    left = near_dedup.deduplicate(docs)
    assert left.columns == docs.columns
    clean = decontaminate.decontaminate(docs, items)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _, _ in edge_rows()} - {0, 1, 2, 9}
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    assert {r.gone_id for r in mixed.collect()} == {0}
    model = quality.train(docs, labels)
    scored = quality.score(docs, model, "score")
    assert sorted(scored.columns) == sorted(docs.columns)
    assert all(0 <= r.score <= 1 for r in scored.collect())
    assert exact_dedup.remove_repeats(docs).count() == docs.count()
    assert tokens.token_counts(docs).count() == docs.count()


def test_rows_that_share_an_id(spark):
    base = " ".join(f"word{i}" for i in range(60))
    near = base.replace("word30 ", "other ")
    unique = " ".join(f"single{i}" for i in range(60))
    rows = [
        (1, base, "a"), (5, near, "a"), (5, unique, "a"), (9, "twice the same text again here", "a"),
        (9, "twice the same text again here", "b"), (11, base, "a"), (12, "x y", "a"), (12, "x y", "a"),
        (13, None, "a"), (13, None, "a"), (13, "", "a"), (None, base, "a"), (None, base, "a"),
        (20, " ".join(f"many{i}" for i in range(50)), "a"), (20, " ".join(f"many{i}" for i in range(49)), "a"),
    ]
    left = near_dedup.deduplicate(clashing(spark, rows).repartition(3))
    found = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    many = [t for i, t, _ in rows if i == 20]
    kept = [t for i, t in found if i == 20]
    assert len(kept) == 1 and kept[0] in many
    rest = [(1, base), (5, unique), (9, rows[3][1]), (12, "x y"), (13, None), (13, ""), (None, base), (None, base)]
    assert [x for x in found if x[0] != 20] == sorted(rest, key=str)
    again = near_dedup.deduplicate(clashing(spark, rows[::-1]).repartition(1))
    assert sorted(map(str, again.collect())) == sorted(map(str, left.collect()))
    assert near_dedup.deduplicate(clashing(spark, [])).count() == 0


def test_rows_without_id_are_not_kept(spark):
    found = near_dedup.near_duplicates(clashing(spark, [(None, "some words are here", "a"), (3, None, "a")])).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in found} == {(None, None, False), (3, 3, True)}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with planted low quality, copies and benchmark passages, nulls and repeated rows."""
    random = np.random.default_rng(4)
    good = [f"good{i}" for i in range(300)]
    bad = [f"bad{i}" for i in range(300)]
    passage = " ".join(f"bench{i}" for i in range(30))
    rows = []
    for i in range(240):
        words = random.choice(good if i % 3 else bad, 60).tolist()
        rows.append((i, " ".join(words), "en", f"s{i % 4}"))
    rows += [(300 + i, rows[1 + 3 * i][1], "en", "s1") for i in range(20)]
    rows += [(400 + i, f"{rows[2 + 3 * i][1]} {passage}", "en", "s2") for i in range(10)]
    rows += [(500, None, "en", "s1"), (501, "", None, None), (None, rows[5][1], "en", "s1"), rows[7], rows[7]]
    place = tmp_path_factory.mktemp("corpus")
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{place}/documents.parquet")
    labels = [(i, int(i % 3 > 0), 0) for i in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return str(place), rows


def test_pipeline_stage_by_stage(spark, folder):
    place, rows = folder
    docs = spark.read.parquet(f"{place}/documents.parquet")
    columns = docs.columns
    outputs = {}
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, place), f"test-{name}")
        outputs[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    kept = [(r.doc_id, r.text) for r in outputs["quality_classifier"].collect()]
    assert {i for i, _ in kept if i is not None and i < 240} == {i for i in range(240) if i % 3}
    left = [(r.doc_id, r.text) for r in outputs["near_duplicates"].collect()]
    named = [(i, t) for i, t in kept if i is not None]
    sets = [shingles(t) for _, t in named]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    links += [(a, b) for a in range(len(named)) for b in range(a) if named[a] == named[b]]
    count = len(set(groups(links, range(len(named))).values()))
    assert len([x for x in left if x[0] is not None]) == count
    clean = {r.doc_id for r in outputs["benchmark_decontamination"].collect()}
    assert clean == {i for i, _ in left} - set(range(400, 410))
    mixed = outputs["source_mixture"].collect()
    assert {r.doc_id for r in mixed} <= clean
    ids = outputs["token_ids"].orderBy("start").collect()
    assert len(ids) == len(mixed)
    ends = np.cumsum([r.n_tokens for r in ids])
    assert [r.start for r in ids] == [0, *ends[:-1].tolist()]
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sums = sorted(zlib.crc32(np.array([*model.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for r in mixed)
    assert sums == sorted(r.ids_crc32 for r in ids)


def test_pipeline_of_empty_tables(spark, folder, tmp_path):
    place, _ = folder
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{place}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
