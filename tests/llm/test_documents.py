"""Operators over documents: edge cases, brute force, held-out accuracy, exact round trips."""

import hashlib
import math
import sys
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronage.llm import compression_model, exact_dedup, mixing, near_dedup, quality, tokens, word_ids
from patronage.llm.components import components
from patronage.llm.shared_strings import shared_strings
from patronage.llm.suffixes import suffix_array
from tests.llm.helpers import crc_mod, documents, edge_rows, groups, shingles, words


@pytest.fixture(scope="module")
def edges(spark):
    return documents(spark, edge_rows())


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


def test_suffix_arrays():
    random = np.random.default_rng(1)
    for n in range(60):
        text = bytes(random.choice(list(b"ab") if n % 2 else list(b"abcd"), n).tolist())
        assert list(suffix_array(text)) == sorted(range(n), key=lambda i: text[i:])


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (30, 30), *((50 + i, 51 + i) for i in range(20))]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = groups([x for x in links if x[0] != x[1]], {n for x in links for n in x if x[0] != x[1]})
    assert {r.node: r.component for r in found} == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_against_brute_force(spark, edges, small):
    for docs in (edges, spark.read.parquet(f"{small}/documents.parquet")):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        sets = {i: shingles(t) for i, t in rows}
        ids = sorted(sets)
        links = [
            (a, b)
            for k, a in enumerate(ids)
            for b in ids[k + 1 :]
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
        ]
        expected = groups(links, ids)
        found = near_dedup.near_duplicates(docs).collect()
        assert len(found) == len(rows)
        for r in found:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), expected[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_of_a_spread_group(spark, monkeypatch):
    """Copies with edits, dealt into several chunks: some are linked, some only through others."""
    monkeypatch.setattr(near_dedup, "CHUNK_SETS", 20)
    random = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(90):
        text = list(base)
        for at in random.choice(150, random.integers(0, 8), replace=False):
            text[at] = f"x{random.integers(1000)}"
        rows.append((i, " ".join(text), "s"))
    sets = {i: shingles(t) for i, t, _ in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    expected = groups(links, sets)
    found = near_dedup.near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert 1 < len(set(expected.values())) < 90


@pytest.mark.parametrize("percent", [80, 85])
def test_deduplicate_short_texts_against_brute_force(spark, percent):
    """Texts of 5 to 12 words, with a word more or less at an end."""
    random = np.random.default_rng(8)
    rows = []
    for n in range(5, 13):
        for k in range(6):
            base = [f"w{n}x{k}y{i}" for i in range(n)]
            rows += [(len(rows), " ".join(base), "s"), (len(rows) + 1, " ".join([*base, "more"][:12]), "s")]
            if random.integers(2):
                rows.append((len(rows), " ".join(["first", *base][:12]), "s"))
    sets = {i: shingles(t) for i, t, _ in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    assert any(len(sets[a]) in (4, 5) and sets[a] != sets[b] for a, b in links) == (percent == 80)
    expected = groups(links, sets)
    left = near_dedup.deduplicate(documents(spark, rows), percent=percent).collect()
    assert sorted(r.doc_id for r in left) == sorted(set(expected.values()))


def test_estimates_are_near_the_truth():
    random = np.random.default_rng(2)
    shared = random.integers(0, 2**63, 400).astype(np.uint64)
    own = [random.integers(0, 2**63, 100).astype(np.uint64) for _ in range(2)]
    sets = [np.unique(np.concatenate([shared, o])) for o in own]
    sketch = near_dedup.sketches(np.concatenate(sets), np.array([500, 500]))
    assert near_dedup.estimate(sketch[0], sketch[1:], 500, np.array([500]))[0] == pytest.approx(400 / 600, abs=0.12)


def brute_removal(rows, width=50):
    bodies = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in bodies:
        for k in range(len(b) - width + 1):
            s = b[k : k + width]
            first[s] = min(first.get(s, i), i)
    result = []
    for i, b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if first[b[k : k + width]] < i:
                gone[k : k + width] = b"\1" * width
        rest = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        result.append((i, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(result)


def removed(docs, **settings):
    rows = exact_dedup.remove_repeats(docs, **settings).collect()
    return sorted(
        (r.doc_id, r.n_bytes, sum(s.high - s.low for s in r.spans), len(r.spans), r.kept_sha256) for r in rows
    )


def test_removal_against_brute_force(spark, edges, small):
    rows = [r for r in edge_rows() if r[0] != 8]
    assert removed(documents(spark, rows)) == brute_removal([r[:2] for r in rows])
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert removed(docs, block_bytes=60_000) == brute_removal(rows)


def test_removal_of_periodic_and_overlapping_texts(spark):
    random = np.random.default_rng(3)
    pieces = ["ab" * 40, "a" * 70, "abc" * 30, "the quick brown fox jumps over the lazy dog again and again, " * 2]
    rows = [(i, "".join(random.choice(pieces, 3)) + str(i % 5), "s") for i in range(40)]
    assert removed(documents(spark, rows)) == brute_removal([r[:2] for r in rows])


@pytest.mark.parametrize("hot", [{"hot_blocks": 1}, {"hot_contexts": 1}, {}])
def test_removal_around_edits_and_hot_lines(spark, hot):
    """Copies with one changed place each, and a line that every text has, over many blocks."""
    random = np.random.default_rng(4)
    line = "All rights reserved, whatever this line may say to its readers today. "
    rows = []
    for i in range(60):
        text = " ".join(str(x) for x in random.integers(0, 10**6, 30)) if i < 20 else rows[i % 20][1]
        at = int(random.integers(0, len(text)))
        rows.append((i, (text[:at] + random.choice(list("xyz")) + text[at + 1 :]) if i >= 20 else text + line + text[: at % 40], "s"))
    rows += [(7, rows[3][1], "s"), (7, rows[3][1], "s")]
    docs = documents(spark, rows).repartition(5)
    assert removed(docs, block_bytes=1500, **hot) == brute_removal([r[:2] for r in rows])


def shared_by_force(contexts, before, doc, width, core):
    first, result = {}, {}
    strings = [
        (i, far, c[b : b + core], c[b - far : b - far + width])
        for i, (c, b) in enumerate(zip(contexts, before))
        for far in range(width - core + 1)
        if 0 <= b - far <= len(c) - width
    ]
    for i, *string in strings:
        first[tuple(string)] = min(first.get(tuple(string), doc[i]), doc[i])
    for i, far, *string in strings:
        if first[far, *string] < doc[i]:
            left, right = result.get(i, (far, width - core - far))
            result[i] = max(left, far), max(right, width - core - far)
    return result


def test_shared_strings_against_brute_force(monkeypatch):
    random = np.random.default_rng(5)
    for trial in range(150):
        width, core = [(6, 2), (10, 4), (50, 20)][trial % 3]
        monkeypatch.setattr("patronage.llm.shared_strings.CONTEXTS", int(random.choice([1, 5, 1000])))
        cores = [bytes(random.integers(97, 99, core).tolist()) for _ in range(3)]
        contexts, before, names = [], [], []
        for _ in range(int(random.integers(1, 50))):
            b, after = (int(random.choice([width - core, width - core, random.integers(0, width - core + 1)])) for _ in "ab")
            own = cores[int(random.integers(0, 3))]
            sides = [bytes(random.choice([0, 97, 98], n, p=[0.1, 0.85, 0.05]).tolist()) for n in (b, after)]
            contexts.append(sides[0] + own + sides[1])
            before.append(b)
            names.append(0 if trial % 2 else cores.index(own))  # unequal cores may have equal numbers
        doc = random.integers(0, 20, len(contexts))
        found = shared_strings(
            np.array(names), np.frombuffer(b"".join(contexts), np.uint8), np.array([len(c) for c in contexts]),
            np.array(before), doc, width, core,
        )
        assert {int(i): (int(a), int(z)) for i, a, z in zip(*found)} == shared_by_force(contexts, before, doc.tolist(), width, core)


def test_removal_sends_packed_rows(spark, small, monkeypatch):
    """What is staged has rows per block and bucket, not per string."""
    staged = {}

    def counted(df, name):
        staged[name] = stage(df, name)
        return staged[name]

    stage = exact_dedup.stage
    monkeypatch.setattr(exact_dedup, "stage", counted)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    removed(docs, block_bytes=60_000)
    assert all(rows.count() < 10 * docs.count() for rows in staged.values())


def near_copies(seed, n=240):
    """Texts of which each has one line in common with all, and a place that its copies have not."""
    random = np.random.default_rng(seed)
    line = "All rights reserved, whatever this line may say to its readers today. "
    texts = [" ".join(str(x) for x in random.integers(0, 10**6, 60)) + line for _ in range(n // 4)] * 4
    places = random.integers(0, 300, n)
    return [(i, t[:p] + str(i) + t[p + 1 :], "s") for i, (t, p) in enumerate(zip(texts, places))]


@pytest.mark.parametrize("hot", [{"hot_blocks": 1}, {"hot_contexts": 1}])
def test_removal_of_hot_strings_stages_little(spark, monkeypatch, hot):
    """Strings that are dealt one by one are staged once per block, and only around what contexts share."""
    rows = near_copies(6)
    staged = []
    stage = exact_dedup.stage

    def counted(df, name):
        staged.append(stage(df, name))
        return staged[-1]

    monkeypatch.setattr(exact_dedup, "stage", counted)
    docs = documents(spark, rows).repartition(4).cache()
    assert removed(docs, block_bytes=1 << 20, **hot) == brute_removal([r[:2] for r in rows])
    size = F.aggregate("parts", F.lit(0), lambda n, x: n + F.octet_length(x))
    sent = sum(df.agg(F.sum(size)).first()[0] or 0 for df in staged)
    assert sent < 6 * sum(len(t.encode()) for _, t, _ in rows)


def test_removal_drops_the_shuffles_of_what_is_staged(spark, monkeypatch):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {str(f) for f in spark._jvm.java.util.ArrayList(
        spark._jvm.scala.jdk.javaapi.CollectionConverters.asJavaCollection(disk.getAllFiles())
    ) if "/shuffle_" in str(f)}
    stage = exact_dedup.stage
    left = []

    def counted(df, name):
        before = shuffled()
        result = stage(df, name)
        for _ in range(20):  # they are dropped a moment later
            if not shuffled() - before:
                break
            time.sleep(0.2)
        left.append(shuffled() - before)
        return result

    monkeypatch.setattr(exact_dedup, "stage", counted)
    rows = near_copies(7, 40)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_before = spark.conf.get(name)
    assert removed(documents(spark, rows).repartition(3), block_bytes=4000) == brute_removal([r[:2] for r in rows])
    assert left and not any(left)
    assert spark.conf.get(name) == set_before


def test_removal_sends_few_bytes_of_copies():
    """Blocks of the same texts: an anchor's context takes less than 16 bytes, an answer less than one."""
    rows = near_copies(8, 60)[:15]  # each text once, in each block
    blocks = []
    for k in range(3):
        bodies = [t.encode() for _, t, _ in rows]
        ids = [i + 1000 * k for i, _, _ in rows]
        blocks.append(pd.DataFrame({"block": k, "doc_id": ids, "body": bodies, "row": ids}))
    size = lambda df: sum(len(x) for parts in df["parts"] for x in parts)
    shape = 50, 20, 1
    n = sum(len(exact_dedup._Block(b, *shape).at) for b in blocks)
    asked = pd.concat([exact_dedup._anchor_rows(*shape)(b) for b in blocks], ignore_index=True)
    cores = exact_dedup._repeated_rows(1024)(asked).assign(kind=exact_dedup.CORES)
    asked = pd.concat(
        [exact_dedup._context_rows(*shape)((k,), b, cores[cores["block"] == k]) for k, b in enumerate(blocks)], ignore_index=True
    )
    assert 9 * n < size(asked) < 16 * n
    contexts = exact_dedup._judged_rows(1 << 17)(asked)
    assert size(cores) + size(contexts) < n


@pytest.mark.parametrize("ids", [[5], [7, 7], [-(2**63), 2**63 - 1, 0], [2**40 + 300, 2**40, 2**40 + 1]])
def test_packed_ids_and_codes_come_back(ids):
    ids = np.array(ids, np.int64)
    assert exact_dedup._thick(exact_dedup._thin(ids), len(ids)).tolist() == ids.tolist()
    codes = (np.arange(len(ids) * 5) % 8).astype(np.uint8)
    assert exact_dedup._codes(exact_dedup._bits(codes, 3), 3, len(codes)).tolist() == codes.tolist()


def test_removal_without_rows_and_without_ids(spark, empty):
    assert removed(empty) == []
    rows = exact_dedup.remove_repeats(documents(spark, [(None, "y" * 60, "s"), (3, "y" * 60, "s")])).collect()
    assert {(r.doc_id, len(r.spans)) for r in rows} == {(None, 0), (3, 0)}


def brute_scores(rows, order=compression_model.ORDER):
    counts, contexts, total = Counter(), [defaultdict(Counter) for _ in range(order + 1)], 0
    stream = lambda w: b"\n" * order + " ".join(w).encode() + b"\n"
    for i, t in rows:
        w = words(t)
        if crc_mod(i, 7) != 2:
            counts.update([*w, "\n"])
            total += len(w) + 1
            s = stream(w)
            for at in range(order, len(s)):
                for k in range(order + 1):
                    contexts[k][s[at - k : at]][s[at]] += 1

    def log(s, at):
        seen, value = set(), 0.0
        for k in range(order, -1, -1):
            own = {a: n for a, n in contexts[k].get(s[at - k : at], {}).items() if a not in seen}
            if not own:
                continue
            if s[at] in own:
                return value + math.log10((2 * own[s[at]] - 1) / (2 * sum(own.values())))
            value += math.log10(len(own) / (2 * sum(own.values())))
            seen |= set(own)
        return value - math.log10(256 - len(contexts[0][b""]))

    result = {}
    for i, t in rows:
        w = words(t)
        s = stream(w)
        base = sum(math.log10((counts[x] + 1) / (total + len(counts) + 1)) for x in [*w, "\n"])
        known = sum(counts[x] > 0 for x in [*w, "\n"])
        result[i] = (len(w) + 1, known, total, base, sum(log(s, at) for at in range(order, len(s))))
    return result


def test_scores_against_brute_force(spark, edges, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("doc_id < 60")
    for frame in (docs, edges):
        rows = [(r.doc_id, r.text) for r in frame.collect()]
        expected = brute_scores(rows)
        found = compression_model.score(frame, compression_model.held_out(), block_bytes=20_000).collect()
        assert len(found) == len(rows)
        for r in found:
            e = expected[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == e[:3]
            assert (r.base_score, r.score) == pytest.approx(e[3:], rel=1e-9)
            assert r.held_out == (crc_mod(r.doc_id, 7) == 2)


def test_scores_of_many_buckets(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("doc_id < 60")
    expected = brute_scores([(r.doc_id, r.text) for r in docs.collect()])
    found = compression_model.score(docs, compression_model.held_out(), block_bytes=20_000, bucket_bytes=5_000).collect()
    for r in found:
        assert (r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][:3]
        assert (r.base_score, r.score) == pytest.approx(expected[r.doc_id][3:], rel=1e-9)


def test_keys_travel_packed():
    """A block sends some bytes per distinct string, not a row."""
    import pandas as pd

    random = np.random.default_rng(2)
    body = " ".join("".join(random.choice(list("etaoinshr"), random.integers(2, 9))) for _ in range(20_000)).encode()
    pdf = pd.DataFrame({"block": [7], "held_out": [False], "doc_id": [1], "body": [body]})
    rows = compression_model._block_features(5)(pdf)
    assert len(rows) == 10 and set(rows["block"]) == {7}
    stream = compression_model.Stream([body])
    for kind, all_keys in enumerate((stream.strings, stream.words)):
        part = rows[rows["kind"] == kind]
        keys, n = np.unique(all_keys, return_counts=True)
        found = [(compression_model._unpack_keys(k), compression_model._unpack(c)) for k, c in zip(part["keys"], part["n"])]
        found_keys, found_n = map(np.concatenate, zip(*found))
        order = np.argsort(found_keys)
        assert (found_keys[order] == keys).all() and (found_n[order] == n).all()
        sent = part["keys"].str.len().sum() + part["n"].str.len().sum()
        assert sent < (4 if kind == 0 else 9) * len(keys), sent / len(keys)


def test_scores_use_contexts_of_five_bytes(spark):
    """Only the fifth byte before the last one tells which one follows."""
    assert compression_model.ORDER >= 5
    rows = [(i, f"{'pq'[i % 2]}abcd{'xy'[i % 2]}", "s") for i in range(40)] + [(100, "pabcdx", "s"), (101, "pabcdy", "s")]
    found = compression_model.score(documents(spark, rows), F.col("doc_id") >= 100).collect()
    right, wrong = (next(r.score for r in found if r.doc_id == i) for i in (100, 101))
    assert right > wrong + 1


def test_scores_without_rows_or_training(spark, empty):
    assert compression_model.score(empty, compression_model.held_out()).count() == 0
    row = compression_model.score(documents(spark, [(1, "ab", "s")]), F.lit(True)).first()
    assert row.score == pytest.approx(3 * math.log10(1 / 256)) and row.train_tokens == 0


def test_probabilities_of_a_context_sum_to_one():
    text = b"abracadabra, abracadabra"
    order = compression_model.ORDER
    packed = [int.from_bytes(text[i : i + order + 1], "big") for i in range(len(text) - order)]
    keys, n = np.unique(packed, return_counts=True)
    pairs = np.zeros((256, 256))
    for key, count in zip(keys, n):
        pairs[key >> 8 & 255, key & 255] += count
    context = int.from_bytes(b"dabr", "big") << 8
    same = [k for k in keys if (k >> 8 & 65535) == (context >> 8 & 65535)]
    every = sorted({context | s for s in range(256)} | set(same))
    counts = dict(zip(keys.tolist(), n.tolist()))
    logs = compression_model.probabilities(
        np.array(every), np.array([counts.get(k, 0) for k in every], float), pairs
    )
    total = sum(10**v for k, v in zip(every, logs) if k >> 8 == context >> 8)
    assert total == pytest.approx(1.0, abs=1e-9)


def test_quality_on_held_out_rows(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").where(quality.held_out())
    rows = scored.select("score", "quality").collect()
    assert np.mean([(r.score >= 0.7) == (r.quality == 1) for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_of_odd_rows(spark, edges, empty):
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(13)] + [(0, None), (None, 1), (0, 0)], "doc_id long, quality int"
    )
    model = quality.train(edges, labels)
    scores = quality.score(edges, model).collect()
    assert len(scores) == len(edge_rows()) and all(0 <= r.score <= 1 for r in scores)
    assert quality.score(empty, model).count() == 0
    assert quality.train(empty, labels).score("text") == 0.5
    assert quality.train(edges, labels.where("quality = 1")).score("text") > 0.9


def test_token_counts_and_their_cache(spark, edges, empty, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    cache = str(tmp_path / "cache")
    for _ in range(2):
        found = tokens.token_counts(edges, cache=cache).collect()
        expected = sorted(
            (i, len((t or "").encode()), len(model.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in edge_rows()
        )
        assert sorted(tuple(r) for r in found) == expected
    distinct = len({t or "" for _, t, _ in edge_rows()})
    assert spark.read.parquet(cache).count() == distinct  # nothing was encoded twice
    other = tokens.token_counts(edges, tokenizer="piece_bpe_32k.model", cache=cache)
    assert other.count() == len(edge_rows())
    assert spark.read.parquet(cache).count() == 2 * distinct
    assert tokens.token_counts(empty).count() == 0


def test_token_counts_encode_a_distinct_word_once(monkeypatch):
    """Texts of the same words go to the library as their distinct words, not as whole texts."""
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    sent = []
    learn = word_ids.WordIds._learn
    monkeypatch.setattr(word_ids.WordIds, "_learn", lambda self, new: (sent.extend(new), learn(self, new)))
    monkeypatch.delitem(sys.modules, "word_ids_of_this_process", raising=False)
    texts = ["", *(" ".join(["alpha"] * n + ["beta, <|endoftext|>é", "É\x1f"]) for n in range(300)), "é" * 3000]
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts]), pa.array(texts)], names=["digest", "body"])
    found = pa.Table.from_batches(tokens._counter("byte_bpe_50k.json")([batch]))
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert found["n_tokens"].to_pylist() == [len(model.encode(t, add_special_tokens=False).ids) for t in texts]
    assert found["digest"].to_pylist() == batch.column(0).to_pylist()
    assert 0 < len(sent) < 20


def test_token_ids_round_trip(spark, edges, empty, tmp_path):
    import public_tokenizers
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    extra = [(20, "it's <|endoftext|>a, b.c ÉCOLE İstanbul don't 12ab é", "s")]
    docs = edges.unionByName(documents(spark, extra))
    folder = str(tmp_path / "ids")
    tokens.write_token_ids(docs, folder, file_bytes=50_000)
    found = tokens.read_digests(spark, folder).orderBy("start").collect()
    start = 0
    rows = sorted([*edge_rows(), *extra], key=lambda r: r[0])
    for r, (i, t, _) in zip(found, rows, strict=True):
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), crc)
        start += len(ids)
    files = sorted((tmp_path / "ids").glob("*.parquet"))
    assert len(files) > 1
    numbers, _, ids = (pq.ParquetFile(files[0]).metadata.row_group(0).column(k) for k in range(3))
    assert "DELTA_BINARY_PACKED" in numbers.encodings and "RLE_DICTIONARY" in ids.encodings
    assert numbers.has_column_index and ids.has_offset_index
    tokens.write_token_ids(empty, str(tmp_path / "none"))
    assert tokens.read_digests(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_remembered_words_equal_whole_texts(name, monkeypatch):
    """Random punctuation, controls, specials and letters against the library on whole texts."""
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    monkeypatch.setattr(word_ids, "KNOWN_WORDS", 5000)
    path = public_tokenizers.path(name)
    model = Tokenizer.from_file(path)
    texts = ['foo).', 'say "foo".', "the dogs'.", "50%, a*, it's. don't?!", "a\x1cb \x1d\x1e c\x1fd", "<|ENDOFTEXT|> <|endoftext|>.x", "İ. i̇."]
    texts += [f"b{chr(c)}. A{chr(c)}{chr(c)},; {chr(c)}?" for c in range(1, 0x3100)]
    pieces = [*"abzAZ09.,;:!?'\"()%*<|> \t\n\x0b\x1c\x1f\x85\xa0\u2003\u3000éÉßİıΣςÅ\u0301\u0307½٣中ǅ", "'s", "'RE", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "..."]
    random = np.random.default_rng(11)
    texts += ["".join(random.choice(pieces, random.integers(1, 40))) for _ in range(5_000)]
    texts += ["".join(random.choice([*pieces, " a", "\n", "$", "[", "]", "#", "_", "-"], random.integers(0, 40))) for _ in range(5_000)]
    encoder = word_ids.WordIds(path)
    assert encoder.kind
    found = []
    monkeypatch.setattr(word_ids, "SLICE_BYTES", 20_000)
    for low, high, ids, counts in encoder.encode(pa.array(["", *texts]).slice(1)):
        assert high - low == len(counts) and len(ids) == counts.sum()
        found += np.split(ids, np.cumsum(counts)[:-1])
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == model.encode(text, add_special_tokens=False).ids, text


def test_mixture_of_odd_rows(spark, edges, empty):
    rows = mixing.mix(edges).collect()
    assert len(rows) == len(edge_rows())
    sizes = Counter()
    for i, t, s in edge_rows():
        sizes[s] += len(words(t))
    for r in rows:
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size
        assert r.target <= 2 * r.source_size
    targets = {r.source: r.target for r in rows}
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 256 for s in targets)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(edges.repartition(5)).collect()))
    assert mixing.mix(empty).count() == 0


def test_mixture_as_documents(spark, edges):
    taken = {}
    for r in mixing.mix(edges).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    mixed = mixing.mixture(edges)
    assert mixed.columns == edges.columns
    found = Counter()
    for r in mixed.collect():
        found[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text) if r.text is not None else r.n_chars is None
    assert {i: n for i, n in taken.items() if n} == {i: n for i, n in found.items() if n}


def test_seats_go_to_the_highest_quotients(spark):
    weights = {"a": 5.0, "b": 3.1, "c": 0.4, "d": 0.0}
    parties = spark.createDataFrame([(n, w, 17) for n, w in weights.items()], "party string, weight double, seats long")
    found = {r.party: r.quota for r in mixing.apportion(parties, [], ["party"], "weight", "seats").collect()}
    quotients = sorted(((w / (2 * k + 1), n) for n, w in weights.items() for k in range(40) if w), key=lambda q: (-q[0], q[1]))
    assert found == {"d": 0} | Counter(n for _, n in quotients[:17])


def test_slices_of_words_need_little_memory():
    """Beside what is remembered, encoding takes little room, whatever the size of a batch."""
    import tracemalloc

    import public_tokenizers
    import pyarrow as pa

    text = "".join(f"wonderful{a} extraordinary{b} " for a in "abcdefgh" for b in "stuvw") + "\n"
    column = pa.array([text] * ((8 << 20) // len(text)))
    encoder = word_ids.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    list(encoder.encode(column.slice(0, 2)))
    tracemalloc.start()
    for _ in encoder.encode(column):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 28 << 20, most


def test_reading_ids_holds_no_words():
    """A worker process that wrote ids frees its words before it reads files back."""
    import public_tokenizers
    import pyarrow as pa

    words = word_ids.word_ids(public_tokenizers.path("word_bpe_49k.json"))
    list(words.encode(pa.array(["some words"])))
    columns = {"file": ["part-0"], "at": [0], "doc_id": [1], "ids": pa.array([[5, 1]], pa.list_(pa.int32()))}
    rows = pa.Table.from_batches(tokens._checksums(iter(pa.table(columns).to_batches())))
    assert rows["n_tokens"].to_pylist() == [2]
    assert rows["ids_crc32"].to_pylist() == [zlib.crc32(np.array([5, 1], "<u4").tobytes())]
    assert "word_ids_of_this_process" not in sys.modules


def test_ids_go_to_python_in_small_batches(spark, edges, tmp_path, monkeypatch):
    key, put = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(key)
    own = type(spark.conf).set
    monkeypatch.setattr(type(spark.conf), "set", lambda self, k, v: (put.append((k, v)), own(self, k, v))[1])
    tokens.write_token_ids(edges, str(tmp_path / "ids"))
    assert tokens.read_digests(spark, str(tmp_path / "ids")).count() == len(edge_rows())
    assert [v for k, v in put if k == key] == [str(tokens.BATCH_ROWS), before] * 2
    assert spark.conf.get(key) == before
