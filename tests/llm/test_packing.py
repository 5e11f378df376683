"""Packing: every id lies in one piece, sequences are full or as long as a power of two."""

import random
import sys
import zlib

import numpy as np
import pytest

from patronage.llm import packing, tokens, word_ids
from tests.llm.helpers import documents, edge_rows


def check(histogram, size):
    patterns = packing.fill_up(packing.shortest_pack_first(histogram, size), size)
    assert sum(p.fill * p.n for p in patterns) == sum(length * n for length, n in histogram.items())
    # nothing is padded, and sequences shorter than `size` are as few as one needs
    assert all(p.fill == size or p.fill & (p.fill - 1) == 0 for p in patterns)
    places = packing.Places(patterns, 1000)
    sequences, pieces = {}, 0
    for length, n in histogram.items():
        row, low, high, sequence, at = places.find(np.full(n, length), np.arange(n))
        covered = {}
        for r, a, z, s, o in zip(row.tolist(), low.tolist(), high.tolist(), sequence.tolist(), at.tolist()):
            covered.setdefault(r, []).append((a, z))
            sequences.setdefault(s, []).append((o, z - a))
            pieces += 1
        assert sorted(covered) == (list(range(n)) if length else [])
        for parts in covered.values():
            parts.sort()
            assert parts[0][0] == 0 and parts[-1][1] == length
            assert all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    assert sorted(sequences) == list(range(1000, 1000 + len(sequences)))
    for parts in sequences.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
    return patterns, pieces


def test_random_histograms():
    generator = random.Random(5)
    for trial in range(120):
        size = generator.choice([8, 16, 64, 1024])
        lengths = [generator.randint(0, size - 1) for _ in range(generator.randint(0, 40))]
        check({length: generator.choice([1, 2, 3, 10, 300]) for length in lengths}, size)


def test_shortest_pack_takes_the_next_length():
    patterns = packing.shortest_pack_first({6: 1, 5: 1, 2: 1}, 8)
    assert sorted([r.length for r in p.runs()] for p in patterns) == [[2, 5], [6]]


def test_a_hot_length_is_few_patterns():
    patterns, pieces = check({600: 30_000, 1: 20_000, 7: 3}, 1024)
    assert len(patterns) < 200
    # 424 of 1024 ids would be padding if nothing were cut
    assert pieces < 30_000 * 2 + 20_003 + 10
    big = packing.fill_up(packing.shortest_pack_first({i: 10**9 + i for i in range(1, 1024)}, 1024), 1024)
    assert len(big) < 50_000


@pytest.mark.parametrize("size", [1024, 16])
def test_documents_round_trip(spark, size):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [*edge_rows(), (12, "a <|endoftext|> b.\n\n c", "s"), (None, "no id", "s")]
    pieces = packing.pack(documents(spark, rows).repartition(3), size=size)
    found = pieces.collect()
    ids = {i: [*model.encode(t or "", add_special_tokens=False).ids, 0] for i, t, _ in rows}
    lengths = {}
    for r in found:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.length == len(r.ids) <= size
        assert r.ids == own[r.start : r.start + r.length]
        lengths.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in lengths.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end == size or end & (end - 1) == 0
    assert sum(r.length for r in found) == sum(len(ids[i]) for i, _, _ in rows)
    for i, own in ids.items():
        starts = sorted((r.start, r.length) for r in found if r.doc_id == i)
        times = sum(1 for j, _, _ in rows if j == i)
        assert sum(n for _, n in starts) == times * len(own)
    digests = packing.pack(documents(spark, rows).repartition(3), size=size, digest=True).collect()
    assert {(r.doc_id, r.start, r.ids_crc32) for r in digests} == {
        (r.doc_id, r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in found
    }
    whole = packing.sequences(pieces).collect()
    assert sum(len(r.ids) for r in whole) == sum(r.length for r in found)
    assert packing.pack(documents(spark, []), size=size).count() == 0


def test_words_are_freed_before_pieces_are_cut():
    word_ids.word_ids(tokens.tokenizer_file("byte_bpe_50k.json"))
    assert "word_ids_of_this_process" in sys.modules
    assert list(packing._cut(packing.Places([], 0), 1024, True)(iter([]))) == []
    assert "word_ids_of_this_process" not in sys.modules


def test_digests_go_to_python_in_small_batches(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(key), {}

    def staged(df, name):
        seen[name] = int(spark.conf.get(key))
        return stage(df, name)

    stage = packing.stage
    monkeypatch.setattr(packing, "stage", staged)
    assert packing.pack(documents(spark, edge_rows()), digest=True).count()
    assert seen["packed-digests"] == tokens.BATCH_ROWS and spark.conf.get(key) == before
