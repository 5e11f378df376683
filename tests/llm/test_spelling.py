"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from patronage.llm import spelling
from patronage.staging import stage
from tests.llm.helpers import LOWER, documents, edge_rows

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    """Whether one inserted, deleted or replaced code point leads from a to b."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(docs, spoil, times):
    counts = Counter()
    for doc_id, text, _ in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run if h % spoil else run[:at] + run[at + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    neighbours = {w: [o for o in words if abs(len(o) - len(w)) < 2 and near(w, o)] for w in words}
    forms = {}
    for word, others in neighbours.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= times * words[word]:
            forms[word] = best

    def root(word):
        while word in forms:
            word = forms[word]
        return word

    return {(w, forms.get(w), root(w), n, len(neighbours[w]), words[forms[w]] if w in forms else None) for w, n in words.items()}


def variants(generator, count):
    """Words of few letters, so that grams repeat, with variants of variants."""
    words = ["".join(generator.choices("abé", k=generator.randint(6, 11))) for _ in range(count)]
    for word in words[: count // 2]:
        at = generator.randrange(len(word))
        words += [word[:at] + word[at + 1 :], word[:at] + "c" + word[at:], word[:at] + "ÿ" + word[at + 1 :]]
    return words


@pytest.mark.parametrize("list_words", [100, 1, 0])
def test_against_all_pairs(spark, monkeypatch, list_words):
    """Also where every gram is frequent, so that all words take the way without short lists."""
    monkeypatch.setattr(spelling, "LIST_WORDS", list_words)
    monkeypatch.setattr(spelling, "CHUNK_ROWS", 500)
    monkeypatch.setattr(spelling, "CHUNK_POINTS", 3000)
    generator = random.Random(list_words)
    pool = variants(generator, 250)
    weights = [generator.choice([1, 1, 2, 40]) for _ in pool]
    docs = [*edge_rows(), (None, "nullable nullable nullabel nullabel nullable", "s")]
    docs += [(i, generator.choice([" ", "-", "1"]).join(generator.choices(pool, weights, k=200)).title(), "s") for i in range(100, 160)]
    docs += [(200 + i, "aa" * 60 + " " + "ab" * 200 + "a " + "ab" * 200, "s") for i in range(3)]
    found = spelling.spelling_forms(documents(spark, docs).repartition(3), spoil=5, times=3).collect()
    result = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found]
    assert len(result) == len(set(result))
    assert set(result) == expected(docs, 5, 3)
    assert any(r.root != r.form for r in found if r.form) and sum(r.n_near for r in found) > 100


def test_chain_of_forms_leads_to_the_last(spark):
    chain = ["tomorow", "tomorrow", "tomorrows", "tomorrowss"]
    text = " ".join(w + " " + " ".join([w] * (3 * 4**i - 1)) for i, w in enumerate(chain))
    found = {r.word: r for r in spelling.spelling_forms(documents(spark, [(1, text, "s")]), spoil=10**12, times=4).collect()}
    assert {r.root for r in found.values()} == {"tomorrowss"}
    assert found["tomorow"].form == "tomorrow" and found["tomorrowss"].form is None


def test_pairs_come_once(spark):
    words = stage(spark.createDataFrame([(w, 5) for w in ("aaaaaaa", "aaaaaaaa", "aaaaaab", "baaaaaa")], "word string, n long"), "test-words")
    pairs = [frozenset((r.word, r.other)) for r in spelling.near_words(words).collect()]
    assert len(pairs) == len(set(pairs)) == 3


def test_empty_tables(spark):
    assert spelling.spelling_forms(documents(spark, [])).count() == 0
    assert spelling.spelling_forms(documents(spark, [(1, None, None), (2, "", "a"), (3, "short words only", "a")])).count() == 0
