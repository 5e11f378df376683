"""Brute-force versions of operators, over rows held in memory."""

from __future__ import annotations

import re
import zlib

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, block long, row long, class string"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def documents(spark, rows):
    """A documents table with extra columns whose names operators use themselves."""
    full = [(i, t, "en", s, len(t) if t is not None else None, "k", 7, 8, "c") for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


def shingles(text: str | None) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def groups(links, nodes):
    """Least member of each node's component."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def crc_mod(doc_id, mod):
    return zlib.crc32(str(doc_id).encode()) % mod


def edge_rows():
    """Nulls, empty texts, repeats, ties and a very long text."""
    base = " ".join(f"word{i}" for i in range(120))
    return [
        (0, base, "a"),
        (1, base, "a"),
        (2, base.replace("word60 ", "other "), "b"),
        (3, None, None),
        (4, "", "a"),
        (5, " \t\n ", None),
        (6, "one two three", "b"),
        (7, "One TWO three", "b"),
        (8, " ".join(f"long{i % 9973}" for i in range(60_000)), "c"),
        (9, base.upper(), "c"),
        (10, "x" * 400, "c"),
        (11, "naïve café " * 30, "a"),
        (11, "naïve café " * 30, "a"),
    ]
