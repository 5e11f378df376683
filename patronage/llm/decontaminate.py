"""Benchmark decontamination by template windows.

Texts become words without case and punctuation. Numbers, units after a number, and names
(capitals) become typed placeholders, so a question that is asked again with other numbers or names
gives the same template. Windows of `width` template words of documents and items are joined by
hash, in three readings: with names as words, with capitals inside a sentence as names, and with
capitals at its beginning as names too.

Windows of a document that match an item at one offset are laid together. They are evidence if they
cover `cover` words of the item, or all of it, by words that are literally the same, wherever the
other slots differ; or by words with consistent slots (equal fillers in the item stand for equal
fillers in the document, and different ones for different ones), in the whole or in one run of
windows. Rows that share an id but not the text are laid by themselves.

Before the join, documents are probed with a bitmap of the items' windows. The bitmap has a fixed
size, so what is broadcast is bounded; when it fills up, more rows reach the join, nothing else.

Nulls: null texts are empty, rows without doc_id or item_id are left out. Items of fewer than
`LEAST` words are too short to be evidence and match nothing; items shorter than a window are one
window. Repeated rows of a document give one result row per (doc_id, item_id).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.blocks import ByteHash, slices, splitmix
from patronage.staging import stage

LEAST = 5
BITMAP_BITS = 24
NUMBER, UNIT, NAME = 1, 2, 3
#: Words that are units when they follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds "
    "oz ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours "
    "day days week weeks month months year years meter meters metre metres kilometer kilometers kilometre kilometres kmh mph percent "
    "dollar dollars cent cents euro euros usd eur c f degree degrees w kw v hz kb mb gb tb"
).split()

_hash = ByteHash(21)
_table = np.arange(256)
_alnum = (_table >= 128) | ((_table >= 48) & (_table <= 57)) | ((_table >= 97) & (_table <= 122))
_digit = (_table >= 48) & (_table <= 57)
_space = np.isin(_table, [9, 10, 11, 12, 13, 32])
_stop = np.isin(_table, np.frombuffer(b".!?:\n", np.uint8))


#: Characters that take another number of bytes in lower case.
_resized = re.compile("[" + "".join(c for c in map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x20000))) if len(c.lower().encode()) != len(c.encode())) + "]")


def _lowered(text: str) -> tuple[bytes, np.ndarray]:
    """UTF-8 in lower case, and which of its bytes belong to characters that were capitals."""
    small = text.lower().encode("utf-8", "replace")
    if text.isascii() or not _resized.search(text):
        raw = text.encode("utf-8", "replace")
        if len(raw) == len(small):
            return small, np.frombuffer(raw, np.uint8) != np.frombuffer(small, np.uint8)
    sizes = [len(c.lower().encode("utf-8", "replace")) for c in text]
    changed = np.repeat(np.fromiter((c != c.lower() for c in text), bool, len(text)), sizes)
    return small, changed if len(changed) == len(small) else np.zeros(len(small), bool)


class Words:
    """Template words of some texts end to end."""

    def __init__(self, texts: list[str]):
        # a NUL ends a text; inside one it is white space
        lowered = [_lowered(t.replace("\0", " ")) for t in texts]
        small = np.frombuffer(b"\0".join(x for x, _ in lowered), np.uint8)
        border = np.zeros(1, bool)
        capital = np.concatenate([border, *(x for _, c in lowered for x in (c, border)), np.zeros(3, bool)])[1:]
        space = _space[small] | (small == 0)
        keep = _alnum[small]
        at = np.flatnonzero(keep)
        if not len(at):
            self.word = self.doc = np.zeros(0, np.int64)
            self.literal = self.plain = self.named = self.initial = np.zeros(0, np.uint64)
            self.slots = [np.zeros(0, np.int8)] * 3
            return
        gaps = np.cumsum(space)[at]
        first = np.flatnonzero(np.concatenate([[True], gaps[1:] != gaps[:-1]]))
        data = small[at]
        sums = _hash.prefix(data)
        last = np.append(first[1:], len(data))
        self.literal = splitmix(_hash.ranges(sums, first, last)) & ~np.uint64(7)
        self.doc = np.cumsum(small == 0)[at[first]] if len(texts) > 1 else np.zeros(len(first), np.int64)
        digits = np.add.reduceat(_digit[data].astype(np.int64), first)
        number = _digit[data[first]] | (digits == last - first)
        after_number = np.concatenate([[False], number[:-1] & (self.doc[1:] == self.doc[:-1])])
        unit = after_number & np.isin(self.literal, _units())
        head = at[first]
        name = capital[head]
        for k, lead in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):  # letters of several bytes may differ in a later one
            name |= (small[head] >= lead) & capital[head + k]
        name &= ~number & ~unit
        stops = np.cumsum(_stop[small] | (small == 0))
        begins = np.concatenate([[True], stops[head[1:]] != stops[head[:-1]]])
        fixed = np.select([number, unit], [NUMBER, UNIT], 0)
        self.slots = [np.where(names, NAME, fixed).astype(np.int8) for names in (np.zeros(len(name), bool), name & ~begins, name)]
        self.plain, self.named, self.initial = (np.where(x > 0, x.astype(np.uint64), self.literal) for x in self.slots)
        starts = np.searchsorted(self.doc, np.arange(len(texts)))
        self.word = np.arange(len(self.doc)) - starts[self.doc]

    def windows(self, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(first words, hashes, reading) of windows inside one text; those with names where there are any."""
        n = len(self.doc) - width + 1
        if n <= 0:
            return
        inside = self.doc[:n] == self.doc[width - 1 :]
        plain = _window(self.plain, width)
        yield np.flatnonzero(inside), plain[inside], 0
        for reading, symbols in ((1, self.named), (2, self.initial)):
            named = _window(symbols, width)
            other = inside & (named != plain)
            yield np.flatnonzero(other), named[other], reading


def _window(symbols: np.ndarray, width: int) -> np.ndarray:
    total = np.zeros(len(symbols) - width + 1, np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + symbols[k : k + len(total)]
    return splitmix(total)


def _units() -> np.ndarray:
    global _unit_hashes
    if _unit_hashes is None:
        data = np.frombuffer("".join(UNITS).encode(), np.uint8)
        ends = np.cumsum([len(u) for u in UNITS])
        starts = np.concatenate([[0], ends[:-1]])
        _unit_hashes = splitmix(_hash.ranges(_hash.prefix(data), starts, ends)) & ~np.uint64(7)
    return _unit_hashes


_unit_hashes: np.ndarray | None = None

WINDOW = "id long, version long, reading int, width int, place int, key long, literal array<long>, slot array<byte>"


def _window_rows(ids: np.ndarray, versions: np.ndarray, texts: list[str], widths, bitmap: np.ndarray | None, whole: bool) -> pd.DataFrame:
    """Rows of WINDOW; `whole`: only windows as wide as the text is, if it is shorter than the widest."""
    words = Words(texts)
    lengths = np.bincount(words.doc, minlength=len(texts))
    parts = []
    for width in widths:
        for first, key, reading in words.windows(width):
            ok = np.ones(len(first), bool)
            if whole:
                own = lengths[words.doc[first]]
                ok = (own == width) | ((own > width) & (width == max(widths)))
            if bitmap is not None:
                bit = key >> np.uint64(64 - BITMAP_BITS)
                ok &= (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)) > 0
            first, key = first[ok], key[ok]
            if len(first):
                spans = first[:, None] + np.arange(width)
                slot = words.slots[reading]
                parts.append(pd.DataFrame({
                    "id": ids[words.doc[first]], "version": versions[words.doc[first]], "reading": reading, "width": width, "place": words.word[first],
                    "key": key.view(np.int64), "literal": list(words.literal.view(np.int64)[spans]),
                    "slot": list(slot[spans]), "length": lengths[words.doc[first]],
                }))
    return pd.concat(parts) if parts else pd.DataFrame(columns=["id", "version", "reading", "width", "place", "key", "literal", "slot", "length"])


def _rows(widths, bitmap, whole: bool):
    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, versions, texts = pdf["id"].to_numpy(np.int64), pdf["version"].to_numpy(np.int64), pdf["text"].tolist()
            for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), 1 << 19):
                rows = _window_rows(ids[i:j], versions[i:j], texts[i:j], widths, bitmap, whole)
                if len(rows):
                    yield rows

    return windows


def _texts(df: DataFrame, key: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return df.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("version"), text.alias("text")).where("id is not null")


def _evidence(words: Column) -> Column:
    """Numbers of words and of slots among them."""
    return F.struct(F.size(words).alias("n_words"), F.size(F.filter(words, lambda w: w["slot"] > 0)).alias("n_slots"))


def _consistent(words: Column) -> Column:
    """As `_evidence`, noughts unless fillers stand for each other one to one."""
    slots = F.filter(words, lambda w: w["slot"] > 0)
    kinds = lambda *names: F.size(F.array_distinct(F.transform(slots, lambda w: F.struct(*[w[n].alias(n) for n in names]))))
    pairs = kinds("slot", "literal", "item_literal")
    fits = (pairs == kinds("slot", "literal")) & (pairs == kinds("slot", "item_literal"))
    return F.when(fits, _evidence(words)).otherwise(F.struct(F.lit(0).alias("n_words"), F.lit(0).alias("n_slots")))


def matches(docs: DataFrame, benchmark: DataFrame, width: int = 8, cover: int = 13) -> DataFrame:
    """doc_id, item_id, n_words of the item found, item_words, n_slots, exact (fillers all the same)."""
    spark = docs.sparkSession
    sizes = tuple(range(LEAST, width + 1))
    items = stage(_texts(benchmark, "item_id").mapInPandas(_rows(sizes, None, True), WINDOW + ", length long"), "windows")
    bit = F.shiftrightunsigned("key", 64 - BITMAP_BITS)
    filled = items.select("width", F.shiftright(bit, 6).alias("cell"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - BITMAP_BITS}) & 63 as int))").alias("bit"))
    cells = filled.groupBy("cell").agg(F.bit_or("bit").alias("bits")).collect()  # at most 2^18 rows
    widths = tuple(sorted(r[0] for r in filled.select("width").distinct().collect()))
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for cell, bits in cells:
        bitmap[cell] = bits
    bitmap = bitmap.view(np.uint64)
    hits = _texts(docs, "doc_id").mapInPandas(_rows(widths, bitmap, False), WINDOW + ", length long")
    # One row per distinct window: items that share it come together, and repeats in a document are one.
    keys = ["key", "reading", "width"]
    items = items.select(*keys, F.col("id").alias("item_id"), F.col("version").alias("item_version"), F.col("place").alias("item_place"), F.col("literal").alias("item_literal"), F.col("slot").alias("item_slot"), F.col("length").alias("item_words"))
    hits = hits.select(*keys, F.col("id").alias("doc_id"), "version", "place", "literal", "slot")
    pairs = hits.join(items, keys).where("slot = item_slot")
    alignment = ["doc_id", "version", "item_id", "item_version", "item_words", "reading", "offset"]
    words = pairs.select(
        *alignment[:-1], (F.col("place") - F.col("item_place")).alias("offset"),
        F.explode(F.arrays_zip("literal", "item_literal", "slot", F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda k: k + F.col("item_place")).alias("at"))).alias("w"),
    ).select(*alignment, "w.at", "w.slot", "w.literal", "w.item_literal")
    laid = words.groupBy(*alignment).agg(F.sort_array(F.collect_set(F.struct("at", "slot", "literal", "item_literal"))).alias("words"))
    enough = F.least(F.lit(cover), F.col("item_words"))
    laid = laid.where(F.size("words") >= enough)
    # words next to each other have the same place less their number in order
    runs = F.array_distinct(F.transform("words", lambda w, i: w["at"] - i))
    alone = F.transform(runs, lambda r: _consistent(F.filter("words", lambda w, i: w["at"] - i == r)))
    same = F.filter("words", lambda w: w["literal"] == w["item_literal"])
    evidence = F.array_max(F.concat(F.array(_consistent(F.col("words")), _evidence(same)), alone))
    laid = laid.select(
        "doc_id", "item_id", "item_words", enough.alias("enough"), evidence.alias("evidence"), (F.size(same) == F.size("words")).alias("exact")
    ).where("evidence.n_words >= enough")
    return laid.groupBy("doc_id", "item_id").agg(
        F.max("evidence.n_words").cast("long").alias("n_words"), F.max("item_words").alias("item_words"),
        F.max_by("evidence.n_slots", "evidence.n_words").cast("long").alias("n_slots"), F.bool_or("exact").alias("exact"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """`docs` without those that hold a benchmark item; rows without doc_id stay."""
    found = matches(docs, benchmark, **settings).select(F.col("doc_id").alias("found_id")).distinct()
    found = stage(found, "contaminated")
    return docs.alias("rows").join(
        found.alias("found"), F.col("rows.doc_id").cast("long") == F.col("found.found_id"), "left_anti"
    )
