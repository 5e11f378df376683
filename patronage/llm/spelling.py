"""Groups of spelling variants: words one code point apart, found through a variable-length gram index.

Grams of three to six code points are counted over all distinct words. The dictionary keeps a gram
once few words hold it and lets a frequent one grow, so most lists of the index are short whatever
the words are. A word is cut in two halves, each decomposed into grams of the dictionary; one edit
touches grams of one half only, so words one edit apart share all grams of the other: the bound on
affected grams makes it enough to read one list per half, that of its first infrequent gram, and
merging the lists comes down to comparing words with that half in common. A half that holds
frequent grams alone has no short list. Its words are listed under the half and what the other half
is without one of its code points; as many words as there are letters can share that, whatever the
size of the corpus. Every pair is verified on the whole words, and is kept in the half that lies
before its first difference, or else in the other, so no pair comes twice.

Words of equal length meet in the class of that length, words whose lengths differ by one in the
class of the shorter. Null texts hold no words; a null doc_id counts as an empty one. Rows that
repeat a doc_id count again. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.word_ids import slices, utf8
from patronage.staging import stage

SLICE_BYTES = 2 << 20
LEAST_LENGTH = 7
SHORTEST_GRAM, LONGEST_GRAM = 3, 6
#: Words that may hold an infrequent gram, unless so many grams were frequent that the driver could not hold them.
LIST_WORDS = 100
#: Frequent grams of one length, at most: the driver and every task hold them.
FREQUENT_GRAMS = 50_000
#: Halves that are longer are listed whole: hardly any words share one, and each has many grams.
LONGEST_HALF = 32
#: Rows that a task holds, or one longer list, and code points that it compares at a time.
CHUNK_ROWS, CHUNK_POINTS = 50_000, 2_000_000


def _letters() -> np.ndarray:
    letters = np.zeros(256, bool)
    letters[[*range(65, 91), *range(97, 123)]] = True
    return letters


_LETTER = _letters()
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _drop(run: bytes, at: int) -> bytes:
    """The run of letters without its code point `at`."""
    text = run.decode()
    return (text[:at] + text[at + 1 :]).encode()


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end, row and code points of maximal runs of letters from A to U+00FF."""
    # a lead byte 0xC3 and its follower are the letters U+00C0 to U+00FF
    lead = data == 0xC3
    follower = np.zeros(len(data), bool)
    follower[1:] = lead[:-1]
    letter = _LETTER[data] | lead | follower
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], letter[:-1]])
    begin = np.flatnonzero(letter & (~before | edge[:-1]))
    after = np.concatenate([letter[1:], [False]])
    end = np.flatnonzero(letter & (~after | edge[1:])) + 1
    two = np.concatenate([[0], np.cumsum(lead)])
    return begin, end, np.searchsorted(offsets, begin, "right") - 1, end - begin - (two[end] - two[begin])


def _counted(spoil: int, least_length: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = ["" if i is None else i for i in batch.column(0).to_pylist()]
            salts = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.int64)
            data, offsets = utf8(batch.column(1))
            for low, high in slices(offsets, SLICE_BYTES):
                part = _FOLD[data[offsets[low] : offsets[high]]]
                begin, end, row, length = _runs(part, offsets[low : high + 1] - offsets[low])
                long = length >= least_length
                begin, end, row, length = begin[long], end[long], row[long], length[long]
                size = end - begin
                bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
                packed = part[np.repeat(begin - bounds[:-1], size) + np.arange(bounds[-1])]
                text, at = packed.tobytes(), bounds.tolist()
                crc = zlib.crc32
                salt = salts[low + row].tolist()
                hashes = np.fromiter([crc(text[a:z], s) for a, z, s in zip(at, at[1:], salt)], np.int64, len(row))
                spoiled = hashes % spoil == 0
                runs = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])
                changed = [
                    _drop(text[at[i] : at[i + 1]], int(hashes[i] % length[i]))
                    for i in np.flatnonzero(spoiled & (length > least_length)).tolist()
                ]
                words = pa.chunked_array([runs.filter(pa.array(~spoiled)), pa.array(changed, pa.large_binary())])
                counts = words.combine_chunks().value_counts()
                yield pa.RecordBatch.from_arrays(
                    [counts.field("values").cast(pa.large_string()).cast(pa.string()), counts.field("counts")], names=["word", "n"]
                )

    return count


def word_counts(docs: DataFrame, spoil: int = 31, least_length: int = LEAST_LENGTH, least_count: int = 2) -> DataFrame:
    """word, n: words of whole texts, in lower case from A to Z, one of `spoil` runs short of a code point."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    counts = rows.mapInArrow(_counted(spoil, least_length), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        for size in range(SHORTEST_GRAM, LONGEST_GRAM + 1):
            grams = [g for w in words for g in {w[p : p + size] for p in range(len(w) - size + 1)}]
            counts = pa.array(grams, pa.string()).value_counts()
            yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["gram", "n"])


def frequent_grams(words: DataFrame) -> set[str]:
    """Grams that more than LIST_WORDS words hold, or more where that would be too many grams."""
    total = words.agg(F.sum(F.char_length("word"))).first()[0] or 0
    # every word of length m holds fewer than m grams of one length, so fewer than this many are frequent
    least = max(LIST_WORDS, -(-total // FREQUENT_GRAMS))
    counts = words.select("word").mapInArrow(_gram_counts, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {row["gram"] for row in counts.where(F.col("n") > least).select("gram").collect()}


def _listed(half: str, frequent: set[str]) -> str | None:
    """Place and text of the first gram of a half that is not frequent; None if all are."""
    for at in range(len(half) - SHORTEST_GRAM + 1):
        for size in range(SHORTEST_GRAM, min(LONGEST_GRAM, len(half) - at) + 1):
            gram = half[at : at + size]
            if gram not in frequent:
                return f"{at}:{gram}"
    return None


ENTRY = "class int, side int, list long, half long, word string, n long"


def _entries(frequent: set[str], least_length: int):
    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, lists, halves = [], [], []
            for i, word in enumerate(pdf["word"].tolist()):
                for size in (len(word), len(word) - 1):
                    if size < least_length:
                        continue
                    cut = size // 2
                    for side in (0, 1):
                        # in the class of the shorter length the right half is counted from the end
                        half = word[:cut] if side == 0 else word[len(word) - (size - cut) :]
                        listed = _listed(half, frequent) if len(half) <= LONGEST_HALF else half
                        if listed is not None:
                            rows.append((i, size, side))
                            lists.append(f"{size}:{side}:{listed}")
                            halves.append(half)
                            continue
                        other = word[cut:] if side == 0 else word[: len(word) - (size - cut)]
                        short = {other[:j] + other[j + 1 :] for j in range(len(other))}
                        if len(word) == size:
                            marked = {f"{j}:{other[:j]}{other[j + 1:]}" for j in range(len(other))}
                            keys = [f"={key}" for key in marked] + [f"-{other}"]
                        else:
                            keys = [f"-{key}" for key in short]
                        rows += [(i, size, side)] * len(keys)
                        lists += [f"{size}:{side}:{half}{key}" for key in keys]
                        halves += [half] * len(keys)
            if rows:
                at, sizes, sides = (np.array(x, np.int64) for x in zip(*rows))
                yield pd.DataFrame(
                    {
                        "class": sizes.astype(np.int32),
                        "side": sides.astype(np.int32),
                        "list": pd.util.hash_array(np.array(lists, object)).view(np.int64),
                        "half": pd.util.hash_array(np.array(halves, object)).view(np.int64),
                        "word": pdf["word"].to_numpy()[at],
                        "n": pdf["n"].to_numpy()[at],
                    }
                )

    return entries


def _near(shorter: np.ndarray, other: np.ndarray, size: int, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether pairs of words are one edit apart, and where they first differ.

    Words are rows of code points, `size` of them in `shorter`, one more in `other` where `long`.
    """
    differ = np.concatenate([shorter != other[:, :size], np.ones((len(shorter), 1), bool)], 1)
    first = differ.argmax(1)
    places = np.arange(size)
    after = places > first[:, None]
    same = ~((shorter != other[:, :size]) & after).any(1) & (first < size)
    moved = ~((shorter != other[:, 1:]) & (places >= first[:, None])).any(1)
    return np.where(long, moved, same), first


def _pairs(chunk: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Near pairs of one chunk, ordered by class, list, half and length."""
    words, counts = chunk["word"].to_numpy(), chunk["n"].to_numpy()
    size, side = chunk["class"].to_numpy(), chunk["side"].to_numpy()
    columns = [size, side, chunk["list"].to_numpy(), chunk["half"].to_numpy()]
    new = np.zeros(len(chunk), bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    group_end = np.append(np.flatnonzero(new)[1:], len(chunk))[np.cumsum(new) - 1]
    own = chunk["length"].to_numpy()
    partners = np.where(own == size, group_end - np.arange(len(chunk)) - 1, 0)
    for length in np.unique(size[partners > 0]).tolist():
        rows = np.flatnonzero((size == length) & (partners > 0))
        class_rows = np.flatnonzero(size == length)
        first_row = class_rows[0]
        codes = np.zeros((len(class_rows), length + 1), np.uint32)
        flat = np.array(words[class_rows], dtype=f"U{length + 1}")
        codes[:] = flat.view(np.uint32).reshape(len(class_rows), length + 1)
        for low, high in slices(np.concatenate([[0], np.cumsum(partners[rows])]), CHUNK_POINTS // (length + 1)):
            left = np.repeat(rows[low:high], partners[rows[low:high]])
            begin = np.cumsum(partners[rows[low:high]]) - partners[rows[low:high]]
            right = left + 1 + np.arange(len(left)) - np.repeat(begin, partners[rows[low:high]])
            near, first = _near(codes[left - first_row][:, :length], codes[right - first_row], length, own[right] > length)
            keep = near & ((first >= length // 2) == (side[left] == 0))
            left, right = left[keep], right[keep]
            if len(left):
                yield pd.DataFrame({"word": words[left], "n": counts[left], "other": words[right], "other_n": counts[right]})


def _matched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Near pairs of a sorted partition, chunk by chunk; a list and half is never torn apart."""
    held: list[pd.DataFrame] = []
    rows = 0
    keys = ["class", "list", "half"]
    for pdf in batches:
        held.append(pdf)
        rows += len(pdf)
        if rows < CHUNK_ROWS:
            continue
        chunk = pd.concat(held, ignore_index=True)
        last = chunk[keys].iloc[-1]
        whole = ~((chunk[keys] == last).all(axis=1).to_numpy())
        cut = int(whole.sum())
        if cut:
            yield from _pairs(chunk.iloc[:cut])
        held, rows = [chunk.iloc[cut:]], len(chunk) - cut
    if rows:
        yield from _pairs(pd.concat(held, ignore_index=True))


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """word, n, other, other_n: every pair of words one edit apart, once. `words` must be staged.

    Words have at least `least_length` code points, twice the shortest gram and one more.
    """
    entries = words.mapInPandas(_entries(frequent_grams(words), least_length), ENTRY).withColumn("length", F.char_length("word"))
    order = ["class", "list", "half", "length", "word"]
    entries = entries.repartition("class", "list").sortWithinPartitions(*order)
    return entries.mapInPandas(_matched, "word string, n long, other string, other_n long")


def spelling_forms(docs: DataFrame, spoil: int = 31, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the documents.

    The form is the near word of largest n (ties: the smallest in code-point order) if that is at
    least `times` the word's own n. Since n grows along forms, they lead to a root without circles;
    each round of following doubles the steps taken.
    """
    words = stage(word_counts(docs, spoil), "words")
    pairs = stage(near_words(words), "near-words")
    both = pairs.union(pairs.select("other", "other_n", "word", "n"))
    best = F.min_by(F.struct("other", "other_n"), F.struct((-F.col("other_n")).alias("turned"), F.col("other").alias("text")))
    nearest = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = words.join(nearest, "word", "left").withColumn("takes", F.col("best.other_n") >= times * F.col("n"))
    rows = stage(
        rows.select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("takes"), F.col("best.other")).alias("form"),
            F.when(F.col("takes"), F.col("best.other_n")).alias("form_n"),
        ),
        "forms",
    )
    steps = stage(rows.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = stage(
            steps.join(further, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "roots",
        )
        if not steps.where("moved").limit(1).count():
            break
        steps = steps.select("word", "root")
    rows = rows.join(steps.select("word", "root"), "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
