"""Packing of token ids into sequences of bounded length: shortest pack first over the histogram.

Every document is encoded once and its ids are staged. Whole sequences are cut off its front, and
what remains counts in a histogram of lengths, all that the driver ever sees. Lengths are placed
longest first: a length goes to the shortest pack that is open, many equal packs at a time, and
opens new packs when none has room. A pack is a pattern with a count, so the work depends on the
number of lengths and not on the number of documents. Packs with room left are then filled by
cutting up the emptiest of them; what remains of those makes sequences as long as powers of two,
which need no padding. Patterns come back to documents by the rank of a document among those with
the same remainder: an interval of ranks names the sequence and the place in it.

Null texts are empty and hold the end id alone. Rows that repeat a doc_id are documents of their
own. Rows without doc_id keep null. An empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.tokens import PARQUET, _small_batches, tokenizer_file
from patronage.llm.word_ids import release, utf8, word_ids
from patronage.staging import _application_folder, stage

#: Ids that leave a task in one batch, or those of one longer document.
BATCH_IDS = 1 << 20
RANK_BITS = 48


def _field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


_IDS = T.ArrayType(T.IntegerType(), False)
ENCODED = T.StructType(
    [_field(n, T.LongType()) for n in ("doc_id", "part", "length", "rank", "full_before", "n_tokens")]
    + [_field("ids", T.BinaryType())]  # 32-bit integers: no step between looks at them one by one
)
PIECES = T.StructType(
    [_field(n, T.LongType()) for n in ("doc_id", "start", "length")]
    + [_field("ids", _IDS)]
    + [_field(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset")]
)
DIGESTS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(4 * counts)]).astype(np.int64)
    data = pa.py_buffer(np.ascontiguousarray(values.astype("<i4", copy=False)))
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), data]).cast(pa.binary())


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _encode(name: str, end_id: int, size: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_file(name))
        part = TaskContext.get().partitionId()
        seen, full = np.zeros(size, np.int64), 0
        for batch in batches:
            for low, high, ids, counts in words.encode(batch.column(1)):
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)
                counts = counts + 1
                length, whole = counts % size, counts // size
                # rank among the task's rows of equal length: place in the sorted order less that of the first
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                rank = np.empty(len(length), np.int64)
                rank[order] = np.arange(len(order)) - np.searchsorted(ranked, ranked)
                rank += seen[length]
                seen += np.bincount(length, minlength=size)
                before = full + np.cumsum(whole) - whole
                full += int(whole.sum())
                columns = [np.full(len(counts), part, np.int64), length, rank, before, counts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), *map(pa.array, columns), _packed(ids, counts)],
                    names=ENCODED.names,
                )

    return encode


@dataclass
class Run:
    """Ids [low, high) of the remainders of one length, those of `n` ranks from `rank` on."""

    length: int
    low: int
    high: int
    rank: int
    n: int

    @property
    def size(self) -> int:
        return self.high - self.low

    def part(self, skip: int, n: int, cut: int = 0) -> Run:
        return Run(self.length, self.low + cut, self.high, self.rank + skip, n)


@dataclass
class Pattern:
    """`n` packs alike: a chain of (run, number of its first ranks that went to other packs)."""

    n: int
    fill: int = 0
    chain: tuple | None = None

    def split(self, n: int) -> tuple[Pattern, Pattern]:
        chain = self.chain and (self.chain[0], self.chain[1], self.chain[2] + n)
        return Pattern(n, self.fill, self.chain), Pattern(self.n - n, self.fill, chain)

    def add(self, run: Run) -> Pattern:
        """The same packs with one more piece each; `run` has as many ranks as there are packs."""
        return Pattern(self.n, self.fill + run.size, (self.chain, run, 0))

    def runs(self) -> Iterator[Run]:
        """Pieces, the last one first."""
        chain, skip = self.chain, 0
        while chain:
            chain, run, more = chain
            skip += more
            yield run.part(skip, self.n)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[Pattern]:
    """Patterns that hold every length below `size` as often as the histogram says."""
    room: list[list[Pattern]] = [[] for _ in range(size + 1)]
    most = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        if not 0 < length < size:
            continue
        most = size
        while left:
            while most >= length and not room[most]:
                most -= 1
            if most >= length:
                pattern = room[most].pop()
                if pattern.n > left:
                    pattern, rest = pattern.split(left)
                    room[most].append(rest)
                pattern = pattern.add(Run(length, 0, length, rank, pattern.n))
                rank, left = rank + pattern.n, left - pattern.n
                room[size - pattern.fill].append(pattern)
                continue
            # new packs, each filled with this length as often as it fits; one with the rest
            each = size // length
            for packs, times in ((left // each, each), (1, left % each)):
                if packs and times:
                    pattern = Pattern(packs)
                    for _ in range(times):
                        pattern = pattern.add(Run(length, 0, length, rank, packs))
                        rank += packs
                    room[size - pattern.fill].append(pattern)
            left = 0
    return [pattern for patterns in room for pattern in patterns]


def fill_up(patterns: list[Pattern], size: int) -> list[Pattern]:
    """The same pieces without padding: the emptiest packs are cut up to fill the others."""
    done = [p for p in patterns if p.fill & (p.fill - 1) == 0 or p.fill == size]
    open_ = sorted((p for p in patterns if not (p.fill & (p.fill - 1) == 0 or p.fill == size)), key=lambda p: -p.fill)
    room = sum((size - p.fill) * p.n for p in open_)
    loose: list[Run] = []
    content = 0
    while open_ and content < room:
        pattern = open_.pop()
        # each pack taken apart adds its content and takes away its room
        packs = min(pattern.n, -(-(room - content) // size))
        if packs < pattern.n:
            pattern, rest = pattern.split(packs)
            open_.append(rest)
        content += pattern.fill * packs
        room -= (size - pattern.fill) * packs
        loose += pattern.runs()
    # the most frequent pattern meets the most frequent run, so that few of either are split
    turn = count()
    packs_left = [(-p.n, next(turn), p) for p in open_]
    runs_left = [(-r.n, next(turn), r) for r in loose]
    heapify(packs_left)
    heapify(runs_left)
    while packs_left:
        pattern, run = heappop(packs_left)[2], heappop(runs_left)[2]
        n = min(pattern.n, run.n)
        if n < pattern.n:
            pattern, rest = pattern.split(n)
            heappush(packs_left, (-rest.n, next(turn), rest))
        if n < run.n:
            heappush(runs_left, (n - run.n, next(turn), run.part(n, run.n - n)))
        fits = min(run.size, size - pattern.fill)
        pattern = pattern.add(Run(run.length, run.low, run.low + fits, run.rank, n))
        if pattern.fill == size:
            done.append(pattern)
        else:
            heappush(packs_left, (-n, next(turn), pattern))
        if fits < run.size:
            heappush(runs_left, (-n, next(turn), run.part(0, n, fits)))
    loose = [run for _, _, run in runs_left]
    # less than one sequence remains: sequences as long as powers of two, the longest first
    left = sum(run.size * run.n for run in loose)
    singles = [Run(r.length, r.low, r.high, r.rank + i, 1) for r in loose for i in range(r.n)]
    while left:
        pattern, goal = Pattern(1), 1 << (left.bit_length() - 1)
        left -= goal
        while pattern.fill < goal:
            run = singles.pop()
            fits = min(run.size, goal - pattern.fill)
            pattern = pattern.add(Run(run.length, run.low, run.low + fits, run.rank, 1))
            if fits < run.size:
                singles.append(run.part(0, 1, fits))
        done.append(pattern)
    return done


class Places:
    """Where the remainder of a rank lies: its pieces, found by length and rank."""

    def __init__(self, patterns: list[Pattern], first_sequence: int):
        rows, sequence = [], first_sequence
        for pattern in patterns:
            end = pattern.fill
            for run in pattern.runs():
                end -= run.size
                rows.append((run.length, run.rank, run.n, run.low, run.high, sequence, end))
            sequence += pattern.n
        table = np.array(rows, np.int64).reshape(-1, 7)
        # ranks of a length are cut where any of its pieces begins or ends; between cuts all ranks are alike
        key = (table[:, 0] << RANK_BITS) + table[:, 1]
        self.key = np.unique(np.concatenate([key, key + table[:, 2]]))
        first, last = np.searchsorted(self.key, key), np.searchsorted(self.key, key + table[:, 2])
        times = last - first
        row = np.repeat(np.arange(len(table)), times)
        segment = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
        order = np.lexsort((table[row, 3], segment))
        row, segment = row[order], segment[order]
        self.low, self.high, self.at = table[row, 3], table[row, 4], table[row, 6]
        self.sequence = table[row, 5] + self.key[segment] - key[row]
        self.bounds = np.searchsorted(segment, np.arange(len(self.key) + 1))

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, low, high, sequence, offset) of all pieces of rows with a remainder."""
        rows = np.flatnonzero(length > 0)
        key = (length[rows] << RANK_BITS) + rank[rows]
        segment = np.searchsorted(self.key, key, "right") - 1
        first, times = self.bounds[segment], self.bounds[segment + 1] - self.bounds[segment]
        piece = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
        skip = np.repeat(key - self.key[segment], times)
        return np.repeat(rows, times), self.low[piece], self.high[piece], self.sequence[piece] + skip, self.at[piece]


def _cut(places: Places, size: int, digest: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # a reused worker process may hold the words of the stage that encoded
        for batch in batches:
            counts = batch.column("n_tokens").to_numpy()
            bounds = np.concatenate([[0], np.cumsum(counts)])
            at = 0
            while at < len(counts):
                end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BATCH_IDS, "right")) - 1)
                yield _pieces(batch.slice(at, end - at), places, size, digest)
                at = end

    return cut


def _pieces(batch: pa.RecordBatch, places: Places, size: int, digest: bool) -> pa.RecordBatch:
    number = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names if n not in ("doc_id", "ids")}
    tokens, length = number["n_tokens"], number["length"]
    ids = utf8(batch.column("ids"))[0].view("<i4")
    whole = tokens // size
    row = np.repeat(np.arange(len(tokens)), whole)
    turn = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
    owner, low, high, sequence, at = places.find(length, number["rank"] + number["base"])
    rest = (whole * size)[owner]
    rows = np.concatenate([row, owner])
    start = np.concatenate([turn * size, rest + low])
    count = np.concatenate([np.full(len(row), size), high - low])
    sequence = np.concatenate([(number["full_before"] + number["full_base"])[row] + turn, sequence])
    at = np.concatenate([np.zeros(len(row), np.int64), at])
    order = np.lexsort((start, rows))
    rows, start, count, sequence, at = (x[order] for x in (rows, start, count, sequence, at))
    # pieces of a row follow each other without gaps, so the ids lie in order already
    content = pa.array(_checksums(ids, count)) if digest else _lists(ids, count)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(pa.array(rows)), pa.array(start), pa.array(count), content,
            pa.array(tokens[rows]), pa.array(sequence), pa.array(at),
        ],
        names=["ids_crc32" if digest and n == "ids" else n for n in PIECES.names],
    )


def _checksums(ids: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of each piece's ids, as little-endian 32-bit integers."""
    data = memoryview(np.ascontiguousarray(ids.astype("<u4", copy=False))).cast("B") if len(ids) else memoryview(b"")
    ends = (4 * np.cumsum(count)).tolist()
    return np.array([zlib.crc32(data[a:z]) for a, z in zip([0, *ends[:-1]], ends)], np.int64)


def pack(
    docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0, size: int = 1024, digest: bool = False
) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset: one row per piece of a document.

    `start` counts the document's ids before the piece, `offset` the sequence's. Sequences hold at
    most `size` ids and are either as long as that or as a power of two. With `digest` the ids are
    left behind, and `ids_crc32` is the unsigned crc32 of them as little-endian 32-bit integers.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    encoded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # small row groups bound what a writer holds
    folder = f"{_application_folder(docs.sparkSession)}/packed-ids-{uuid.uuid4().hex}"
    with _small_batches(docs.sparkSession):
        encoded.mapInArrow(_encode(tokenizer, end_id, size), ENCODED).write.options(**PARQUET).parquet(folder)
    encoded = docs.sparkSession.read.schema(ENCODED).parquet(folder)
    counts = encoded.groupBy("part", "length").agg(
        F.count("*").alias("n"), F.sum(F.floor(F.col("n_tokens") / size)).alias("whole")
    )
    counts = stage(counts, "packed-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole_before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    wholes = counts.groupBy("part").agg(F.sum("whole").alias("whole")).select(
        "part", F.coalesce(F.sum("whole").over(whole_before), F.lit(0)).cast("long").alias("full_base")
    )
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("base"))
    bases = stage(bases.join(wholes, "part"), "packed-bases")
    # at most `size` lengths, whatever the number of documents
    histogram = {r["length"]: (r["n"], r["whole"]) for r in counts.groupBy("length").agg(F.sum("n").alias("n"), F.sum("whole").alias("whole")).collect()}
    patterns = fill_up(shortest_pack_first({k: n for k, (n, _) in histogram.items()}, size), size)
    places = Places(patterns, sum(whole for _, whole in histogram.values()))
    pieces = encoded.join(bases, ["part", "length"]).mapInArrow(_cut(places, size, digest), DIGESTS if digest else PIECES)
    if not digest:
        return pieces
    # some bytes per piece: staged, so that rows of ids go to Python few at a time
    with _small_batches(docs.sparkSession):
        return stage(pieces, "packed-digests")


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, ids, starts (where a piece begins), doc_ids: one row per sequence."""
    piece = F.struct("offset", "ids", F.coalesce("doc_id", F.lit(-1)).alias("doc_id"))
    parts = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("parts"))
    return parts.select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("starts"), F.col("parts.doc_id").alias("doc_ids")
    )
