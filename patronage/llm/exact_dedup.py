"""Removal of byte strings that an earlier document already has.

A byte goes if some string of `width` bytes that covers it also starts in a document with a
smaller id. Strings are judged on the input and never cross documents.

1. Every `width`-byte string holds at least one *anchor*: the `core` bytes in it with the least
   hash. Anchors depend on the string alone, so equal strings share theirs. Only anchors seen in
   more than one document matter further; about one byte in sixteen is an anchor. Blocks send
   theirs packed by bucket, four bytes each; a chance match costs work and changes nothing.
2. The *context* of an anchor is all that any string with this anchor can hold. Where a whole
   context is in an earlier document, everything in it goes. Copies collapse here, so what
   follows sees one document per context.
3. A string around an anchor holds one of three longer *pieces* around it. Of the contexts left
   over, only those matter further that have a piece that another context has too.
4. A shared string holds its anchor in both documents, so contexts of one core are all that need
   comparing. Blocks send the contexts that matter to the core's bucket; a suffix array, built by
   linear grouping over the parts in which contexts agree (`shared_strings`), brings equal strings
   together. How far they reach goes back to the blocks. Contexts of a core that very many blocks
   or contexts have would make a large bucket: of these the strings around shared pieces are dealt
   one by one, each once per block, and meet by 128-bit digests.

What travels is packed: one row per block and bucket, or per block. A block sends sorted keys, and
a bucket answers with bits in the order of the keys; the block finds the same keys again. Each step
is staged, and its shuffles are dropped, before the next one starts.

Null texts are empty. Rows without doc_id keep their text and remove nothing from others. Rows
that repeat a doc_id do not remove from each other. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.blocks import ByteHash, slices, splitmix, stage_blocks
from patronage.llm.shared_strings import flat, shared_strings
from patronage.staging import short_shuffles, stage

BATCH_BYTES = 512 << 10
#: Anchors that one task compares.
ANCHORS = 1 << 20
_hash, _other = ByteHash(11), ByteHash(12)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over x[i : i + width] for every i with a whole window."""
    have, result, at = 1, x, 0
    out = None
    rest = width
    while rest:
        if rest & have:
            part = result[at : at + len(x) - width + 1]
            out = part.copy() if out is None else pick(out, part)
            at += have
            rest -= have
        if rest:
            result = pick(result[: len(result) - have], result[have:])
            have *= 2
    return out


class _Batch:
    """Some documents end to end, with the anchors of their strings."""

    def __init__(self, bodies: list[bytes], width: int, core: int):
        self.width, self.core = width, core
        self.raw = b"".join(bodies)
        self.data = np.frombuffer(self.raw, np.uint8)
        lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
        self.end = np.cumsum(lengths)
        self.start = self.end - lengths
        self.sums = _hash.prefix(self.data)
        self.anchor = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.uint64)
        self.doc = np.zeros(0, np.int64)
        n = len(self.data)
        if n < width:
            return
        # the ranges of _hash, all of them and without an index
        hashes = (self.sums[core:] - self.sums[:-core]) * _hash.back[: n - core + 1]
        # half of a number is enough to choose by; equal ones are anchors together
        own = (hashes * _MIX >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        span = width - core + 1
        least = _sliding(own, span, np.minimum)
        for a, z in zip(self.start, self.end):  # strings that cross documents have no anchor
            least[max(0, max(a, z - width + 1)) : z] = 0
        padded = np.concatenate([np.zeros(span - 1, np.uint32), least, np.zeros(span - 1, np.uint32)])
        is_anchor = _sliding(padded, span, np.maximum)[: len(own)] == own
        self.anchor = np.flatnonzero(is_anchor)
        self.key = splitmix(hashes[self.anchor]) | np.uint64(1)
        self.doc = np.searchsorted(self.end, self.anchor, side="right")

    def bounds(self, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.maximum(at - (self.width - self.core), self.start[doc])
        return low, np.minimum(at + self.width, self.end[doc])

    def contexts(self, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
        low, high = self.bounds(at, doc)
        shape = ((at - low) * 1024 + (high - at)).astype(np.uint64)
        return splitmix(_hash.ranges(self.sums, low, high) ^ splitmix(shape))


def _batches(pdf: pd.DataFrame, width: int, core: int):
    """(ids, rows, batch) over the documents of a block that can matter."""
    pdf = pdf[pdf["doc_id"].notna() & (pdf["body"].str.len() >= width)]
    bodies, ids, rows = pdf["body"].tolist(), pdf["doc_id"].to_numpy(np.int64), pdf["row"].to_numpy(np.int64)
    lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
    for i, j in slices(lengths, BATCH_BYTES):
        yield ids[i:j], rows[i:j], _Batch(bodies[i:j], width, core)


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Whether a row of sorted keys differs from the one before."""
    first = np.ones(len(keys[0]), bool)
    first[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return first


def _merged(owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of an owner's overlapping or touching ranges, by owner and place."""
    order = np.lexsort([low, owner])
    owner, low, high = owner[order], low[order], high[order]
    if not len(low):
        return owner, low, high
    # owners lie apart, so that no range reaches the next one's
    base = np.cumsum(_firsts(owner)) * (int(high.max()) + 1)
    reach = np.maximum.accumulate(high + base)
    new = np.flatnonzero(np.concatenate([[True], (low + base)[1:] > reach[:-1]]))
    return owner[new], low[new], np.append(reach[new[1:] - 1], reach[-1]) - base[new]


def _short(key: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a key, and below it 32 bits that tell it from nearly all others in the bucket."""
    return (((key >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (key & np.uint64(0xFFFFFFFF))).astype(np.int64)


def _runs(sorted_keys: np.ndarray):
    first = np.flatnonzero(_firsts(sorted_keys))
    return sorted_keys[first].tolist(), first.tolist(), np.append(first[1:], len(sorted_keys)).tolist()


PACKED = "block long, bucket long, parts array<binary>"


def _rows(rows: list[tuple[int, int, list[bytes]]]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["block", "bucket", "parts"]).astype({"block": "int64", "bucket": "int64"})


def _dealt(block: int, bucket: np.ndarray, *columns: np.ndarray) -> pd.DataFrame:
    """One row per bucket with the packed columns of its rows, in the order they have."""
    order = np.argsort(bucket, kind="stable")
    columns = [x[order] for x in columns]
    return _rows([(block, k, [x[a:z].tobytes() for x in columns]) for k, a, z in zip(*_runs(bucket[order]))])


def _unpacked(parts: pd.Series, *kinds) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which row each packed value comes from, and the columns one row after the other."""
    columns = [[np.frombuffer(p[k], kind) for p in parts] for k, kind in enumerate(kinds)]
    sizes = np.fromiter(map(len, columns[0]), np.int64, len(parts))
    joined = [np.concatenate([np.zeros(0, kind), *x]) for kind, x in zip(kinds, columns)]
    return np.repeat(np.arange(len(parts)), sizes), joined


def _bits(codes: np.ndarray, bits: int) -> bytes:
    """Small numbers, first the lowest bit of all."""
    return np.packbits((codes.astype(np.uint8) >> np.arange(bits, dtype=np.uint8)[:, None]) & 1, axis=1).tobytes()


def _codes(packed: bytes, bits: int, count: int) -> np.ndarray:
    planes = np.unpackbits(np.frombuffer(packed, np.uint8).reshape(bits, -1), axis=1, count=count)
    return np.bitwise_or.reduce(planes << np.arange(bits, dtype=np.uint8)[:, None], axis=0)


def _thin(ids: np.ndarray) -> bytes:
    """The least id, and of the distances from it first the lowest byte of all; bytes that all lack are left out."""
    least = ids.min()
    far = ids.view(np.uint64) - least.view(np.uint64)
    used = -(-int(far.max()).bit_length() // 8)
    return least.tobytes() + far.astype("<u8").view(np.uint8).reshape(-1, 8).T[:used].tobytes()


def _thick(packed: bytes, count: int) -> np.ndarray:
    far = np.zeros((count, 8), np.uint8)
    planes = np.frombuffer(packed, np.uint8, offset=8).reshape(-1, count)
    far[:, : len(planes)] = planes.T
    return (far.view("<u8").ravel().astype(np.uint64) + np.frombuffer(packed[:8], np.uint64)).view(np.int64)


def _joined(arrays, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *arrays])


class _Block:
    """The anchors of a block, with what lies around them."""

    def __init__(self, pdf: pd.DataFrame, width: int, core: int, buckets: int):
        self.width, self.core, self.buckets = width, core, buckets
        self.batches, found = [], []
        for ids, rows, b in _batches(pdf, width, core):
            low, high = b.bounds(b.anchor, b.doc)
            number = np.full(len(b.anchor), len(self.batches))
            found.append((
                number, b.anchor, b.start[b.doc], low, high, ids[b.doc], rows[b.doc],
                _short(b.key, buckets), b.contexts(b.anchor, b.doc).view(np.int64),
            ))
            self.batches.append(b)
        columns = [_joined(x, np.int64) for x in zip(*found)] or [np.zeros(0, np.int64)] * 9
        self.batch, self.at, self.start, self.low, self.high, self.doc, self.row, self.own, context = columns
        self.context = context.view(np.uint64)

    def by_batch(self, anchors: np.ndarray):
        """Batches, and which of `anchors` each has."""
        for k, b in enumerate(self.batches):
            own = np.flatnonzero(self.batch[anchors] == k)
            if len(own):
                yield b, own


def _asked(block: int, key: np.ndarray, owner: np.ndarray) -> pd.DataFrame:
    """Distinct keys by bucket, and whether several owners have them."""
    keys, first, number = np.unique(key, return_index=True, return_inverse=True)
    several = np.zeros(len(keys), np.uint8)
    several[number[owner != owner[first][number]]] = 1
    short = keys.astype(np.uint32)
    return _rows([
        (block, k, [short[a:z].tobytes(), _bits(several[a:z], 1)]) for k, a, z in zip(*_runs(keys >> 32))
    ])


def _answered(known: pd.DataFrame, bucket: np.ndarray, bits: int) -> np.ndarray:
    """What the buckets say about a block's sorted keys."""
    parts = dict(zip(known["bucket"], known["parts"]))
    return _joined((_codes(parts[k][0], bits, z - a) for k, a, z in zip(*_runs(bucket))), np.uint8)


def _anchor_rows(width: int, core: int, buckets: int):
    def anchors(pdf: pd.DataFrame) -> pd.DataFrame:
        """A block's distinct cores, and whether several of its documents hold them."""
        b = _Block(pdf, width, core, buckets)
        return _asked(int(pdf["block"].iloc[0]), b.own, b.doc)

    return anchors


#: What is said about a core or piece: several have it; very many blocks do.
REPEATED, HOT = 1, 2


def _repeated_rows(hot_blocks: int):
    def repeated(pdf: pd.DataFrame) -> pd.DataFrame:
        """Which keys of a bucket several owners have, and which of them very many blocks do."""
        source, (keys,) = _unpacked(pdf["parts"], np.uint32)
        sizes = np.bincount(source, minlength=len(pdf)).tolist()
        several = _joined((_codes(p[1], 1, n) for p, n in zip(pdf["parts"], sizes)), np.uint8)
        _, number, count = np.unique(keys, return_inverse=True, return_counts=True)
        often = count > 1
        often[number[several > 0]] = True
        said = (REPEATED * often + HOT * (count > hot_blocks))[number].astype(np.uint8)
        end = np.cumsum(sizes).tolist()
        pdf["parts"] = [[_bits(said[z - n : z], 2)] for n, z in zip(sizes, end)]
        return pdf

    return repeated


#: What is said about a context: an earlier document has it; its strings are to be compared, by bucket or one by one.
OLD, COMPARED, SINGLE = 1, 2, 4
#: Answers that go back to the blocks.
CORES, CONTEXTS, PIECES = range(3)


class _Contexts:
    """A block's distinct contexts of repeated cores, by bucket, core and bytes."""

    def __init__(self, b: _Block, known: pd.DataFrame):
        cores, number = np.unique(b.own, return_inverse=True)
        said = _answered(known[known["kind"] == CORES], cores >> 32, 2)[number]
        rows = np.flatnonzero(said & REPEATED)
        own, context, doc, hot = b.own[rows], b.context[rows], b.doc[rows], said[rows] & HOT > 0
        # contexts of hot cores are dealt one by one
        bucket = np.where(hot, (context % np.uint64(b.buckets)).astype(np.int64), own >> 32)
        order = np.lexsort([doc, context, own, bucket])
        new = _firsts(own[order], context[order])
        #: Anchors with their context's number, and of each context the first anchor in its least document.
        self.rows, self.number = rows[order], np.cumsum(new) - 1
        first = order[new]
        self.first, self.bucket, self.hot = rows[first], bucket[first], hot[first]
        self.several = np.zeros(len(first), bool)
        self.several[self.number[b.doc[self.rows] > b.doc[self.first][self.number]]] = True

    def judged(self, b: _Block, known: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """What is said about each context; anchors, among `rows`, with the context of an earlier document."""
        said = _answered(known[known["kind"] == CONTEXTS], self.bucket, 3)
        return said, (said[self.number] & OLD > 0) | (b.doc[self.rows] > b.doc[self.first][self.number])


def _context_rows(width: int, core: int, buckets: int):
    def contexts(key, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        """A block's contexts of repeated cores: core, context, least document, whether several documents or a hot core."""
        b = _Block(pdf, width, core, buckets)
        c = _Contexts(b, known)
        short, context, doc = b.own[c.first].astype(np.uint32), b.context[c.first], b.doc[c.first]
        return _rows([
            (key[0], k, [short[a:z].tobytes(), context[a:z].tobytes(), _thin(doc[a:z]), _bits(c.hot[a:z], 1)])
            for k, a, z in zip(*_runs(c.bucket))
        ])

    return contexts


def _judged_rows(hot_contexts: int):
    def judged(pdf: pd.DataFrame) -> pd.DataFrame:
        """What must be done with the contexts of a bucket."""
        source, (core, context) = _unpacked(pdf["parts"], np.uint32, np.uint64)
        sizes = np.bincount(source, minlength=len(pdf)).tolist()
        doc = _joined((_thick(p[2], n) for p, n in zip(pdf["parts"], sizes)), np.int64)
        hot = _joined((_codes(p[3], 1, n) for p, n in zip(pdf["parts"], sizes)), np.uint8)
        order = np.lexsort([doc, context, core])
        core, context, doc, hot = (x[order] for x in (core, context, doc, hot))
        new = _firsts(core, context)
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        first = _firsts(core)
        contexts = np.add.reduceat(new.astype(np.int64), np.flatnonzero(first))[np.cumsum(first) - 1]
        old = doc > least
        single = ~old & ((hot > 0) | (contexts > hot_contexts))
        said = np.empty(len(order), np.uint8)
        said[order] = OLD * old + COMPARED * (~old & ~single & (contexts > 1)) + SINGLE * single
        end = np.cumsum(sizes).tolist()
        pdf["parts"] = [[_bits(said[z - n : z], 3)] for n, z in zip(sizes, end)]
        return pdf

    return judged


def _cuts(width: int, core: int) -> list[tuple[int, int]]:
    """Bytes before the anchor of the strings that hold a piece, at least and at most."""
    free = width - core
    return [(a, z) for a, z in ((free * k // 3, free * (k + 1) // 3) for k in range(3)) if a < z] or [(0, 0)]


def _piece_keys(b: _Block, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By cut and anchor, the key of the piece, and whether the document holds it."""
    cuts = _cuts(b.width, b.core)
    keys = np.zeros((len(cuts), len(anchors)), np.int64)
    fits = np.zeros((len(cuts), len(anchors)), bool)
    for batch, own in b.by_batch(anchors):
        at, low, high = b.at[anchors[own]], b.low[anchors[own]], b.high[anchors[own]]
        for k, (least, most) in enumerate(cuts):
            start, end = at - least, at - most + b.width
            inside = (start >= low) & (end <= high)
            fits[k, own] = inside
            salt = splitmix(np.array([k], np.uint64))
            hashes = splitmix(_hash.ranges(batch.sums, start[inside], end[inside]) ^ salt)
            keys[k, own[inside]] = _short(hashes, b.buckets)
    return keys, fits


def _piece_rows(width: int, core: int, buckets: int):
    def pieces(key, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        """The distinct pieces of the contexts that must be compared, and whether several contexts hold them."""
        b = _Block(pdf, width, core, buckets)
        c = _Contexts(b, known)
        said, _ = c.judged(b, known)
        keys, fits = _piece_keys(b, c.first[said & (COMPARED | SINGLE) > 0])
        keys = keys[fits]
        return _asked(key[0], keys, np.arange(len(keys)))

    return pieces


#: Rows for a core's bucket, for the own block, of strings dealt one by one, and of where those are.
SENT, GONE, PLACES, STRINGS, ENTRIES = range(5)
_SENT = (np.uint32, np.uint64, np.int64, np.uint16, np.uint16)
_GONE = (np.int64, np.int64, np.int64)
_PLACES = (np.uint64, np.int64, np.int64)
#: Strings are dealt to so many times the buckets.
FINER = 4


def _single_rows(block: int, b: _Block, anchors: np.ndarray, shared: np.ndarray) -> list[pd.DataFrame]:
    """Distinct strings around shared pieces by bucket, with their least documents, and where the block has them."""
    width, core = b.width, b.core
    tried = np.zeros((width - core + 1, len(anchors)), bool)
    for (least, most), alive in zip(_cuts(width, core), shared):
        tried[least : most + 1] |= alive
    strings = []
    for batch, own in b.by_batch(anchors):
        far, who = np.nonzero(tried[:, own])
        who = own[who]
        start = b.at[anchors[who]] - far
        fits = (start >= b.low[anchors[who]]) & (start + width <= b.high[anchors[who]])
        far, who, start = far[fits], who[fits], start[fits]
        one = splitmix(_hash.ranges(batch.sums, start, start + width))
        two = splitmix(_other.ranges(_other.prefix(batch.data), start, start + width))
        strings.append((one, two, who, far))
    if not strings:
        return []
    one, two, who, far = map(np.concatenate, zip(*strings))
    doc = b.doc[anchors[who]]
    bucket = (one % np.uint64(b.buckets * FINER)).astype(np.int64)
    order = np.lexsort([doc, two, one, bucket])
    one, two, who, far, doc, bucket = (x[order] for x in (one, two, who, far, doc, bucket))
    new = _firsts(one, two)
    first = np.flatnonzero(new)
    behind = doc > doc[first][np.cumsum(new) - 1]
    one, two, doc, bucket = one[first], two[first], doc[first], bucket[first]
    sent = _rows([
        (block, k, [one[a:z].tobytes(), two[a:z].tobytes(), _thin(doc[a:z])]) for k, a, z in zip(*_runs(bucket))
    ])
    parts = [_bits(new + 2 * behind, 2), who.astype(np.uint32).tobytes(), far.astype(np.uint16).tobytes(), b.context[anchors].tobytes()]
    return [sent.assign(kind=STRINGS), _rows([(block, 0, parts)]).assign(kind=ENTRIES)] if len(first) else []


def _string_rows(width: int, core: int, buckets: int):
    def strings(key, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        """A block's old ranges, and of contexts that share a piece their bytes and places, each context's bytes once."""
        b = _Block(pdf, width, core, buckets)
        c = _Contexts(b, known)
        said, old = c.judged(b, known)
        gone = c.rows[old]
        row, low, high = _merged(b.row[gone], b.low[gone] - b.start[gone], b.high[gone] - b.start[gone])
        tables = [_dealt(key[0], np.zeros(len(row), np.int64), row, low, high).assign(kind=GONE)]

        asked = np.flatnonzero(said & (COMPARED | SINGLE))
        keys, shared = _piece_keys(b, c.first[asked])
        held, number = np.unique(keys[shared], return_inverse=True)
        shared[shared] = _answered(known[known["kind"] == PIECES], held >> 32, 2)[number] & REPEATED > 0
        alive = shared.any(axis=0)
        asked, shared = asked[alive], shared[:, alive]
        wanted = np.zeros(len(said), bool)
        wanted[asked] = True
        own = c.rows[~old & wanted[c.number]]
        tables.append(
            _dealt(key[0], np.zeros(len(own), np.int64), b.context[own], b.row[own], b.at[own] - b.start[own]).assign(kind=PLACES)
        )

        single = said[asked] & SINGLE > 0
        tables += _single_rows(key[0], b, c.first[asked[single]], shared[:, single])
        sent = c.first[asked[~single]]
        sent = sent[np.argsort(b.own[sent] >> 32, kind="stable")]
        length, before = b.high[sent] - b.low[sent], b.at[sent] - b.low[sent]
        end = np.cumsum(length)
        data = np.empty(length.sum(), np.uint8)
        for batch, some in b.by_batch(sent):
            data[flat(end[some] - length[some], length[some])] = batch.data[flat(b.low[sent[some]], length[some])]
        columns = (b.own[sent].astype(np.uint32), b.context[sent], b.doc[sent], length.astype(np.uint16), before.astype(np.uint16))
        tables.append(_rows([
            (key[0], k, [*(x[a:z].tobytes() for x in columns), data[end[a] - length[a] : end[z - 1]].tobytes()])
            for k, a, z in zip(*_runs(b.own[sent] >> 32))
        ]).assign(kind=SENT))
        return pd.concat(tables)

    return strings


def _older_rows(pdf: pd.DataFrame) -> pd.DataFrame:
    """Which strings of a bucket an earlier document of another block has, and how many there are."""
    source, (one, two) = _unpacked(pdf["parts"], np.uint64, np.uint64)
    sizes = np.bincount(source, minlength=len(pdf)).tolist()
    doc = _joined((_thick(p[2], n) for p, n in zip(pdf["parts"], sizes)), np.int64)
    order = np.lexsort([doc, two, one])
    new = _firsts(one[order], two[order])
    least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    older = np.empty(len(order), np.uint8)
    older[order] = doc[order] > least
    end = np.cumsum(sizes).tolist()
    pdf["parts"] = [[_bits(older[z - n : z], 1), np.int64(n).tobytes()] for n, z in zip(sizes, end)]
    return pdf


def _found_rows(width: int, core: int):
    def found(pdf: pd.DataFrame) -> pd.DataFrame:
        """Per block, the contexts of a bucket with strings of an earlier document, and how far those reach."""
        source, (short, context, doc, length, before) = _unpacked(pdf["parts"], *_SENT)
        data = np.frombuffer(b"".join(p[len(_SENT)] for p in pdf["parts"]), np.uint8)
        some, left, right = shared_strings(
            short, data, length.astype(np.int64), before.astype(np.int64), doc, width, core
        )
        table = _dealt(0, source[some], context[some], left, right)
        table["block"] = pdf["block"].to_numpy(np.int64)[table["bucket"]]
        return table

    return found


_FOUND = (np.uint64, np.int64, np.int64)
FOUND, OLDER = ENTRIES + 1, ENTRIES + 2


def _single_hits(entries: pd.Series, older: pd.DataFrame, free: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts with strings of an earlier document that were dealt one by one, and how far those reach."""
    if not len(entries):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    flags, who, far, context = entries.iloc[0]
    who, far, context = np.frombuffer(who, np.uint32), np.frombuffer(far, np.uint16).astype(np.int64), np.frombuffer(context, np.uint64)
    flags = _codes(flags, 2, len(who))
    said = older.sort_values("bucket")["parts"]
    said = _joined((_codes(p[0], 1, int(np.frombuffer(p[1], np.int64)[0])) for p in said), np.uint8)
    hit = (flags & 2 > 0) | (said[np.cumsum(flags & 1) - 1] > 0)
    left, right = np.full(len(context), -1), np.full(len(context), -1)
    np.maximum.at(left, who[hit], far[hit])
    np.maximum.at(right, who[hit], free - far[hit])
    some = np.flatnonzero(left >= 0)
    return context[some], left[some], right[some]


def _kept_rows(width: int, core: int):
    def kept(key, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        parts = {kind: known["parts"][known["kind"] == kind] for kind in (GONE, PLACES, FOUND, ENTRIES)}
        _, (row, low, high) = _unpacked(parts[GONE], *_GONE)
        _, (context, place_row, at) = _unpacked(parts[PLACES], *_PLACES)
        _, found = _unpacked(parts[FOUND], *_FOUND)
        single = _single_hits(parts[ENTRIES], known[known["kind"] == OLDER], width - core)
        found, left, right = (np.concatenate(x) for x in zip(found, single))
        if len(found):
            order = np.argsort(found)
            found, left, right = found[order], left[order], right[order]
            place = np.minimum(np.searchsorted(found, context), len(found) - 1)
            hit = found[place] == context
            place, at = place[hit], at[hit]
            row = np.concatenate([row, place_row[hit]])
            low, high = np.concatenate([low, at - left[place]]), np.concatenate([high, at + core + right[place]])
        row, low, high = _merged(row, low, high)
        ranges = {k: (a, z) for k, a, z in zip(*_runs(row))}
        out = []
        for doc_id, row, body in zip(pdf["doc_id"].astype("Int64"), pdf["row"], pdf["body"]):
            a, z = ranges.get(row, (0, 0))
            spans = list(zip(low[a:z].tolist(), high[a:z].tolist()))
            rest, at = [], 0
            for start, end in spans:
                rest.append(body[at:start])
                at = end
            rest.append(body[at:])
            rest = b"".join(rest)
            out.append((doc_id, len(body), spans, rest, hashlib.sha256(rest).hexdigest()))
        frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept", "kept_sha256"])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame

    return kept


def remove_repeats(
    docs: DataFrame,
    width: int = 50,
    core: int = 20,
    block_bytes: int = 4 << 20,
    hot_blocks: int = 1024,
    hot_contexts: int = 1 << 17,
) -> DataFrame:
    """doc_id, n_bytes, spans (array of removed [low, high)), kept (bytes left), kept_sha256.

    Contexts of a core that more than `hot_blocks` blocks have, or of which there are more than
    `hot_contexts`, are not brought together in one task; their strings meet one by one.
    """
    body = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    blocks = stage_blocks(
        docs.select(F.col("doc_id").cast("long"), body.alias("body"), F.monotonically_increasing_id().alias("row")),
        F.octet_length("body"),
        block_bytes,
    )
    # a group of anchors is some megabytes, whatever the size of the corpus
    buckets = max(1, -(-blocks.select("block").distinct().count() * block_bytes // (16 * ANCHORS)))
    by_block = blocks.groupBy("block")
    shape = width, core, buckets

    def told(**answers: DataFrame):
        """The blocks, each with what the buckets said to it."""
        kinds = {"cores": CORES, "contexts": CONTEXTS, "pieces": PIECES}
        known = reduce(DataFrame.unionByName, (x.withColumn("kind", F.lit(kinds[k])) for k, x in answers.items()))
        return by_block.cogroup(known.groupBy("block"))

    def judged(asked: DataFrame, rows) -> DataFrame:
        return asked.groupBy("bucket").applyInPandas(rows, PACKED)

    with short_shuffles(docs.sparkSession):
        cores = stage(judged(by_block.applyInPandas(_anchor_rows(*shape), PACKED), _repeated_rows(hot_blocks)), "cores")
        asked = told(cores=cores).applyInPandas(_context_rows(*shape), PACKED)
        contexts = stage(judged(asked, _judged_rows(hot_contexts)), "contexts")
        asked = told(cores=cores, contexts=contexts).applyInPandas(_piece_rows(*shape), PACKED)
        # only whether a piece is repeated counts
        pieces = stage(judged(asked, _repeated_rows(hot_blocks)), "pieces")
        strings = stage(
            told(cores=cores, contexts=contexts, pieces=pieces).applyInPandas(_string_rows(*shape), f"{PACKED}, kind int"),
            "strings",
        )
    found = judged(strings.where(F.col("kind") == SENT).drop("kind"), _found_rows(width, core))
    older = judged(strings.where(F.col("kind") == STRINGS).drop("kind"), _older_rows)
    known = (
        found.withColumn("kind", F.lit(FOUND))
        .unionByName(older.withColumn("kind", F.lit(OLDER)))
        .unionByName(strings.where(F.col("kind").isin(GONE, PLACES, ENTRIES)))
    )
    return by_block.cogroup(known.groupBy("block")).applyInPandas(
        _kept_rows(width, core),
        "doc_id long, n_bytes long, spans array<struct<low: long, high: long>>, kept binary, kept_sha256 string",
    )
