"""Token ids of whole texts, each distinct word encoded by the library once per worker process.

A text is cut only where the tokenizer's own splitter cuts it whatever stands around: between a
visible character and the blank after it, and between an ASCII letter or digit and a sign. Pieces
are told apart in Arrow, distinct new ones go to the library, and the ids of all pieces are
gathered from one flat array, so no Python object exists per occurrence of a word. The splitters
known here are those of the two public vocabularies; with any other, whole texts are encoded.
"""

from __future__ import annotations

import gc
import json
import os
import sys
from collections.abc import Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa

#: Distinct pieces that a worker process remembers; beyond that it forgets all and starts anew.
KNOWN_WORDS = 800_000
#: Bytes of text that are split at a time, or one longer text.
SLICE_BYTES = 2 << 20
#: Words that go to the library in one string.
JOINED_WORDS = 200

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Signs that follow an ASCII letter or digit as a piece of their own; those of special strings never do.
SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True

WORD_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `most` bytes, or of one longer row."""
    first, last = 0, len(offsets) - 1
    while first < last:
        end = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        end = min(max(end, first + 1), last)
        yield first, end
        first = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column without nulls, and the offsets of its rows; nothing is copied."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class WordIds:
    """Encodes texts with the tokenizer file at `path`; see `word_ids`."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.model = Tokenizer.from_file(path)
        # the same model for words of ASCII letters, which need no pattern to be told apart
        self.letters = Tokenizer(self.model.model)
        self.letters.pre_tokenizer = CharDelimiterSplit(" ")
        self.model.no_truncation()
        self.model.no_padding()
        # the vocabulary, which comes last, is left out: as Python objects it would be large
        head, _, rest = self.model.to_str().partition(',"model":{')
        settings = json.loads(head + "}")
        word_end = '"end_of_word_suffix":"' in rest.partition('"vocab":')[0]
        splitter = settings["pre_tokenizer"] or {}
        inner = (splitter.get("pretokenizers") or [{}])[0]
        plain_specials = not any(
            t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or set(t["content"]) & set(" \t\n\v\f\r")
            for t in settings["added_tokens"]
        )
        own = "".join(t["content"] for t in settings["added_tokens"]).encode()
        self.stop = np.zeros(256, bool)
        self.stop[[sign for sign in SIGNS if sign not in own]] = True
        vocabulary = self.model.get_vocab()
        marks = np.zeros(max(vocabulary.values(), default=0) + 2, bool)
        self.kind = None
        if (
            plain_specials
            and word_end
            and (settings["normalizer"] or {}).get("normalizers") == WORD_NORMALIZERS
            and (inner.get("pattern"), inner.get("behavior"), inner.get("invert")) == ({"Regex": WORD_PATTERN}, "Removed", True)
        ):
            self.kind = "ends"
            suffix = json.loads('"' + rest.partition('"end_of_word_suffix":"')[2].partition('"')[0] + '"')
            marks[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        elif (
            plain_specials
            and settings["normalizer"] is None
            and not word_end
            and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex")
            and not splitter.get("add_prefix_space")
        ):
            self.kind = "blanks"
            marks[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.marks = marks
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int32)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, text: str, letters: bool) -> np.ndarray:
        model = self.letters if letters else self.model
        return np.array(model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def _remember(self, pieces: list[bytes], ids: np.ndarray, length: np.ndarray) -> None:
        """Add `pieces` whose ids lie one after the other in `ids`, `length` of them each."""
        n, at = len(ids), len(self.known)
        if self.used + n > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(n, len(self.ids)), np.int32)])
        if at + len(pieces) > len(self.start):
            more = max(len(pieces), at)
            self.start = np.concatenate([self.start, np.zeros(more, np.int64)])
            self.length = np.concatenate([self.length, np.zeros(more, np.int32)])
        self.ids[self.used : self.used + n] = ids
        self.start[at : at + len(pieces)] = self.used + np.cumsum(length) - length
        self.length[at : at + len(pieces)] = length
        self.used += n
        self.known.update(zip(pieces, range(at, at + len(pieces))))

    def _learn(self, new: list[bytes]) -> None:
        """Encode pieces by the library: words of letters many at a time, told apart by the marked ids."""
        lead = 1 if self.kind == "blanks" else 0
        letters, words, rest = [], [], []
        for piece in new:
            if piece[lead:].isalpha() and (not lead or piece[0] == 0x20):  # of bytes: ASCII letters
                letters.append(piece)
                continue
            text = piece.decode()
            body = text[lead:]
            whole = body.isalpha() and body.lower().isalpha() and (not lead or text[0] == " ")
            (words if whole else rest).append(piece)
        for pieces, plain in ((letters, True), (words, False)):
            for at in range(0, len(pieces), JOINED_WORDS):
                part = pieces[at : at + JOINED_WORDS]
                if not lead:
                    text = b" ".join(part)
                    ids = self._joined((text.lower() if plain else text).decode(), plain)
                elif plain:
                    ids = self._joined(b"".join(part).decode().replace(" ", " Ġ")[1:], True)
                else:
                    ids = self._joined(b"".join(part).decode(), False)
                cut = np.flatnonzero(self.marks[ids])
                cut = np.append(cut, len(ids)) if lead else np.concatenate([[0], cut + 1])
                if len(cut) == len(part) + 1 and cut[0] == 0 and cut[-1] == len(ids):
                    self._remember(part, ids, np.diff(cut))
                else:
                    rest += part
        for at in range(0, len(rest), JOINED_WORDS):
            part = rest[at : at + JOINED_WORDS]
            ids = self._library([piece.decode() for piece in part])
            length = np.fromiter(map(len, ids), np.int64, len(ids))
            self._remember(part, np.fromiter(chain.from_iterable(ids), np.int32, length.sum()), length)

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces begin and end; every row that is not empty begins one."""
        blank = _BLANK[data]
        before = np.empty_like(data)
        before[0], before[1:] = 0, data[:-1]
        stop = self.stop[data] & _ALNUM[before]
        first = np.zeros(len(data), bool)
        first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        if self.kind == "blanks":
            visible = _VISIBLE[before]
            # letters of two bytes, U+00C0 to U+00FF, are visible too
            visible[2:] |= (data[:-2] == 0xC3) & (before[2:] >= 0x80)
            begin = np.flatnonzero(first | stop | (blank & visible))
            return begin, np.append(begin[1:], len(data))
        after_blank = np.empty(len(data), bool)
        after_blank[0], after_blank[1:] = True, blank[:-1]
        begin = np.flatnonzero(~blank & (first | stop | after_blank))
        next_blank = np.append(np.flatnonzero(blank), len(data))
        end = np.append(begin[1:], len(data))
        # a row ends a piece too: the next row's first piece begins there or after blanks
        return begin, np.minimum(np.minimum(end, next_blank[np.searchsorted(next_blank, begin)]), _row_ends(offsets, begin))

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, row after the last, ids, number of ids per row) for slices of the column."""
        all_data, all_offsets = utf8(column)
        for low, high in slices(all_offsets, SLICE_BYTES):
            data = all_data[all_offsets[low] : all_offsets[high]]
            offsets = all_offsets[low : high + 1] - all_offsets[low]
            if self.kind is None:
                texts = [bytes(data[a:z]).decode() for a, z in zip(offsets[:-1], offsets[1:])]
                found = self._library(texts)
                counts = np.fromiter(map(len, found), np.int64, len(found))
                yield low, high, np.concatenate([np.array(i, np.int32) for i in found]), counts
            elif len(data) == 0:
                yield low, high, np.zeros(0, np.int32), np.zeros(high - low, np.int64)
            else:
                yield low, high, *self._gather(data, offsets)

    def _gather(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin, end = self._pieces(data, offsets)
        if len(begin) == 0:
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        if self.kind == "blanks":
            packed, bounds = data, np.append(begin, len(data))
        else:
            # every byte that is not blank lies in one piece, so nothing is gathered by number
            bounds = np.concatenate([[0], np.cumsum(end - begin)])
            packed = data[~_BLANK[data]]
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(begin), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(packed))]
        ).dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        new = [piece for piece in distinct if piece not in self.known]
        if new:
            self._learn(new)
        own = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        index = pieces.indices.to_numpy()
        length = self.length[own][index].astype(np.int64)
        after = np.cumsum(length)
        source = np.repeat(self.start[own][index] - (after - length), length)
        source += np.arange(after[-1])
        per_row = np.concatenate([[0], after])[np.searchsorted(begin, offsets)]
        return self.ids[source], np.diff(per_row)


def word_ids(path: str) -> WordIds:
    """The encoder of a worker process, whose tasks share what it remembers.

    Functions travel to executors by value, so what outlives a task is kept under a name of the process.
    """
    kept = sys.modules.setdefault("word_ids_of_this_process", ModuleType("word_ids_of_this_process"))
    if getattr(kept, "path", None) != path:
        kept.path, kept.encoder = path, WordIds(path)
    return kept.encoder


def release() -> None:
    """Free what `word_ids` keeps in this worker process, for stages that encode nothing."""
    if sys.modules.pop("word_ids_of_this_process", None):
        gc.collect()
        pa.default_memory_pool().release_unused()


def _row_ends(offsets: np.ndarray, begin: np.ndarray) -> np.ndarray:
    return offsets[np.searchsorted(offsets, begin, "right")]
