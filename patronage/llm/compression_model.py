"""Language-model scores by prediction by partial matching.

Texts are streams of bytes: A-Z in lower case, words joined by one space, one end symbol. The
model is a byte-context trie of order `ORDER` over the training texts: for each context how often
each byte followed it. A byte is predicted in the longest context that occurs; a context that has
not seen it escapes to the next shorter one (escape estimate D: half a count of each byte seen
goes to the escape), where bytes that the longer context has seen are excluded; below order nought
stands a uniform code over the bytes left. A text's score is the log10 of its probability.

The probability of a byte depends on the `ORDER` bytes before it only, so each distinct string of
`ORDER` + 1 bytes is evaluated once, whatever its number of occurrences. The trie is split by the
two nearest context bytes, which hold all longer contexts below them; orders 1 and 0 are tables of
at most 65,536 counts. Blocks of documents (`blocks`) send in their distinct strings with counts and
get back the probabilities of exactly these. Counts of words, for the base score, go the same way.
Strings and words travel packed by bucket: sorted, as differences, by planes of bytes. Answers come
in the same order without the keys, which the block finds again in its texts.

Nulls: a null text is empty, just the end symbol. Rows without doc_id are training rows. Without
training texts every byte costs the uniform code.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.blocks import ByteHash, slices, splitmix, stage_blocks
from patronage.staging import stage

ORDER = 5
END = 10
BATCH_BYTES = 1 << 20
#: Bytes of text whose keys make a bucket, and keys of it that are summed at a time.
BUCKET_BYTES = 32 << 20
KEYS = 1 << 20
_hash = ByteHash(41)
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_space = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


class Stream:
    """Symbols of some texts: packed strings of ORDER + 1 bytes per symbol, hashes per word."""

    def __init__(self, bodies: list[bytes]):
        data = _lower[np.frombuffer(b"\n".join(bodies) + b"\n", np.uint8)]
        lengths = np.fromiter(map(len, bodies), np.int64, len(bodies)) + 1
        ends = np.cumsum(lengths)
        solid = ~_space[data]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]])))
        first, last = edges[::2], edges[1::2]
        self.words = splitmix(_hash.ranges(_hash.prefix(data), first, last)).view(np.int64)
        upto = np.searchsorted(first, ends)
        self.n_words = np.diff(np.concatenate([[0], upto]))
        keep, symbols = solid, data.copy()
        keep[last] = True
        symbols[last] = 32
        final = ends - 1  # of texts without words
        some = self.n_words > 0
        final[some] = last[upto[some] - 1]
        keep[final] = True
        symbols[final] = END
        at = np.cumsum(keep)
        self.n_symbols = np.diff(np.concatenate([[0], at[ends - 1]]))
        symbols = symbols[keep]
        padded = np.full(len(symbols) + ORDER * len(bodies), END, np.uint8)
        place = np.arange(len(symbols)) + ORDER * (1 + np.repeat(np.arange(len(bodies)), self.n_symbols))
        padded[place] = symbols
        packed = np.zeros(len(padded) - ORDER, np.int64)
        for k in range(ORDER + 1):
            packed = packed << 8 | padded[k : k + len(packed)]
        self.strings = packed[place - ORDER]


def _batches(pdf: pd.DataFrame):
    bodies = pdf["body"].tolist()
    for i, j in slices(np.fromiter(map(len, bodies), np.int64, len(bodies)), BATCH_BYTES):
        yield i, j, Stream(bodies[i:j])


def _counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of weights by distinct key."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, weights = map(np.concatenate, zip(*parts))
    codes, distinct = pd.factorize(keys)
    return distinct, np.bincount(codes, weights, len(distinct)).astype(np.int64)


def _pack(values: np.ndarray) -> bytes:
    """64-bit numbers, compressed by planes of bytes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return np.int64(len(values)).tobytes() + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(packed: bytes) -> np.ndarray:
    n = int(np.frombuffer(packed, np.int64, 1)[0])
    planes = np.frombuffer(pa.decompress(packed[8:], 8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(np.int64).reshape(n)


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.int64(0)))


def _unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed))


def _by_bucket(kind: int, keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of distinct keys by bucket and size, and the bucket of each.

    Strings that differ in the last two bytes share a bucket, so that keys are near each other.
    """
    mixed = splitmix(keys >> 16) if kind == 0 else keys.view(np.uint64)
    bucket = (mixed % np.uint64(buckets)).astype(np.int64)
    return np.lexsort([keys, bucket]), bucket


def _block_features(buckets: int):
    def features(pdf: pd.DataFrame) -> pd.DataFrame:
        """A block's distinct strings (kind 0) and words (kind 1) with training counts, by bucket."""
        training = (~pdf["held_out"]).to_numpy(np.float64)
        strings, words = [], []
        for i, j, s in _batches(pdf):
            for found, keys, sizes in ((strings, s.strings, s.n_symbols), (words, s.words, s.n_words)):
                codes, distinct = pd.factorize(keys)
                found.append((distinct, np.bincount(codes, np.repeat(training[i:j], sizes), len(distinct))))
        rows = []
        for kind, parts in enumerate((strings, words)):
            keys, n = _counted(parts)
            order, bucket = _by_bucket(kind, keys, buckets)
            keys, n, bucket = keys[order], n[order], bucket[order]
            first = np.flatnonzero(np.diff(bucket, prepend=-1))
            for a, z in zip(first, np.append(first[1:], len(keys))):
                rows.append((kind, bucket[a], _pack_keys(keys[a:z]), _pack(n[a:z])))
        table = pd.DataFrame(rows, columns=["kind", "bucket", "keys", "n"])
        table.insert(0, "block", np.int64(pdf["block"].iloc[0]))
        return table

    return features


def _bucket_counts(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of a bucket in ascending order, and their training counts in all blocks."""
    parts, size = [], 0
    for keys, n in zip(pdf["keys"], pdf["n"]):
        parts.append((_unpack_keys(keys), _unpack(n)))
        size += len(parts[-1][0])
        if size > KEYS and len(parts) > 2:
            parts = [_counted(parts)]
            size = 0
    keys, n = _counted(parts)
    order = np.argsort(keys)
    return keys[order], n[order]


def _string_rows(pdf: pd.DataFrame) -> pd.DataFrame:
    keys, n = _bucket_counts(pdf)
    return pd.DataFrame({"key": keys, "n": n})


ANSWERS = "block long, kind int, bucket long, codes binary, table binary, owned long"


def _string_answers(pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """Per block, the probabilities of its strings of a bucket, as numbers into those that occur."""
    order = np.argsort(known["key"].to_numpy(np.int64))
    keys, value = known["key"].to_numpy(np.int64)[order], known["value"].to_numpy(np.float64)[order]
    rows = []
    for block, bucket, packed in zip(pdf["block"], pdf["bucket"], pdf["keys"]):
        own, codes = np.unique(value[np.searchsorted(keys, _unpack_keys(packed))], return_inverse=True)
        rows.append((block, 0, bucket, _pack(codes.astype(np.int64)), _pack_keys(own.view(np.int64)), 0))
    return pd.DataFrame(rows, columns=["block", "kind", "bucket", "codes", "table", "owned"])


def _word_answers(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per block, the counts of its words of a bucket; one row has the number of distinct training words."""
    keys, n = _bucket_counts(pdf)
    rows = [
        (block, 1, bucket, _pack(n[np.searchsorted(keys, _unpack_keys(packed))]), None, 0)
        for block, bucket, packed in zip(pdf["block"], pdf["bucket"], pdf["keys"])
    ]
    table = pd.DataFrame(rows, columns=["block", "kind", "bucket", "codes", "table", "owned"])
    table.loc[0, "owned"] = int((n > 0).sum())
    return table


def probabilities(strings: np.ndarray, n: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 of the probability of the last byte of each string after the others.

    `strings` are all distinct ones that share the two bytes before the last; `n` counts them in
    training (0: only elsewhere). `pairs[c, s]` counts s after c in training.
    """
    symbol = strings & 255
    one = int(strings[0] >> 8 & 255)
    levels = []  # from the longest context: count of the symbol, all counts, number of symbols
    for order in range(ORDER, 1, -1):
        context, own = pd.factorize(strings >> 8 & ((1 << 8 * order) - 1))
        pair, _ = pd.factorize(context * 256 + symbol)
        by_pair = np.bincount(pair, n)
        seen = by_pair > 0
        owner = np.zeros(len(by_pair), np.int64)
        owner[pair] = context
        levels.append((context, pair, by_pair, np.bincount(context, n), np.bincount(owner, seen, len(own))))
    low = [(pairs[one], one), (pairs.sum(axis=0), 0)]
    result = np.zeros(len(strings))
    done = np.zeros(len(strings), bool)
    longer: tuple | None = None  # per string: is there a longer context, its symbols' mass here, their number
    for order in range(ORDER, -1, -1):
        if order > 1:
            context, pair, by_pair, total, kinds = levels[ORDER - order]
            own, all_, different = by_pair[pair], total[context], kinds[context]
        else:
            counts = low[1 - order][0]
            own = counts[symbol].astype(float)
            all_ = np.full(len(strings), counts.sum(), float)
            different = np.full(len(strings), (counts > 0).sum(), float)
        if longer is not None:
            # mass, in this context, of the symbols that the next longer context has seen
            above_context, above_symbols, above_kinds = longer
            mass = np.bincount(above_context[above_symbols[0]], own[above_symbols[0]], above_context.max() + 1)[above_context]
            all_, different = all_ - mass, different - above_kinds
        exists = all_ > 0
        hit = exists & ~done & (own > 0)
        result[hit] += np.log10((2 * own[hit] - 1) / (2 * all_[hit]))
        done |= hit
        miss = exists & ~done
        result[miss] += np.log10(different[miss] / (2 * all_[miss]))
        if order > 1:
            # one string per (context, symbol seen) stands for it
            stands = np.unique(pair, return_index=True)[1]
            longer = (context, (stands[by_pair[pair[stands]] > 0],), kinds[context])
        elif order == 1:
            seen = np.flatnonzero(low[0][0] > 0)
            if len(seen):
                mass = pairs.sum(axis=0)[seen].sum()
                longer = (np.zeros(len(strings), np.int64), None, float(len(seen)))
                all0, kinds0 = pairs.sum() - mass, (pairs.sum(axis=0) > 0).sum() - len(seen)
            else:
                all0, kinds0 = pairs.sum(), (pairs.sum(axis=0) > 0).sum()
            counts = pairs.sum(axis=0)
            hit = ~done & (counts[symbol] > 0)
            result[hit] += np.log10((2 * counts[symbol][hit] - 1) / (2 * all0)) if all0 else 0.0
            done |= hit
            if all0:
                result[~done] += np.log10(kinds0 / (2 * all0))
            break
    left = 256 - int((pairs.sum(axis=0) > 0).sum())
    if left:
        result[~done] -= np.log10(left)
    return result


def _trie_rows(pairs: np.ndarray, buckets: int):
    def rows(pdf: pd.DataFrame) -> pd.DataFrame:
        strings, n = pdf["key"].to_numpy(np.int64), pdf["n"].to_numpy(np.float64)
        bucket = _by_bucket(0, strings, buckets)[1]
        return pd.DataFrame({"bucket": bucket, "key": strings, "value": probabilities(strings, n, pairs)})

    return rows


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, known_log double, owned long, score double"


def _answers(known: pd.DataFrame, kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """What the buckets answered for each of a block's keys, which may repeat."""
    codes, distinct = pd.factorize(keys)
    order, _ = _by_bucket(kind, distinct, buckets)
    value = np.zeros(len(distinct))
    rows = known[known["kind"] == kind].sort_values("bucket")
    parts = [
        _unpack_keys(table).view(np.float64)[_unpack(packed)] if kind == 0 else _unpack(packed).astype(np.float64)
        for packed, table in zip(rows["codes"], rows["table"])
    ]
    if parts:
        value[order] = np.concatenate(parts)
    return value[codes]


def _block_scores(buckets: int):
    def scores(key, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        batches = list(_batches(pdf))
        value = _answers(known, 0, np.concatenate([s.strings for _, _, s in batches]), buckets)
        count = _answers(known, 1, np.concatenate([s.words for _, _, s in batches]), buckets)
        out, string, word = [], 0, 0
        for i, j, s in batches:
            logs, counts = value[string : string + len(s.strings)], count[word : word + len(s.words)]
            string, word = string + len(s.strings), word + len(s.words)
            score = np.add.reduceat(logs, np.cumsum(s.n_symbols) - s.n_symbols)
            sums = []
            for values in (counts > 0, np.log10(counts + 1)):
                total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
                ends = np.cumsum(s.n_words)
                sums.append(total[ends] - total[ends - s.n_words])
            out.append(pd.DataFrame({
                "doc_id": pdf["doc_id"].iloc[i:j].astype("Int64").to_numpy(), "held_out": pdf["held_out"].iloc[i:j].to_numpy(),
                "n_tokens": s.n_words + 1, "n_known": sums[0].astype(np.int64), "known_log": sums[1], "owned": 0, "score": score,
            }))
        result = pd.concat(out, ignore_index=True)
        result["doc_id"] = result["doc_id"].astype("Int64")
        result.loc[0, "owned"] = int(known["owned"].sum())
        return result

    return scores


def held_out(doc_id: str = "doc_id", fold: int = 2, folds: int = 7) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == fold


def model(counts: DataFrame, buckets: int) -> DataFrame:
    """bucket, key, value: each distinct string of the corpus and the log10 probability of its last byte."""
    cells = counts.where("n > 0").groupBy((F.col("key") % 65536).alias("pair")).agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros(65536, np.float64)  # at most 65,536 rows, whatever the corpus
    for pair, n in cells:
        pairs[pair] = n
    near = F.shiftright("key", 8).bitwiseAND(65535)
    return counts.withColumn("near", near).groupBy("near").applyInPandas(
        _trie_rows(pairs.reshape(256, 256), buckets), "bucket long, key long, value double"
    )


def score(docs: DataFrame, held: Column, block_bytes: int = 3 << 20, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each whole text.

    Learns from rows for which `held` is false.
    """
    body = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), body.alias("body"))
    blocks = stage_blocks(rows, F.octet_length("body"), block_bytes)
    # a bucket of keys is some megabytes, whatever the size of the corpus
    buckets = max(1, -(-blocks.select("block").distinct().count() * block_bytes // bucket_bytes))
    features = stage(
        blocks.groupBy("block").applyInPandas(
            _block_features(buckets), "block long, kind int, bucket long, keys binary, n binary"
        ),
        "features",
    )
    strings = features.where("kind = 0")
    counts = stage(strings.groupBy("bucket").applyInPandas(_string_rows, "key long, n long"), "strings")
    known = model(counts, buckets)
    known = (
        strings.select("block", "bucket", "keys").groupBy("bucket").cogroup(known.groupBy("bucket"))
        .applyInPandas(_string_answers, ANSWERS)
    )
    words = features.where("kind = 1").groupBy("bucket").applyInPandas(_word_answers, ANSWERS)
    scored = stage(
        blocks.groupBy("block").cogroup(known.unionByName(words).groupBy("block"))
        .applyInPandas(_block_scores(buckets), SCORED),
        "scores",
    )
    n, docs_in, distinct = scored.agg(
        F.sum(F.when(~F.col("held_out"), F.col("n_tokens"))), F.count_if(~F.col("held_out")), F.sum("owned")
    ).first()
    n, distinct = n or 0, (distinct or 0) + (1 if docs_in else 0)
    base = F.col("known_log") + F.lit(float(np.log10(docs_in + 1))) - F.col("n_tokens") * F.lit(float(np.log10(n + distinct + 1)))
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.lit(1 if docs_in else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )
