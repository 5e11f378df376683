"""Token counts through a digest cache, and token ids in Parquet list columns.

`token_counts`: digests of normalised content and of the tokenizer (file and settings) are joined
to stored counts; only distinct content without a stored count is encoded, and the new counts are
appended to the cache. Normalising may only join texts that the tokenizer treats alike, so by
default it just turns null into the empty text.

`write_token_ids`: documents in ascending doc_id order, one file per range of ids, each row a list
of token ids with the end id. Ids are dictionary-encoded, numbers are delta-encoded; row groups and
pages are small and pages carry an index, so a reader can select rows and columns.

Null texts are empty. Rows that repeat a doc_id are kept, ordered by text. Null ids come first.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.word_ids import release, word_ids
from patronage.staging import _application_folder, stage

#: Characters that a sentencepiece model encodes at a time, or one longer text.
BATCH_CHARS = 1 << 18
#: Rows of texts or ids that go to a Python worker at a time; they are long.
BATCH_ROWS = 2000


def tokenizer_file(name: str) -> str:
    """Where the public tokenizer `name` lies; every executor has its own copy."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_version(path: str) -> str:
    """Digest of a tokenizer's file and of the settings it is used with."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + b"|special=default|add=no|truncate=no|pad=no").hexdigest()


def _sizes(path: str):
    """A function from a column of texts to their numbers of ids, in slices of bounded size.

    A tokenizers file encodes each distinct word once per worker process (`word_ids`); a
    sentencepiece model, whose pieces cross words, encodes whole texts.
    """
    if not path.endswith(".model"):
        words = word_ids(path)
        return lambda column: (counts for _, _, _, counts in words.encode(column))
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def sliced(column: pa.Array) -> Iterator[np.ndarray]:
        texts = column.to_pylist()
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= BATCH_CHARS):
                size += len(texts[end])
                end += 1
            ids = model.encode(texts[at:end], num_threads=1)
            yield np.fromiter(map(len, ids), np.int64, len(ids))
            at = end

    return sliced


def _counter(name: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = _sizes(tokenizer_file(name))
        for batch in batches:
            counts = np.concatenate([np.zeros(0, np.int64), *sizes(batch.column(1))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts)], names=["digest", "n_tokens"])

    return count


CACHE = "digest binary, version string, n_tokens long"


def token_counts(
    docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", cache: str | None = None, normalise=None
) -> DataFrame:
    """doc_id, n_bytes, n_tokens per document; new counts are appended to the folder `cache`.

    Without `cache` the application's own folder is used, empty at first. `normalise` maps the
    text column to what is digested and encoded. An interrupted append leaves nothing behind that
    is read; content encoded twice by concurrent runs has equal counts and is read once.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_file(tokenizer))
    body: Column = F.coalesce(F.col("text"), F.lit(""))
    body = normalise(body) if normalise else body
    folder = cache or f"{_application_folder(spark)}/token-cache-{os.urandom(8).hex()}"
    spark.createDataFrame([], CACHE).write.mode("append").parquet(folder)
    stored = lambda: (
        spark.read.schema(CACHE).parquet(folder).where(F.col("version") == version)
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    )
    digest = F.unhex(F.sha2(body, 256))
    keys = stage(
        docs.select(
            F.col("doc_id").cast("long"), digest.alias("digest"),
            F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("n_bytes"),
        ),
        "digests",
    )
    identity = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))
    misses = keys.groupBy("digest").agg(F.min(identity).alias("id")).join(stored(), "digest", "left_anti")
    texts = docs.select(identity.alias("id"), digest.alias("digest"), body.alias("body"))
    new = texts.join(misses, ["id", "digest"]).select("digest", "body")
    new = new.mapInArrow(_counter(tokenizer), "digest binary, n_tokens long")
    # rows that repeat both doc_id and text come here twice and are stored once
    new = new.dropDuplicates(["digest"])
    new.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(folder)
    return keys.join(stored(), "digest").select("doc_id", "n_bytes", "n_tokens")


IDS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)
#: One writer holds a row group in memory; pages bound what a selective read must decode.
PARQUET = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside sends `BATCH_ROWS` rows at a time to Python, or fewer if the session says so."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _ids_of(name: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_file(name))
        for batch in batches:
            for low, high, ids, counts in words.encode(batch.column(1)):
                ids = np.insert(ids, np.cumsum(counts), end_id).astype(np.int32)
                offsets = np.concatenate([[0], np.cumsum(counts + 1)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(counts + 1), lists], names=["doc_id", "n_tokens", "ids"]
                )

    return encode


def write_token_ids(
    docs: DataFrame, folder: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, file_bytes: int = 64 << 20
) -> None:
    """Write the ids of `docs`; file names ascend with doc_id. `file_bytes` of text go to a file.

    The text is dealt by range of doc_id and sorted first and encoded last, in the task that writes
    the file, so ids are never shuffled and a lost task is simply run again.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc(), F.col("text").asc()]
    dealt = (
        docs.select(F.col("doc_id").cast("long"), text.alias("text"))
        .repartitionByRange(files, *order[:2])
        .sortWithinPartitions(*order)
    )
    with _small_batches(docs.sparkSession):
        dealt.mapInArrow(_ids_of(tokenizer, end_id), IDS).write.options(**PARQUET).parquet(folder)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()  # a reused worker process may hold the words of the stage that wrote the files
    for batch in batches:
        lists = batch.column(3)
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy().astype("<u4", copy=False)
        sums = [zlib.crc32(values[a:z].tobytes()) for a, z in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
            names=["file", "at", "doc_id", "n_tokens", "ids_crc32"],
        )


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row of the files, in their order.

    `start` counts the ids of all rows before: whole files by a sum over files, then the rows of
    the own file. The window over files sees one row per file.
    """
    files = spark.read.schema(IDS).parquet(folder)
    rows = files.select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"), "doc_id", "ids"
    ).mapInArrow(_checksums, "file string, at long, doc_id long, n_tokens long, ids_crc32 long")
    with _small_batches(spark):
        rows = stage(rows, "id-digests")
    before = Window.orderBy(F.regexp_extract("file", r"^part-(\d+)", 1).cast("long"), "file").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("file").agg(F.sum("n_tokens").alias("all")).select(
        "file", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base")
    )
    own = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("n_tokens").over(own), F.lit(0))
    return rows.join(base, "file").select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")
