"""Mixing sources to target weights by equal-token blocks.

Words are the tokens. Sources in code-point order (null last) get weights in turn. Together they
are to give `share` times all words; a source stops at `limit` times its own words and the rest
is shared anew by weight. Of its target a source first gives whole passes over all its documents.
The remainder is made of blocks of `block_words` words:

* sources are dealt into shards of about `shard_words` words by a seeded hash of doc_id;
* Sainte-Laguë apportionment (highest quotients w / (2 k + 1)) gives each source a whole number of
  blocks, and then each shard of it, so quotas are integers that sum up exactly. Quotients that
  must be among the highest whatever the rest are counted, not listed, so at most about two rows
  per party are ranked;
* in a shard, documents in seeded order form one stream of words cut into blocks; a quota of m of
  M blocks takes block j if (j + r) m mod M < m, with a seeded r: exactly m blocks, evenly spread.

Everything is DataFrame functions. No text is shuffled, only ids and sizes.

Nulls: a null text has no words; null sources are one source; null doc_ids are ordered by hash
as if empty. Repeated rows each count. No rows or no words: nothing is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)


def words(text) -> Column:
    """Number of words of a text; nought for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float = 1.5, limit: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """`sources` (source, source_size) with `target`: shared by weight, stopped at limit x size.

    The level at which sources stop is found in one pass over the sources by capacity per weight.
    One row per source is all that the unpartitioned windows see.
    """
    w = F.element_at(
        F.array(*map(F.lit, weights)),
        ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int"),
    )
    rows = sources.withColumn("weight", w).withColumn("stop", F.col("source_size") * F.lit(limit))
    by_level = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (
        rows.withColumn("full", F.coalesce(F.sum("stop").over(before), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(whole) * F.lit(share))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("rest"))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("stop") / F.col("weight"), F.col("level"))).over(whole))
    )
    target = F.least("stop", F.col("weight") * F.col("level"))
    return rows.select("source", "source_size", F.coalesce(target, "stop").alias("target"))


def apportion(parties: DataFrame, key: list[str], party: list[str], weight: str, seats: str) -> DataFrame:
    """`parties` with `quota`: `seats` of each `key` by the highest quotients weight / (2 k + 1).

    Ties go to the first party in the order of `party` columns.
    """
    whole = Window.partitionBy(*key) if key else Window.partitionBy(F.lit(0))
    q = parties.withColumn("parties_", F.count("*").over(whole)).withColumn("all_", F.sum(weight).over(whole))
    part = F.when(F.col("all_") > 0, F.col(weight) / F.col("all_")).otherwise(0.0)
    # rounding shares of half a party less (more) cannot give more (less) seats than there are
    low = F.greatest(F.lit(0), F.floor(part * (F.col(seats) - F.col("parties_") / 2) + 0.5)).cast("long")
    high = F.ceil(part * (F.col(seats) + F.col("parties_") / 2) + 0.5).cast("long")
    q = q.withColumn("sure_", low).withColumn("most_", F.greatest(high, low))
    q = q.withColumn("left_", F.col(seats) - F.sum("sure_").over(whole))
    quotients = q.where(F.col(weight) > 0).select(
        *key, *party, "left_", weight,
        F.explode(F.sequence("sure_", "most_")).alias("k_"),
    )
    order = Window.partitionBy(*key) if key else Window.partitionBy(F.lit(0))
    rank = F.row_number().over(
        order.orderBy((F.col(weight) / (2 * F.col("k_") + 1)).desc(), *[F.col(c).asc_nulls_last() for c in party])
    )
    won = quotients.withColumn("rank_", rank).where("rank_ <= left_").groupBy(*key, *party).agg(F.count("*").alias("won_"))
    won = won.select(*[F.col(c).alias(f"{c}_won") for c in [*key, *party]], "won_")
    same = F.lit(True)
    for c in [*key, *party]:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_won"))
    return q.join(won, same, "left").select(*parties.columns, (F.col("sure_") + F.coalesce("won_", F.lit(0))).alias("quota"))


def _seeded(seed: int, *parts) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def mix(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = (),
    share: float = 1.5,
    limit: float = 2.0,
    weights=WEIGHTS,
    block_words: int = 128,
    shard_words: int = 1_000_000,
    seed: int = 17,
) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, passes, skip, taken, and `keep`.

    `taken` is passes x size and what the chosen blocks hold of the document. `begin`, `m_`, `of_`
    and `r_` tell which words those are (see `chosen_words`).
    """
    sized = stage(
        docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), words(text).alias("size"), F.xxhash64(text).alias("content"), *keep),
        "sizes",
    )
    sources = stage(
        targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share, limit, weights)
        .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("wanted", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long"))
        .withColumn("seats", F.round(F.sum("wanted").over(Window.partitionBy(F.lit(0))) / block_words).cast("long")),
        "sources",
    )
    sources = stage(apportion(sources, [], ["source"], "wanted", "seats"), "quotas").withColumnRenamed("quota", "blocks")
    own = sized.withColumn("digest", _seeded(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    own = own.join(sources.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_")
    own = own.withColumn("shard", _number(F.col("digest")) % F.col("shards"))
    shards = own.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.max("blocks").alias("blocks")
    )
    shards = apportion(shards, ["source"], ["shard"], "shard_size", "blocks")
    count = F.ceil(F.col("shard_size") / block_words).cast("long")
    shards = stage(
        shards.select(
            F.col("source").alias("source_"), F.col("shard").alias("shard_"),
            F.least("quota", count).alias("m_"), F.greatest(count, F.lit(1)).alias("of_"),
            (_number(_seeded(seed, F.lit("start"), F.coalesce("source", F.lit("")), F.col("shard").cast("string")))).alias("r_"),
        ),
        "shards",
    )
    stream = Window.partitionBy("source", "shard").orderBy("digest", "doc_id", "size", "content")
    placed = own.withColumn(
        "begin", F.coalesce(F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    placed = placed.join(
        shards, F.col("source").eqNullSafe(F.col("source_")) & (F.col("shard") == F.col("shard_")), "left"
    )
    end = F.col("begin") + F.col("size")
    taken = F.when(F.col("size") > 0, _held(end, block_words) - _held(F.col("begin"), block_words)).otherwise(0)
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", "passes", "begin", "m_", "of_", "r_",
        (F.col("passes") * F.col("size") + taken).cast("long").alias("taken"), *keep,
    )


def _held(at: Column, block_words: int) -> Column:
    """Chosen words among the first `at` of a shard's stream."""
    block = F.floor(at / block_words)
    ahead = (block - 1 + F.col("r_") % F.col("of_")) * F.col("m_")
    behind = (F.col("r_") % F.col("of_") - 1) * F.col("m_")
    whole = F.floor(ahead / F.col("of_")) - F.floor(behind / F.col("of_"))
    return whole * block_words + (at % block_words) * _chosen(block).cast("long")


def _chosen(block: Column) -> Column:
    return ((block + F.col("r_") % F.col("of_")) * F.col("m_")) % F.col("of_") < F.col("m_")


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """The mixture as rows of `docs`: each document whole once per pass, then its chosen words.

    Chosen words that follow each other become one shorter document with the words joined by a
    space. `n_chars`, where there is such a column, is that of the shorter text.
    """
    block = settings.get("block_words", 128)
    # all columns but the text travel in one, so that their names meet no others
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select("doc_id", "source", "text", F.struct(*others).alias("row_"))
    rows = mix(packed, keep=("text", "row_"), **settings)
    first, last = F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("size") - 1) / block)
    blocks = F.when((F.col("size") > 0) & (F.col("m_") > 0), F.filter(F.sequence(first, last), _chosen)).otherwise(
        F.array().cast("array<bigint>")
    )
    # runs of blocks: a run starts where the block before is not chosen and ends likewise
    rows = rows.withColumn("blocks_", blocks)
    starts = F.filter("blocks_", lambda b: ~F.array_contains("blocks_", b - 1))
    ends = F.filter("blocks_", lambda b: ~F.array_contains("blocks_", b + 1))
    spans = F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("z")),
        lambda s: F.struct(
            (F.greatest(s["a"] * block, F.col("begin")) - F.col("begin")).alias("low"),
            (F.least((s["z"] + 1) * block, F.col("begin") + F.col("size")) - F.col("begin")).alias("high"),
        ),
    )
    whole = F.struct(F.lit(-1).cast("long").alias("low"), F.lit(-1).cast("long").alias("high"))
    rows = rows.withColumn("span_", F.explode(F.concat(F.array_repeat(whole, F.col("passes").cast("int")), spans)))
    words_ = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    part = F.array_join(
        F.slice(words_, (F.col("span_.low") + 1).cast("int"), (F.col("span_.high") - F.col("span_.low")).cast("int")), " "
    )
    as_is = F.col("span_.low") < 0
    rows = rows.withColumn("text", F.when(as_is, F.col("text")).otherwise(part))
    own = {c: F.col(f"row_.`{c}`").alias(c) for c in others} | {"text": F.col("text")}
    if "n_chars" in others:
        kind = docs.schema["n_chars"].dataType
        own["n_chars"] = F.when(as_is, own["n_chars"]).otherwise(F.length("text").cast(kind)).alias("n_chars")
    return rows.select(*(own[c] for c in docs.columns))
