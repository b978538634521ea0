"""Exact duplicates by deterministic block naming.

Each normalised text is cut into blocks of fixed size. Equal blocks get the same integer name and different blocks different
ones: the distinct blocks are brought together with their whole contents, sorted, and numbered. Then adjacent names of a
document are named in pairs, and these pairs again, until one name is left. Documents with the same number of blocks and the same
last name are equal; no two different documents ever share one, whatever their digests.

Contents are shuffled once, as distinct blocks. Documents carry two 64-bit hashes of each block instead of the block; that
this is safe is proved on every run, from the contents, when the blocks are named: if two different blocks have the same pair
of hashes, the run starts again with other seeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import SPACES, rows_with, staged, with_unique_key

BLOCK = 4096


def normalised(text: Column) -> Column:
    """The text without the six separators; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACES}]+", "")


def _blocks(norm: Column, size: int) -> Column:
    """Consecutive blocks of ``size`` code points; the empty text is one empty block."""
    return F.when(F.length(norm) <= size, F.array(norm)).otherwise(
        F.regexp_extract_all(norm, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    )


def _numbered(distinct: DataFrame) -> DataFrame:
    """Different rows get different integers: each shard is sorted by content and counted on from its own first number."""
    return distinct.sortWithinPartitions(*distinct.columns).withColumn("name", F.monotonically_increasing_id())


def _hashes(block: Column, seed: int) -> tuple[Column, Column]:
    return F.xxhash64(block, F.lit(seed)), F.xxhash64(F.lit(seed + 1), block)


def _block_names(docs: DataFrame, text: str, size: int) -> tuple[DataFrame, int]:
    """``a, b, name`` of every distinct block, and the seed with which no two blocks share ``a, b``."""
    seed = 0
    while True:
        cut = docs.select(normalised(F.col(text)).alias("norm"))
        named = _numbered(cut.select(F.explode(_blocks(F.col("norm"), size)).alias("block")).distinct())
        a, b = _hashes(F.col("block"), seed)
        names = staged(named.select(a.alias("a"), b.alias("b"), "name"), "block-names")
        if not names.groupBy("a", "b").count().where("count > 1").limit(1).count():
            return names, seed
        seed += 2


def identities(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``row`` (a number of its own), ``key``, ``n_chars`` of the original text, ``text_sha256`` of
    the normalised one, and ``blocks, name``, equal exactly where the normalised texts are equal."""
    names, seed = _block_names(docs, text, size)
    cut = docs.select(
        F.col(key).alias("key"), F.length(F.coalesce(text, F.lit(""))).alias("n_chars"), normalised(F.col(text)).alias("norm")
    )
    hashes = F.transform(_blocks(F.col("norm"), size), lambda c: F.struct(*(h.alias(n) for h, n in zip(_hashes(c, seed), "ab"))))
    rows = staged(
        cut.select(F.monotonically_increasing_id().alias("row"), "key", "n_chars", F.sha2("norm", 256).alias("text_sha256"),
                   hashes.alias("hashes")),
        "block-hashes",
    )
    blocks = rows.select("row", F.size("hashes").alias("blocks"), F.posexplode("hashes").alias("at", "h"))
    blocks = blocks.select("row", "blocks", "at", "h.a", "h.b").join(names, ["a", "b"])
    open_names = staged(blocks.select("row", "blocks", F.col("blocks").alias("n"), "at", "name"), "named-blocks")
    finished = open_names.where("n = 1")
    longest = rows.agg(F.max(F.size("hashes"))).first()[0] or 1
    while longest > 1:
        pairs = open_names.where("n > 1").withColumn("left", F.when(F.col("at") % 2 == 0, F.col("name")))
        pairs = pairs.withColumn("right", F.when(F.col("at") % 2 == 1, F.col("name")))
        pairs = pairs.groupBy("row", "blocks", F.expr("(n + 1) div 2").cast("int").alias("n"), F.shiftright("at", 1).alias("at"))
        pairs = staged(pairs.agg(F.max("left").alias("left"), F.coalesce(F.max("right"), F.lit(-1)).alias("right")), "name-pairs")
        named = _numbered(pairs.select("left", "right").distinct())
        open_names = staged(pairs.join(named, ["left", "right"]).select("row", "blocks", "n", "at", "name"), "named-pairs")
        finished = finished.union(open_names.where("n = 1"))
        longest = (longest + 1) // 2
    return rows.drop("hashes").join(finished.select("row", "blocks", "name"), "row")


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = BLOCK) -> DataFrame:
    """``key, keep_id, group_size, kept, text_sha256`` for every row of ``docs``, dropped ones too.

    Of equal texts the row with the most code points stays, then the smallest key, null keys last; of repeated rows that agree in
    these too, one. Null, empty and blank texts are equal to each other. Further columns are not read.
    """
    rows = staged(identities(docs, key, text, size), "identities")
    best = F.min(F.struct(-F.col("n_chars"), F.col("key").isNull(), F.col("key"), F.col("row")))
    groups = rows.groupBy("blocks", "name").agg(best.alias("best"), F.count("*").alias("group_size"))
    groups = groups.select("blocks", "name", F.col("best.key").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")
    out = rows.join(staged(groups, "groups"), ["blocks", "name"])  # written, so that a large group's rows can be split
    return out.select(F.col("key").alias(key), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                      "text_sha256")


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows, own = with_unique_key(docs, key)
    kept = exact_duplicates(rows, own, text).where("kept").select(F.col(own).alias("kept"))
    return rows_with(rows, own, kept).select(*docs.columns)
