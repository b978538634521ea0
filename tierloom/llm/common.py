"""What the operators of this package share: staging, whole-text columns, word ids, components of links."""

from __future__ import annotations

import sys
from collections import defaultdict

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.session import shared_folder

# Functions of this package travel with their tasks; workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules["tierloom.llm"])

#: The six characters that separate words.
SPACES = "\x20\x09-\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str, partitions: int | None = None) -> DataFrame:
    """Write to the shared folder and read back: computed once, lineage cut, kept when executors are lost."""
    path = shared_folder(df.sparkSession, purpose)
    (df.repartition(partitions) if partitions else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: Column) -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(column, F.lit("")).cast("binary")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column has."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_unique_key(docs: DataFrame, key: str) -> tuple[DataFrame, str]:
    """``docs`` and a column that tells all rows apart and sorts as ``key`` does, null keys last.

    That is ``key``, or where it has nulls or repeats, a struct of it and a number, written with the rows; the number decides between
    rows with one key only.
    """
    repeated = docs.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).where("n > 1 or key is null")
    if not repeated.limit(1).count():
        return docs, key
    name = fresh_name(docs, "_row")
    own = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.monotonically_increasing_id().alias("n"))
    return staged(docs.withColumn(name, own), "numbered"), name


def rows_with(docs: DataFrame, key: str, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is in the one column of ``kept``."""
    name = fresh_name(docs, "_kept")
    return docs.join(kept.toDF(name), F.col(key) == F.col(name), "left_semi")


def words_of(text: bytes) -> list[bytes]:
    """Runs without the six separators. ``bytes.split`` knows exactly these six and no other white space."""
    return text.split()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def record_batches(rows, schema: pa.Schema, size: int = 4096):
    """Tuples as record batches of at most ``size`` rows."""
    block = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), schema)], schema=schema)
            block = []
    if block:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), schema)], schema=schema)


def numbering() -> defaultdict:
    """A dictionary that gives each new key the next integer."""
    ids: defaultdict = defaultdict()
    ids.default_factory = ids.__len__
    return ids


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Smallest node that each linked node reaches: ``node, root`` from undirected ``a, b``.

    Alternates two steps on the whole edge table: each node hands its smallest neighbour to its larger neighbours, then to
    its smaller ones. Both work per edge with grouped minima, so no node's neighbourhood meets in one place, and every
    round is written to the shared folder. Ends when a round changes nothing; the number of rounds is about the
    logarithm of the longest chain. Edges with a null end or with equal ends are left out.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = staged(edges, purpose)
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                                F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
        edges = staged(small.select("col.*").where("u <> v").distinct(), purpose)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def linked_labels(links, left, right):
    """Smallest labels along a block of links: ``links[i, j]`` joins row ``i`` to column ``j``; labels only go down.

    What is emitted from this is one edge for each label that went down, not one for each link.
    """
    import numpy as np

    most = np.iinfo(np.int64).max

    def least_of(matrix, values, own):
        strips = [np.where(matrix[at : at + 128], values[None, :], most).min(1, initial=most) for at in range(0, len(matrix), 128)]
        return np.minimum(own, np.concatenate(strips)) if strips else own

    while True:
        new_left = least_of(links, right, left)
        new_right = least_of(links.T, new_left, right)
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right
