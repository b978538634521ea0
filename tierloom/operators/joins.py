"""Fact-to-dimension joins and checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A dimension of at most this many rows and bytes may be broadcast on request.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and about as many bytes as they take: texts as they are, nested values as JSON, 8 for the rest."""
    sizes = []
    for field in df.schema:
        kind = field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(field.name), F.lit(0)))
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.coalesce(F.length(F.to_json(F.struct(field.name))), F.lit(0)))
    row = reduce(Column.__add__, sizes, F.lit(8 * (1 + len(df.columns))))
    found = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("bytes")).first()
    return found["rows"], found["bytes"]


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring rows and bytes; a larger side is left to the planner."""
    rows, size = measured_size(df)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def enrich(
    facts: DataFrame, dimension: DataFrame, key: str | Sequence[str], broadcast: bool = False,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join of facts to a dimension, keeping all facts.

    Without the hint the planner picks the strategy from sizes seen at run time, and splits the partitions of a hot
    key on the fact side (adaptive skew join; a left join may split its left side).
    """
    return facts.join(broadcast_if_small(dimension, max_rows) if broadcast else dimension, key, "left")


def join_null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL equals NULL, as in grouping; the key columns come from the left side."""
    renamed = right.withColumnsRenamed({name: f"__right_{name}" for name in columns})
    matches = [F.col(name).eqNullSafe(F.col(f"__right_{name}")) for name in columns]
    return left.join(renamed, reduce(Column.__and__, matches), how).drop(*[f"__right_{name}" for name in columns])


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is not in the parent. A NULL key refers to nothing and is no orphan."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")
