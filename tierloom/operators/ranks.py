"""Exact values at given ranks of each group by radix selection: values are counted, not sorted, and never shuffled.

A double's bits, with those of negative ones turned over, are an integer in the same order. A pass counts the values by the next
:data:`DIGIT` bits of it, only of the values that share the bits found so far with a wanted rank, and keeps the bin in which each
rank falls. Tasks combine their counts first, so at most ``2**DIGIT`` numbers per group and wanted prefix leave a task. A rank is
settled as soon as its bin holds one value, at the latest after ``64 / DIGIT`` passes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.operators.joins import broadcast_if_small, join_null_safe
from tierloom.session import carry_to_workers, shared_folder
from tierloom.sources.writers import write_parquet

carry_to_workers(__name__)

DIGIT = 16


@F.pandas_udf(T.LongType())
def _ordered(values: pd.Series) -> pd.Series:
    return pd.Series(ordered_bits(values.to_numpy()))


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """64-bit integers that compare as the doubles do; both zeros are one."""
    bits = (values.astype(np.float64) + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFF_FFFF_FFFF_FFFF))


def values_at_ranks(long: DataFrame, keys: Sequence[str], wanted: DataFrame) -> DataFrame:
    """``keys, rank, value``: for each row of ``wanted`` (``keys, rank``, from 0) the value at that rank of its group of ``long``
    (``keys, value``, doubles without NULL and NaN). NULL keys are a group. Ranks that the group doesn't have give no row.
    """
    keyed = long.select(*keys, "value", _ordered("value").alias("__bits"))
    state = wanted.select(*keys, F.col("rank").cast("long").alias("rank")).distinct()
    state = state.withColumns({"__before": F.lit(0).cast("long"), "__prefix": F.lit(0).cast("long"),
                               "__low": F.lit(0.0), "__high": F.lit(1.0)})
    columns, open_ = state.columns, state
    settled = None
    for shift in range(64 - DIGIT, -1, -DIGIT):
        rows = keyed.withColumn("__bin", F.shiftright("__bits", shift))
        if shift + DIGIT < 64:
            prefixes = broadcast_if_small(open_.select(*keys, "__prefix").distinct())
            rows = join_null_safe(rows.withColumn("__prefix", F.shiftright("__bits", shift + DIGIT)), prefixes, [*keys, "__prefix"], "left_semi")
        else:
            rows = rows.withColumn("__prefix", F.lit(0).cast("long"))
        bins = rows.groupBy(*keys, "__prefix", "__bin").agg(
            F.count("*").alias("n"), F.min("value").alias("__bin_low"), F.max("value").alias("__bin_high"))
        # at most 2**DIGIT rows for each group and prefix
        along = Window.partitionBy(*keys, "__prefix").orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)
        bins = bins.withColumn("__upto", F.sum("n").over(along))
        met = join_null_safe(bins, broadcast_if_small(open_.drop("__low", "__high")), [*keys, "__prefix"], "inner")
        met = met.where((F.col("__before") + F.col("__upto") - F.col("n") <= F.col("rank")) & (F.col("rank") < F.col("__before") + F.col("__upto")))
        found = met.select(
            *keys, "rank", (F.col("__before") + F.col("__upto") - F.col("n")).alias("__before"), F.col("__bin").alias("__prefix"),
            F.col("__bin_low").alias("__low"), F.col("__bin_high").alias("__high")).select(*columns)
        path = write_parquet(found, shared_folder(long.sparkSession, "ranks"))
        found = long.sparkSession.read.schema(found.schema).parquet(path)
        done = found.where("__low = __high")
        settled = done if settled is None else settled.union(done)
        open_ = found.where("__low <> __high")
        if not open_.limit(1).count():
            break
    return settled.select(*keys, "rank", F.col("__low").alias("value"))
