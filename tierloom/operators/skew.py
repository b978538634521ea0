"""Slices for keys that hold too many rows for one task: a prefix scan over ranges of (key, order).

A window over ``partitionBy(key)`` puts all rows of a key into one task. Here the rows, in the order of key and order column, are
cut into ranges of about :data:`ROWS_PER_SLICE` rows by a sorted sample, and a window runs over (key, slice). What a slice needs from
earlier ones is one summary row, and the callers scan these summaries. The number of slices grows with the rows and the
rows of a slice do not, however they are spread over the keys.

Keys count by their hash, as only the order within a key matters. A key of fewer than about two slices is not cut. Where the cuts fall
changes only the work per task and never the result, so a sample may choose them; it is read once, so that every later evaluation
of the frame cuts in the same places.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions.columns import clock_position
from tierloom.operators.joins import join_null_safe
from tierloom.session import carry_to_workers

carry_to_workers(__name__)

SLICE = "__slice"
_HASH, _AT = "__key_hash", "__at"

#: Rows of a slice, about; a table of fewer rows than the second number is left whole.
ROWS_PER_SLICE, MIN_ROWS = 1_000_000, 5_000_000
#: Sampled rows between two cuts, which makes slices even to about a fifth, and sampled rows that one task sorts.
SAMPLE_PER_SLICE, SAMPLE_PER_TASK = 32, 65_536
#: So many summaries may be broadcast; more of them are joined by the planner's choice.
BROADCAST_SLICES = 200_000


def with_slices(
    df: DataFrame,
    key: Sequence[str],
    order_by: str,
    rows_per_slice: int = ROWS_PER_SLICE,
    min_rows: int = MIN_ROWS,
    profile: DataFrame | None = None,
) -> tuple[DataFrame, int]:
    """Add the column :data:`SLICE`: 0 for keys that are not cut, 1, 2, ... in order for the rows of those that are.

    Returns the frame and the number of slices, 0 if no key is cut. The sample comes from ``profile`` if the rows of ``df`` are
    costly to compute: a frame with the same key and order columns that needs no join.
    """
    profile = df if profile is None else profile
    rows = profile.count()  # reads no columns
    if rows <= min_rows:
        return df.withColumn(SLICE, F.lit(0)), 0
    placed = [F.xxhash64(*key).alias(_HASH), _position(df, order_by).alias(_AT)]
    cuts = _cuts(profile.select(*placed), rows, rows_per_slice)
    if not len(cuts):
        return df.withColumn(SLICE, F.lit(0)), 0
    # one cut per slice, two numbers each
    shared = df.sparkSession.sparkContext.broadcast({h: own[_AT].to_numpy() for h, own in cuts.groupby(_HASH)})

    @F.pandas_udf("int")
    def slice_of(hashes: pd.Series, at: pd.Series) -> pd.Series:
        bounds, out = shared.value, np.zeros(len(hashes), np.int32)
        hashes, at = hashes.to_numpy(), at.to_numpy()
        for one in set(np.unique(hashes).tolist()) & bounds.keys():
            own = hashes == one
            out[own] = 1 + np.searchsorted(bounds[one], at[own])
        return pd.Series(out)

    return df.withColumn(SLICE, slice_of(*placed)), len(cuts) + cuts[_HASH].nunique()


def _position(df: DataFrame, order_by: str):
    """A number that rises with the order column; NULL comes first."""
    return F.coalesce(clock_position(order_by, dict(df.dtypes)[order_by]), F.lit(float("-inf")))


def _cuts(placed: DataFrame, rows: int, rows_per_slice: int) -> pd.DataFrame:
    """Every :data:`SAMPLE_PER_SLICE`-th row of a sorted sample, of keys that have several, without repeats."""
    sampled = SAMPLE_PER_SLICE * rows / rows_per_slice
    some = placed.sample(min(1.0, sampled / rows), 17)
    tasks = max(1, int(sampled / SAMPLE_PER_TASK))
    in_order = some.repartitionByRange(tasks, _HASH, _AT).sortWithinPartitions(_HASH, _AT)
    number = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    picked = in_order.select(_HASH, _AT, number.alias("n")).where(F.col("n") % SAMPLE_PER_SLICE == SAMPLE_PER_SLICE - 1)
    found = picked.select(_HASH, _AT).toPandas().sort_values([_HASH, _AT])
    found = found[found.groupby(_HASH)[_AT].transform("size") > 1] if len(found) else found
    return found.drop_duplicates()


def join_summaries(rows: DataFrame, summaries: DataFrame, columns: Sequence[str], slices: int) -> DataFrame:
    """Attach one summary row per (key, slice), of which there are ``slices``. A NULL key has its own."""
    return join_null_safe(rows, F.broadcast(summaries) if slices <= BROADCAST_SLICES else summaries, columns)
