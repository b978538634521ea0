"""Latest row per key and status changes over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierloom.operators.skew import SLICE, join_summaries, with_slices


def _columns(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def latest_per_key(
    df: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """The newest row of each key.

    Spark limits each group to one row before the shuffle (``WindowGroupLimit``), so that a hot key sends one row per
    task. Without ``tie_break`` any of the newest rows may be kept.
    """
    newest = Window.partitionBy(*_columns(key)).orderBy(*[F.desc(c) for c in [*_columns(order_by), *tie_break]])
    return df.withColumn("__row", F.row_number().over(newest)).where("__row = 1").drop("__row")


def neighbours(
    sliced: DataFrame, slices: int, key: Sequence[str], ts: str, state: Column, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Add the structs ``__before`` and ``__after``: the state of the previous and next row of the same key.

    They are NULL only at the two ends of a key, also where the state itself is NULL. The frame comes with its slices
    from :func:`tierloom.operators.skew.with_slices`; at the ends of a slice the neighbouring slices answer.
    """
    group = [*key, SLICE]
    order = [ts, *tie_break]
    window = Window.partitionBy(*group).orderBy(*order)
    out = sliced.withColumns({"__before": F.lag(state).over(window), "__after": F.lead(state).over(window)})
    if not slices:
        return out
    along = Window.partitionBy(*key).orderBy(SLICE)
    edges = (
        sliced.where(F.col(SLICE) > 0)
        .groupBy(*group)
        .agg(F.min_by(state, F.struct(*order)).alias("first"), F.max_by(state, F.struct(*order)).alias("last"))
        .select(*group, F.lag("last").over(along).alias("__carry"), F.lead("first").over(along).alias("__next"))
    )
    return (
        join_summaries(out, edges, group, slices)
        .withColumns({"__before": F.coalesce("__before", "__carry"), "__after": F.coalesce("__after", "__next")})
        .drop("__carry", "__next")
    )


def status_transitions(
    df: DataFrame, key: str | Sequence[str], ts: str, status: str, tie_break: Sequence[str] = (), **slicing
) -> DataFrame:
    """Add ``prev_status``, ``next_status`` and ``status_changed`` (a previous status exists and differs)."""
    keys = _columns(key)
    sliced, slices = with_slices(df, keys, ts, **slicing)
    return (
        neighbours(sliced, slices, keys, ts, F.struct(F.col(status).alias("status")), tie_break)
        .withColumns({"prev_status": F.col("__before.status"), "next_status": F.col("__after.status")})
        .withColumn(
            "status_changed", F.col("prev_status").isNotNull() & (F.col("prev_status") != F.col(status))
        )
        .drop("__before", "__after", SLICE)
    )
