"""Drift between a baseline and a current window: KS test, mean shift, category shares, and a summary report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierloom.functions.columns import percent_change
from tierloom.functions.ks import exact_p, series_p
from tierloom.operators.joins import join_null_safe
from tierloom.operators.ranks import values_at_ranks
from tierloom.operators.skew import SLICE, join_summaries, with_slices
from tierloom.session import shared_folder
from tierloom.sources.writers import write_parquet

BASELINE, CURRENT = "baseline", "current"

# Default limits of the two checks, and the closing lines of the report.
ALPHA = 0.05
THRESHOLD_PCT = 30.0
ADVICE = (
    "Recommendation: review scoring thresholds (e.g. high_value_customer cutoff) — "
    "they may be stale relative to current data."
)
NO_DRIFT = "No significant drift detected across checked features."


def union_windows(frames: Mapping[str, DataFrame], window_col: str = "window") -> DataFrame:
    """Stack frames with the same columns, each labelled with its window name."""
    out = None
    for label, frame in frames.items():
        labelled = frame.withColumn(window_col, F.lit(label))
        out = labelled if out is None else out.unionByName(labelled)
    return out


def _long(df: DataFrame, group: Sequence[str], features: Sequence[str]) -> DataFrame:
    """One row per (group, feature, value), NULL and NaN left out as a missing value."""
    doubles = df.select(*group, *[F.col(f).cast("double").alias(f) for f in features])
    return doubles.unpivot(list(group), list(features), "feature", "value").where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def _in(window_col: str, label: str) -> Column:
    return F.col(window_col) == label


def _window_stats(df: DataFrame, window_col: str, features: Sequence[str]) -> DataFrame:
    """Size and mean of both windows per feature, from one aggregate; a feature without values has NULL means."""
    known = [F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features]
    aggregates, per_feature = [], []
    for i, (name, column) in enumerate(zip(features, known)):
        fields = [F.lit(name).alias("feature")]
        for label in (BASELINE, CURRENT):
            value = F.when(_in(window_col, label), column)
            aggregates += [F.avg(value).alias(f"{label}_mean_{i}"), F.count(value).alias(f"{label}_rows_{i}")]
            fields += [F.col(f"{label}_{part}_{i}").alias(f"{label}_{part}") for part in ("mean", "rows")]
        per_feature.append(F.struct(*fields))
    return df.agg(*aggregates).select(F.inline(F.array(*per_feature)))


def _shifted(stats: DataFrame, threshold_pct: float, change: str) -> DataFrame:
    """Add the percent change of the mean, infinite from a mean of 0, and whether it is beyond the threshold."""
    after = F.col("current_mean")
    from_zero = F.when(after != 0, F.lit(float("inf"))).otherwise(F.lit(0.0))
    return stats.withColumn(change, percent_change(F.col("baseline_mean"), after, from_zero)).withColumn(
        "mean_shift_drift", F.coalesce(F.abs(change) > threshold_pct, F.lit(False))
    )


def mean_shift(
    df: DataFrame, window_col: str, features: Sequence[str], threshold_pct: float = THRESHOLD_PCT
) -> DataFrame:
    """Percent change of the mean per feature, flagged above the threshold in either direction.

    From a mean of 0 any change counts as infinite. All features share one scan and one aggregate.
    """
    stats = _window_stats(df, window_col, features).drop("baseline_rows", "current_rows")
    return _shifted(stats, threshold_pct, "pct_change")


def _running_counts(
    long: DataFrame, group: Sequence[str], counts: Mapping[str, Column], **slicing
) -> DataFrame:
    """Counts per distinct value with running sums (``run_*``, including the value) in value order per group.

    Rows are first combined to one per distinct value. A group with many of them is summed in slices, whose totals
    shift the sums of the following slices, so no task sees a whole group.
    """
    sliced, slices = with_slices(long, group, "value", **slicing)
    aggregates = [column.alias(name) for name, column in counts.items()]
    per_value = sliced.groupBy(*group, SLICE, "value").agg(*aggregates)
    so_far = Window.partitionBy(*group, SLICE).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    running = per_value.withColumns({f"run_{name}": F.sum(name).over(so_far) for name in counts})
    if not slices:
        return running.drop(SLICE)
    earlier = Window.partitionBy(*group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        sliced.where(F.col(SLICE) > 0)
        .groupBy(*group, SLICE)
        .agg(*aggregates)
        .select(*group, SLICE, *[F.sum(name).over(earlier).alias(f"shift_{name}") for name in counts])
    )
    return (
        join_summaries(running, shifts, [*group, SLICE], slices)
        .withColumns(
            {f"run_{n}": F.col(f"run_{n}") + F.coalesce(F.col(f"shift_{n}"), F.lit(0)) for n in counts}
        )
        .drop(SLICE, *[f"shift_{name}" for name in counts])
    )


P_VALUES = {"limiting": series_p, "exact": exact_p}


def ks_drift(
    df: DataFrame, window_col: str, features: Sequence[str], alpha: float = ALPHA, method: str = "limiting", **slicing
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per feature between the two windows, missing values left out.

    The statistic is the largest gap between the two running shares over all values. ``method`` says which p-value goes
    with it, at every size: ``limiting`` is that of large samples, ``exact`` counts lattice paths, with work that grows
    with the rows of both samples on one core, and is meant for small windows.
    """
    if method not in P_VALUES:
        raise ValueError(f"unknown method {method}")
    long = _long(df.where(F.col(window_col).isin(BASELINE, CURRENT)), [window_col], features)
    counts = {"n": F.count_if(_in(window_col, BASELINE)), "m": F.count_if(_in(window_col, CURRENT))}
    stats = _window_stats(df, window_col, features)  # one row per listed feature
    size_n, size_m = F.col("baseline_rows"), F.col("current_rows")
    gaps = (
        _running_counts(long, ["feature"], counts, **slicing)
        .join(F.broadcast(stats.select("feature", "baseline_rows", "current_rows")), "feature")
        .groupBy("feature")
        .agg(F.max(F.abs(F.try_divide("run_n", size_n) - F.try_divide("run_m", size_m))).alias("ks_stat"))
    )
    p = P_VALUES[method](F.col("ks_stat"), size_n, size_m)
    change = percent_change(F.col("baseline_mean"), F.col("current_mean"), F.lit(float("nan")))
    return (
        stats.join(gaps, "feature", "left")
        .withColumn("p_value", p)
        .select(
            "feature",
            "baseline_mean",
            "current_mean",
            change.alias("pct_change"),
            "ks_stat",
            "p_value",
            F.coalesce(F.col("p_value") < alpha, F.lit(False)).alias("drift_detected"),
        )
    )


def categorical_drift(df: DataFrame, window_col: str, features: Sequence[str]) -> DataFrame:
    """Share of each category in both windows, in percent; a category missing on one side has 0 there."""
    long = df.select(window_col, *[F.col(f).cast("string").alias(f) for f in features]).unpivot(
        [window_col], list(features), "feature", "category"
    ).where(F.col("category").isNotNull())
    counts = [F.count_if(_in(window_col, BASELINE)), F.count_if(_in(window_col, CURRENT))]
    per_category = long.groupBy("feature", "category").agg(counts[0].alias("b"), counts[1].alias("c"))
    totals = long.groupBy("feature").agg(counts[0].alias("all_b"), counts[1].alias("all_c"))

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0)) * 100

    return (
        per_category.where("b > 0 or c > 0")
        .join(F.broadcast(totals), "feature")  # one row per listed feature
        .select(
            "feature", "category", share("b", "all_b").alias("baseline_pct"), share("c", "all_c").alias("current_pct")
        )
    )


def combined_drift(
    df: DataFrame, window_col: str, numeric: Sequence[str], alpha: float = ALPHA,
    threshold_pct: float = THRESHOLD_PCT, method: str = "limiting", **slicing,
) -> DataFrame:
    """KS result per feature with the mean-shift flag; either one flags the feature."""
    ks = ks_drift(df, window_col, numeric, alpha, method, **slicing)
    return (
        _shifted(ks, threshold_pct, "__change")
        .drop("__change")
        .withColumn("combined_drift", F.col("drift_detected") | F.col("mean_shift_drift"))
    )


def drift_summary(report: DataFrame) -> DataFrame:
    """One row: the drifted features in name order and what to do about them."""
    names = F.array_sort(F.collect_list(F.when(F.col("combined_drift"), F.col("feature"))))  # one per feature
    return report.agg(names.alias("drifted")).select(
        F.array_join("drifted", ", ").alias("drifted_features"),
        F.when(F.size("drifted") > 0, ADVICE).otherwise(NO_DRIFT).alias("advice"),
    )


QUARTILES = {"q25": 0.25, "q50": 0.50, "q75": 0.75}


def describe(df: DataFrame, group: Sequence[str], features: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per group and feature; missing values are left out.

    Quartiles are exact, interpolated between the two neighbouring ranks, which are selected by counting
    (:func:`tierloom.operators.ranks.values_at_ranks`), so no task holds the values of a group.
    """
    keys = [*group, "feature"]
    long = _long(df, group, features)
    basics = long.groupBy(*keys).agg(
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # Written once, the basics are not computed again for the ranks and the join.
    stored = write_parquet(basics, shared_folder(df.sparkSession, "describe"))
    basics = df.sparkSession.read.schema(basics.schema).parquet(stored)
    last = F.col("count") - 1
    ends = [edge(last * share).cast("long") for share in QUARTILES.values() for edge in (F.floor, F.ceil)]
    found = values_at_ranks(long, keys, basics.select(*keys, F.explode(F.array(*ends)).alias("rank")))
    by_rank = found.groupBy(*keys).agg(F.map_from_entries(F.collect_set(F.struct("rank", "value"))).alias("at"))  # six at most

    def interpolated(name: str, share: float) -> Column:
        rank = last * share
        low, high = (F.col("at")[edge(rank).cast("long")] for edge in (F.floor, F.ceil))
        return (low + (high - low) * (rank - F.floor(rank))).alias(name)

    joined = join_null_safe(basics, by_rank, keys, "inner")
    return joined.select(*keys, "count", "mean", "std", "min", *[interpolated(n, s) for n, s in QUARTILES.items()], "max")
