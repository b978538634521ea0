"""Comparing rule thresholds: run summaries, scored customers per run, and differences between runs."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.functions.columns import known_or_zero
from tierloom.operators.alerts import HIGH_VALUE, alert_reason, default_rules
from tierloom.session import carry_to_workers
from tierloom.sources.writers import write_csv

carry_to_workers(__name__)

#: Different thresholds of one sweep over a table of them.
MOST_THRESHOLDS = 100_000

SCORED = ["customer_id", "customer_name", "total_spend", "pending_orders", "cancelled_orders"]


def scoring_input(customers: DataFrame, signals: DataFrame, key: str = "customer_id") -> DataFrame:
    """All customers with their measures, NULL for a customer without orders."""
    return customers.join(signals, key, "left").select(*SCORED)


def threshold_sweep(scoring: DataFrame, runs: Mapping[str, float]) -> DataFrame:
    """One row per run with its parameters and metrics. All runs are counted in one pass over the customers."""
    reasons = {name: alert_reason(default_rules(threshold)) for name, threshold in runs.items()}
    counted = scoring.agg(
        F.count("*").alias("total"),
        *[F.count_if(reason == HIGH_VALUE).alias(f"hits_{i}") for i, reason in enumerate(reasons.values())],
    )

    def run_row(i: int, name: str, threshold: float):
        params = F.create_map(F.lit("high_value_threshold"), F.lit(str(threshold)))
        metrics = F.create_map(
            F.lit("high_value_customer_count"), F.col(f"hits_{i}").cast("double"),
            F.lit("total_customers_scored"), F.col("total").cast("double"),
        )
        return F.struct(F.lit(name).alias("run_name"), params.alias("params"), metrics.alias("metrics"))

    rows = [run_row(i, name, threshold) for i, (name, threshold) in enumerate(runs.items())]
    return counted.select(F.inline(F.array(*rows)))


def sweep_table(scoring: DataFrame, runs: DataFrame, name: str = "run_name", threshold: str = "threshold") -> DataFrame:
    """One row per row of ``runs`` with the number of customers above its threshold and of all customers.

    Thresholds are sorted once, each customer is placed among them by binary search, and the counts per place are summed from the
    top, so a thousand thresholds cost one pass over the customers, as one does. There may be :data:`MOST_THRESHOLDS` different
    ones. A run without a threshold (NULL or NaN) has no hits.
    """
    value = F.nanvl(F.col(threshold).cast("double"), F.lit(None))
    marks = runs.select(value.alias("t")).where("t is not null").distinct().limit(MOST_THRESHOLDS + 1).collect()
    if len(marks) > MOST_THRESHOLDS:
        raise ValueError(f"more than {MOST_THRESHOLDS} thresholds")
    cuts = np.sort(np.array([row["t"] for row in marks], float))

    @F.pandas_udf(T.LongType())
    def passed(spend: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, spend.to_numpy(), side="left"))

    # A customer above n of the sorted thresholds is a hit of the first n. From here on there is a row per place and threshold.
    places = scoring.select(passed(known_or_zero("total_spend").cast("double")).alias("place"))
    places = places.groupBy("place").agg(F.count("*").alias("n"))
    grid = [*((i, float(t)) for i, t in enumerate(cuts)), (len(cuts), None)]
    both = scoring.sparkSession.createDataFrame(grid, "place long, t double").unionByName(places, allowMissingColumns=True)
    above = Window.orderBy(F.desc("place"), F.col("n").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = both.select("t", "n", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("hits"),
                         F.coalesce(F.sum("n").over(everyone), F.lit(0)).alias("customers"))
    counts = F.broadcast(counts.where("n is null").drop("n"))  # a row per different threshold, and one for none
    joined = runs.join(counts, value.eqNullSafe(F.col("t")))
    return joined.select(F.col(name), F.col(threshold), "hits", "customers")


def scored_by_run(scoring: DataFrame, runs: Mapping[str, float]) -> DataFrame:
    """Every customer under every run. Customers are joined to their measures once, then scored per run in place."""
    per_run = [
        F.struct(F.lit(name).alias("run_name"), alert_reason(default_rules(threshold)).alias("alert_reason"))
        for name, threshold in runs.items()
    ]
    scored = scoring.withColumn("__run", F.explode(F.array(*per_run)))
    return scored.select("__run.run_name", *SCORED, "__run.alert_reason")


def write_runs(scored: DataFrame, path: str) -> str:
    """The scored customers as one CSV folder per run."""
    return write_csv(scored, path, partition_by=["run_name"])


def threshold_diff(scoring: DataFrame, runs: Mapping[str, float], a: str, b: str, key: str = "customer_id") -> DataFrame:
    """:func:`run_diff` straight from the measures: both alerts of a customer are compared in place, without a shuffle."""
    alert_a, alert_b = (alert_reason(default_rules(runs[name])) for name in (a, b))
    both = scoring.select(key, alert_a.alias("alert_a"), alert_b.alias("alert_b"))
    return both.where(~F.col("alert_a").eqNullSafe(F.col("alert_b")))


def run_diff(scored: DataFrame, a: str, b: str, key: str = "customer_id") -> DataFrame:
    """Customers whose alert differs between two runs. The runs meet in one aggregate instead of a self-join."""
    return (
        scored.where(F.col("run_name").isin(a, b))
        .groupBy(key)
        .agg(
            F.max(F.when(F.col("run_name") == a, F.col("alert_reason"))).alias("alert_a"),
            F.max(F.when(F.col("run_name") == b, F.col("alert_reason"))).alias("alert_b"),
        )
        .where(~F.col("alert_a").eqNullSafe(F.col("alert_b")))
    )
