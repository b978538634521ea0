"""Whole jobs over stored tables: publish the customer targets, and load keyed tables incrementally."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from tierloom.operators import alerts as al
from tierloom.operators.features import FeatureView, increment
from tierloom.operators.keyed import collection_add, new_rows, replace_keys, scd2_apply, scd2_history, upsert_newest
from tierloom.operators.quality import AcceptedValues, NotNull, Relationship, Unique, checked, guarded_write, run_checks
from tierloom.operators.staging import stage_customers, stage_orders
from tierloom.operators.windows import latest_per_key
from tierloom.session import shared_folder
from tierloom.sources.bucketed import BucketedTable
from tierloom.sources.readers import CUSTOMER_SEED, ORDER_SEED, read_csv, require_sources
from tierloom.sources.writers import write_parquet

# The declared checks of the published tables.
STAGED_CUSTOMER_CHECKS = (Unique(("customer_id",)), NotNull("customer_id"), NotNull("customer_name"))
STAGED_ORDER_CHECKS = (
    Unique(("order_id",)),
    NotNull("order_id"),
    NotNull("customer_id"),
    Relationship("customer_id", "customers", "customer_id"),
    AcceptedValues("order_status", ("completed", "pending", "cancelled")),
)
TARGET_CHECKS = (
    Unique(("customer_id",)),
    Unique(("customer_id", "alert_reason")),
    NotNull("customer_id"),
    NotNull("alert_priority"),
    AcceptedValues("alert_reason", (al.HIGH_VALUE, al.PENDING, al.CANCELLED, al.NO_ALERT)),
    AcceptedValues("target_tier", (*al.TIERS.values(), al.LOWEST_TIER)),
)
INCREMENTAL_ORDER_CHECKS = (
    Unique(("order_id",)),
    NotNull("order_id"),
    NotNull("customer_id"),
    NotNull("order_date"),
    NotNull("order_amount"),
    AcceptedValues("order_status", ("completed", "pending", "cancelled")),
)


def build_targets(
    customers: DataFrame, orders: DataFrame, threshold: float = al.HIGH_VALUE_THRESHOLD, ranked: bool = True
) -> DataFrame:
    """Staged customers and orders to ranked targets, as one plan."""
    found = al.customer_alerts(customers, al.order_signals(orders), al.default_rules(threshold))
    return al.customer_targets(found, ranked=ranked)


def publish_targets(
    spark: SparkSession, customers_csv: str, orders_csv: str, out: str, threshold: float = al.HIGH_VALUE_THRESHOLD
) -> DataFrame:
    """Check that the sources exist, stage, consolidate, check, and only then write; returns the written table.

    Every step can be rerun: the result replaces the earlier one.
    """
    require_sources(spark, [customers_csv, orders_csv])
    # Parsed once: the checks and the build read Parquet.
    customers = _staged(stage_customers(read_csv(spark, customers_csv, CUSTOMER_SEED)), "customers")
    orders = _staged(stage_orders(read_csv(spark, orders_csv, ORDER_SEED)), "orders")
    for name, frame, checks in (
        ("customers", customers, STAGED_CUSTOMER_CHECKS),
        ("orders", orders, STAGED_ORDER_CHECKS),
    ):
        failed = run_checks(frame, checks, {"customers": customers}).where("not passed").collect()
        if failed:
            raise ValueError(f"staged {name}: " + "; ".join(f"{r.check_name}({r.column})" for r in failed))
    guarded_write(build_targets(customers, orders, threshold, ranked=False), TARGET_CHECKS, out)
    return spark.read.parquet(out)


def _staged(df: DataFrame, purpose: str) -> DataFrame:
    path = write_parquet(df, shared_folder(df.sparkSession, purpose))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_incremental(
    table: BucketedTable,
    source: DataFrame,
    cursor: str,
    lookback: timedelta | None = None,
    dedup: bool = False,
    tie_break: Sequence[str] = (),
    checks: Sequence = (),
) -> DataFrame:
    """Delete-and-insert into a stored table; only buckets that hold keys of new rows are rewritten.

    ``checks`` are run on the new rows, which replace all rows of their keys, before anything is published; if one fails, the
    table stays as it is.
    """
    target = table.read()
    batch = source if target is None else new_rows(source, target, cursor, lookback)
    if dedup:
        batch = latest_per_key(batch, table.key, cursor, tie_break)
    if checks:
        batch = checked(batch, checks)
    table.update(batch, lambda current, rows: replace_keys(current, rows, table.key))
    return table.read()


def load_history(
    table: BucketedTable, batch: DataFrame, ts: str, columns: Sequence[str], log: DataFrame | None = None
) -> DataFrame:
    """Bring a stored versioned table up to date; only buckets that hold changed keys are rewritten."""
    table.update(batch, lambda current, rows: _history(current, rows, table.key, ts, columns, log))
    return table.read()


def _history(current, rows, key, ts, columns, log) -> DataFrame:
    if "is_current" not in current.columns:  # nothing is stored yet
        return scd2_history(rows, key, ts, columns)
    return scd2_apply(current, rows, key, ts, columns, log)


def load_collection(table: BucketedTable, records: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Add records to a stored collection; records whose ids are there stay, and only touched buckets are rewritten."""
    (id_col,) = table.key
    table.update(records, lambda current, rows: collection_add(current, rows, id_col, order_by))
    return table.read()


def load_features(table: BucketedTable, view_df: DataFrame, spec: FeatureView, end, start=None) -> DataFrame:
    """Materialise into a stored latest table; only buckets that hold keys of new rows are rewritten."""
    newest = [spec.timestamp_field, spec.created_field]
    table.update(
        increment(table.read(), view_df, spec, end, start),
        lambda current, rows: upsert_newest(current, rows, spec.key, newest),
    )
    return table.read()
