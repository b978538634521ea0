"""Order signals, one rule-based alert per customer, and the target tier."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.functions.columns import first_match, known_or_zero

# Alert names in rule order, the fallback, the tier labels and the default threshold.
HIGH_VALUE = "high_value_customer"
PENDING = "pending_order_followup"
CANCELLED = "cancellation_review"
NO_ALERT = "no_alert"
TIERS = {1: "Tier 1 - High Priority", 2: "Tier 2 - Medium Priority", 3: "Tier 3 - Low Priority"}
LOWEST_TIER = "Tier 4 - No Action"
HIGH_VALUE_THRESHOLD = 400

MEASURES = ("total_orders", "total_spend", "pending_orders", "cancelled_orders")


@dataclass(frozen=True)
class Rule:
    """An alert name and the condition that raises it, given a function from measure name to column."""

    alert: str
    holds: Callable[[Callable[[str], Column]], Column]


def default_rules(threshold: float | Column = HIGH_VALUE_THRESHOLD) -> list[Rule]:
    """The first rule that holds wins, and its position is the priority. The threshold itself is not high value."""
    return [
        Rule(HIGH_VALUE, lambda measure: measure("total_spend") > threshold),
        Rule(PENDING, lambda measure: measure("pending_orders") > 0),
        Rule(CANCELLED, lambda measure: measure("cancelled_orders") > 0),
    ]


def alert_reason(rules: Sequence[Rule], measure: Callable[[str], Column] = known_or_zero) -> Column:
    return first_match([(rule.holds(measure), rule.alert) for rule in rules], NO_ALERT)


def alert_priority(rules: Sequence[Rule], measure: Callable[[str], Column] = known_or_zero) -> Column:
    cases = [(rule.holds(measure), position) for position, rule in enumerate(rules, start=1)]
    return first_match(cases, len(rules) + 1)


def order_signals(
    orders: DataFrame,
    key: str = "customer_id",
    amount: str = "order_amount",
    date: str = "order_date",
    status: str = "order_status",
) -> DataFrame:
    """One row of measures per customer. All aggregates combine before the shuffle, so a hot customer is no problem."""
    return orders.groupBy(key).agg(
        F.count("*").alias("total_orders"),
        F.sum(amount).alias("total_spend"),
        F.count_if(F.col(status) == "pending").alias("pending_orders"),
        F.count_if(F.col(status) == "cancelled").alias("cancelled_orders"),
        F.max(date).alias("last_order_date"),
    )


def customer_alerts(
    customers: DataFrame, signals: DataFrame, rules: Sequence[Rule] | None = None, key: str = "customer_id"
) -> DataFrame:
    """Every customer with its measures (0 without orders), alert reason and alert priority."""
    rules = default_rules() if rules is None else rules
    types = dict(signals.dtypes)
    zero = {
        name: F.coalesce(F.nanvl(name, F.lit(0.0)) if types[name] == "double" else F.col(name), F.lit(0))
        for name in MEASURES
    }
    joined = customers.join(signals, key, "left").select(
        key, "customer_name", "region", *[column.alias(name) for name, column in zero.items()], "last_order_date"
    )
    return joined.withColumns(
        {"alert_reason": alert_reason(rules, F.col), "alert_priority": alert_priority(rules, F.col)}
    )


def target_tier(priority: Column, tiers: Mapping[int, str] = TIERS, otherwise: str = LOWEST_TIER) -> Column:
    return first_match([(priority == number, label) for number, label in tiers.items()], otherwise)


def customer_targets(alerts: DataFrame, tiers: Mapping[int, str] = TIERS, ranked: bool = True) -> DataFrame:
    """Alerts with their tier, in rank order: priority, then spend from high to low, then customer."""
    tiered = alerts.withColumn("target_tier", target_tier(F.col("alert_priority"), tiers))
    return tiered.orderBy(*rank_order()) if ranked else tiered


def rank_order() -> list[Column]:
    return [F.asc("alert_priority"), F.desc("total_spend"), F.asc("customer_id")]


def top_targets(targets: DataFrame, rows: int) -> DataFrame:
    """The first ``rows`` targets in rank order."""
    return targets.orderBy(*rank_order()).limit(rows)
