"""The test tables in the shape the operators expect, and the same shapes as SQL for the oracle."""

from __future__ import annotations

from datetime import timedelta

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.functions.columns import first_match
from tierloom.operators import alerts as al
from tierloom.operators.features import FeatureView
from tierloom.operators.staging import stage, stage_orders

#: Spend per customer over all orders has its median near here.
THRESHOLD = 2_500_000

#: Order tables are split into an earlier and a later load at this date, event tables at the other.
ORDER_CUT = "1999-01-01"
EVENT_CUT = "2024-01-16"

USER_VIEW = FeatureView(
    name="user_stats",
    key="user_id",
    fields={"value": T.DoubleType(), "event_type": T.StringType()},
    ttl=timedelta(days=2),
    timestamp_field="ts",
    created_field="created",
    services={"activity": ("value", "event_type")},
)

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORICAL = ["l_returnflag", "l_linestatus"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the name of their region; nations and regions are fixed, tiny tables."""
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    return (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.col("r_name").alias("region"))
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"customer_id": "customer_id", "name": "customer_name", "region": "region"}
    return stage(raw_customers(spark, sf_dir), names, lower=["region"])


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    mixed_case = first_match([(status == "F", "Completed"), (status == "P", "PENDING")], "cancelled")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("order_amount"),
        mixed_case.alias("STATUS"),
        F.col("o_orderdate").alias("last_updated"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_orders(raw_orders(spark, sf_dir))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals = al.order_signals(orders(spark, sf_dir))
    return al.customer_alerts(customers(spark, sf_dir), signals, al.default_rules(THRESHOLD))


def rounded(df: DataFrame, *columns: str, digits: int = 2) -> DataFrame:
    """Sums of doubles depend on their order in the last digits, so both sides of a comparison round them."""
    return df.withColumns({name: F.round(name, digits) for name in columns})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as feature rows."""
    return table(spark, sf_dir, "events").withColumn("created", F.col("ts"))


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by ship date as baseline and current window, prices raised by half in the current one."""
    current = F.col("l_shipdate") >= moment("1998-07-01")
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            F.when(current, "current").otherwise("baseline").alias("window"), *NUMERIC, *CATEGORICAL
        )
        .withColumn(
            "l_extendedprice",
            F.col("l_extendedprice") * F.when(F.col("window") == "current", 1.5).otherwise(1.0),
        )
    )


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question vector per label: the mean of the label's vectors, combined per task before the shuffle."""
    return (
        table(spark, sf_dir, "embeddings")
        .groupBy(F.col("label").cast("bigint").alias("query_id"))
        .agg(Summarizer.mean(array_to_vector("embedding")).alias("mean"))
        .select("query_id", vector_to_array("mean").alias("query_vector"))
    )


# --- the same shapes in SQL ---

CUSTOMERS_SQL = """
    SELECT c_custkey AS customer_id, c_name AS customer_name, lower(r_name) AS region
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
"""

ORDERS_SQL = """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date, o_totalprice AS order_amount,
           CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'pending' ELSE 'cancelled' END AS order_status,
           o_orderdate AS last_updated
    FROM orders
"""

SIGNALS_SQL = """
    SELECT customer_id, count(*) AS total_orders, sum(order_amount) AS total_spend,
           count(*) FILTER (WHERE order_status = 'pending') AS pending_orders,
           count(*) FILTER (WHERE order_status = 'cancelled') AS cancelled_orders,
           max(order_date) AS last_order_date
    FROM stg_orders GROUP BY customer_id
"""


def priority_sql(threshold: float) -> str:
    """The position of the first rule that holds."""
    rules = f"[coalesce(total_spend > {threshold}, false), coalesce(pending_orders > 0, false), " \
        "coalesce(cancelled_orders > 0, false), true]"
    return f"list_position({rules}, true)"


def pick_sql(labels, position: str) -> str:
    return "[" + ", ".join(f"'{label}'" for label in labels) + f"][{position}]"


REASONS = (al.HIGH_VALUE, al.PENDING, al.CANCELLED, al.NO_ALERT)


def alerts_sql(threshold: float, orders_filter: str = "true") -> str:
    """WITH clauses up to ``targets``."""
    return f"""
    WITH stg_customers AS ({CUSTOMERS_SQL}),
    stg_orders AS ({ORDERS_SQL} WHERE {orders_filter}),
    signals AS ({SIGNALS_SQL}),
    ranked AS (SELECT *, {priority_sql(threshold)} AS p FROM stg_customers LEFT JOIN signals USING (customer_id)),
    alerts AS (
        SELECT customer_id, customer_name, region, ifnull(total_orders, 0) AS total_orders,
               round(ifnull(total_spend, 0), 2) AS total_spend, ifnull(pending_orders, 0) AS pending_orders,
               ifnull(cancelled_orders, 0) AS cancelled_orders, last_order_date,
               {pick_sql(REASONS, "p")} AS alert_reason, p::INTEGER AS alert_priority
        FROM ranked),
    targets AS (SELECT *, {pick_sql([*al.TIERS.values(), al.LOWEST_TIER], "alert_priority")} AS target_tier FROM alerts)
    """


WINDOWS_SQL = """
    SELECT CASE WHEN l_shipdate >= TIMESTAMP '1998-07-01' THEN 'current' ELSE 'baseline' END AS "window",
           l_quantity, l_extendedprice * CASE WHEN l_shipdate >= TIMESTAMP '1998-07-01' THEN 1.5 ELSE 1.0 END
           AS l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
    FROM lineitem
"""

LONG_SQL = f"""
    SELECT "window" AS w, feature, value FROM ({WINDOWS_SQL})
    UNPIVOT (value FOR feature IN (l_quantity, l_extendedprice, l_discount, l_tax))
"""

CENTROIDS_SQL = """
    SELECT query_id, list(mean ORDER BY i) AS query_vector FROM (
        SELECT label::BIGINT AS query_id, i, avg(v) AS mean FROM (
            SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
        GROUP BY ALL)
    GROUP BY query_id
"""
