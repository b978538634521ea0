"""Queries over keyed loads, versioned history, data quality, features and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.operators import features as fe
from tierloom.operators import keyed
from tierloom.operators import quality as dq
from tierloom.operators.joins import orphans
from tierloom.plans import testtables as tt
from tierloom.plans.loads import INCREMENTAL_ORDER_CHECKS, load_features, load_incremental
from tierloom.plans.registry import query
from tierloom.session import shared_folder
from tierloom.sources.bucketed import BucketedTable
from tierloom.sources.writers import write_parquet
from tierloom.streaming import push

ORDER_COLUMNS = "order_id, customer_id, order_date, order_amount, order_status, last_updated"


def reissued_orders(spark, sf_dir):
    """All orders, those pending before the cut completed by a later update."""
    orders = tt.orders(spark, sf_dir)
    settled = (F.col("order_status") == "pending") & (F.col("order_date") < tt.moment(tt.ORDER_CUT))
    return orders.withColumns(
        {
            "order_status": F.when(settled, "completed").otherwise(F.col("order_status")),
            "last_updated": F.when(settled, F.expr("order_date + INTERVAL 2500 DAYS")).otherwise(F.col("order_date")),
        }
    )


REISSUED_SQL = f"""
    SELECT order_id, customer_id, order_date, order_amount,
           CASE WHEN settled THEN 'completed' ELSE order_status END AS order_status,
           CASE WHEN settled THEN order_date + INTERVAL 2500 DAY ELSE order_date END AS last_updated
    FROM (SELECT *, order_status = 'pending' AND order_date < TIMESTAMP '{tt.ORDER_CUT}' AS settled
          FROM ({tt.ORDERS_SQL}))
"""


@query(
    "incremental_delete_insert",
    f"""WITH target AS (SELECT {ORDER_COLUMNS} FROM ({tt.ORDERS_SQL}) WHERE order_date < TIMESTAMP '{tt.ORDER_CUT}'),
    batch AS (SELECT {ORDER_COLUMNS} FROM ({REISSUED_SQL}) WHERE last_updated > (SELECT max(last_updated) FROM target))
    SELECT * FROM target WHERE order_id NOT IN (SELECT order_id FROM batch) UNION ALL SELECT * FROM batch""",
)
def incremental_delete_insert(spark, sf_dir):
    """A first load of the earlier orders, then an incremental load from all orders into the stored table."""
    stored = BucketedTable(spark, shared_folder(spark, "orders_incremental"), "order_id", buckets=8)
    earlier = tt.orders(spark, sf_dir).where(F.col("order_date") < tt.moment(tt.ORDER_CUT))
    load_incremental(stored, earlier, "last_updated", checks=INCREMENTAL_ORDER_CHECKS)
    return load_incremental(stored, reissued_orders(spark, sf_dir), "last_updated", checks=INCREMENTAL_ORDER_CHECKS)


LAST_ORDER_SQL = "row_number() OVER (PARTITION BY customer_id ORDER BY last_updated DESC, order_id DESC) = 1"


@query(
    "merge_upsert",
    f"""WITH o AS (SELECT {ORDER_COLUMNS} FROM ({tt.ORDERS_SQL})),
    target AS (SELECT * FROM o WHERE order_date < TIMESTAMP '{tt.ORDER_CUT}' QUALIFY {LAST_ORDER_SQL}),
    batch AS (SELECT * FROM o WHERE order_date >= TIMESTAMP '{tt.ORDER_CUT}' QUALIFY {LAST_ORDER_SQL})
    SELECT * FROM target WHERE customer_id NOT IN (SELECT customer_id FROM batch) UNION ALL SELECT * FROM batch""",
)
def merge_upsert(spark, sf_dir):
    orders = tt.orders(spark, sf_dir)
    later = F.col("order_date") >= tt.moment(tt.ORDER_CUT)
    newest = ["last_updated", "order_id"]
    target = keyed.latest_per_key(orders.where(~later), "customer_id", newest)
    return keyed.merge_upsert(target, orders.where(later), "customer_id", newest)


HISTORY_SQL = """
    WITH seen AS (SELECT user_id, ts, event_type, lag(event_type) OVER t AS prev FROM events
                  WINDOW t AS (PARTITION BY user_id ORDER BY ts)),
    changed AS (SELECT * FROM seen WHERE prev IS NULL OR prev <> event_type),
    history AS (SELECT user_id, event_type, ts AS effective_date, lead(ts) OVER t AS end_date FROM changed
                WINDOW t AS (PARTITION BY user_id ORDER BY ts))
    SELECT *, end_date IS NULL AS is_current FROM history
"""


@query("scd2_history", HISTORY_SQL)
def scd2_history(spark, sf_dir):
    return keyed.scd2_history(tt.table(spark, sf_dir, "events"), "user_id", "ts", "event_type")


@query("scd2_apply", HISTORY_SQL)
def scd2_apply(spark, sf_dir):
    """The earlier events as stored versions, the later ones as a batch: the result is the whole history."""
    log = tt.table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    later = F.col("ts") >= tt.moment(tt.EVENT_CUT)
    dim = keyed.scd2_history(log.where(~later), "user_id", "ts", "event_type")
    stored = spark.read.parquet(write_parquet(dim, shared_folder(spark, "scd2_dim")))
    return keyed.scd2_apply(stored, log.where(later), "user_id", "ts", "event_type")


@query(
    "scd2_as_of",
    f"""SELECT * FROM ({HISTORY_SQL}) WHERE effective_date <= TIMESTAMP '{tt.EVENT_CUT} 12:00:00'
        AND (end_date IS NULL OR TIMESTAMP '{tt.EVENT_CUT} 12:00:00' < end_date)""",
)
def scd2_as_of(spark, sf_dir):
    dim = keyed.scd2_history(tt.table(spark, sf_dir, "events"), "user_id", "ts", "event_type")
    return keyed.scd2_as_of(dim, f"{tt.EVENT_CUT} 12:00:00")


# --- data quality ---


def staged_events(spark, sf_dir):
    """Events with the type ``error`` read as a missing type."""
    return tt.table(spark, sf_dir, "events").withColumn("event_type", F.nullif("event_type", F.lit("error")))


EVENT_CHECKS = (
    dq.NotNull("event_type"),
    dq.AcceptedValues("event_type", ("view", "click", "purchase")),
    dq.Holds("value", "value <= 200"),
)


@query(
    "guarded_write_quarantine",
    """SELECT event_id, user_id, concat_ws(', ', CASE WHEN event_type = 'error' THEN 'not_null(event_type)' END,
              CASE WHEN event_type = 'signup' THEN 'accepted_values(event_type)' END,
              CASE WHEN value > 200 THEN 'check(value)' END) AS violations FROM events""",
)
def guarded_write_quarantine(spark, sf_dir):
    """Rows without violations pass the guard and are written; the others are kept aside with their reasons."""
    good, bad = dq.quarantine(staged_events(spark, sf_dir), EVENT_CHECKS)
    path = dq.guarded_write(good, EVENT_CHECKS, shared_folder(spark, "guarded_write"))
    written = spark.read.parquet(path).select("event_id", "user_id", F.lit("").alias("violations"))
    return written.unionByName(bad.select("event_id", "user_id", F.array_join("violations", ", ").alias("violations")))


@query(
    "dq_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS record_count FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def dq_unique(spark, sf_dir):
    return dq.duplicate_keys(tt.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_not_null",
    """SELECT 'event_type' AS "column", count(*) FILTER (WHERE event_type = 'error') AS failures FROM events
       UNION ALL SELECT 'user_id', count(*) FILTER (WHERE user_id IS NULL) FROM events
       UNION ALL SELECT 'value', count(*) FILTER (WHERE value IS NULL) FROM events""",
)
def dq_not_null(spark, sf_dir):
    return dq.null_counts(staged_events(spark, sf_dir), ["event_type", "user_id", "value"])


@query(
    "dq_accepted_values",
    """SELECT event_type, count(*) AS record_count FROM events WHERE event_type NOT IN ('view', 'click', 'purchase')
       AND event_type <> 'error' GROUP BY event_type""",
)
def dq_accepted_values(spark, sf_dir):
    return dq.unexpected_values(staged_events(spark, sf_dir), "event_type", ["view", "click", "purchase"])


@query("dq_relationships", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def dq_relationships(spark, sf_dir):
    """Documents that no label refers to."""
    documents = tt.table(spark, sf_dir, "documents").select("doc_id", "source")
    return orphans(documents, tt.table(spark, sf_dir, "labels"), "doc_id", "doc_id")


@query(
    "dq_duplicates",
    """SELECT user_id, event_type, count(*) AS record_count FROM events
       GROUP BY user_id, event_type HAVING count(*) > 1""",
)
def dq_duplicates(spark, sf_dir):
    return dq.failing_rows(
        spark,
        "SELECT user_id, event_type, count(*) AS record_count FROM {frame} GROUP BY ALL HAVING record_count > 1",
        frame=tt.table(spark, sf_dir, "events"),
    )


@query(
    "dq_report",
    f"""WITH o AS ({tt.ORDERS_SQL}), r AS (
        SELECT 'unique' AS check_name, 'order_id' AS "column",
               (SELECT count(*) FROM (SELECT order_id FROM o GROUP BY order_id HAVING count(*) > 1)) AS failures
        UNION ALL SELECT 'unique', 'customer_id',
               (SELECT count(*) FROM (SELECT customer_id FROM o GROUP BY customer_id HAVING count(*) > 1))
        UNION ALL SELECT 'not_null', 'customer_id', (SELECT count(*) FROM o WHERE customer_id IS NULL)
        UNION ALL SELECT 'accepted_values', 'order_status', (SELECT count(*) FROM o WHERE order_status = 'cancelled')
        UNION ALL SELECT 'check', 'order_amount', (SELECT count(*) FROM o WHERE order_amount < 2000)
        UNION ALL SELECT 'relationships', 'customer_id',
               (SELECT count(*) FROM o WHERE customer_id NOT IN (SELECT c_custkey FROM customer))
        UNION ALL SELECT 'relationships', 'order_id',
               (SELECT count(*) FROM o WHERE order_id NOT IN (SELECT event_id FROM events)))
    SELECT *, failures = 0 AS passed FROM r""",
)
def dq_report(spark, sf_dir):
    checks = [
        dq.Unique(("order_id",)),
        dq.Unique(("customer_id",)),
        dq.NotNull("customer_id"),
        dq.AcceptedValues("order_status", ("completed", "pending")),
        dq.Holds("order_amount", "order_amount >= 2000"),
        dq.Relationship("customer_id", "customers", "customer_id"),
        dq.Relationship("order_id", "events", "event_id"),
    ]
    customers = tt.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    refs = {"customers": customers, "events": tt.table(spark, sf_dir, "events")}
    return dq.run_checks(tt.orders(spark, sf_dir), checks, refs)


# --- features ---


def asked(spark, sf_dir):
    """Purchases ask for feature values; the other events are the feature rows."""
    return (
        tt.table(spark, sf_dir, "events")
        .where("event_type = 'purchase'")
        .select("event_id", "user_id", F.col("ts").alias("event_timestamp"))
    )


def feature_rows(spark, sf_dir):
    return tt.events(spark, sf_dir).where("event_type <> 'purchase'")


ASOF_SQL = """
    SELECT p.event_id, p.user_id, p.ts AS event_timestamp,
           CASE WHEN v.ts >= p.ts - INTERVAL 2 DAY THEN v.value END AS value,
           CASE WHEN v.ts >= p.ts - INTERVAL 2 DAY THEN v.event_type END AS event_type
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type <> 'purchase') v
    ON p.user_id = v.user_id AND p.ts >= v.ts
"""


@query("asof_features", ASOF_SQL)
def asof_features(spark, sf_dir):
    return fe.historical_features(
        asked(spark, sf_dir), feature_rows(spark, sf_dir), tt.USER_VIEW, ["user_stats:value", "user_stats:event_type"]
    )


@query("on_demand_feature", f"SELECT *, value + event_id AS value_plus_request FROM ({ASOF_SQL})")
def on_demand_feature(spark, sf_dir):
    joined = fe.historical_features(
        asked(spark, sf_dir), feature_rows(spark, sf_dir), tt.USER_VIEW, "activity"
    )
    return fe.on_demand(joined, {"value_plus_request": "value + event_id"})


LATEST_SQL = """SELECT user_id, value, event_type, ts, ts AS created FROM events WHERE {} QUALIFY
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""


@query(
    "asof_batch_scoring",
    f"""SELECT customer_id, value, event_type FROM (SELECT c_custkey AS customer_id FROM customer) LEFT JOIN (
        {LATEST_SQL.format("ts <= TIMESTAMP '2024-01-31' AND ts >= TIMESTAMP '2024-01-29'")}) ON customer_id = user_id""",
)
def asof_batch_scoring(spark, sf_dir):
    entities = tt.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    scored = fe.batch_scoring(entities, tt.events(spark, sf_dir), tt.USER_VIEW, "activity", "2024-01-31 00:00:00")
    return scored.withColumnRenamed("user_id", "customer_id")


@query("feature_materialize", LATEST_SQL.format("ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'"))
def feature_materialize(spark, sf_dir):
    return fe.materialize(tt.events(spark, sf_dir), tt.USER_VIEW, "2024-01-05", "2024-01-25")


@query(
    "feature_materialize_incremental",
    LATEST_SQL.format("ts BETWEEN TIMESTAMP '2024-01-14' AND TIMESTAMP '2024-01-25'"),
)
def feature_materialize_incremental(spark, sf_dir):
    """A first run up to the cut (looking back one TTL), stored, then a second run from there."""
    rows = tt.events(spark, sf_dir)
    latest = BucketedTable(spark, shared_folder(spark, "latest_features"), "user_id", buckets=8)
    load_features(latest, rows, tt.USER_VIEW, tt.EVENT_CUT)
    return load_features(latest, rows, tt.USER_VIEW, "2024-01-25")


@query(
    "online_features",
    f"""SELECT customer_id, value, event_type FROM (SELECT c_custkey AS customer_id FROM customer) LEFT JOIN (
        {LATEST_SQL.format("true")}) ON customer_id = user_id""",
)
def online_features(spark, sf_dir):
    latest = fe.materialize(tt.events(spark, sf_dir), tt.USER_VIEW, None, "2100-01-01")
    entities = tt.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return fe.online_features(latest, entities, tt.USER_VIEW, "activity").withColumnRenamed("user_id", "customer_id")


@query(
    "online_lookup",
    f"""SELECT customer_id, value, event_type FROM (SELECT c_custkey AS customer_id FROM customer WHERE c_nationkey = 7) LEFT JOIN (
        {LATEST_SQL.format("true")}) ON customer_id = user_id""",
)
def online_lookup(spark, sf_dir):
    """A request for the customers of one nation against the stored latest table; the other keys' buckets are not read."""
    latest = BucketedTable(spark, shared_folder(spark, "latest_features"), "user_id", buckets=32)
    load_features(latest, tt.events(spark, sf_dir), tt.USER_VIEW, "2100-01-01", "1900-01-01")
    entities = tt.table(spark, sf_dir, "customer").where("c_nationkey = 7").select(F.col("c_custkey").alias("user_id"))
    return fe.online_lookup(entities, latest, tt.USER_VIEW, "activity").withColumnRenamed("user_id", "customer_id")


VIEWS = ["user_stats:value", "order_stats:order_amount", "order_stats:value"]


def order_view(spark, sf_dir):
    """Orders as a second view of the same users, with a field that the first one has, too."""
    rows = tt.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("order_amount"),
        F.col("o_orderkey").cast("double").alias("value"),
        # Orders are years older than the events, so their times are moved into the range of these.
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(pmod(o_orderkey, 30), 0, 0, pmod(o_orderkey, 86400))").alias("at"),
        F.col("o_orderdate").alias("made"),
    )
    spec = fe.FeatureView("order_stats", "user_id", {"order_amount": T.DoubleType(), "value": T.DoubleType()},
                          timestamp_field="at", created_field="made")
    return rows, spec


ORDER_VIEW_SQL = """SELECT o_custkey AS user_id, o_totalprice AS order_amount, o_orderkey::DOUBLE AS value, o_orderdate AS made,
    TIMESTAMP '2024-01-01' + to_days((o_orderkey % 30)::INTEGER) + to_seconds(o_orderkey % 86400) AS moment FROM orders"""


@query(
    "asof_two_views",
    f"""SELECT a.event_id, a.user_id, a.event_timestamp, a.value AS user_stats__value, o.order_amount, o.value AS order_stats__value
        FROM ({ASOF_SQL}) a ASOF LEFT JOIN (SELECT * FROM ({ORDER_VIEW_SQL}) QUALIFY row_number() OVER (
            PARTITION BY user_id, moment ORDER BY made DESC) = 1) o ON a.user_id = o.user_id AND a.event_timestamp >= o.moment""",
)
def asof_two_views(spark, sf_dir):
    """Two views on one time line."""
    return fe.historical_views(
        asked(spark, sf_dir), [(feature_rows(spark, sf_dir), tt.USER_VIEW), order_view(spark, sf_dir)], VIEWS
    )


@query(
    "online_two_views",
    f"""SELECT customer_id, u.value AS user_stats__value, o.order_amount, o.value AS order_stats__value
        FROM (SELECT c_custkey AS customer_id FROM customer) LEFT JOIN ({LATEST_SQL.format("true")}) u ON customer_id = u.user_id
        LEFT JOIN (SELECT * FROM ({ORDER_VIEW_SQL}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY moment DESC, made DESC) = 1) o
        ON customer_id = o.user_id""",
)
def online_two_views(spark, sf_dir):
    """The latest values of two views by key."""
    rows, spec = order_view(spark, sf_dir)
    latest = [
        (fe.materialize(tt.events(spark, sf_dir), tt.USER_VIEW, None, "2100-01-01"), tt.USER_VIEW),
        (fe.materialize(rows, spec, None, "2100-01-01"), spec),
    ]
    entities = tt.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return fe.online_views(entities, latest, VIEWS).withColumnRenamed("user_id", "customer_id")


@query(
    "event_props_json",
    "SELECT event_id, (props->>'$.k')::BIGINT AS k, props->>'$.k' AS k_text FROM events",
)
def event_props_json(spark, sf_dir):
    """A JSON text as a typed struct and as a map of strings."""
    return tt.table(spark, sf_dir, "events").select(
        "event_id",
        F.from_json("props", T.StructType([T.StructField("k", T.LongType())]))["k"].alias("k"),
        F.from_json("props", T.MapType(T.StringType(), T.StringType()))["k"].alias("k_text"),
    )


# --- streams ---


def in_waves(df, later, landing, run):
    """Two loads of a landing folder, the later rows first; the stream runs after each and takes only the new files."""
    for wave in (df.where(later), df.where(~later)):
        wave.write.mode("append").parquet(landing)
        run(df.sparkSession.readStream.schema(df.schema).parquet(landing)).awaitTermination()


def push_events(spark, sf_dir):
    root = shared_folder(spark, "push")
    latest = BucketedTable(spark, f"{root}/latest", "user_id", buckets=8)
    in_waves(
        tt.events(spark, sf_dir),
        F.col("ts") >= tt.moment(tt.EVENT_CUT),
        f"{root}/landing",
        lambda stream: push.push_stream(stream, tt.USER_VIEW, f"{root}/offline", latest, f"{root}/checkpoint"),
    )
    return latest, f"{root}/offline"


@query("push_ingest", LATEST_SQL.format("true"))
def push_ingest(spark, sf_dir):
    """The earlier events arrive last; the latest table still ends up with the newest row per user."""
    latest, _ = push_events(spark, sf_dir)
    return latest.read()


@query("push_offline", "SELECT user_id, value, event_type, ts, ts AS created FROM events")
def push_offline(spark, sf_dir):
    """The offline history holds every pushed event once."""
    _, offline = push_events(spark, sf_dir)
    return push.read_offline(spark, offline, tt.USER_VIEW)


@query(
    "stream_upsert_orders",
    f"""SELECT {ORDER_COLUMNS} FROM (SELECT {ORDER_COLUMNS} FROM ({tt.ORDERS_SQL}) UNION ALL
        SELECT {ORDER_COLUMNS} FROM ({REISSUED_SQL}) WHERE order_date <> last_updated)
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY last_updated DESC) = 1""",
)
def stream_upsert_orders(spark, sf_dir):
    """Orders and their later updates as a stream; the updates arrive first and the table keeps the newest rows."""
    root = shared_folder(spark, "order_stream")
    updates = reissued_orders(spark, sf_dir).where("order_date <> last_updated")
    stored = BucketedTable(spark, f"{root}/orders", "order_id", buckets=8)
    in_waves(
        tt.orders(spark, sf_dir).unionByName(updates),
        F.col("last_updated") >= tt.moment(tt.ORDER_CUT),
        f"{root}/landing",
        lambda stream: push.upsert_stream(stream, stored, "last_updated", [], f"{root}/checkpoint"),
    )
    return stored.read()
