"""Queries over sources, sinks, staging, alerts, joins and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierloom.functions.columns import preview
from tierloom.operators import alerts as al
from tierloom.operators import joins, keyed, windows

from tierloom.plans import testtables as tt
from tierloom.plans.registry import query
from tierloom.session import shared_folder
from tierloom.sources import readers, writers

ORDER_COLUMNS = "order_id, customer_id, order_date, order_amount, order_status, last_updated"


@query("scan_parquet", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_parquet(spark, sf_dir):
    return readers.read_parquet(spark, f"{sf_dir}/orders*.parquet", ["o_orderkey", "o_custkey", "o_totalprice"])


@query(
    "scan_table",
    f"""WITH stg_orders AS ({tt.ORDERS_SQL})
    SELECT customer_id, total_orders, round(total_spend, 2) AS total_spend, pending_orders, cancelled_orders,
           last_order_date FROM ({tt.SIGNALS_SQL})""",
)
def scan_table(spark, sf_dir):
    writers.publish_view(tt.orders(spark, sf_dir), "staged_orders")
    staged = readers.read_table(
        spark, "staged_orders", ["customer_id", "order_date", "order_amount", "order_status"]
    )
    return tt.rounded(al.order_signals(staged), "total_spend")


@query(
    "scan_csv",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def scan_csv(spark, sf_dir):
    orders = tt.table(spark, sf_dir, "orders")
    path = writers.write_csv(orders, shared_folder(spark, "scan_csv"))
    return readers.read_csv(spark, path, orders.schema)


@query(
    "scan_csv_text",
    """SELECT doc_id, 'say "' || source || '", ok' || chr(10) || text || ' ' AS text, NULLIF(lang, 'de') AS lang FROM documents""",
)
def scan_csv_text(spark, sf_dir):
    """Texts with quotes, commas, newlines, outer spaces and NULLs, to CSV and back."""
    said = F.concat(F.lit('say "'), "source", F.lit('", ok\n'), "text", F.lit(" "))
    documents = tt.table(spark, sf_dir, "documents").select(
        "doc_id", said.alias("text"), F.nullif("lang", F.lit("de")).alias("lang")
    )
    path = writers.write_csv(documents, shared_folder(spark, "scan_csv_text"))
    return readers.read_csv(spark, path, documents.schema, multiline=True)


@query(
    "scan_text",
    """SELECT doc_id // 256 AS volume, string_agg(text, chr(10) ORDER BY doc_id) || chr(10) AS text,
              count(*) AS documents FROM documents GROUP BY 1""",
)
def scan_text(spark, sf_dir):
    """Documents written as text files, 256 to a file, and read back as one row per file."""
    path = shared_folder(spark, "scan_text")
    volumes = tt.table(spark, sf_dir, "documents").select(F.expr("doc_id DIV 256").alias("volume"), "doc_id", "text")
    (
        volumes.repartition("volume")
        .sortWithinPartitions("volume", "doc_id")
        .drop("doc_id")
        .write.partitionBy("volume")
        .text(path)
    )
    files = readers.read_documents(spark, path).select(
        F.regexp_extract("path", "volume=([0-9]+)", 1).cast("bigint").alias("volume"), "text"
    )
    return files.join(volumes.groupBy("volume").agg(F.count("*").alias("documents")), "volume")


@query("sink_parquet", tt.alerts_sql(tt.THRESHOLD) + "SELECT * FROM alerts")
def sink_parquet(spark, sf_dir):
    path = writers.write_parquet(tt.alerts(spark, sf_dir), shared_folder(spark, "sink_parquet"))
    return tt.rounded(readers.read_parquet(spark, path), "total_spend")


@query("sink_csv", tt.CUSTOMERS_SQL)
def sink_csv(spark, sf_dir):
    staged = tt.customers(spark, sf_dir)
    path = writers.write_csv(staged, shared_folder(spark, "sink_csv"))
    return readers.read_csv(spark, path, staged.schema)


@query(
    "feature_export",
    tt.alerts_sql(tt.THRESHOLD)
    + """SELECT customer_id, customer_name, region, total_orders, total_spend, pending_orders, cancelled_orders,
         alert_priority, TIMESTAMP '2026-01-01 00:00:00' AS event_timestamp, TIMESTAMP '2026-01-01 00:00:00' AS created
         FROM targets""",
)
def feature_export(spark, sf_dir):
    exported = writers.stamp_features(
        al.customer_targets(tt.alerts(spark, sf_dir), ranked=False).select(
            "customer_id", "customer_name", "region", "total_orders", "total_spend", "pending_orders",
            "cancelled_orders", "alert_priority",
        ),
        tt.moment("2026-01-01 00:00:00"),
    )
    path = writers.write_parquet(exported, shared_folder(spark, "feature_export"))
    return tt.rounded(readers.read_parquet(spark, path), "total_spend")


@query(
    "schema_evolve",
    f"""SELECT o_orderkey, o_custkey, o_totalprice,
        CASE WHEN o_orderdate >= TIMESTAMP '{tt.ORDER_CUT}' THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def schema_evolve(spark, sf_dir):
    orders = tt.table(spark, sf_dir, "orders")
    later = F.col("o_orderdate") >= tt.moment(tt.ORDER_CUT)
    path = shared_folder(spark, "schema_evolve")
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    writers.write_parquet(orders.where(~later).select(*columns), path)
    writers.write_parquet(orders.where(later).select(*columns, "o_orderpriority"), path, mode="append")
    return writers.read_evolved(spark, path).select(*columns, "o_orderpriority")


@query(
    "append_evolving",
    """SELECT doc_id, lang, n_chars, NULL::INTEGER AS quality FROM documents
       UNION ALL SELECT doc_id, NULL, NULL, quality FROM labels""",
)
def append_evolving(spark, sf_dir):
    documents = tt.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return writers.append_evolving(documents, tt.table(spark, sf_dir, "labels").select("doc_id", "quality"))


@query("stg_customers", tt.CUSTOMERS_SQL)
def stg_customers(spark, sf_dir):
    return tt.customers(spark, sf_dir)


@query("stg_orders", tt.ORDERS_SQL)
def stg_orders(spark, sf_dir):
    return tt.orders(spark, sf_dir)


@query(
    "order_signals",
    f"""WITH stg_orders AS ({tt.ORDERS_SQL})
    SELECT customer_id, total_orders, round(total_spend, 2) AS total_spend, pending_orders, cancelled_orders,
           last_order_date FROM ({tt.SIGNALS_SQL})""",
)
def order_signals(spark, sf_dir):
    return tt.rounded(al.order_signals(tt.orders(spark, sf_dir)), "total_spend")


@query("customer_alerts", tt.alerts_sql(tt.THRESHOLD) + "SELECT * FROM alerts")
def customer_alerts(spark, sf_dir):
    return tt.rounded(tt.alerts(spark, sf_dir), "total_spend")


@query("customer_targets", tt.alerts_sql(tt.THRESHOLD) + "SELECT * FROM targets")
def customer_targets(spark, sf_dir):
    return tt.rounded(al.customer_targets(tt.alerts(spark, sf_dir)), "total_spend")


RECENT = "2001-01-01"


@query(
    "recent_customer_targets",
    tt.alerts_sql(400_000, f"o_orderdate >= TIMESTAMP '{RECENT}'") + "SELECT * FROM targets",
)
def recent_customer_targets(spark, sf_dir):
    """Alerts on the orders of the last months; many customers have none. The date reaches the scan."""
    recent = tt.orders(spark, sf_dir).where(F.col("order_date") >= tt.moment(RECENT))
    found = al.customer_alerts(tt.customers(spark, sf_dir), al.order_signals(recent), al.default_rules(400_000))
    return tt.rounded(al.customer_targets(found, ranked=False), "total_spend")


@query(
    "top_targets",
    tt.alerts_sql(tt.THRESHOLD)
    + "SELECT * FROM targets ORDER BY alert_priority, total_spend DESC, customer_id LIMIT 25",
)
def top_targets(spark, sf_dir):
    targets = al.customer_targets(tt.rounded(tt.alerts(spark, sf_dir), "total_spend"), ranked=False)
    return al.top_targets(targets, 25)


ENRICHED_SQL = f"""SELECT {ORDER_COLUMNS}, customer_name, region
    FROM ({tt.ORDERS_SQL}) LEFT JOIN ({tt.CUSTOMERS_SQL}) USING (customer_id)"""


@query("orders_enriched", ENRICHED_SQL)
def orders_enriched(spark, sf_dir):
    return joins.enrich(tt.orders(spark, sf_dir), tt.customers(spark, sf_dir), "customer_id")


@query("orders_enriched_broadcast", ENRICHED_SQL)
def orders_enriched_broadcast(spark, sf_dir):
    return joins.enrich(tt.orders(spark, sf_dir), tt.customers(spark, sf_dir), "customer_id", broadcast=True)


@query(
    "latest_per_key",
    f"""SELECT {ORDER_COLUMNS} FROM ({tt.ORDERS_SQL})
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY last_updated DESC, order_id DESC) = 1""",
)
def latest_per_key(spark, sf_dir):
    return windows.latest_per_key(tt.orders(spark, sf_dir), "customer_id", "last_updated", ["order_id"])


@query(
    "status_transitions",
    f"""WITH o AS (SELECT order_id, customer_id, order_status, last_updated FROM ({tt.ORDERS_SQL})),
    w AS (SELECT *, lag(order_status) OVER t AS prev_status, lead(order_status) OVER t AS next_status FROM o
          WINDOW t AS (PARTITION BY customer_id ORDER BY last_updated, order_id))
    SELECT *, prev_status IS NOT NULL AND prev_status <> order_status AS status_changed FROM w""",
)
def status_transitions(spark, sf_dir):
    orders = tt.orders(spark, sf_dir).select("order_id", "customer_id", "order_status", "last_updated")
    return windows.status_transitions(orders, "customer_id", "last_updated", "order_status", ["order_id"])


@query(
    "collection_add",
    """SELECT 'doc_' || d.doc_id AS id, d.source, d.n_chars, CASE WHEN l.doc_id IS NULL THEN 2 ELSE 1 END AS added_by
       FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)""",
)
def collection_add(spark, sf_dir):
    """The labelled documents come first; the second load offers all documents and adds only the others."""
    documents = tt.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("id"), "source", "n_chars"
    )
    labelled = documents.join(tt.table(spark, sf_dir, "labels"), "doc_id", "left_semi").drop("doc_id")
    first = keyed.collection_add(None, labelled.withColumn("added_by", F.lit(1)))
    return keyed.collection_add(first, documents.drop("doc_id").withColumn("added_by", F.lit(2)))


@query(
    "collection_get",
    """SELECT 'doc_' || doc_id AS id, source, substring(text, 1, 200) AS preview FROM documents
       WHERE doc_id IN (SELECT doc_id FROM labels)""",
)
def collection_get(spark, sf_dir):
    def record_id():
        return F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("id")

    collection = tt.table(spark, sf_dir, "documents").select(record_id(), "source", "text")
    ids = tt.table(spark, sf_dir, "labels").select(record_id())
    return keyed.collection_get(collection, ids).select("id", "source", preview("text", 200).alias("preview"))


@query("union_windows", tt.WINDOWS_SQL)
def union_windows(spark, sf_dir):
    from tierloom.operators.drift import union_windows as stack

    items = tt.table(spark, sf_dir, "lineitem")
    current = F.col("l_shipdate") >= tt.moment("1998-07-01")
    columns = [*tt.NUMERIC, *tt.CATEGORICAL]
    raised = items.where(current).withColumn("l_extendedprice", F.col("l_extendedprice") * 1.5)
    return stack({"baseline": items.where(~current).select(*columns), "current": raised.select(*columns)})
