import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierloom.operators import alerts as al
from tierloom.operators import experiments as ex
from tierloom.operators import text
from tierloom.operators.windows import latest_per_key, status_transitions
from tierloom.plans.loads import build_targets, publish_targets
from tierloom.sources import readers, writers


def test_golden_targets(seeds):
    got = build_targets(*seeds)
    assert [tuple(r) for r in got.select("customer_id", "total_orders", "total_spend", "pending_orders",
                                         "cancelled_orders", F.col("last_order_date").cast("string"),
                                         "alert_reason", "alert_priority", "target_tier").collect()] == [
        (3, 1, 499.0, 0, 0, "2024-03-20", "high_value_customer", 1, "Tier 1 - High Priority"),
        (2, 2, 399.99, 1, 0, "2024-05-10", "pending_order_followup", 2, "Tier 2 - Medium Priority"),
        (4, 1, 75.25, 0, 1, "2024-04-05", "cancellation_review", 3, "Tier 3 - Low Priority"),
        (1, 2, 370.5, 0, 0, "2024-03-10", "no_alert", 4, "Tier 4 - No Action"),
        (5, 0, 0.0, 0, 0, None, "no_alert", 4, "Tier 4 - No Action"),
    ]
    assert [r.customer_id for r in al.top_targets(got, 2).collect()] == [3, 2]


def test_threshold_is_strict_and_nan_is_no_spend(spark):
    measures = spark.sql(
        """SELECT * FROM VALUES (1, 400D, 0L, 0L), (2, 400.01D, 0L, 0L), (3, DOUBLE('NaN'), 1L, 0L),
           (4, NULL, NULL, NULL), (5, 1D, 1L, 1L), (6, 1D, 0L, 2L)
           AS t(id, total_spend, pending_orders, cancelled_orders)"""
    )
    got = measures.select("id", al.alert_reason(al.default_rules()), al.alert_priority(al.default_rules()))
    assert rows(got) == [
        (1, "no_alert", 4), (2, "high_value_customer", 1), (3, "pending_order_followup", 2), (4, "no_alert", 4),
        (5, "pending_order_followup", 2), (6, "cancellation_review", 3),
    ]


def test_threshold_runs(spark, seeds, tmp_path):
    customers, orders = seeds
    scoring = ex.scoring_input(customers, al.order_signals(orders))
    runs = {"threshold_400": 400, "threshold_350": 350}
    got = {r.run_name: (r.params, r.metrics) for r in ex.threshold_sweep(scoring, runs).collect()}
    assert got["threshold_400"] == (
        {"high_value_threshold": "400"}, {"high_value_customer_count": 1.0, "total_customers_scored": 5.0})
    assert got["threshold_350"][1]["high_value_customer_count"] == 3.0
    scored = ex.scored_by_run(scoring, runs)
    assert rows(scored.where("customer_id = 5"), "total_spend", "pending_orders", "alert_reason") == [
        (None, None, "no_alert")] * 2
    assert rows(ex.run_diff(scored, "threshold_400", "threshold_350")) == [
        (1, "no_alert", "high_value_customer"), (2, "pending_order_followup", "high_value_customer")]
    ex.write_runs(scored, str(tmp_path / "runs"))
    assert sorted(p.name for p in (tmp_path / "runs").glob("run_name=*")) == [
        "run_name=threshold_350", "run_name=threshold_400"]


def test_a_table_of_thresholds(spark):
    spend = [None, float("nan"), 0.0, 1.0, 2.0, 2.0, 3.5, 900.0]
    scoring = spark.createDataFrame([(i, s) for i, s in enumerate(spend)], "customer_id long, total_spend double")
    marks = [*(i / 4 for i in range(-4, 1000)), 2.0, 2.0, None, float("nan"), 1e9]
    runs = spark.createDataFrame([(f"r{i}", t) for i, t in enumerate(marks)], "run_name string, threshold double")
    got = {r.run_name: (r.hits, r.customers) for r in ex.sweep_table(scoring, runs).collect()}
    known = [0 if s is None or s != s else s for s in spend]
    assert got == {f"r{i}": (0 if t is None or t != t else sum(s > t for s in known), 8) for i, t in enumerate(marks)}
    plain = ex.threshold_sweep(scoring.selectExpr("*", "0L as pending_orders", "0L as cancelled_orders"), {"a": 1.5, "b": 2.0})
    assert {r.run_name: r.metrics["high_value_customer_count"] for r in plain.collect()} == {"a": 4.0, "b": 2.0}
    assert {r.hits for r in ex.sweep_table(scoring.limit(0), runs).collect()} == {0}
    assert ex.sweep_table(scoring, runs.limit(0)).collect() == []


def test_notes(seeds):
    notes = {r.customer_id: r for r in text.alert_notes(build_targets(*seeds)).collect()}
    assert notes[3].alert_note == (
        "Carla in east region is a high-value account with $499.00 in total spend across 1 orders. Recommend priority "
        "outreach to maintain engagement and explore upsell opportunities.")
    assert notes[2].alert_note.startswith(
        "Bob has 1 pending order(s) requiring follow-up. Total historical spend is $399.99. Recommend contacting")
    assert notes[4].alert_note.startswith("Dev has 1 cancelled order(s), which may indicate")
    assert notes[5].alert_note.startswith("Elena shows no active alerts.")
    assert notes[5].note_id == "alert_note_5"


def test_windows(spark, seeds):
    _, orders = seeds
    assert latest_per_key(orders, "order_id", "last_updated").count() == 6
    assert rows(status_transitions(orders, "customer_id", "last_updated", "order_status").where("status_changed"),
                "order_id", "prev_status", "order_status", "next_status") == [(106, "completed", "pending", None)]
    versions = spark.sql("SELECT * FROM VALUES (1, 10, 1), (1, 20, 2), (1, 20, 3), (2, 5, 4) AS t(id, at, seq)")
    assert rows(latest_per_key(versions, "id", "at", ["seq"])) == [(1, 20, 3), (2, 5, 4)]


CUSTOMERS_CSV = "customer_id,name,signup_date,region\n1,Alice,2024-01-15,East\n2,Bob,2024-02-20,West\n"
ORDERS_CSV = (
    "order_id,customer_id,order_date,order_amount,STATUS,last_updated\n"
    "101,1,2024-02-01,450.50,COMPLETED,2024-02-01 10:00:00\n"
    "102,2,2024-02-15,89.99,Pending,2024-02-15 09:30:00\n"
)


def test_publish(spark, tmp_path):
    customers, orders, out = tmp_path / "customers.csv", tmp_path / "orders.csv", str(tmp_path / "targets")
    customers.write_text(CUSTOMERS_CSV)
    with pytest.raises(FileNotFoundError, match="orders.csv"):
        publish_targets(spark, str(customers), str(orders), out)
    orders.write_text(ORDERS_CSV)
    for _ in range(2):
        got = publish_targets(spark, str(customers), str(orders), out)
        assert rows(got, "customer_id", "region", "target_tier") == [
            (1, "east", "Tier 1 - High Priority"), (2, "west", "Tier 2 - Medium Priority")]
    orders.write_text(ORDERS_CSV + "103,9,2024-02-15,89.99,Lost,2024-02-15 09:30:00\n")
    with pytest.raises(ValueError, match=r"accepted_values\(order_status\)"):
        publish_targets(spark, str(customers), str(orders), out)


def test_readers_and_tables(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(CUSTOMERS_CSV)
    inferred = readers.read_csv(spark, str(path))
    assert dict(inferred.dtypes)["signup_date"] == "date"
    writers.publish_table(inferred, "seeded_customers", str(tmp_path / "table"))
    writers.publish_table(inferred, "seeded_customers", str(tmp_path / "table"))
    assert readers.read_table(spark, "default.seeded_customers", ["name"]).count() == 2
    spark.sql("DROP TABLE seeded_customers")
    writers.publish_view(inferred, "v_customers")
    assert readers.read_table(spark, "v_customers").count() == 2
    for name, body in (("b.txt", "two\n\nlines ü\n"), ("a.txt", "one")):
        (tmp_path / name).write_text(body, encoding="utf-8")
    assert rows(readers.read_documents(spark, str(tmp_path / "*.txt")), "source", "text") == [("a.txt", "one"), ("b.txt", "two\n\nlines ü\n")]


def test_stamp_is_one_value(spark):
    stamped = writers.stamp_features(spark.range(100, numPartitions=4))
    assert stamped.select("event_timestamp", "created").distinct().count() == 1


def test_a_diff_in_place_is_the_diff_of_the_runs(seeds):
    from tierloom.operators import alerts, experiments

    customers, orders = seeds
    scoring = experiments.scoring_input(customers, alerts.order_signals(orders))
    runs = {"high": 400.0, "low": 350.0}
    scored = experiments.scored_by_run(scoring, runs)
    want = rows(experiments.run_diff(scored, "high", "low"))
    assert rows(experiments.threshold_diff(scoring, runs, "high", "low")) == want and want
