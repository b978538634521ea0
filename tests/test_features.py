import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.operators import features as fe
from tierloom.plans.loads import build_targets
from tierloom.sources.bucketed import BucketedTable
from tierloom.sources.writers import stamp_features
from tierloom.streaming import push

SPEC = fe.FeatureView(
    "stats", "k", {"v": T.FloatType(), "n": T.LongType()}, ttl=timedelta(days=1), services={"only_v": ("v",)}
)


def feature_rows(spark, *values):
    return spark.createDataFrame(
        [(k, float(v), n, datetime.fromisoformat(e), datetime.fromisoformat(c)) for k, v, n, e, c in values],
        "k bigint, v double, n int, event_timestamp timestamp, created timestamp",
    )


def entity_rows(spark, *values):
    return spark.createDataFrame(
        [(k, datetime.fromisoformat(t), label) for k, t, label in values],
        "k bigint, event_timestamp timestamp, label string",
    )


@pytest.fixture(scope="module")
def stats(spark):
    return feature_rows(
        spark,
        (1, 1.0, 1, "2024-01-01T00:00", "2024-01-01T01:00"),
        (1, 2.0, 2, "2024-01-02T00:00", "2024-01-02T01:00"),
        (1, 3.0, 3, "2024-01-02T00:00", "2024-01-02T05:00"),  # same time, created later
        (1, 4.0, 4, "2024-01-09T00:00", "2024-01-09T01:00"),  # future for all but the last question
        (2, 9.0, 9, "2024-01-05T00:00", "2024-01-05T01:00"),
    )


def test_asof(spark, stats):
    asked = entity_rows(
        spark,
        (1, "2024-01-01T12:00", "a"),
        (1, "2024-01-02T00:00", "b"),  # at the feature's own time
        (1, "2024-01-03T00:00", "c"),  # exactly one TTL old
        (1, "2024-01-03T00:01", "d"),  # just too old
        (1, "2023-12-31T00:00", "e"),  # before any value
        (7, "2024-01-02T00:00", "f"),  # unknown key
        (2, "2024-01-05T10:00", "g"),
        (2, "2024-01-05T10:00", "g"),  # a repeated question stays
    )
    got = fe.historical_features(asked, stats, SPEC, ["stats:v", "n"])
    assert got.columns == ["k", "event_timestamp", "label", "v", "n"]
    assert dict(got.dtypes)["v"] == "float" and dict(got.dtypes)["n"] == "bigint"
    assert rows(got, "label", "v", "n") == [
        ("a", 1.0, 1), ("b", 3.0, 3), ("c", 3.0, 3), ("d", None, None), ("e", None, None), ("f", None, None),
        ("g", 9.0, 9), ("g", 9.0, 9)]


def test_rows_without_a_key_match_nothing(spark, stats):
    unkeyed = stats.withColumn("k", F.when(F.col("k") == 1, F.col("k")))
    asked = entity_rows(spark, (None, "2024-01-05T12:00", "n"), (1, "2024-01-02T00:00", "b"))
    want = [("b", 3.0), ("n", None)]
    assert rows(fe.historical_features(asked, unkeyed, SPEC, ["v"]), "label", "v") == want


def test_batch_scoring_is_asof_at_one_time(spark, stats):
    stamp = datetime(2024, 1, 3)
    keys = spark.createDataFrame([(1, "x"), (2, "y"), (7, "z")], "k bigint, label string")
    asof = fe.historical_features(keys.withColumn("event_timestamp", F.lit(stamp)), stats, SPEC, ["v"])
    assert rows(fe.batch_scoring(keys, stats, SPEC, ["v"], stamp)) == rows(asof.drop("event_timestamp"))


def test_names_and_declaration(spark, stats, seeds):
    assert SPEC.resolve("only_v") == ["v"]
    for wrong in (["other:v"], ["stats:zz"], "no_such_set"):
        with pytest.raises(KeyError):
            SPEC.resolve(wrong)
    with pytest.raises(ValueError, match="lacks n"):
        SPEC.apply(stats.drop("n"))
    exported = stamp_features(build_targets(*seeds), datetime(2024, 6, 1))
    view = fe.CUSTOMER_STATS.apply(exported)
    assert dict(view.dtypes)["total_spend"] == "float" and view.count() == 5
    latest = fe.materialize(exported, fe.CUSTOMER_STATS, "2024-01-01", "2024-12-31")
    found = fe.online_features(
        latest, spark.createDataFrame([(3,), (99,)], "customer_id bigint"), fe.CUSTOMER_STATS,
        ["customer_stats:total_spend", "customer_stats:alert_priority"])
    assert rows(found) == [(3, 499.0, 1), (99, None, None)]


def test_materialize(spark, stats):
    got = fe.materialize(stats, SPEC, "2024-01-01", "2024-01-05")
    assert rows(got, "k", "v") == [(1, 3.0), (2, 9.0)]
    first = fe.materialize_incremental(None, stats, SPEC, "2024-01-02")
    assert rows(first, "k", "v") == [(1, 3.0)]
    second = fe.materialize_incremental(first, stats, SPEC, "2024-01-10")
    assert rows(second, "k", "v") == [(1, 4.0), (2, 9.0)]
    # overlapping and repeated runs do no harm
    again = fe.materialize_incremental(second, stats, SPEC, "2024-01-10", start="2024-01-01")
    assert rows(again) == rows(second)
    derived = fe.on_demand(second.withColumn("val_to_add", F.lit(10)), {"v_plus": "v + val_to_add"})
    assert rows(derived, "k", "v_plus") == [(1, 14.0), (2, 19.0)]


def test_push(spark, stats, tmp_path):
    root = str(tmp_path)
    table = BucketedTable(spark, f"{root}/latest", "k", buckets=4)
    stats.coalesce(1).write.parquet(f"{root}/landing")

    def run():
        stream = spark.readStream.schema(stats.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landing")
        push.push_stream(stream, SPEC, f"{root}/offline", table, f"{root}/checkpoint").awaitTermination()
        return rows(table.read(), "k", "v")

    assert run() == [(1, 4.0), (2, 9.0)]
    # an out-of-order event, a newer one, and one that was pushed before
    feature_rows(
        spark,
        (1, 0.5, 0, "2024-01-08T00:00", "2024-01-08T01:00"),
        (2, 10.0, 10, "2024-01-06T00:00", "2024-01-06T01:00"),
        (1, 4.0, 4, "2024-01-09T00:00", "2024-01-09T01:00"),
    ).coalesce(1).write.mode("append").parquet(f"{root}/landing")
    assert run() == [(1, 4.0), (2, 10.0)]
    assert run() == [(1, 4.0), (2, 10.0)]
    assert push.read_offline(spark, f"{root}/offline", SPEC).count() == 7
    # read after push
    asked = spark.createDataFrame([(2,), (3,)], "k bigint")
    assert rows(fe.online_features(table.read(), asked, SPEC, "only_v")) == [(2, 10.0), (3, None)]
    # a replay of the first batch changes neither table
    streams = [p.name for p in (tmp_path / "offline").glob("stream=*")]
    assert len(streams) == 1 and streams[0] != "stream=None"
    push.push_batch(stats, 0, SPEC, f"{root}/offline", table, stream=streams[0].removeprefix("stream="))
    assert rows(table.read(), "k", "v") == [(1, 4.0), (2, 10.0)]
    assert spark.read.parquet(f"{root}/offline").count() == 8
    assert push.read_offline(spark, f"{root}/offline", SPEC).count() == 7
    # a stream with a checkpoint of its own counts its batches anew, and loses nothing
    feature_rows(spark, (5, 5.0, 5, "2024-01-08T00:00", "2024-01-08T01:00")).write.parquet(f"{root}/other")
    other = spark.readStream.schema(stats.schema).parquet(f"{root}/other")
    push.push_stream(other, SPEC, f"{root}/offline", table, f"{root}/checkpoint2").awaitTermination()
    assert rows(table.read(), "k", "v") == [(1, 4.0), (2, 10.0), (5, 5.0)]
    assert push.read_offline(spark, f"{root}/offline", SPEC).count() == 8


def test_push_targets(spark, stats, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "latest"), "k", buckets=2)
    push.push_batch(stats, 0, SPEC, str(tmp_path / "offline"), table, to=push.OFFLINE)
    assert table.read() is None and push.read_offline(spark, str(tmp_path / "offline"), SPEC).count() == 5
    push.push_batch(stats, 0, SPEC, str(tmp_path / "none"), table, to=push.ONLINE)
    assert table.read().count() == 2 and not (tmp_path / "none").exists()
    with pytest.raises(ValueError):
        push.push_batch(stats, 1, SPEC, str(tmp_path / "none"), table, to="elsewhere")


def test_asof_against_brute_force(spark):
    rng = random.Random(11)
    start = datetime(2024, 1, 1)

    def at():
        return start + timedelta(hours=rng.randint(0, 200))

    known = [(rng.randint(0, 15), rng.random(), n, at(), at()) for n in range(600)]
    asked = [(rng.randint(0, 17), at(), f"q{n}") for n in range(400)]
    view = spark.createDataFrame(known, "k bigint, v double, n int, event_timestamp timestamp, created timestamp")
    entities = spark.createDataFrame(asked, "k bigint, event_timestamp timestamp, label string")
    want = []
    for key, when, label in asked:
        hits = [r for r in known if r[0] == key and when - SPEC.ttl <= r[3] <= when]
        newest = max(((r[3], r[4]) for r in hits), default=None)
        want.append((label, newest))
    got = fe.historical_features(entities, view, SPEC, ["n"]).collect()
    by_number = {r[2]: (r[3], r[4]) for r in known}
    assert sorted((r.label, None if r.n is None else by_number[r.n]) for r in got) == sorted(want)


def test_several_views_on_one_time_line(spark, stats):
    """Both views in one request, with a field they share, also when the key is hot."""
    other = fe.FeatureView("more", "k", {"v": T.DoubleType(), "w": T.LongType()}, timestamp_field="at", created_field="made")
    rows2 = spark.createDataFrame([(1, 10.0, 7, "2024-01-01"), (1, 11.0, 8, "2024-01-04"), (2, 12.0, 9, "2024-01-02")],
                                  "k bigint, v double, w bigint, d string")
    rows2 = rows2.select("k", "v", "w", F.to_timestamp("d").alias("at"), F.to_timestamp("d").alias("made"))
    asked = entity_rows(spark, (1, "2024-01-03T12:00", "a"), (2, "2024-01-01T12:00", "b"), (9, "2024-01-09T00:00", "c"))
    one = fe.historical_features(asked, stats, SPEC, ["v"]).withColumnRenamed("v", f"{SPEC.name}__v")
    two = fe.historical_features(asked, rows2, other, ["v", "w"]).withColumnRenamed("v", "more__v")
    want = rows(one.join(two, ["k", "event_timestamp", "label"]), "label", f"{SPEC.name}__v", "more__v", "w")
    names = [f"{SPEC.name}:v", "more:v", "more:w"]
    for skew in ({}, {"rows_per_slice": 40, "min_rows": 0}):
        got = fe.historical_views(asked, [(stats, SPEC), (rows2, other)], names, **skew)
        assert rows(got, "label", f"{SPEC.name}__v", "more__v", "w") == want
    with pytest.raises(KeyError):
        fe.historical_views(asked, [(stats, SPEC)], names)


def test_asof_in_the_repeated_hour(spark):
    """New York, 3 November 2024: a value from the first 01:30 is there at the second one."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = F.timestamp_seconds("s")
        known = spark.createDataFrame([(1, 2.5, 1730611800)], "k bigint, v double, s bigint").select(
            "k", "v", at.alias(SPEC.timestamp_field), at.alias(SPEC.created_field))
        known = known.withColumns({name: F.lit(None).cast(t) for name, t in SPEC.fields.items() if name != "v"})
        asked = spark.createDataFrame([(1, "x", 1730615400), (1, "y", 1730608200)], "k bigint, label string, s bigint")
        asked = asked.select("k", "label", at.alias("event_timestamp"))
        assert rows(fe.historical_features(asked, known, SPEC, ["v"]), "label", "v") == [("x", 2.5), ("y", None)]
        latest = fe.materialize_incremental(known, known.withColumn("v", F.lit(9.0)), SPEC, "2024-11-04")
        assert rows(latest, "k") == [(1,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
