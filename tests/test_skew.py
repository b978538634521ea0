"""A hot key cut into slices must give the same rows as one window over the whole key."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.operators import drift, keyed, ranks, skew
from tierloom.operators.features import FeatureView, historical_features
from tierloom.operators.skew import SLICE, with_slices
from tierloom.operators.windows import status_transitions

SLICED = {"rows_per_slice": 60, "min_rows": 20}


@pytest.fixture(scope="module")
def log(spark):
    """3000 rows; key 0 holds a third of them, NULL another large part; times repeat and some are missing."""
    return (
        spark.range(3000)
        .select(
            F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 40)
            .cast("bigint").alias("key"),
            F.when(F.col("id") % 97 == 0, F.lit(None)).otherwise(
                F.expr("TIMESTAMP_NTZ'2024-03-10 00:00:00' + make_dt_interval(0, 0, 0, (id * 7919) % 2000 * 60)")
            ).alias("ts"),
            F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("s"), F.xxhash64("id") % 3))
            .alias("status"),
            "id",
        )
        .repartition(7)
    )


def test_slices_follow_the_order_and_split_the_hot_keys(log):
    sliced, hot = with_slices(log, ["key"], "ts", **SLICED)
    assert hot
    sizes = {(r["key"], r[SLICE]): r["count"] for r in sliced.groupBy("key", SLICE).count().collect()}
    assert max(sizes.values()) < 200 and len([k for k in sizes if k[0] == 0]) > 10
    ranges = sliced.where("key = 0 AND ts IS NOT NULL").groupBy(SLICE).agg(F.min("ts"), F.max("ts")).orderBy(SLICE)
    bounds = [tuple(r)[1:] for r in ranges.collect()]
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    assert sliced.count() == 3000
    assert with_slices(log, ["key"], "ts")[1] == 0


def test_one_key_for_all_rows_makes_even_slices_and_tasks(spark):
    """No cap on the number of slices: twice the rows, twice the slices, and none of them grows."""
    for rows_all in (40_000, 80_000):
        log = spark.range(rows_all).select(F.lit("k").alias("key"), (F.xxhash64("id") % 10**9).alias("at"), "id").repartition(5)
        sliced, slices = with_slices(log, ["key"], "at", rows_per_slice=500, min_rows=20)
        sizes = [r["count"] for r in sliced.groupBy(SLICE).count().collect()]
        assert slices == len(sizes) and 0.8 * rows_all / 500 < slices < 1.1 * rows_all / 500 and max(sizes) < 1500
        tasks = sliced.repartition(8, "key", SLICE).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in tasks) < 2 * rows_all / 8


def test_summaries_beyond_the_bound_are_joined_without_a_broadcast(spark, log, monkeypatch):
    plain = rows(status_transitions(log, "key", "ts", "status", ["id"]))
    monkeypatch.setattr(skew, "BROADCAST_SLICES", 3)
    assert rows(status_transitions(log, "key", "ts", "status", ["id"], **SLICED)) == plain


def test_transitions(log):
    plain = status_transitions(log, "key", "ts", "status", ["id"])
    assert rows(status_transitions(log, "key", "ts", "status", ["id"], **SLICED)) == rows(plain)
    assert plain.columns == status_transitions(log, "key", "ts", "status", ["id"], **SLICED).columns


def test_history(log):
    plain = keyed.scd2_history(log, "key", "ts", "status", ["id"])
    assert rows(keyed.scd2_history(log, "key", "ts", "status", ["id"], **SLICED)) == rows(plain)


@pytest.mark.parametrize("ttl_minutes", [None, 30])
def test_asof(log, ttl_minutes):
    from datetime import timedelta

    spec = FeatureView(
        "v", "key", {"status": T.StringType(), "id": T.LongType()},
        ttl=timedelta(minutes=ttl_minutes) if ttl_minutes else None, timestamp_field="ts", created_field="created",
    )
    timed = log.where("ts IS NOT NULL").withColumn("created", F.col("id"))
    # Feature rows are rare, so that values must be carried over several slices.
    features, asked = timed.where("id % 20 = 0"), timed.where("id % 20 <> 0").select("key", "ts", F.col("id").alias("q"))
    names = ["status", "id"]
    plain = historical_features(asked, features, spec, names, ts="ts")
    assert plain.where("id IS NOT NULL").count() > 500
    assert rows(historical_features(asked, features, spec, names, ts="ts", **SLICED)) == rows(plain)


def test_running_counts(spark):
    values = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "baseline").otherwise("current").alias("window"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.xxhash64("id") % 1000 / 7.0).alias("a"),
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise((F.col("id") % 10).cast("double")).alias("b"),
    )
    plain = drift.ks_drift(values, "window", ["a", "b"])
    assert rows(drift.ks_drift(values, "window", ["a", "b"], **SLICED)) == rows(plain)


def test_described(spark):
    values = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "baseline").otherwise("current").alias("window"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.xxhash64("id") % 1000 / 7.0).alias("a"),
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise((F.col("id") % 10).cast("double")).alias("b"),
    )
    described = drift.describe(values, ["window"], ["a", "b"])
    unnamed = values.withColumn("window", F.when(F.col("window") == "current", F.col("window")))
    by_null = {(r.window, r.feature): r["count"] for r in drift.describe(unnamed, ["window"], ["a"]).collect()}
    assert by_null == {(None, "a"): 2000, ("current", "a"): 2000}
    pdf = values.toPandas()
    for r in described.collect():
        series = pdf[pdf.window == r.window][r.feature].describe()
        assert [r["count"], r["mean"], r["std"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]] == pytest.approx(
            series.tolist())


def test_values_at_ranks(spark):
    """Every rank of small groups: signs, zeros, infinities, neighbouring doubles, repeats, a NULL group."""
    rng = np.random.default_rng(2)
    odd = [0.0, -0.0, float("inf"), float("-inf"), 5e-324, -5e-324, 1.0, np.nextafter(1.0, 2), -1e300, 1e300]
    data = [(k, float(v)) for k in (None, "x", "y") for v in [*odd, *rng.normal(size=40), *rng.integers(-3, 3, 20)]]
    long = spark.createDataFrame([*data, ("z", 3.0)], "k string, value double").repartition(3)
    wanted = spark.createDataFrame([(k, r) for k in (None, "x", "y", "z") for r in range(72)], "k string, rank int")
    got = {(r.k, r.rank): r.value for r in ranks.values_at_ranks(long, ["k"], wanted).collect()}
    want = {(k, r): v for k in (None, "x", "y", "z") for r, v in enumerate(sorted(v for g, v in [*data, ("z", 3.0)] if g == k))}
    assert got == want
    bits = ranks.ordered_bits(np.array(sorted(v for _, v in data)))
    assert (np.diff(bits) >= 0).all()
    assert ranks.values_at_ranks(long.where("value > 1e308 and value < 0"), ["k"], wanted).collect() == []


def test_rank_of_many_values(spark):
    """Many different values of one group, found in few passes."""
    long = spark.range(200_000).select(F.lit("g").alias("k"), (F.xxhash64("id") / 1e9).alias("value"))
    wanted = spark.createDataFrame([("g", 100_000)], "k string, rank int")
    got = ranks.values_at_ranks(long, ["k"], wanted).first()["value"]
    assert got == sorted(r.value for r in long.collect())[100_000]


def test_rows_of_one_second_are_cut(spark):
    """A hot key whose rows all fall into one second, apart by microseconds."""
    log = spark.range(2000).select(
        F.lit(1).alias("key"), F.expr("TIMESTAMP_NTZ'2024-03-10 00:00:00' + make_dt_interval(0, 0, 0, id / 1000000)").alias("ts"),
        (F.col("id") % 2).alias("status"), "id")
    sliced, hot = with_slices(log, ["key"], "ts", **SLICED)
    assert hot and max(r["count"] for r in sliced.groupBy(SLICE).count().collect()) < 200
    plain = status_transitions(log, "key", "ts", "status", ["id"])
    assert rows(status_transitions(log, "key", "ts", "status", ["id"], **SLICED)) == rows(plain)
