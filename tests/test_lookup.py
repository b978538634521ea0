"""Lookups by key in a stored table, and loads that refuse bad batches."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.operators import features as fe
from tierloom.operators.keyed import upsert_newest
from tierloom.operators.quality import CheckFailed, NotNull, Unique
from tierloom.plans.loads import load_incremental
from tierloom.sources import bucketed
from tierloom.sources.bucketed import BucketedTable


@pytest.fixture
def stored(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["a", "b"], buckets=16)
    made = spark.range(3000).select((F.col("id") % 500).alias("a"), F.concat(F.lit("k"), F.col("id") % 7).alias("b"), F.col("id").alias("v"))
    table.update(made, lambda current, batch: upsert_newest(current, batch, ["a", "b"], "v"))
    return table


@pytest.mark.parametrize("named", [bucketed.NAMED_KEYS, 1])
def test_lookup_gives_the_rows_of_the_keys(spark, stored, monkeypatch, named):
    monkeypatch.setattr(bucketed, "NAMED_KEYS", named)
    asked = [(3, "k3"), (3, "k3"), (499, "k1"), (7, "k0"), (8, "zz"), (None, "k1"), (5, None)]
    keys = spark.createDataFrame(asked, "a int, b string")  # another integer type than the table's
    want = [r for r in rows(stored.read()) if r[:2] in {(a, b) for a, b in asked}]
    assert rows(stored.lookup(keys)) == want and want
    assert stored.lookup(keys.limit(0)).collect() == []
    everything = stored.read().select("a", "b")
    assert rows(stored.lookup(everything)) == rows(stored.read())


def test_lookup_reads_the_buckets_of_the_keys_only(spark, stored):
    keys = spark.createDataFrame([(3, "k3")], "a long, b string")
    found = stored.lookup(keys)
    assert found.count() == 1
    folders = {path.split(f"{bucketed.BUCKET}=")[1].split("/")[0] for path in found.inputFiles() if bucketed.BUCKET in path}
    everywhere = {path.split(f"{bucketed.BUCKET}=")[1].split("/")[0] for path in stored.read().inputFiles()}
    assert len(folders) == 1 and len(everywhere) == 16
    assert "In(a, [3])" in (plan := found._jdf.queryExecution().executedPlan().toString()) or "EqualTo(a,3)" in plan


def test_lookup_of_nothing_stored(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "none"), "k")
    assert table.lookup(spark.createDataFrame([(1,)], "k long")) is None


def test_online_lookup(spark, tmp_path):
    spec = fe.FeatureView("v", "k", {"x": T.DoubleType(), "y": T.StringType()}, timestamp_field="at", created_field="made")
    asked = spark.createDataFrame([(1, "p"), (1, "q"), (9, "r"), (None, "s")], "k long, tag string")
    table = BucketedTable(spark, str(tmp_path / "latest"), "k", buckets=4)
    empty = fe.online_lookup(asked, table, spec, ["x"])
    assert rows(empty) == [(1, "p", None), (1, "q", None), (9, "r", None), (None, "s", None)]
    made = spark.createDataFrame([(i, float(i), str(i)) for i in range(50)], "k long, x double, y string")
    table.update(made.select("k", "x", "y", F.current_timestamp().alias("at"), F.current_timestamp().alias("made")), lambda c, b: b)
    got = fe.online_lookup(asked, table, spec, ["x", "y"])
    assert rows(got) == rows(fe.online_features(table.read(), asked, spec, ["x", "y"]))
    with pytest.raises(ValueError):
        fe.online_lookup(asked, BucketedTable(spark, str(tmp_path / "o"), "other"), spec, ["x"])


def test_a_bad_batch_publishes_nothing(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "id", buckets=4)
    schema = "id long, at long, value string"
    checks = (Unique(("id",)), NotNull("value"))
    first = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], schema)
    before = rows(load_incremental(table, first, "at", checks=checks))
    for bad in ([(3, 2, None)], [(3, 2, "x"), (3, 2, "y")]):
        with pytest.raises(CheckFailed):
            load_incremental(table, first.union(spark.createDataFrame(bad, schema)), "at", checks=checks)
        assert rows(table.read()) == before and len(table.versions()) == 1
    good = first.union(spark.createDataFrame([(1, 2, "c")], schema))
    assert rows(load_incremental(table, good, "at", checks=checks)) == [(1, 2, "c"), (2, 1, "b")]
