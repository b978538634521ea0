import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierloom.operators import quality as dq
from tierloom.sources import writers


@pytest.fixture(scope="module")
def frame(spark):
    return spark.sql(
        """SELECT * FROM VALUES (1, 10, 'a'), (1, 20, 'b'), (2, NULL, 'zz'), (3, 99, NULL), (NULL, 10, 'a'),
           (NULL, 10, 'zz') AS t(id, ref, kind)"""
    )


def test_report(spark, frame):
    checks = [
        dq.Unique(("id",)), dq.NotNull("id"), dq.AcceptedValues("kind", ("a", "b")), dq.Holds("ref", "ref < 50"),
        dq.Relationship("ref", "parent", "key"),
    ]
    parent = spark.createDataFrame([(10,), (20,)], "key int")
    assert rows(dq.run_checks(frame, checks, {"parent": parent})) == [
        ("accepted_values", "kind", 2, False), ("check", "ref", 1, False), ("not_null", "id", 2, False),
        ("relationships", "ref", 1, False), ("unique", "id", 1, False),
    ]
    clean = frame.where("id = 2 OR id = 3").withColumn("ref", F.lit(10)).withColumn("kind", F.lit("a"))
    assert {r.passed for r in dq.run_checks(clean, checks, {"parent": parent}).collect()} == {True}


def test_single_checks(spark, frame):
    assert rows(dq.duplicate_keys(frame, ["id"])) == [(1, 2)]
    assert rows(dq.unexpected_values(frame, "kind", ["a", "b"])) == [("zz", 2)]
    assert rows(dq.null_counts(frame, ["id", "ref", "kind"])) == [("id", 2), ("kind", 1), ("ref", 1)]
    assert dq.failing_rows(spark, "SELECT * FROM {f} WHERE id > 3", f=frame).count() == 0


def test_quarantine_and_guard(spark, frame, tmp_path):
    checks = [dq.NotNull("id"), dq.AcceptedValues("kind", ("a", "b"))]
    good, bad = dq.quarantine(frame, checks)
    assert good.count() == 3 and good.columns == frame.columns
    assert rows(bad, "id", "violations") == [
        (2, ["accepted_values(kind)"]), (None, ["not_null(id)", "accepted_values(kind)"]), (None, ["not_null(id)"])]
    path = str(tmp_path / "out")
    with pytest.raises(dq.CheckFailed, match=r"not_null\(id\): 2"):
        dq.guarded_write(frame, checks, path)
    assert not (tmp_path / "out").exists()
    for _ in range(2):
        assert spark.read.parquet(dq.guarded_write(good, checks, path)).count() == 3


def test_evolving_columns(spark, tmp_path):
    path = str(tmp_path / "evolving")
    old, new = spark.range(2).toDF("id"), spark.range(2, 4).withColumn("extra", F.lit("x"))
    writers.write_parquet(old, path)
    writers.write_parquet(new, path, mode="append")
    want = [(0, None), (1, None), (2, "x"), (3, "x")]
    assert rows(writers.read_evolved(spark, path), "id", "extra") == want
    assert rows(writers.append_evolving(old, new), "id", "extra") == want


def test_quarantine_refuses_checks_of_whole_tables(spark):
    frame = spark.range(3).withColumnRenamed("id", "k")
    for check in (dq.Unique(("k",)), dq.Relationship("k", "t", "k")):
        with pytest.raises(TypeError):
            dq.quarantine(frame, [dq.NotNull("k"), check])


def test_a_refused_publication_leaves_the_name_as_it_was(spark, tmp_path):
    root, checks = str(tmp_path / "published"), [dq.NotNull("k"), dq.Unique(("k",))]
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert rows(dq.guarded_publish(good, checks, "published_rows", root)) == rows(good)
    with pytest.raises(dq.CheckFailed):
        dq.guarded_publish(good.union(good), checks, "published_rows", root)
    assert rows(spark.table("published_rows")) == rows(good)
    better = good.where("k = 2")
    assert rows(dq.guarded_publish(better, checks, "published_rows", root)) == rows(better) == rows(spark.table("published_rows"))
    spark.sql("DROP VIEW published_rows")
