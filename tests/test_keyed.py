import datetime
import random
from datetime import timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierloom.operators import keyed
from tierloom.plans.loads import load_incremental
from tierloom.sources.bucketed import BUCKET, BucketedTable


def orders(spark, *values):
    return spark.createDataFrame(
        [(i, v, t) for i, v, t in values], "id bigint, value string, at string"
    ).withColumn("at", F.to_timestamp("at"))


def test_first_load_takes_all(spark):
    source = orders(spark, (1, "a", "2024-01-01"), (1, "b", "2024-01-02"))
    assert keyed.delete_insert(None, source, "id", "at").count() == 2
    assert rows(keyed.delete_insert(None, source, "id", "at", dedup=True), "value") == [("b",)]


def test_late_row_with_equal_time_is_missed_unless_looked_back_for(spark):
    target = orders(spark, (1, "a", "2024-01-01"), (2, "a", "2024-01-02"))
    source = orders(spark, (1, "late", "2024-01-02"), (2, "new", "2024-01-03"), (3, "new", "2024-01-03"))
    assert rows(keyed.delete_insert(target, source, "id", "at"), "id", "value") == [(1, "a"), (2, "new"), (3, "new")]
    back = keyed.delete_insert(target, source, "id", "at", lookback=timedelta(days=1))
    assert rows(back, "id", "value") == [(1, "late"), (2, "new"), (3, "new")]


def test_empty_target_lets_nothing_in(spark):
    source = orders(spark, (1, "a", "2024-01-01"))
    assert keyed.delete_insert(source.limit(0), source, "id", "at").count() == 0


def test_repeated_keys_in_a_batch(spark):
    target = orders(spark, (1, "a", "2024-01-01"))
    source = orders(spark, (1, "b", "2024-01-02"), (1, "c", "2024-01-03"))
    assert rows(keyed.delete_insert(target, source, "id", "at"), "value") == [("b",), ("c",)]
    assert rows(keyed.delete_insert(target, source, "id", "at", dedup=True), "value") == [("c",)]


def test_upserts(spark):
    target = orders(spark, (1, "a", "2024-01-05"), (2, "a", "2024-01-05"))
    batch = orders(spark, (1, "old", "2024-01-01"), (3, "x", "2024-01-01"), (3, "y", "2024-01-02"))
    assert rows(keyed.merge_upsert(target, batch, "id", "at"), "id", "value") == [(1, "old"), (2, "a"), (3, "y")]
    once = keyed.upsert_newest(target, batch, "id", "at")
    assert rows(once, "id", "value") == [(1, "a"), (2, "a"), (3, "y")]
    assert rows(keyed.upsert_newest(once, batch, "id", "at")) == rows(once)


def log_of(spark, *values):
    return spark.createDataFrame(list(values), "k bigint, at int, v string")


def history_by_hand(log):
    out = []
    for key in sorted({k for k, _, _ in log}):
        points = []
        for _, at, v in sorted((r for r in log if r[0] == key), key=lambda r: r[1]):
            if not points or points[-1][1] != v:
                points.append((at, v))
        for i, (at, v) in enumerate(points):
            end = points[i + 1][0] if i + 1 < len(points) else None
            out.append((key, v, at, end, end is None))
    return sorted(out, key=repr)


LOG = [(1, 1, "a"), (1, 2, "a"), (1, 5, "b"), (1, 9, "a"), (2, 3, "x"), (3, 1, "q"), (3, 4, None), (3, 6, "q")]


def test_history(spark):
    assert rows(keyed.scd2_history(log_of(spark, *LOG), "k", "at", "v")) == history_by_hand(LOG)


@pytest.mark.parametrize(
    "batch",
    [
        [(1, 11, "c"), (1, 12, "c"), (1, 13, "d"), (4, 1, "n")],  # several changes, a repeat, a new key
        [(1, 10, "a"), (2, 7, "x")],  # nothing changes
        [(1, 7, "z"), (2, 1, "w")],  # late, inside a closed version and before the first
        [(1, 5, "b"), (1, 9, "a"), (2, 3, "x")],  # a replay
    ],
)
def test_apply(spark, batch):
    dim = keyed.scd2_history(log_of(spark, *LOG), "k", "at", "v")
    got = keyed.scd2_apply(dim, log_of(spark, *batch), "k", "at", "v")
    want = history_by_hand(LOG + batch)
    assert rows(got) == want
    again = keyed.scd2_apply(got, log_of(spark, *batch), "k", "at", "v")
    assert rows(again) == want


@pytest.mark.parametrize("batch", [[(3, 2, "m"), (1, 0, "b")], [(1, 3, "m")], [(2, 5, "y"), (4, 1, "n")]])
def test_apply_rebuilds_late_keys_from_the_log(spark, batch):
    """The repeat of x at time 8 opened no version; only the log still knows that x came back after a late y."""
    log = LOG + [(2, 8, "x")]
    dim = keyed.scd2_history(log_of(spark, *log), "k", "at", "v")
    got = keyed.scd2_apply(dim, log_of(spark, *batch), "k", "at", "v", log=log_of(spark, *log))
    assert rows(got) == history_by_hand(log + batch)


def test_apply_against_brute_force(spark):
    """400 keys with random changes, of which random ones arrive in a later batch, in any order."""
    rng = random.Random(2)
    log, batch = [], []
    for key in range(400):
        for at in sorted(rng.sample(range(40), rng.randint(1, 12))):
            (batch if rng.random() < rng.choice([0.1, 0.7]) else log).append((key, at, rng.choice(["a", "b", None])))
    dim = keyed.scd2_history(log_of(spark, *log), "k", "at", "v")
    assert rows(dim) == history_by_hand(log)
    got = keyed.scd2_apply(dim, log_of(spark, *batch), "k", "at", "v", log=log_of(spark, *log))
    assert rows(got) == history_by_hand(log + batch)


def test_as_of(spark):
    dim = keyed.scd2_history(log_of(spark, *LOG), "k", "at", "v")
    assert rows(keyed.scd2_as_of(dim, 5), "k", "v") == [(1, "b"), (2, "x"), (3, None)]
    assert rows(keyed.scd2_as_of(dim, 1), "k", "v") == [(1, "a"), (3, "q")]


def test_collection(spark):
    def records(*values):
        return spark.createDataFrame(list(values), "id string, text string")

    first = keyed.collection_add(None, records(("a", "1"), ("a", "1")))
    both = keyed.collection_add(first, records(("a", "2"), ("b", "2")))
    assert rows(both) == [("a", "1"), ("b", "2")]
    assert rows(keyed.collection_add(both, records(("a", "3"), ("b", "3")))) == rows(both)
    assert rows(keyed.collection_get(both, spark.createDataFrame([("b",), ("zz",)], "id string"))) == [("b", "2")]


def test_bucketed_table(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "id", buckets=4)
    newest = lambda current, batch: keyed.upsert_newest(current, batch, "id", "at")
    assert table.read() is None and table.last_version() is None
    start = orders(spark, *[(i, "a", "2024-01-01") for i in range(40)])
    assert table.update(start, newest) == 0
    assert table.update(orders(spark, (7, "b", "2024-01-02")), newest) == 1
    state = rows(table.read())
    assert len(state) == 40 and rows(table.read().where("value = 'b'"), "id") == [(7,)]
    assert rows(table.read(version=0)) == rows(start)
    # only the bucket of key 7 was written again
    assert len(list((tmp_path / "t" / "data" / "__version=1").glob(f"{BUCKET}=*"))) == 1
    # a batch that comes twice changes nothing
    assert table.update(orders(spark, (7, "b", "2024-01-02")), newest) == 2
    assert rows(table.read()) == state
    # a writer that died before its manifest entry left files that nobody reads, and its rerun replaces them
    orders(spark, (9, "junk", "2024-01-09")).withColumn(BUCKET, F.lit(0)).write.partitionBy(BUCKET).parquet(
        str(tmp_path / "t" / "data" / "__version=3"))
    assert rows(table.read()) == state
    assert table.update(orders(spark, (9, "d", "2024-01-09")), newest) == 3
    assert rows(table.read().where("id = 9"), "value") == [("d",)]
    assert table.update(start.limit(0), newest) == 3 and table.versions() == [0, 1, 2, 3]


def test_incremental_load_reruns(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "id", buckets=4)
    source = orders(spark, *[(i, "a", f"2024-01-0{i}") for i in range(1, 6)])
    once = rows(load_incremental(table, source, "at"))
    assert rows(load_incremental(table, source, "at")) == once == rows(source)
    more = source.unionByName(orders(spark, (2, "b", "2024-02-01")))
    assert rows(load_incremental(table, more, "at").where("id = 2"), "value") == [("b",)]


NULL_KEYS = "k bigint, v string, at int"


@pytest.mark.parametrize("merge", [keyed.merge_upsert, keyed.upsert_newest])
def test_rows_without_a_key_all_stay_and_reruns_add_none(spark, merge):
    target = spark.createDataFrame([(1, "a", 1), (None, "x", 1)], NULL_KEYS)
    batch = spark.createDataFrame([(1, "b", 2), (None, "y", 2), (None, "z", 2), (None, "z", 2), (None, "x", 1)], NULL_KEYS)
    want = [(1, "b", 2), (None, "x", 1), (None, "y", 2), (None, "z", 2), (None, "z", 2)]
    once = merge(target, batch, "k", "at")
    assert rows(once) == sorted(want, key=repr)
    assert rows(merge(once, batch, "k", "at")) == rows(once)


def test_marks_hold_in_the_repeated_hour(spark):
    """New York, 3 November 2024: 01:30 comes twice."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        instants = spark.createDataFrame([(1, 1730611800), (2, 1730613600), (3, 1730615400), (4, 1730617200)], "id int, s bigint")
        source = instants.select("id", F.timestamp_seconds("s").alias("at"))
        got = keyed.new_rows(source, source.where("id <= 2"), "at")
        assert [r.id for r in got.orderBy("id").collect()] == [3, 4]
        got = keyed.new_rows(source, source.where("id <= 3"), "at")
        assert [r.id for r in got.collect()] == [4]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_collections_keep_the_same_record_of_a_repeated_id(spark):
    records = spark.createDataFrame([("a", i, "x") for i in range(50)], "id string, n int, t string")
    kept = {keyed.collection_add(None, records.repartition(k + 1)).first().n for k in range(4)}
    assert len(kept) == 1
    assert keyed.collection_add(None, records, order_by=["n"]).first().n == 49


@pytest.fixture
def stored(spark, tmp_path):
    def open_table(buckets=8, key="k"):
        return BucketedTable(spark, str(tmp_path / "table"), key, buckets)

    return open_table


def test_a_table_keeps_its_key_and_buckets(spark, stored):
    frame = spark.range(100).selectExpr("id AS k", "id AS version")
    add = lambda current, rows: keyed.replace_keys(current, rows, "k")
    stored().update(frame, add)
    for other in (stored(16), stored(8, "version")):
        with pytest.raises(ValueError):
            other.update(frame, add)
        with pytest.raises(ValueError):
            other.read()
    assert rows(stored().read(), "k", "version") == rows(frame)  # a user's column may be called version
    with pytest.raises(ValueError, match="reserved"):
        BucketedTable(spark, stored().root + "2", "k").update(frame.withColumn("__bucket", F.lit(1)), lambda c, r: r)


def test_new_columns_and_emptied_buckets(spark, stored):
    table = stored(4)
    table.update(spark.range(20).selectExpr("id AS k", "'a' AS v"), lambda current, rows: rows)
    wider = spark.createDataFrame([(3, "b", 1.5)], "k bigint, v string, w double")
    table.update(wider, lambda current, rows: current.where("k <> 3").unionByName(rows, allowMissingColumns=True))
    got = {r.k: (r.v, r.w) for r in table.read().collect()}
    assert len(got) == 20 and got[3] == ("b", 1.5) and got[4] == ("a", None)
    with pytest.raises(ValueError, match="is gone"):
        table.update(spark.createDataFrame([(3,)], "k bigint"), lambda current, rows: rows)
    everything = spark.range(20).selectExpr("id AS k")
    table.update(everything, lambda current, rows: current.join(rows, "k", "left_anti"))
    assert table.read().count() == 0 and table.read(0).count() == 20
    table.update(wider, lambda current, rows: current.unionByName(rows))
    assert rows(table.read()) == [(3, "b", 1.5)]


def test_a_batch_is_computed_once(spark, stored):
    """A batch whose rows differ each time they are computed: rows and touched buckets still agree."""
    batch = spark.range(200).select(F.expr("CAST(rand() * 1e12 AS bigint) AS k"))
    stored().update(batch, lambda current, rows: rows)
    assert stored().read().count() == 200


def test_stored_history_and_collection(spark, stored, tmp_path):
    from tierloom.plans.loads import load_collection, load_history

    schema = "k bigint, s string, at date"
    day = lambda n: datetime.date(2024, 1, n)
    first = spark.createDataFrame([(1, "a", day(1)), (1, "b", day(3)), (2, "a", day(1)), (None, "n", day(2))], schema)
    later = spark.createDataFrame([(1, "c", day(5)), (2, "a", day(4)), (None, "n", day(2))], schema)
    got = rows(load_history(stored(), first, "at", ["s"]))
    assert rows(load_history(stored(), first, "at", ["s"])) == got
    got = rows(load_history(stored(), later, "at", ["s"], log=first))
    whole = rows(keyed.scd2_history(first.union(later), "k", "at", ["s"]))
    assert got == whole and rows(load_history(stored(), later, "at", ["s"], log=first.union(later))) == whole
    records = BucketedTable(spark, str(tmp_path / "records"), "id", 4)
    one = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "id string, n int")
    load_collection(records, one)
    two = spark.createDataFrame([("a", 2), ("c", 2), (None, 2)], "id string, n int")
    held = rows(load_collection(records, two))
    assert [r for r in held if r[0]] == [("a", 1), ("b", 1), ("c", 2)]
    assert rows(load_collection(records, two)) == held
