import itertools
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierloom.functions.ks import exact_p_value
from tierloom.operators import drift

NUMERIC = ["total_spend", "pending_orders", "cancelled_orders", "total_orders"]


@pytest.fixture(scope="module")
def windows(spark):
    return spark.createDataFrame(
        [
            ("baseline", 499.0, 0.0, 0.0, 1, "east", "high"), ("baseline", 370.5, 1.0, 0.0, 2, "east", "pending"),
            ("baseline", 75.25, 0.0, 1.0, 1, "south", "cancel"), ("baseline", 89.99, 0.0, 0.0, 1, "west", "none"),
            ("baseline", 0.0, 0.0, 0.0, 0, "west", "none"),
            ("current", 1171.839512594438, 2.0, 0.0, 1, "east", "high"),
            ("current", 876.8767991924817, 1.0, 0.0, 2, "east", "pending"),
            ("current", 150.16862221644868, 0.0, 1.0, 1, "south", "cancel"),
            ("current", 206.36180375414267, 2.0, 0.0, 1, "north", "none"),
            ("current", 0.0, 0.0, 0.0, 0, None, "none"),
        ],
        "window string, total_spend double, pending_orders double, cancelled_orders double, total_orders int, "
        "region string, reason string",
    )


def test_report(windows):
    got = {r.feature: r for r in drift.combined_drift(windows, "window", NUMERIC, method="exact").collect()}
    assert got["total_spend"].baseline_mean == pytest.approx(206.948)
    assert got["total_spend"].pct_change == pytest.approx(132.45, abs=0.01)
    assert got["pending_orders"].pct_change == pytest.approx(400)
    for name in ("total_spend", "pending_orders"):
        assert got[name].ks_stat == pytest.approx(0.4) and got[name].p_value == pytest.approx(0.8730, abs=1e-4)
        assert (got[name].drift_detected, got[name].mean_shift_drift, got[name].combined_drift) == (False, True, True)
    for name in ("cancelled_orders", "total_orders"):
        assert (got[name].ks_stat, got[name].p_value, got[name].combined_drift) == (0.0, 1.0, False)
    summary = drift.drift_summary(drift.combined_drift(windows, "window", NUMERIC)).first()
    assert summary.drifted_features == "pending_orders, total_spend" and summary.advice.startswith("Recommendation")
    calm = drift.drift_summary(drift.combined_drift(windows, "window", ["total_orders"])).first()
    assert tuple(calm) == ("", "No significant drift detected across checked features.")


def test_zero_base_and_missing_values(spark):
    df = spark.createDataFrame(
        [("baseline", 0.0, None, 0.0, float("nan")), ("baseline", 0.0, None, 0.0, 2.0), ("current", 1.0, None, 0.0, 2.0)],
        "window string, up double, nothing double, flat double, gaps double",
    )
    features = ["up", "nothing", "flat", "gaps"]
    shift = {r.feature: r for r in drift.mean_shift(df, "window", features).collect()}
    assert shift["up"].pct_change == math.inf and shift["up"].mean_shift_drift
    assert shift["flat"].pct_change == 0 and not shift["flat"].mean_shift_drift
    assert shift["gaps"].pct_change == 0
    assert shift["nothing"].pct_change is None and not shift["nothing"].mean_shift_drift
    ks = {r.feature: r for r in drift.ks_drift(df, "window", features).collect()}
    assert math.isnan(ks["up"].pct_change) and ks["up"].ks_stat == 1.0
    assert ks["nothing"].ks_stat is None and not ks["nothing"].drift_detected


def test_categories(windows):
    got = {(r.feature, r.category): (r.baseline_pct, r.current_pct)
           for r in drift.categorical_drift(windows, "window", ["region", "reason"]).collect()}
    assert got["region", "west"] == (40.0, 0.0) and got["region", "north"] == (0.0, 25.0)
    assert got["region", "east"] == (40.0, 50.0) and got["reason", "none"] == (40.0, 40.0)


def test_exact_p_against_all_orders():
    n, m = 5, 3
    stats = []
    for picked in itertools.combinations(range(n + m), n):
        i = j = best = 0
        for at in range(n + m):
            i, j = (i + 1, j) if at in picked else (i, j + 1)
            best = max(best, abs(i / n - j / m))
        stats.append(best)
    for d in sorted(set(stats)):
        share = sum(s >= d - 1e-9 for s in stats) / len(stats)
        assert exact_p_value(d, n, m) == pytest.approx(share) == pytest.approx(exact_p_value(d, m, n))


@pytest.mark.parametrize(("d", "n", "m"), [(0.0185, 3000, 3000), (0.03, 2500, 4000), (0.012, 10_000, 10_000)])
def test_exact_p_of_larger_samples_is_near_the_limit(d, n, m):
    x = d * math.sqrt(n * m / (n + m))
    limit = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))
    assert exact_p_value(d, n, m) == pytest.approx(limit, abs=0.03)


def test_large_samples_use_the_limit(spark):
    df = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, "baseline").otherwise("current").alias("window"),
        (F.col("id") + F.when(F.col("id") % 2 == 0, 0).otherwise(400)).cast("double").alias("v"),
    )
    row = drift.ks_drift(df, "window", ["v"]).first()
    assert row.ks_stat == pytest.approx(0.01, abs=1e-3)
    x = row.ks_stat * math.sqrt(10_000)
    assert row.p_value == pytest.approx(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 50)))


def test_union(spark):
    got = drift.union_windows({"baseline": spark.range(2), "current": spark.range(1)})
    assert rows(got) == [(0, "baseline"), (0, "current"), (1, "baseline")]


def test_nearly_equal_windows_have_not_drifted(spark):
    """A million rows on each side that differ in one."""
    before = spark.range(1_000_000).select(F.lit("baseline").alias("window"), F.col("id").cast("double").alias("v"))
    after = before.select(F.lit("current").alias("window"), F.when(F.col("v") == 500, 501.0).otherwise(F.col("v")).alias("v"))
    found = drift.combined_drift(before.union(after), "window", ["v"]).first()
    assert found.ks_stat == pytest.approx(1e-6) and found.p_value == 1.0 and not found.combined_drift


def test_limiting_p_values(spark):
    """Known points of the limiting distribution, on both sides of the two series; the size plays no part."""
    from tierloom.functions.ks import series_p

    known = [(0.001, 1.0), (0.3, 0.9999906), (0.5, 0.9639452), (0.8, 0.5441424), (0.99, 0.2808738), (1.0, 0.2699997), (1.2, 0.1122497),
             (1.36, 0.0494859), (2.0, 0.0006709), (30.0, 0.0)]
    for size in (8, 2_000_000):
        frame = spark.createDataFrame([(x, x / math.sqrt(size / 2), size) for x, _ in known], "x double, d double, n long")
        got = {r.x: r.p for r in frame.select("x", series_p(F.col("d"), F.col("n"), F.col("n")).alias("p")).collect()}
        assert [got[x] for x, _ in known] == pytest.approx([p for _, p in known], abs=1e-5)


def test_unknown_method(windows):
    with pytest.raises(ValueError):
        drift.ks_drift(windows, "window", NUMERIC, method="auto")
