"""Population stability index against a numpy recomputation and its edge cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.config import Monitoring
from riskloom.operators.drift import (
    classify,
    count_traffic,
    drift_alerts,
    drift_table,
    fit_profile,
    psi_breakdown,
    shared_features,
)
from riskloom.operators.log import DRIFT_SCHEMA
from riskloom.plans.drift_job import drift_check


@pytest.fixture(scope="module")
def column(spark):
    def build(values, name="x"):
        return spark.createDataFrame(
            [(None if v is None else float(v),) for v in values], f"{name} double"
        )

    return build


def by_shares(expected, actual):
    """The index from the shares of rows per bin, worked out in plain arithmetic."""
    return sum((a - e) * math.log(a / e) for e, a in zip(expected, actual))


#: 1000 whole numbers; four bins meet at 249.75, 499.5 and 749.25.
LADDER = list(range(1000))


def in_quarters(*counts):
    return [200 + 250 * k for k, n in enumerate(counts) for _ in range(n)]


def psi(column, expected, actual, bins=10):
    return drift_table(fit_profile(column(expected), ["x"], bins), column(actual)).first()


@pytest.mark.parametrize(
    "counts, status", [((25, 25, 25, 25), "stable"), ((20, 22, 28, 30), "stable"), ((12, 21, 30, 37), "warn"), ((10, 20, 30, 40), "warn"), ((1, 2, 7, 90), "alert")]
)
def test_index_of_known_shares(column, counts, status):
    row = psi(column, LADDER, in_quarters(*counts), 4)
    expected = by_shares([0.25] * 4, [n / sum(counts) for n in counts])
    assert row["psi"] == pytest.approx(expected, abs=1e-12) and row["status"] == status


def test_an_empty_bin_counts_as_a_millionth(column):
    row = psi(column, LADDER, in_quarters(50, 50, 0, 0), 4)
    assert row["psi"] == pytest.approx(by_shares([0.25] * 4, [0.5, 0.5, 1e-6, 1e-6]), abs=1e-9)


def test_ties_merge_bins(column):
    # Quarters of 10 rows: 0 six times, 1 three times, 2 once. Edges 0, 0, 0, 1, 2 leave [0, 1) and [1, 2].
    base, now = [0] * 6 + [1] * 3 + [2], [0] * 3 + [1] * 5 + [2] * 2
    assert psi(column, base, now, 4)["psi"] == pytest.approx(by_shares([0.6, 0.4], [0.3, 0.7]), abs=1e-12)


@pytest.mark.parametrize("now", [[], [float("nan")] * 100, [None] * 3])
def test_no_current_values_is_unknown(column, now):
    row = psi(column, range(100), now)
    assert row["psi"] is None and row["status"] == "unknown" and row["current_n"] == len(now)


def test_no_baseline_is_unknown(column):
    row = psi(column, [None, float("nan")], [1.0])
    assert row["psi"] is None and row["status"] == "unknown" and row["baseline_n"] == 2


def test_constant_baseline_is_zero_and_marked(column):
    row = psi(column, np.ones(500), np.random.default_rng(5).normal(size=500))
    assert row["psi"] == 0.0 and row["constant_baseline"]


@pytest.mark.parametrize("gone", [1, 37])
def test_values_that_are_no_number_weigh_nothing(column, gone):
    """Shares and mean come from the numbers alone; the rows without one are still counted."""
    now = in_quarters(4, 9, 2, 5)
    row = psi(column, LADDER, [*([float("nan")] * gone), *now], 4)
    assert row["psi"] == pytest.approx(by_shares([0.25] * 4, [0.2, 0.45, 0.1, 0.25]))
    assert (row["current_n"], row["current_mean"]) == (20 + gone, pytest.approx(np.mean(now)))


def test_infinite_values_fall_into_the_outer_bins(column):
    now = [*in_quarters(10, 10, 10, 10), float("inf"), float("-inf")]
    assert psi(column, LADDER, now, 4)["psi"] == pytest.approx(by_shares([0.25] * 4, [11 / 42, 10 / 42, 10 / 42, 11 / 42]))


def test_breakdown_adds_up_and_its_bounds_meet(column):
    rng = np.random.default_rng(8)
    base, now = rng.normal(size=3000), rng.normal(0.5, 1, 3000)
    profile = fit_profile(column(base), ["x"])
    rows = psi_breakdown(profile, column(now)).orderBy("bin").collect()
    total = drift_table(profile, column(now)).first()["psi"]
    assert sum(r["psi_contribution"] for r in rows) == pytest.approx(total)
    assert rows[0]["bin_lower"] is None and rows[-1]["bin_upper"] is None
    assert [r["bin_upper"] for r in rows[:-1]] == [r["bin_lower"] for r in rows[1:]]


def test_only_the_shifted_feature_alerts_and_missing_ones_are_skipped(spark):
    rng = np.random.default_rng(9)

    def frame(limit):
        rows = zip(rng.normal(40, 10, 4000), rng.normal(limit, 50000, 4000))
        return spark.createDataFrame([(float(a), float(b)) for a, b in rows], "age double, limit_bal double")

    base, now = frame(150000), frame(400000)
    both, missing = shared_features(base, now, ["age", "limit_bal", "absent"])
    assert (both, missing) == (["age", "limit_bal"], ["absent"])
    table = drift_table(fit_profile(base, both), now)
    assert {r["feature"]: r["status"] for r in table.collect()} == {"age": "stable", "limit_bal": "alert"}
    alerts = drift_alerts(table).first()
    assert alerts["alerting"] == "limit_bal" and alerts["n_alerts"] == 1


def test_status_bounds(spark):
    df = spark.createDataFrame([(v,) for v in (0.0999, 0.1, 0.2499, 0.25, float("nan"), None)], "psi double")
    found = [r[0] for r in df.select(classify(F.col("psi"))).collect()]
    assert found == ["stable", "warn", "warn", "alert", "unknown", "unknown"]
    with pytest.raises(ValueError, match="psi_warn"):
        Monitoring(psi_warn=0.3, psi_alert=0.2)


def test_groups_are_measured_apart(column, spark):
    rng = np.random.default_rng(10)
    base = rng.normal(size=2000)
    profile = fit_profile(column(base), ["x"])
    parts = {"a": rng.normal(size=500), "b": rng.normal(1, 1, 300)}
    rows = [(d, float(v)) for d, vs in parts.items() for v in vs]
    out = drift_table(profile, spark.createDataFrame(rows, "day string, x double"), ["day"]).collect()
    assert {r["day"]: r["psi"] for r in out} == {d: pytest.approx(psi(column, base, v)["psi"]) for d, v in parts.items()}


def test_counting_traffic_is_one_scan_without_an_unpivot(column):
    profile = fit_profile(column(range(100)), ["x"])
    text = count_traffic(profile, column(range(50)))._jdf.queryExecution().toString()
    physical = text[text.index("== Physical Plan ==") :]
    assert "Expand" not in physical and "Generate" not in physical and "Join" not in physical
    assert physical.count("Exchange SinglePartition") <= 1


def test_scheduled_check_without_a_log_is_empty(spark):
    features = spark.createDataFrame([("train", 1.0)], "split_name string, age double")
    log = spark.createDataFrame([], "age double, day string")
    for current in (None, log):
        out = drift_check(features, current)
        assert out.count() == 0 and set(DRIFT_SCHEMA) < set(out.columns)


def test_scheduled_check_appends_and_reads_recent_days_only(spark, tmp_path, caplog):
    features = spark.createDataFrame(
        [("train", float(k)) for k in range(100)] + [("test", 1e9)], "split_name string, age double"
    )
    log = spark.createDataFrame(
        [(1e6, "2026-01-01")] * 500 + [(float(k), "2026-01-02") for k in range(100)],
        "age double, day string",
    )
    path = str(tmp_path / "drift")
    for _ in range(2):
        recent = drift_check(features, log, since="2026-01-02", persist_to=path)
        assert recent.first()["status"] == "stable"
    assert spark.read.parquet(path).count() == 2
    with caplog.at_level("ERROR"):
        assert drift_check(features, log).first()["status"] == "alert"
    assert "drift alert: age" in caplog.text
