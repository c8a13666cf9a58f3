"""Running totals and quantiles against brute force, on the short and the cut path."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ranks
from riskloom.operators.prep import stratified_folds
from riskloom.operators.ranks import exact_quantiles, running_totals


@pytest.fixture(scope="module")
def grouped(spark):
    rng = np.random.default_rng(1)
    rows = [(f"g{k % 3}", float(v), int(rng.integers(1, 9))) for k, v in enumerate(rng.normal(size=900))]
    return spark.createDataFrame(rows, "g string, v double, n long"), rows


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("rows_per_bucket", [20, 10_000])
@pytest.mark.parametrize("keys", [(), ("g",)])
def test_running_totals_match_brute_force(grouped, descending, rows_per_bucket, keys):
    df, rows = grouped
    out = running_totals(
        df, "v", ["n"], keys, descending=descending, rows_per_bucket=rows_per_bucket
    ).collect()
    assert len(out) == len(rows)
    for r in out:
        mine = [x for x in rows if not keys or x[0] == r["g"]]
        ahead = sum(n for _, v, n in mine if (v > r["v"] if descending else v < r["v"]))
        assert r["before_n"] == ahead
        assert r["total_n"] == sum(n for _, _, n in mine)


def test_cut_path_has_no_single_task_window(grouped):
    df, _ = grouped
    plan = running_totals(df, "v", ["n"], rows_per_bucket=20)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    # The only window without a range is over the totals per range.
    assert "_range" in physical
    assert "CartesianProduct" not in physical and "NestedLoopJoin" not in physical


def test_cut_points_bound_every_range(spark):
    # A very uneven spread: nearly all values within a billionth of each other.
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.random(4000) * 1e-9, rng.random(40) * 1e9])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    cuts = ranks._cut_points(df, "v", 100)
    sizes = np.diff(np.searchsorted(np.sort(values), [-np.inf, *cuts, np.inf]))
    assert sizes.max() <= 110


@pytest.mark.parametrize("n", [1, 2, 3, 10, 997])
def test_quantiles_of_short_columns(spark, n):
    rng = np.random.default_rng(n)
    a, b = rng.normal(size=n), np.round(rng.normal(size=n))
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    qs = [k / 10 for k in range(11)]
    found = exact_quantiles(df, ["a", "b"], qs)
    assert found["a"].count == n
    assert np.allclose(found["a"].values, np.quantile(a, qs), rtol=0, atol=1e-12)
    assert np.allclose(found["b"].values, np.quantile(b, qs), rtol=0, atol=1e-12)


def _long_column(n=60_000):
    rng = np.random.default_rng(5)
    smooth = rng.normal(size=n)
    # One value holds a third of the rows.
    hot = np.where(rng.random(n) < 1 / 3, 0.25, rng.random(n))
    return smooth, hot


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_quantiles_of_long_columns_use_value_ranges(spark, monkeypatch, accuracy):
    smooth, hot = _long_column()
    assert len(smooth) > ranks.RankPlan().whole_rows
    df = spark.createDataFrame(
        [(float(x), float(y)) for x, y in zip(smooth, hot)], "smooth double, hot double"
    )
    seen = []
    original = ranks._values_at

    def spy(values, wanted, ranges, sizes):
        seen.append(ranges)
        return original(values, wanted, ranges, sizes)

    monkeypatch.setattr(ranks, "_values_at", spy)
    qs = ["0", "0.1", "0.5", "0.95", "1"]
    with ranks.rank_plan(accuracy=accuracy):
        found = exact_quantiles(df, ["smooth", "hot"], qs)
    for c, data in (("smooth", smooth), ("hot", hot)):
        assert np.allclose(found[c].values, np.quantile(data, [float(q) for q in qs]), atol=1e-12)
    assert len(seen) == 1 and len(seen[0]["smooth"]) > 1


def test_a_missed_range_is_searched_again_in_full(spark, monkeypatch):
    smooth, _ = _long_column()
    df = spark.createDataFrame([(float(x),) for x in smooth], "v double")
    monkeypatch.setattr(ranks, "_likely_ranges", lambda *a: {"v": [(100.0, 200.0)]})
    assert exact_quantiles(df, ["v"], ["0.5"])["v"].values[0] == pytest.approx(
        np.median(smooth), abs=1e-12
    )


@pytest.mark.parametrize("name", ["_order", "_range", "_in", "_at", "v"])
def test_columns_may_have_any_name(spark, name):
    df = spark.range(300).selectExpr(f"cast(id * 37 % 300 AS double) AS {name}", "1L AS n", "id AS _order_", "id AS _at_n")
    out = running_totals(df, name, ["n"], rows_per_bucket=20)
    assert all(r["before_n"] == r[name] for r in out.collect()) and out.columns[:4] == df.columns


def test_folds_are_even_on_both_plans(spark):
    df = spark.range(600_000).selectExpr("id AS client_id", "cast(id % 5 = 0 AS int) AS default_next_month")
    cut = stratified_folds(df, 4, 1)
    with ranks.rank_plan(rows_per_bucket=10**9):
        whole = stratified_folds(df, 4, 1)
    sizes = {(r["default_next_month"], r["fold"]): r["count"] for r in cut.groupBy("default_next_month", "fold").count().collect()}
    assert sizes == {(y, f): n for y, n in ((0, 120_000), (1, 30_000)) for f in range(4)}
    assert cut.join(whole, ["client_id", "fold"]).count() == 600_000


def test_sampled_cut_points_still_give_exact_totals(spark):
    rng = np.random.default_rng(4)
    values = np.unique(rng.normal(size=5000))
    df = spark.createDataFrame([(float(v), 1) for v in values], "v double, n long")
    with ranks.rank_plan(sample_per_cut=5, rows_per_bucket=100):
        out = running_totals(df, "v", ["n"]).orderBy("v").collect()
    assert [r["before_n"] for r in out] == list(range(len(values)))


def test_null_and_nan_are_skipped_and_empty_is_none(spark):
    df = spark.createDataFrame(
        [(1.0, None), (float("nan"), None), (None, None), (3.0, None)], "a double, b double"
    )
    found = exact_quantiles(df, ["a", "b"], ["0.5"])
    assert found["a"] == ranks.Quantiles(2, (2.0,))
    assert found["b"] == ranks.Quantiles(0, (None,))
    assert exact_quantiles(df.filter(F.lit(False)), ["a"], ["0.5"])["a"].values == (None,)
