"""Threshold, cost, ranking and calibration operators against brute force."""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.config import SEX_LABELS, CostMatrix
from riskloom.operators import calibration as cal
from riskloom.operators import ranks
from riskloom.operators.calibration import calibration_table
from riskloom.operators.evaluate import (
    _HALF_STEP,
    baseline_costs,
    compare_models,
    confusion,
    cost_curve,
    cost_sweep,
    fairness,
    fit_threshold,
    metrics,
    next_double,
    optimal_threshold,
    ranked_scores,
    ranking_metrics,
)
from tests.conftest import graded_scores

COST = CostMatrix()


def outcomes(y, p, t):
    hit = p >= t
    return {
        "tn": int(((y == 0) & ~hit).sum()), "fp": int(((y == 0) & hit).sum()),
        "fn": int(((y == 1) & ~hit).sum()), "tp": int(((y == 1) & hit).sum()),
    }


def auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return np.mean([(a > b) + (a == b) / 2 for a, b in product(pos, neg)])


def average_precision(y, p):
    total, seen = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall = y[hit].sum() / y.sum()
        total += (recall - seen) * y[hit].mean()
        seen = recall
    return total


def test_confusion_counts(score_frame):
    y, p = graded_scores()
    row = confusion(score_frame(y, p), 0.3).first()
    assert row.asDict() == outcomes(y, p, 0.3)


def test_curve_equals_brute_force_at_every_point(score_frame):
    y, p = graded_scores()
    curve = cost_curve(ranked_scores(score_frame(y, p)), COST).collect()
    assert len(curve) == len(set(p)) + 1
    for r in curve:
        expected = outcomes(y, p, r["threshold"])
        assert {k: r[k] for k in expected} == expected
        assert r["cost"] == COST.expected_cost(**expected)


def test_tied_scores_leave_only_reachable_points(score_frame):
    y, p = np.array([0, 1, 0, 1, 1, 0, 0, 1]), np.array([0.2] * 4 + [0.8] * 4)
    curve = {r["threshold"] for r in cost_curve(ranked_scores(score_frame(y, p)), COST).collect()}
    assert curve == {math.nextafter(0.8, 1), 0.8, 0.2}


def test_optimum_is_the_minimum_and_the_highest_of_equals(score_frame):
    y, p = graded_scores()
    t = fit_threshold(score_frame(y, p), COST)
    cost = COST.expected_cost(**outcomes(y, p, t))
    assert cost == min(COST.expected_cost(**outcomes(y, p, x)) for x in {*p, 0.0, 2.0})
    flat = CostMatrix(1.0, 1.0, 1.0, 1.0)
    best = optimal_threshold(cost_curve(ranked_scores(score_frame(y, p)), flat)).first()
    assert best["threshold"] == math.nextafter(p.max(), 2)


def test_dearer_false_alarms_raise_the_threshold(score_frame):
    y, p = graded_scores(1000, 3)
    frame = score_frame(y, p)
    assert fit_threshold(frame, COST) < 0.5
    assert fit_threshold(frame, CostMatrix(false_positive=15000.0)) > fit_threshold(frame, COST)


def test_empty_scores_give_an_empty_curve_and_no_threshold(score_frame):
    empty = score_frame([], [])
    assert cost_curve(ranked_scores(empty), COST).count() == 0
    with pytest.raises(ValueError, match="without scores"):
        fit_threshold(empty, COST)


def test_baselines_and_savings(score_frame):
    y, p = graded_scores()
    frame = score_frame(y, p)
    base = baseline_costs(frame, COST).first()
    assert base["intervene_none"] == y.sum() * 16000
    assert base["intervene_all"] == y.sum() * 1500 + (1 - y).sum() * 3000
    t = fit_threshold(frame, COST)
    row = metrics(ranked_scores(frame), COST, t).first()
    assert row["savings_vs_best_baseline"] == min(base) - row["total_cost"] >= 0


def test_metric_row_against_brute_force(score_frame):
    y, p = graded_scores()
    p = np.round(p, 2)
    row = metrics(ranked_scores(score_frame(y, p)), COST, 0.3).first()
    o = outcomes(y, p, 0.3)
    assert {k: row[k] for k in o} == o
    assert row["n"] == 600 and row["positive_rate"] == pytest.approx(y.mean())
    assert row["roc_auc"] == pytest.approx(auc(y, p))
    assert row["pr_auc"] == pytest.approx(average_precision(y, p))
    assert row["brier"] == pytest.approx(((p - y) ** 2).mean())
    assert row["accuracy"] == pytest.approx((o["tp"] + o["tn"]) / 600)
    assert row["precision"] == pytest.approx(o["tp"] / (o["tp"] + o["fp"]))
    assert row["recall"] == pytest.approx(o["tp"] / (o["tp"] + o["fn"]))
    assert row["f1"] == pytest.approx(2 * o["tp"] / (2 * o["tp"] + o["fp"] + o["fn"]))
    assert row["cost_per_client"] == pytest.approx(COST.expected_cost(**o) / 600)


@pytest.mark.parametrize("gap", [0.02, 0.6])
def test_scores_that_part_the_classes_cost_only_the_interventions(score_frame, gap):
    """Nine accounts, the four defaulters all above the rest, however small the distance."""
    y = np.array([1, 0, 0, 1, 1, 0, 0, 1, 0])
    p = 0.1 + gap * y + np.arange(9) / 1000
    row = metrics(ranked_scores(score_frame(y, p)), COST, float(p[y == 1].min())).first()
    assert [row[c] for c in ("tp", "tn", "fn", "fp")] == [4, 5, 0, 0]
    assert row["pr_auc"] == row["roc_auc"] == row["f1"] == 1.0
    assert row["cost_per_client"] == pytest.approx(4 * COST.true_positive / 9)


def test_one_class_has_no_auc_and_zero_scores(score_frame):
    row = metrics(ranked_scores(score_frame([0, 0], [0.1, 0.2])), COST, 0.5).first()
    assert row["roc_auc"] is None
    assert (row["pr_auc"], row["recall"], row["precision"], row["f1"]) == (0.0, 0.0, 0.0, 0.0)


def test_unit_cost():
    assert CostMatrix(100, 10, 5, 0).expected_cost(tn=1, fp=2, fn=3, tp=4) == 340
    assert COST.boundary == pytest.approx(0.1714, abs=1e-4)


def test_fairness_covers_every_group(score_frame):
    y, p = graded_scores()
    groups = np.arange(600) % 2 + 1
    rows = fairness(score_frame(y, p, groups), 0.3, labels=SEX_LABELS).orderBy("code").collect()
    assert [r["group"] for r in rows] == ["male", "female"]
    assert sum(r["n"] for r in rows) == 600
    for r in rows:
        mine = groups == r["code"]
        assert r["roc_auc"] == pytest.approx(auc(y[mine], p[mine]))
        assert r["selection_rate"] == pytest.approx((p[mine] >= 0.3).mean())


def test_sweep_chooses_on_fit_and_measures_elsewhere(score_frame):
    fy, fp = graded_scores(500, 1)
    ty, tp = graded_scores(400, 2)
    rows = cost_sweep(
        ranked_scores(score_frame(fy, fp)), ranked_scores(score_frame(ty, tp)), COST
    ).collect()
    assert [r["fn_fp_ratio"] for r in rows] == [2, 3, 5, 8, 10, 15, 20, 30]
    for r in rows:
        cost = COST.with_ratio(r["fn_fp_ratio"])
        assert r["threshold"] == fit_threshold(score_frame(fy, fp), cost)
        o = outcomes(ty, tp, r["threshold"])
        assert r["flagged_pct"] == pytest.approx((o["tp"] + o["fp"]) / 4)
        none = ty.sum() * cost.false_negative
        everyone = ty.sum() * cost.true_positive + (1 - ty).sum() * cost.false_positive
        best = min(none, everyone)
        assert r["savings_pct"] == pytest.approx((best - cost.expected_cost(**o)) / best * 100)


def test_model_comparison_has_a_row_per_flavor(score_frame):
    y, p = graded_scores()
    frames = {"a": score_frame(y, p), "b": score_frame(y, 1 - p)}
    rows = {r["flavor"]: r for r in compare_models(frames, COST, {"a": 0.3, "b": 0.3}).collect()}
    assert rows["a"]["roc_auc"] + rows["b"]["roc_auc"] == pytest.approx(1.0)


@given(st.floats(min_value=1e-300, max_value=1e300))
@settings(max_examples=500, deadline=None)
def test_next_double_step(x):
    assert x + x * _HALF_STEP == math.nextafter(x, math.inf)


def test_next_double_column(spark):
    values = [0.0, 5e-324, 0.1, 0.25, 0.5, 1.0, 0.9999999999999999]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(next_double(df.x)).collect()]
    assert got[0] == 5e-324 and got[2:] == [math.nextafter(v, 2) for v in values[2:]]


def brute_bins(y, p, bins):
    n = len(p)
    order = sorted(range(n), key=lambda k: (p[k], k))
    out = {}
    for r, k in enumerate(order, 1):
        b = max(-(-(r - 1) * bins // (n - 1)) - 1, 0)
        out.setdefault(b, []).append((p[k], y[k]))
    return {
        b: (len(v), np.mean([x[0] for x in v]), np.mean([x[1] for x in v])) for b, v in out.items()
    }


@pytest.mark.parametrize("n, bins, digits", [(600, 5, 9), (599, 10, 2), (601, 10, 1), (7, 10, 1), (2, 3, 0)])
def test_calibration_table_matches_row_ranks(score_frame, n, bins, digits):
    y, p = graded_scores(n)
    p = np.round(p, digits)
    rows = calibration_table(score_frame(y, p), bins).collect()
    assert {r["bin"]: (r["n"], pytest.approx(r["mean_predicted"]), pytest.approx(r["observed_rate"])) for r in rows} == brute_bins(y, p, bins)
    assert sum(r["n"] for r in rows) == n


def test_calibration_with_one_score_in_half_of_the_rows_on_the_cut_path(score_frame, monkeypatch):
    y, p = graded_scores(800)
    p = np.where(np.arange(800) % 2 == 0, 0.25, p)

    def cut(df, order, sums, keys=(), **kw):
        return ranks.running_totals(df, order, sums, keys, rows_per_bucket=50, **kw)

    monkeypatch.setattr(cal, "running_totals", cut)
    rows = calibration_table(score_frame(y, p), 10).collect()
    assert {r["bin"]: (r["n"], pytest.approx(r["mean_predicted"]), pytest.approx(r["observed_rate"])) for r in rows} == brute_bins(y, p, 10)


def test_ranking_by_group_equals_ranking_each_group(score_frame):
    y, p = graded_scores()
    groups = np.arange(600) % 3
    whole = ranked_scores(score_frame(y, p, groups), ["sex"])
    for r in ranking_metrics(whole, ["sex"]).collect():
        mine = groups == r["sex"]
        assert r["pr_auc"] == pytest.approx(average_precision(y[mine], p[mine]))
