"""Preparation, folds, training, calibration and the registry."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.config import CostMatrix, ModelConfig, Settings
from riskloom.operators.clean import clean
from riskloom.operators.evaluate import ranked_scores, ranking_metrics
from riskloom.operators.linear import fit_penalties
from riskloom.operators.features import features, model_columns, split_frame
from riskloom.operators.prep import (
    apply_columns,
    class_weights,
    fit_levels,
    fit_preparation,
    oversample_positives,
    stratified_folds,
    with_class_weight,
)
from riskloom.operators.scoring import score_requests
from riskloom.plans import train as training
from riskloom.plans.registry import latest_version, load_model, save_model
from riskloom.plans.report import report_tables, write_reports
from riskloom.session import materialise
from tests.conftest import synthetic

SHORT = Settings(model=ModelConfig(search_draws=1, lr_max_iter=20, mlp_max_iter=10, mlp_hidden=(8,)))


@pytest.fixture(scope="module")
def raw(make):
    return materialise(make(synthetic(800)))


@pytest.fixture(scope="module")
def table(raw):
    return materialise(features(clean(raw)))


@pytest.fixture(scope="module")
def fitted(table):
    return fit_preparation(split_frame(table, "train"), model_columns(table))


def test_preparation_matches_numpy(table, fitted):
    train = split_frame(table, "train").toPandas()
    for c in ("age", "avg_utilization", "overall_payment_ratio", "months_delinquent"):
        median = np.nanmedian(train[c])
        filled = train[c].fillna(median)
        assert fitted.medians[c] == pytest.approx(median)
        assert fitted.means[c] == pytest.approx(filled.mean())
        assert fitted.deviations[c] == pytest.approx(filled.std(ddof=0))
        assert fitted.lowest[c] == np.nanmin(train[c])


def test_standardised_training_columns_have_mean_0_and_deviation_1(table, fitted):
    train = split_frame(table, "train")
    out = apply_columns(train, fitted.standardised(), ["client_id"]).toPandas()
    for c in ("age", "limit_bal", "overall_payment_ratio"):
        assert out[c].mean() == pytest.approx(0, abs=1e-9)
        assert out[c].std(ddof=0) == pytest.approx(1)


def test_one_hot_drops_the_first_level_and_unknown_is_all_zero(spark, fitted):
    assert fitted.levels == {"education": (1, 2, 3, 4), "marriage": (1, 2, 3)}
    rows = [(1, 1, 1), (2, 2, 3), (3, 77, None)]
    df = spark.createDataFrame(rows, "client_id int, education int, marriage int")
    out = [tuple(r)[1:] for r in apply_columns(df, fitted.one_hot(), ["client_id"]).orderBy("client_id").collect()]
    assert out == [(0, 0, 0, 0, 0), (1, 0, 0, 0, 1), (0, 0, 0, 0, 0)]


def test_too_many_levels_are_refused(spark):
    with pytest.raises(ValueError, match="levels"):
        fit_levels(spark.range(2000).withColumnRenamed("id", "c"), ["c"])


def test_missing_values_get_the_median_or_a_sentinel_below_the_minimum(spark, fitted):
    df = spark.createDataFrame([(1, None)], "client_id int, overall_payment_ratio double")
    name = "overall_payment_ratio"
    median = apply_columns(df, {name: fitted.imputed()[name]}, ["client_id"]).first()[name]
    low = apply_columns(df, {name: fitted.with_sentinel()[name]}, ["client_id"]).first()[name]
    assert median == fitted.medians[name] and low == fitted.lowest[name] - 1


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(100)], "client_id int, default_next_month int")
    rows = {r["label"]: r for r in class_weights(df).collect()}
    assert rows[1]["weight"] == 2.5 and rows[0]["weight"] == 0.625 and rows[1]["pos_weight"] == 4
    sums = with_class_weight(df).groupBy("default_next_month").agg(F.sum("weight")).collect()
    assert {r[1] for r in sums} == {50.0}
    copies = oversample_positives(df).groupBy("default_next_month").count().collect()
    assert {r["default_next_month"]: r["count"] for r in copies} == {0: 80, 1: 80}


def test_folds_are_stratified_stable_and_seeded(table):
    train = split_frame(table, "train")
    a, b, c = (stratified_folds(train, 4, seed).select("client_id", "fold") for seed in (1, 1, 2))
    assert a.exceptAll(b).count() == 0 and a.exceptAll(c).count() > 0
    counts = stratified_folds(train, 4, 1).groupBy("default_next_month", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in counts if r["default_next_month"] == label]
        assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_settings_are_drawn_without_repeats_and_by_seed():
    grid = [{"k": k} for k in range(50)]
    assert training.draw_settings(grid, 10, 1) == training.draw_settings(grid, 10, 1)
    assert len({g["k"] for g in training.draw_settings(grid, 10, 1)}) == 10
    assert training.draw_settings(grid[:3], 10, 1) == grid[:3]


@pytest.fixture(scope="module")
def outcome(table):
    return training.train(table, [training.logistic_candidate(SHORT)], SHORT, "linear")


def test_training_finds_signal_and_uses_each_split_for_its_job(outcome, table):
    test = outcome.test_metrics.first()
    assert test["roc_auc"] > 0.6
    assert outcome.valid_metrics.first()["savings_pct"] >= 0
    assert outcome.brier_after < outcome.brier_before
    assert outcome.split_sizes == {r[0]: r[1] for r in table.groupBy("split_name").count().collect()}
    assert outcome.calibration.agg(F.sum("n")).first()[0] == outcome.split_sizes["test"]
    assert {r["group"] for r in outcome.fairness.collect()} == {"male", "female"}


def test_isotonic_scores_rise_with_the_margin_and_mean_equals_the_rate(outcome, table):
    valid = outcome.model.transform(split_frame(table, "valid"))
    rows = valid.select(training.margin().alias("m"), F.col("calibrated").alias("p"), "default_next_month")
    pdf = rows.toPandas().sort_values("m")
    assert (pdf["p"].diff().dropna() >= -1e-12).all()
    # Pooling keeps every block's mean, so the calibrated mean is the observed rate.
    assert pdf["p"].mean() == pytest.approx(pdf["default_next_month"].mean())


def test_sigmoid_calibration_improves_brier(outcome, table):
    valid = split_frame(table, "valid")
    settings = Settings(model=ModelConfig(calibration="sigmoid"))
    base = type(outcome.model)(outcome.model.stages[:-1])
    model = training.calibrate(base, valid, settings)
    scored = training.score_frame(model, valid, settings)
    after = ranking_metrics(ranked_scores(scored)).first()["brier"]
    assert after < outcome.brier_before
    with pytest.raises(ValueError, match="calibration"):
        ModelConfig(calibration="none")


def test_winner_is_chosen_on_valid(table, monkeypatch):
    candidates = [
        training.logistic_candidate(SHORT),
        training.boosted_candidate(
            SHORT, {"step": (0.1,), "depth": (2,), "leaves": (4,), "least": (20,), "l2": (1.0,), "rounds": (3,)}
        ),
    ]
    o = training.train(table, candidates, SHORT, "trees")
    assert o.algorithm == max(o.candidates, key=o.candidates.get)
    assert set(o.candidates) == {"logistic_regression", "boosted_trees"}
    assert 0 < o.test_metrics.first()["roc_auc"] <= 1


def test_network_trains_on_repeated_positives(table):
    o = training.train(table, [training.network_candidate(SHORT)], SHORT, "network")
    assert o.test_metrics.first()["roc_auc"] > 0.55


def test_registry_keeps_versions_and_points_at_the_newest(spark, outcome, raw, table, tmp_path):
    root = str(tmp_path)
    names, cost = outcome.feature_names, CostMatrix()
    save_model(spark, root, "linear", outcome.model, names, 0.2, cost, version="1", extra={"note": "a"})
    save_model(spark, root, "linear", outcome.model, names, 0.3, cost, version="2")
    assert latest_version(spark, root, "linear") == "2"
    with pytest.raises(Exception, match="already exists"):
        save_model(spark, root, "linear", outcome.model, names, 0.9, cost, version="1")
    model, card = load_model(spark, root, "linear")
    assert (card["threshold"], card["feature_names"], card["cost_matrix"]["false_negative"]) == (
        0.3, names, 16000.0,
    )
    old, old_card = load_model(spark, root, "linear", "1")
    assert old_card["threshold"] == 0.2 and "note" in old_card["document"]
    again = training.score_frame(model, split_frame(table, "test"), SHORT)
    assert again.exceptAll(outcome.test_scores).count() == 0
    scorer = training.model_scorer(model, card["feature_names"])
    out = score_requests(raw, card["threshold"], card["version"], scorer)
    assert out.count() == raw.count()
    row = out.filter((F.col("default_probability") >= 0.3) != (F.col("decision") == "flag")).count()
    assert row == 0


def test_report_tables_are_written(spark, outcome, tmp_path):
    tables = report_tables({"linear": outcome}, SHORT)
    assert set(tables) == {"models", "confusion", "calibration", "fairness", "cost_sweep"}
    write_reports(tables, str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report/cost_sweep")).count() == 8
    assert spark.read.json(str(tmp_path / "report/metrics_json")).first()["flavor"] == "linear"


def test_search_prefers_the_better_setting(table):
    settings = Settings(model=ModelConfig(search_draws=2, cv_folds=2, lr_max_iter=5))
    found = training.search(
        training.logistic_candidate(settings),
        split_frame(table, "train"),
        model_columns(table),
        settings,
    )
    assert 0 < found.cv_pr_auc < 1 and set(found.params) == {"regParam"}


def test_penalties_are_fitted_together_to_the_optimum_of_each(spark, table, monkeypatch):
    fits = []
    fit = training.LogisticRegression.fit
    monkeypatch.setattr(training.LogisticRegression, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    settings = Settings(model=ModelConfig(search_draws=2, cv_folds=2, lr_max_iter=50))
    train = split_frame(table, "train")
    training.search(training.logistic_candidate(settings), train, model_columns(table), settings)
    assert len(fits) == 1  # the best setting on all rows; the folds need no fit of their own
    rng = np.random.default_rng(1)
    x, w = rng.normal(size=(200, 2)), rng.uniform(0.5, 2.0, 200)
    y = (rng.random(200) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    rows = spark.createDataFrame([(k % 2, float(a), float(b), [float(v) for v in c]) for k, (a, b, c) in enumerate(zip(y, w, x))], "part int, y double, w double, x array<double>")
    found = fit_penalties(rows, [[0.01, 1.0], [0.01]], 50)
    for part, penalties in enumerate([[0.01, 1.0], [0.01]]):
        for penalty, b in zip(penalties, found[part]):
            s = slice(part, None, 2)
            rest = w[s] * (1 / (1 + np.exp(-(x[s] @ b[:2] + b[2]))) - y[s])
            assert np.abs(x[s].T @ rest / w[s].sum() + penalty * b[:2]).max() < 1e-6 and abs(rest.sum()) < 1e-4
