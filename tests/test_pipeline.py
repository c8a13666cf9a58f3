"""How a run trains its flavors; the steps themselves have tests of their own."""

from __future__ import annotations

from threading import Barrier

import pytest

from riskloom.operators.clean import clean
from riskloom.operators.features import features
from riskloom.plans import pipeline
from riskloom.plans import train as training
from riskloom.session import materialise, new_path, work_scope
from tests.conftest import synthetic


def test_flavors_share_the_preparation_and_train_side_by_side(spark, make, monkeypatch):
    table = materialise(features(materialise(clean(make(synthetic(60))))))
    fitted, both = [], Barrier(2, timeout=60)
    fit = pipeline.fit_preparation

    def train(found, candidates, settings, flavor, whole):
        both.wait()  # passes when the other flavor trains, too
        return flavor, new_path(spark, flavor), whole

    monkeypatch.setattr(pipeline, "build_features", lambda *a: table)
    monkeypatch.setattr(pipeline, "fit_preparation", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    monkeypatch.setattr(pipeline, "train", train)
    monkeypatch.setattr(pipeline, "register", lambda spark, root, outcome, s: outcome[0])
    monkeypatch.setattr(pipeline, "report_tables", lambda *a: {})
    monkeypatch.setattr(pipeline, "write_reports", lambda *a: None)
    with work_scope(spark) as made:
        run = pipeline.run_pipeline(spark, None, "unused", {"a": [], "b": []})
        assert {path for _, path, _ in run.outcomes.values()} <= set(made)  # the scope owns what threads store
    assert run.versions == {"a": "a", "b": "b"} and len(fitted) == 1
    assert all(whole is fitted[0] for _, _, whole in run.outcomes.values())


def test_a_preparation_at_hand_is_not_fitted_again(monkeypatch):
    class Found(Exception):
        pass

    class Table:
        columns = ["client_id", "age"]

    def search(candidate, part, columns, settings, whole=None):
        raise Found(whole)

    monkeypatch.setattr(training, "split_frame", lambda table, name: table)
    monkeypatch.setattr(training, "model_columns", lambda *a: ["age"])
    monkeypatch.setattr(training, "search", search)
    with pytest.raises(Found, match="at hand"):
        training.train(Table(), ["c"], training.Settings(), "f", "at hand")
