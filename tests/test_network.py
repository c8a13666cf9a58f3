"""The network's loss, slopes and fit, against Spark's own learner on repeated rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskloom.operators import network
from riskloom.plans import train as training

LAYERS = [3, 4, 2]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3))
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.normal(size=200) > 0).astype(int)
    listed = [(k, Vectors.dense(a), int(b), 1 + 2 * int(b), k % 5 == 0) for k, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(listed, ["id", "features", "y", "copies", "watched"])


def test_loss_and_slopes_are_those_of_repeated_rows(rows, monkeypatch):
    monkeypatch.setattr(network, "ROWS_PACKED", 30)
    monkeypatch.setattr(network, "ROWS_AT_ONCE", 16)
    model = MultilayerPerceptronClassifier(labelCol="y", layers=LAYERS, maxIter=0, seed=1).fit(rows)
    at = model.weights.toArray()
    loss, slopes = network.evaluate(network.packed_rows(rows, "y", "copies"), LAYERS, at)
    shown = model.transform(rows.withColumn("copy", F.expr("explode(sequence(1, copies))")))
    of_label = F.element_at(vector_to_array("probability"), F.col("y").cast("int") + 1)
    assert loss == pytest.approx(shown.agg(-F.avg(F.log(of_label))).first()[0])
    got = [(np.array(r["features"]), r["y"], r["copies"]) for r in rows.collect()]
    x, y, w = (np.array(v, float) for v in zip(*got))
    for k in (0, 11, 12, 16, len(at) - 1):
        step = np.zeros(len(at))
        step[k] = 1e-5
        up, down = (network.loss_and_slopes(p, LAYERS, x, y, w) for p in (at + step, at - step))
        assert slopes[k] == pytest.approx((up[1] - down[1]) / up[0] / 2e-5, abs=1e-7)


def test_descent_finds_the_least_of_a_bent_valley():
    def look(p):
        a, b = p
        return (1 - a) ** 2 + 100 * (b - a * a) ** 2, np.array([-2 * (1 - a) - 400 * a * (b - a * a), 200 * (b - a * a)])

    assert network.descend(look, np.array([-1.2, 1.0]), 200) == pytest.approx([1, 1], abs=0.05)
    assert list(network.descend(lambda p: (0.0, p * 0), np.ones(2), 5)) == [1, 1]


def test_a_descent_goes_on_with_what_it_knew():
    def look(p):
        seen.append(p)
        return float(np.sum(scale * (p - 1) ** 2)), 2 * scale * (p - 1)

    scale, start = np.array([1.0, 10.0, 100.0, 1000.0]), np.zeros(4)
    seen = []
    whole = network.descend(look, start, 8)
    looks, seen = len(seen), []
    at = network.descent(look, start)
    network.go_on(look, at, 3)
    network.go_on(look, at, 5)
    assert list(at.point) == list(whole) and len(seen) == looks


def test_tasks_get_equal_shares_and_their_workers_stay(rows, monkeypatch):
    monkeypatch.setattr(network, "ROWS_PACKED", 5)
    monkeypatch.setattr(network, "ROWS_PER_TASK", 10)
    packed = network.packed_rows(rows.repartition(1), "y", "copies").persist()
    assert packed.rdd.getNumPartitions() == 20  # 200 rows; a multiple of the 4 cores
    held = [r["n"] for r in packed.groupBy(F.spark_partition_id()).agg(F.sum(F.length("y") / 8).alias("n")).collect()]
    assert sum(held) == 200 and max(held) == 10
    calls = []
    monkeypatch.setattr(type(packed), "first", lambda self: calls.append("first"))  # it would end the workers
    at = MultilayerPerceptronClassifier(labelCol="y", layers=LAYERS, maxIter=0, seed=1).fit(rows.limit(2)).weights.toArray()
    assert network.evaluate(packed, LAYERS, at)[0] > 0 and not calls
    packed.unpersist()


def test_positives_are_counted_and_not_repeated(rows, monkeypatch):
    fitted = []
    fit = MultilayerPerceptronClassifier.fit
    monkeypatch.setattr(MultilayerPerceptronClassifier, "fit", lambda self, df, *a: fitted.append(df.count()) or fit(self, df, *a))
    model = training.PatientNetwork(LAYERS, "y", 20, 1).fit(rows, {})
    assert max(fitted) == 2  # Spark's learner gets no rows of the table
    learnt = network.packed_rows(rows.filter("not watched"), "y", "copies")
    start = MultilayerPerceptronClassifier(labelCol="y", layers=LAYERS, maxIter=0, seed=1).fit(rows.limit(2))
    before, after = (network.evaluate(learnt, LAYERS, m.weights.toArray())[0] for m in (start, model))
    assert after < before
