"""Train, calibrate, choose a threshold and evaluate, with one job per split:
search inside train, calibrate and choose on valid, look at test once."""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from typing import Any

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import SEX_LABELS, CostMatrix, Settings
from riskloom.operators.boosting import (
    BoostedModel,
    Setting,
    binned,
    column_edges,
    grow,
    held_margins,
    with_thresholds,
)
from riskloom.operators.calibration import calibration_table
from riskloom.operators.evaluate import (
    fairness,
    fit_threshold,
    metrics,
    ranked_scores,
    ranking_metrics,
    tied_counts,
)
from riskloom.operators.features import model_columns, split_frame
from riskloom.operators.isotonic import isotonic_steps
from riskloom.operators.linear import fit_penalties, held_linear_margins
from riskloom.operators.network import descent, evaluate, go_on, packed_rows
from riskloom.operators.prep import (
    Preparation,
    fit_preparation,
    stratified_folds,
    with_class_weight,
    with_copies,
)
from riskloom.operators.scoring import Scorer, require_columns
from riskloom.session import materialise

# Searched settings of the linear and the boosted candidate.
LOG_C = (-3.0, 2.0, 20)
BOOSTED_GRID = {
    "step": (0.02, 0.05, 0.1, 0.2),
    "depth": (3, 4, 6, 8, None),
    "leaves": (15, 31, 63),
    "least": (20, 50, 100, 200),
    "l2": (0.0, 0.1, 1.0, 10.0),
    "rounds": (200, 400),
}
# Share of the training rows that boosting and the network watch in order to stop early.
WATCHED = 0.15


class AveragePrecision(Evaluator):
    """Step-wise average precision of ``rawPrediction``; larger is better."""

    def __init__(self, label: str = "default_next_month") -> None:
        super().__init__()
        self.label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(F.col(self.label).alias("y"), margin().alias("p"))
        return ranking_metrics(ranked_scores(scored)).first()["pr_auc"]

    def isLargerBetter(self) -> bool:
        return True


def margin(column: str = "rawPrediction"):
    """Decision score of the positive class."""
    return vector_to_array(F.col(column))[1]


@dataclass(frozen=True)
class Candidate:
    """A learner, how its inputs are prepared, and the settings to search."""

    name: str
    estimator: Callable[[int], Estimator]
    numeric: Callable[[Preparation], dict[str, str]]
    grid: Callable[[Estimator, int], list[dict]]
    rows: Callable[[DataFrame], DataFrame] = with_class_weight
    # Column that calibration reads: margins where there are any, else probabilities.
    score: str = "rawPrediction"


def with_watched(df: DataFrame, settings: Settings) -> DataFrame:
    """Add ``watched``: the training rows that tell a learner when to stop."""
    draw = F.pmod(F.xxhash64(F.col("client_id"), F.lit(settings.model.seed)), F.lit(1000))
    return df.withColumn("watched", draw < int(WATCHED * 1000))


def logistic_candidate(settings: Settings) -> Candidate:
    """L2 logistic regression on imputed, standardised inputs."""

    def estimator(d: int) -> Estimator:
        return LogisticRegression(
            labelCol=settings.model.target,
            weightCol="weight",
            maxIter=settings.model.lr_max_iter,
            elasticNetParam=0.0,
            standardization=False,
        )

    def grid(lr: Estimator, n: int) -> list[dict]:
        low, high, steps = LOG_C
        cs = [10 ** (low + (high - low) * k / (steps - 1)) for k in range(steps)]
        # The penalty is per row here and the weights add up to the row count.
        return ParamGridBuilder().addGrid(lr.regParam, [1.0 / (c * n) for c in cs]).build()

    return Candidate("logistic_regression", estimator, Preparation.standardised, grid)


@dataclass(frozen=True)
class HistogramBoosting:
    """Boosted trees over ``features`` (NaN: missing), weighted, stopped by the watched rows."""

    columns: int
    label: str

    def bin(self, df: DataFrame, fold: str | None = None) -> tuple[DataFrame, list[list[float]]]:
        """The binned table of prepared rows, and the edges of its columns."""
        rows = df.withColumn("_x", vector_to_array("features"))
        names = [f"x{k}" for k in range(self.columns)]
        edges = column_edges(rows.select(*(F.col("_x")[k].alias(n) for k, n in enumerate(names))), names)
        return binned(rows, "_x", edges, self.label, "weight", "watched", fold), edges

    def fit(self, df: DataFrame, params: dict[str, Any]) -> BoostedModel:
        table, edges = self.bin(df)
        grown = grow(table, [Setting(**params)], self.columns)
        return BoostedModel(trees=json.dumps(with_thresholds(grown.trees[0], edges)))

    def cross_validate(self, df: DataFrame, grid: list[dict], folds: int) -> list[float]:
        """Mean average precision of each setting over the column ``fold``.

        The rows are binned once, with edges of all of them; all settings and folds grow in step.
        """
        table, _ = self.bin(df, "fold")
        settings = [Setting(**params, held=k) for params in grid for k in range(folds)]
        grown = grow(table, settings, self.columns)
        held = held_margins(table, grown, settings)
        found = ranking_metrics(ranked_scores(held, ["model"]), ["model"]).select("model", "pr_auc").collect()
        scores = {r["model"]: r["pr_auc"] for r in found}
        return [sum(scores[folds * i + k] for k in range(folds)) / folds for i in range(len(grid))]


def boosted_candidate(settings: Settings, grid_values: dict | None = None) -> Candidate:
    """Histogram boosting with early stopping; missing values have a branch of their own."""
    values = grid_values or BOOSTED_GRID

    def estimator(d: int) -> HistogramBoosting:
        return HistogramBoosting(d, settings.model.target)

    def grid(boosting: HistogramBoosting, n: int) -> list[dict]:
        return [dict(zip(values, chosen)) for chosen in itertools.product(*values.values())]

    def rows(df: DataFrame) -> DataFrame:
        return with_watched(with_class_weight(df, settings.model.target), settings)

    return Candidate("boosted_trees", estimator, Preparation.with_missing, grid, rows)


@dataclass(frozen=True)
class PatientNetwork:
    """Feed-forward network that stops when it gets no better on the watched rows.

    It is fitted ``step`` iterations at a time, each time from where it was and with what was
    known there, until the average precision of the watched rows has not risen ``patience`` times or
    ``max_iter`` is used up; the best weights win. Rows count ``copies`` times. The weights begin and
    end in Spark's own learner, which fits nothing here; ``operators/network.py`` does.
    """

    layers: list[int]
    label: str
    max_iter: int
    seed: int
    step: int = 10
    patience: int = 3

    def fit(self, df: DataFrame, params: dict) -> MultilayerPerceptronClassificationModel:
        learner = MultilayerPerceptronClassifier(labelCol=self.label, layers=self.layers, maxIter=0, seed=self.seed)
        blank = df.sparkSession.createDataFrame(
            [(Vectors.dense([0.0] * self.layers[0]), float(k)) for k in range(self.layers[-1])], ["features", self.label]
        )
        fitting = packed_rows(df.filter("not watched"), self.label, "copies").persist()
        judging = df.filter("watched")
        look = partial(evaluate, fitting, self.layers)
        best, model = None, learner.fit(blank, params)  # the first weights, by the seed
        at = descent(look, model.weights.toArray())
        top, since = -math.inf, 0
        for _ in range(max(1, self.max_iter // self.step)):
            go_on(look, at, self.step)
            model = learner.fit(blank, {**params, learner.initialWeights: Vectors.dense(at.point)})
            shown = model.transform(judging).select(
                F.col(self.label).alias("y"), margin("probability").alias("p")
            )
            found = ranking_metrics(ranked_scores(shown)).first()
            score = (found["pr_auc"] if found else None) or 0.0
            if score > top:
                best, top, since = model, score, 0
            else:
                since += 1
            if since >= self.patience:
                break
        fitting.unpersist()
        return best


def network_candidate(settings: Settings) -> Candidate:
    """Feed-forward network. Positives count as often as would balance the classes."""

    def estimator(d: int) -> PatientNetwork:
        return PatientNetwork(
            layers=[d, *settings.model.mlp_hidden, 2],
            label=settings.model.target,
            max_iter=settings.model.mlp_max_iter,
            seed=settings.model.seed,
        )

    def rows(df: DataFrame) -> DataFrame:
        return with_watched(with_copies(df, settings.model.target), settings)

    return Candidate(
        "neural_network",
        estimator,
        Preparation.standardised,
        lambda est, n: [{}],
        rows,
        score="probability",
    )


def draw_settings(grid: list[dict], draws: int, seed: int) -> list[dict]:
    """A seeded sample of the grid without repeats; the whole grid when it is smaller."""
    return grid if len(grid) <= draws else random.Random(seed).sample(grid, draws)


@dataclass
class SearchResult:
    candidate: Candidate
    pipeline: PipelineModel
    params: dict[str, Any]
    cv_pr_auc: float
    valid_pr_auc: float = math.nan
    # Mean cross-validated score of each setting tried, and how many folds each had.
    tried: list[float] = field(default_factory=list)
    folds: int = 0


def _input_size(prep: Preparation, numeric: dict[str, str]) -> int:
    return len(prep.one_hot()) + len(numeric)


def search(
    candidate: Candidate,
    train: DataFrame,
    columns: list[str],
    settings: Settings,
    parallelism: int = 4,
    whole: Preparation | None = None,
) -> SearchResult:
    """Cross-validate a sample of settings and refit the best on all of ``train``.

    The preparation is fitted once per fold, on that fold's training rows only, and the
    fits of a fold share its cached input. Penalties of the linear candidate are fitted by Newton steps
    of all folds at once, a job a step. Boosting needs no statistics but bin edges and levels,
    which all folds share, and grows all its models in step. ``whole`` is the preparation fitted
    on all of ``train``, if there is one already.
    """
    model = settings.model
    judge = AveragePrecision(model.target)
    n = train.count()

    def prepared(fit_on: DataFrame, prep: Preparation | None = None) -> tuple[PipelineModel, Estimator, list[dict]]:
        prep = prep or fit_preparation(fit_on, columns, model.nominal)
        numeric = candidate.numeric(prep)
        learner = candidate.estimator(_input_size(prep, numeric))
        grid = draw_settings(candidate.grid(learner, n), model.search_draws, model.seed)
        return prep.stages(numeric), learner, grid

    scores: list[list[float]] = []
    means: list[float] = []
    stages, learner, grid = prepared(train, whole)
    if len(grid) > 1 and isinstance(learner, HistogramBoosting):
        folded = stratified_folds(train, model.cv_folds, model.seed, model.target)
        fitting = stages.transform(candidate.rows(materialise(folded)))
        means = learner.cross_validate(fitting, grid, model.cv_folds)
    elif len(grid) > 1 and isinstance(learner, LogisticRegression):
        folded = materialise(stratified_folds(train, model.cv_folds, model.seed, model.target))
        rows, penalties = None, []
        for k in range(model.cv_folds):
            inside = folded.filter(F.col("fold") != k)
            fold_stages, _, fold_grid = prepared(inside)
            # Weights are those of the training rows; the held rows need none.
            held = folded.filter(F.col("fold") == k).withColumn("weight", F.lit(0.0))
            part = fold_stages.transform(candidate.rows(inside).unionByName(held)).select(
                F.lit(k).alias("part"), (F.col("fold") == k).alias("held"), F.col(model.target).cast("double").alias("y"),
                F.col("weight").alias("w"), vector_to_array("features").alias("x"),
            )
            rows = part if rows is None else rows.unionByName(part)
            penalties.append([next(v for p, v in params.items() if p.name == "regParam") for params in fold_grid])
        rows = rows.persist()
        found = fit_penalties(rows.filter("not held"), penalties, model.lr_max_iter)
        held = held_linear_margins(rows.filter("held"), found)
        tried = ranking_metrics(ranked_scores(held, ["model"]), ["model"]).select("model", "pr_auc").collect()
        by_model = {r["model"]: r["pr_auc"] for r in tried}
        scores = [[by_model[k * len(grid) + i] for i in range(len(grid))] for k in range(model.cv_folds)]
        rows.unpersist()
    elif len(grid) > 1:
        folded = materialise(stratified_folds(train, model.cv_folds, model.seed, model.target))
        for k in range(model.cv_folds):
            inside = folded.filter(F.col("fold") != k)
            fold_stages, fold_learner, fold_grid = prepared(inside)
            fitting = fold_stages.transform(candidate.rows(inside)).persist()
            judging = fold_stages.transform(folded.filter(F.col("fold") == k)).persist()

            def score(params: dict) -> float:
                return judge.evaluate(fold_learner.fit(fitting, params).transform(judging))

            with ThreadPoolExecutor(parallelism) as pool:
                scores.append(list(pool.map(score, fold_grid)))
            fitting.unpersist()
            judging.unpersist()

    means = means or [sum(s) / len(s) for s in zip(*scores)]
    best = max(range(len(means)), key=lambda i: means[i]) if means else 0
    rows = candidate.rows(train)
    added = [c for c in rows.columns if c not in train.columns]
    # What learners read, and no more, is kept.
    fitting = stages.transform(rows).select(model.target, *added, "features").persist()
    fitted = learner.fit(fitting, grid[best])
    fitting.unpersist()
    return SearchResult(
        candidate=candidate,
        pipeline=PipelineModel([stages, fitted]),
        params={getattr(p, "name", p): v for p, v in grid[best].items()},
        cv_pr_auc=means[best] if means else math.nan,
        tried=means,
        folds=model.cv_folds if means else 0,
    )


def calibrate(
    model: PipelineModel, valid: DataFrame, settings: Settings, score: str = "rawPrediction"
) -> PipelineModel:
    """Append a calibration stage fitted on valid; the model itself stays frozen.

    Fitted on tied counts: as many points as there are distinct scores.
    """
    scored = model.transform(valid).select(
        F.col(settings.model.target).alias("y"), margin(score).alias("p")
    )
    counts = materialise(tied_counts(scored))
    if settings.model.calibration == "isotonic":
        return PipelineModel([*model.stages, fit_isotonic(counts, score)])
    slicer = VectorSlicer(inputCol=score, outputCol="calibration_input", indices=[1])
    return PipelineModel([*model.stages, slicer, fit_sigmoid(counts)])


def fit_isotonic(counts: DataFrame, score: str) -> IsotonicRegressionModel:
    """Monotone steps through tied counts (``p``, ``pos``, ``n``), read from ``score``.

    The steps are pooled in tasks (``isotonic_steps``); only their ends, which are the model,
    reach the driver.
    """
    ends = F.expr("if(low < high, array(low, high), array(low))")
    points = isotonic_steps(counts).select(
        F.explode(ends).alias(score),
        (F.col("pos") / F.col("n").cast("double")).alias("y"),
        (F.col("n").cast("double") / F.size(ends)).alias("w"),
    )
    return IsotonicRegression(
        featuresCol=score, labelCol="y", weightCol="w", predictionCol="calibrated", featureIndex=1
    ).fit(points)


def sigmoid_points(counts: DataFrame) -> DataFrame:
    """Tied counts as weighted labels with smoothed targets: ``p``, ``y``, ``w``."""
    totals = counts.agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")).first()
    high = (totals["pos"] + 1.0) / (totals["pos"] + 2.0)
    low = 1.0 / (totals["n"] - totals["pos"] + 2.0)
    # Smoothed targets as weights of the two labels.
    hit = f"pos * {high!r}D + (n - pos) * {low!r}D"
    both = f"named_struct('y', 1.0D, 'w', {hit}), named_struct('y', 0.0D, 'w', n - ({hit}))"
    return counts.selectExpr("p", f"inline(array({both}))")


def fit_sigmoid(counts: DataFrame) -> LogisticRegressionModel:
    """A logistic curve through tied counts."""
    assemble = VectorAssembler(inputCols=["p"], outputCol="calibration_input")
    return LogisticRegression(
        featuresCol="calibration_input", labelCol="y", weightCol="w", regParam=0.0,
        rawPredictionCol="calibrated_margin", probabilityCol="calibrated_probability",
        predictionCol="calibrated_label", tol=1e-9, maxIter=1000,
    ).fit(assemble.transform(sigmoid_points(counts)))


def probability(scored: DataFrame, uncalibrated: bool = False):
    """Probability of default in a transformed frame."""
    if uncalibrated:
        return margin("probability")
    if "calibrated" in scored.columns:
        return F.col("calibrated")
    return margin("calibrated_probability")


def score_frame(
    model: PipelineModel, df: DataFrame, settings: Settings, uncalibrated: bool = False
) -> DataFrame:
    """``client_id``, ``sex``, ``y`` and the probability ``p``."""
    scored = model.transform(df)
    return scored.select(
        "client_id",
        "sex",
        F.col(settings.model.target).alias("y"),
        probability(scored, uncalibrated).alias("p"),
    )


def model_scorer(model: PipelineModel, names: list[str]) -> Scorer:
    """The fitted pipeline as a scorer of feature rows; checks that its inputs are there."""

    def score(features: DataFrame) -> DataFrame:
        require_columns(features, names)
        scored = model.transform(features)
        return scored.select(*features.columns, probability(scored).alias("p"))

    return score


@dataclass
class Outcome:
    """Everything training decided and measured."""

    flavor: str
    algorithm: str
    model: PipelineModel
    feature_names: list[str]
    threshold: float
    params: dict[str, Any]
    cv_pr_auc: float
    candidates: dict[str, float]
    brier_before: float
    brier_after: float
    valid_metrics: DataFrame
    test_metrics: DataFrame
    calibration: DataFrame
    fairness: DataFrame
    valid_scores: DataFrame
    test_scores: DataFrame
    split_sizes: dict[str, int] = field(default_factory=dict)


def train(
    features: DataFrame,
    candidates: list[Candidate],
    settings: Settings,
    flavor: str,
    whole: Preparation | None = None,
) -> Outcome:
    """Search every candidate, keep the best on valid, calibrate, choose, evaluate.

    ``features`` is the stored feature table (or a materialised frame); ``whole`` is the preparation
    fitted on its training part, if there is one already.
    """
    cost: CostMatrix = settings.cost
    columns = model_columns(features, settings.model.excluded)
    parts = {name: split_frame(features, name) for name in ("train", "valid", "test")}
    judge = AveragePrecision(settings.model.target)

    whole = whole or fit_preparation(parts["train"], columns, settings.model.nominal)
    results = [search(c, parts["train"], columns, settings, whole=whole) for c in candidates]
    for r in results:
        r.valid_pr_auc = judge.evaluate(r.pipeline.transform(parts["valid"]))
    # On valid, not by the search score: the search has already been fitted to that one.
    best = max(results, key=lambda r: r.valid_pr_auc)

    model = calibrate(best.pipeline, parts["valid"], settings, best.candidate.score)
    before = score_frame(best.pipeline, parts["valid"], settings, uncalibrated=True)
    valid = materialise(score_frame(model, parts["valid"], settings))
    test = materialise(score_frame(model, parts["test"], settings))
    threshold = fit_threshold(valid, cost)
    ranked = {"valid": ranked_scores(valid), "test": ranked_scores(test)}
    sizes = features.groupBy("split_name").count().collect()
    return Outcome(
        flavor=flavor,
        algorithm=best.candidate.name,
        model=model,
        feature_names=columns,
        threshold=threshold,
        params=best.params,
        cv_pr_auc=best.cv_pr_auc,
        candidates={r.candidate.name: r.valid_pr_auc for r in results},
        brier_before=ranking_metrics(ranked_scores(before)).first()["brier"],
        brier_after=ranking_metrics(ranked["valid"]).first()["brier"],
        valid_metrics=metrics(ranked["valid"], cost, threshold),
        test_metrics=metrics(ranked["test"], cost, threshold),
        calibration=calibration_table(test),
        fairness=fairness(test, threshold, labels=SEX_LABELS),
        valid_scores=valid,
        test_scores=test,
        split_sizes={r["split_name"]: r["count"] for r in sizes},
    )
