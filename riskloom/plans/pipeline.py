"""One run from the raw table to registered models and their report tables."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from riskloom.config import Settings
from riskloom.operators.features import model_columns, split_frame
from riskloom.operators.prep import fit_preparation
from riskloom.plans.batch import build_features
from riskloom.plans.registry import save_model
from riskloom.plans.report import report_tables, write_reports
from riskloom.plans.train import Candidate, Outcome, train


@dataclass
class Run:
    """What a run left behind: versions by flavor, report tables by name as read back."""

    features: DataFrame
    outcomes: dict[str, Outcome]
    versions: dict[str, str]
    reports: dict[str, DataFrame]


def card(outcome: Outcome) -> dict[str, Any]:
    """What the registry keeps of a training run beside the model."""
    return {
        "algorithm": outcome.algorithm,
        "params": outcome.params,
        # NaN where one setting needed no search; JSON has no NaN.
        "cv_pr_auc": None if math.isnan(outcome.cv_pr_auc) else outcome.cv_pr_auc,
        "candidates": outcome.candidates,
        "brier_before": outcome.brier_before,
        "brier_after": outcome.brier_after,
        "split_sizes": outcome.split_sizes,
        "valid_metrics": outcome.valid_metrics.first().asDict(),
        "test_metrics": outcome.test_metrics.first().asDict(),
    }


def register(spark: SparkSession, root: str, outcome: Outcome, settings: Settings) -> str:
    """Store a trained outcome as the newest version of its flavor."""
    return save_model(
        spark, root, outcome.flavor, outcome.model, outcome.feature_names, outcome.threshold,
        settings.cost, card(outcome),
    )


def run_pipeline(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    flavors: dict[str, list[Candidate]],
    settings: Settings | None = None,
) -> Run:
    """Clean, derive, check, train each flavor, register it, and write the reports.

    Everything goes below ``root``: ``clean``, ``features`` (by split), ``models`` and
    ``reports``. The preparation is fitted once for all flavors, which train side by side: each is
    a chain of many short jobs.
    """
    s = settings or Settings()
    table = build_features(spark, raw, f"{root}/clean", f"{root}/features", s)
    columns = model_columns(table, s.model.excluded)
    whole = fit_preparation(split_frame(table, "train"), columns, s.model.nominal)
    with ThreadPoolExecutor(max(1, len(flavors))) as pool:
        # Each thread in a copy of the context, which names the owner of intermediate tables.
        begun = {
            flavor: pool.submit(copy_context().run, train, table, candidates, s, flavor, whole)
            for flavor, candidates in flavors.items()
        }
        outcomes = {flavor: done.result() for flavor, done in begun.items()}
    versions = {f: register(spark, f"{root}/models", o, s) for f, o in outcomes.items()}
    tables = report_tables(outcomes, s)
    write_reports(tables, f"{root}/reports")
    reports = {name: spark.read.parquet(f"{root}/reports/{name}") for name in tables}
    return Run(table, outcomes, versions, reports)
