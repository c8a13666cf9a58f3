"""Report tables of a training run, written side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import Settings
from riskloom.operators.evaluate import cost_sweep, ranked_scores
from riskloom.plans.train import Outcome


def report_tables(outcomes: dict[str, Outcome], settings: Settings) -> dict[str, DataFrame]:
    """Model comparison, confusion, calibration, fairness and cost sweep by name.

    The sweep chooses its thresholds on valid and measures them on test.
    """
    tables: dict[str, list[DataFrame]] = {
        "models": [], "confusion": [], "calibration": [], "fairness": [], "cost_sweep": []
    }
    for flavor, o in outcomes.items():
        tag = F.lit(flavor).alias("flavor")
        tables["models"].append(
            o.test_metrics.select(tag, F.lit(o.algorithm).alias("algorithm"), "*")
        )
        tables["confusion"].append(o.test_metrics.select(tag, "threshold", "tn", "fp", "fn", "tp"))
        tables["calibration"].append(o.calibration.select(tag, "*"))
        tables["fairness"].append(o.fairness.select(tag, "*"))
        sweep = cost_sweep(
            ranked_scores(o.valid_scores), ranked_scores(o.test_scores), settings.cost
        )
        tables["cost_sweep"].append(
            sweep.select(
                tag,
                "fn_fp_ratio",
                F.round("threshold", 4).alias("threshold"),
                F.round("flagged_pct", 1).alias("flagged_pct"),
                F.round("recall", 4).alias("recall"),
                F.round("precision", 4).alias("precision"),
                F.round("savings_pct", 1).alias("savings_pct"),
            )
        )
    out = {}
    for name, frames in tables.items():
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.unionByName(frame)
        out[name] = whole
    return out


def write_reports(tables: dict[str, DataFrame], path: str) -> None:
    """Each table as Parquet, and the model table as JSON besides."""
    for name, table in tables.items():
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")
    if "models" in tables:
        tables["models"].coalesce(1).write.mode("overwrite").json(f"{path}/metrics_json")
