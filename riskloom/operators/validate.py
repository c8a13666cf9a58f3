"""Invariants of the feature table: all problems found in one pass and reported together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskloom.config import SPLITS

# A positive rate outside these bounds is degenerate.
MIN_RATE, MAX_RATE = 0.01, 0.99


class FeatureValidationError(ValueError):
    """The feature table breaks an invariant."""


def _check(name: str, column: str, bad: str) -> str:
    return f"named_struct('check', '{name}', 'column', '{column}', 'bad_rows', cast({bad} as bigint))"


def validation_report(df: DataFrame, target: str = "default_next_month") -> DataFrame:
    """One row per check and column with the number of offending rows (0 is fine).

    A check on the whole table (empty, degenerate rate, splits) counts 1 when it fails.
    """
    aggregates = {"rows": "count(*)"}
    checks = [_check("empty_table", "*", "if(rows = 0, 1, 0)")]

    if target in df.columns:
        aggregates["odd_labels"] = f"count_if({target} NOT IN (0, 1))"
        aggregates["rate"] = f"avg(cast({target} as double))"
        healthy = f"coalesce(rate > {MIN_RATE}D AND rate < {MAX_RATE}D, false)"
        checks += [
            _check("binary_target", target, "odd_labels"),
            _check("positive_rate", target, f"if({healthy}, 0, 1)"),
        ]
    else:
        checks.append(_check("target_present", target, "1"))

    if "split_name" in df.columns:
        known = ", ".join(f"'{name}'" for name in SPLITS)
        aggregates["odd_splits"] = f"count_if(NOT coalesce(split_name IN ({known}), false))"
        for name in SPLITS:
            aggregates[f"in_{name}"] = f"count_if(split_name = '{name}')"
        missing = " + ".join(f"if(in_{name} = 0, 1, 0)" for name in SPLITS)
        checks += [
            _check("known_splits", "split_name", "odd_splits"),
            _check("all_splits", "split_name", missing),
        ]

    for k, f in enumerate(df.schema.fields):
        aggregates[f"present{k}"] = f"count({f.name})"
        checks.append(_check("all_null", f.name, f"if(present{k} = 0, rows, 0)"))
        if isinstance(f.dataType, NumericType):
            infinite = f"abs(cast({f.name} as double)) = double('Infinity')"
            aggregates[f"infinite{k}"] = f"count_if({infinite})"
            checks.append(_check("infinite", f.name, f"infinite{k}"))

    summary = df.agg(*(F.expr(f"{text} AS {name}") for name, text in aggregates.items()))
    if "client_id" in df.columns:
        # Its own shuffle; map-side counts first, so many copies of one id are no burden.
        copies = df.groupBy("client_id").agg(F.count("*").alias("copies"))
        extra = copies.agg(F.expr("coalesce(sum(copies - 1), 0) AS extra"))
        summary = summary.select("*", extra.scalar().alias("extra_ids"))
        checks.append(_check("unique_id", "client_id", "extra_ids"))
    return summary.selectExpr(f"inline(array({', '.join(checks)}))")


def validate_features(df: DataFrame, target: str = "default_next_month") -> None:
    """Raise naming every broken invariant."""
    problems = validation_report(df, target).filter("bad_rows > 0").collect()
    if any(r["check"] == "empty_table" for r in problems):
        raise FeatureValidationError("feature table is empty")
    if problems:
        lines = (f"{r['check']}({r['column']}): {r['bad_rows']}" for r in problems)
        raise FeatureValidationError("feature validation failed:\n  - " + "\n  - ".join(lines))
