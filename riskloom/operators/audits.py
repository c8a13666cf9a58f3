"""Audits of splits and of features served against features stored, and the figures
that justify the cost matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.months import PAY, total
from riskloom.operators.compare import differing_rows
from riskloom.operators.ranks import exact_quantiles
from riskloom.session import materialise

# Share of a defaulted balance that is recovered.
RECOVERY = 0.20


def split_balance(features: DataFrame) -> DataFrame:
    """Rows, positives and positive rate of each split."""
    y = F.col("default_next_month")
    return features.groupBy("split_name").agg(
        F.count("*").alias("n"),
        F.sum(y).cast("bigint").alias("positives"),
        F.avg(y.cast("double")).alias("positive_rate"),
    )


def split_overlap(features: DataFrame) -> DataFrame:
    """Clients that sit in more than one split; empty when splits are disjoint."""
    return (
        features.groupBy("client_id")
        .agg(
            F.min("split_name").alias("lowest"),
            F.max("split_name").alias("highest"),
            F.count("*").alias("copies"),
        )
        .filter("lowest <> highest")
    )


def split_moves(before: DataFrame, after: DataFrame) -> DataFrame:
    """Clients whose split differs between two builds of the table."""
    left = before.select("client_id", F.col("split_name").alias("split_before"))
    right = after.select("client_id", F.col("split_name").alias("split_after"))
    return left.join(right, "client_id").filter("split_before <> split_after")


def skew_audit(
    served: DataFrame, stored: DataFrame, columns: Sequence[str], bucket: Column | None = None
) -> DataFrame:
    """Per feature: rows compared, rows that differ (NULL equals NULL), largest gap.

    Buckets of ids are compared by hashes first (``differing_rows``, also for ``bucket``); only rows
    of buckets that differ are joined.
    """
    kept = [] if bucket is None else [bucket]
    doubles = [F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)]
    sides = [df.select("client_id", *doubles, *kept) for df in (served, stored)]
    names = [f"c{k}" for k in range(len(columns))]
    mine, other, equal = differing_rows(*sides, "client_id", names, bucket)
    if mine is None:
        zero = [(c, equal, 0, 0.0) for c in columns]
        return served.sparkSession.createDataFrame(zero, "feature string, n bigint, differing bigint, max_abs_diff double")
    mine = mine.select("client_id", *(F.col(n).alias(f"a{k}") for k, n in enumerate(names)))
    other = other.select("client_id", *(F.col(n).alias(f"b{k}") for k, n in enumerate(names)))
    # Counted wide, one aggregate per column, so no row is multiplied by the features.
    aggregates = [f"count(*) + {equal} AS n"]
    for k in range(len(columns)):
        aggregates.append(f"count_if(NOT a{k} <=> b{k}) AS differ{k}")
        aggregates.append(f"coalesce(max(abs(a{k} - b{k})), 0.0D) AS gap{k}")
    rows = ", ".join(
        f"named_struct('feature', '{c}', 'n', n, 'differing', differ{k}, 'max_abs_diff', gap{k})"
        for k, c in enumerate(columns)
    )
    return mine.join(other, "client_id").agg(*map(F.expr, aggregates)).selectExpr(
        f"inline(array({rows}))"
    )


def check_no_skew(audit: DataFrame, tolerance: float = 1e-9) -> None:
    """Fail when a served feature is off by more than an absolute ``tolerance``."""
    bad = audit.filter(F.col("max_abs_diff") > tolerance).select("feature").collect()
    if bad:
        raise ValueError(f"served features differ from stored ones: {[r['feature'] for r in bad]}")


def default_rate_by_history(features: DataFrame) -> DataFrame:
    """Default rate of dormant and billed accounts."""
    y = F.col("default_next_month")
    return features.groupBy("has_billing_history").agg(
        F.count("*").alias("n"),
        F.sum(y).cast("bigint").alias("defaults"),
        F.avg(y.cast("double")).alias("default_rate"),
    )


def loss_given_default(clean: DataFrame, recovery: float = RECOVERY) -> DataFrame:
    """Median and mean balance at default, and the loss after recovery."""
    defaulted = materialise(clean.filter("default_next_month = 1").select("bill_amt_1"))
    median = exact_quantiles(defaulted, ["bill_amt_1"], ["0.5"])["bill_amt_1"].values[0]
    middle = F.lit(median).cast("double")
    return defaulted.agg(
        F.count("*").alias("defaults"),
        F.max(middle).alias("median_balance"),
        F.avg("bill_amt_1").alias("mean_balance"),
        F.max(middle * (1.0 - recovery)).alias("loss_given_default"),
    )


def payment_flow(clean: DataFrame) -> DataFrame:
    """Mean monthly payment of the accounts that did not default."""
    paid = F.expr(f"{total(PAY)} / 6.0D")
    good = clean.filter("default_next_month = 0")
    return good.agg(F.count("*").alias("n"), F.avg(paid).alias("mean_monthly_payment"))


def base_rate(features: DataFrame) -> DataFrame:
    """Rows and positive rate of the whole table."""
    y = F.col("default_next_month")
    return features.agg(
        F.count("*").alias("n"),
        F.sum(y).cast("bigint").alias("positives"),
        F.avg(y.cast("double")).alias("positive_rate"),
    )
