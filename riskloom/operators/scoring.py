"""Request validation and scoring. Row-wise parts run on batches and streams alike."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import MAX_BATCH, SplitRule
from riskloom.functions.decisions import decision, risk_band
from riskloom.functions.months import BILL, PAY, PAY_STATUS
from riskloom.operators.clean import clean_rows
from riskloom.operators.features import features
from riskloom.operators.joins import join_hot_split
from riskloom.operators.ranks import exact_quantiles
from riskloom.sources.panel import FIXTURE_SCORE

# Accepted range of each request field as (lowest, highest).
MONEY = (-1_000_000, 100_000_000)
PAYMENT = (0, 100_000_000)
STATUS = (-2, 9)
BOUNDS: dict[str, tuple[float | None, float | None]] = {
    "client_id": (0, None),
    "limit_bal": (None, 100_000_000),
    "sex": (1, 2),
    "education": (0, 6),
    "marriage": (0, 3),
    "age": (18, 100),
    **dict.fromkeys(PAY_STATUS, STATUS),
    **dict.fromkeys(BILL, MONEY),
    **dict.fromkeys(PAY, PAYMENT),
}
RECORD_FIELDS = tuple(BOUNDS)
# Raw inputs that scorers and the prediction log read beside the features.
RAW_INPUTS = ("bill_amt_1", "pay_amt_1")

Scorer = Callable[[DataFrame], DataFrame]


def _in_bounds(name: str) -> str:
    low, high = BOUNDS[name]
    tests = [f"{name} IS NOT NULL"]
    if low is not None:
        tests.append(f"{name} >= {low}")
    if high is not None:
        tests.append(f"{name} <= {high}")
    if name == "limit_bal":
        tests.append(f"{name} > 0")
    return f"({' AND '.join(tests)})"


def rejection_reasons() -> Column:
    """Names of the fields out of bounds; empty for a valid request."""
    names = ", ".join(f"if({_in_bounds(n)}, null, '{n}')" for n in BOUNDS)
    return F.expr(f"array_compact(array({names}))")


def validate_requests(requests: DataFrame) -> DataFrame:
    """Add ``reasons`` to every request."""
    return requests.withColumn("reasons", rejection_reasons())


def accepted(requests: DataFrame) -> DataFrame:
    """Requests with every field in bounds."""
    return requests.filter(" AND ".join(_in_bounds(n) for n in BOUNDS))


def quarantined(requests: DataFrame) -> DataFrame:
    """Rejected requests with their reasons."""
    return validate_requests(requests).filter(F.size("reasons") > 0)


def duplicate_ids(requests: DataFrame) -> DataFrame:
    """Clients asked for more than once within a batch."""
    return (
        requests.groupBy("batch_id", "client_id")
        .agg(F.count("*").alias("copies"))
        .filter("copies > 1")
    )


def batch_status(requests: DataFrame, max_batch: int = MAX_BATCH) -> DataFrame:
    """Size and verdict of each batch: oversized, duplicate_ids or ok.

    Counts per (batch, client) first, so a huge batch is added up from partial counts.
    A batch without rows has no row here: there is nothing to reject.
    """
    per_client = requests.groupBy("batch_id", "client_id").agg(F.count("*").alias("copies"))
    return (
        per_client.groupBy("batch_id")
        .agg(
            F.sum("copies").cast("bigint").alias("records"),
            F.count_if(F.col("copies") > 1).alias("duplicated_clients"),
        )
        .withColumn(
            "status",
            F.when(F.col("records") > max_batch, "oversized")
            .when(F.col("duplicated_clients") > 0, "duplicate_ids")
            .otherwise("ok"),
        )
    )


def keep_ok_batches(requests: DataFrame, max_batch: int = MAX_BATCH) -> DataFrame:
    """Requests of the batches that pass; one large batch is not gathered in a task."""
    bad = batch_status(requests, max_batch).filter("status <> 'ok'").select("batch_id")
    return join_hot_split(requests, bad, "batch_id", "left_anti")


def request_features(
    requests: DataFrame, rule: SplitRule | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """The training feature definition on request rows, with the label as a placeholder.

    ``keep`` names request columns (ids, times, raw inputs) that travel along.
    """
    ready = requests.withColumns(
        {
            "ingested_at": F.current_timestamp().cast("timestamp_ntz"),
            "default_next_month": F.lit(0),
        }
    )
    return features(clean_rows(ready, keep), rule, keep)


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Model inputs in training order; fails naming what is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return df.select(*names)


def fixture_scorer(features_df: DataFrame) -> DataFrame:
    """Closed-form score of the newest status and utilisation."""
    return features_df.selectExpr("*", f"{FIXTURE_SCORE} AS p")


def decide(
    scored: DataFrame, threshold: float, model_version: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Result rows: probability, decision, threshold, band and version per client."""
    t = F.lit(float(threshold))
    return scored.select(
        *keep,
        "client_id",
        F.col("p").alias("default_probability"),
        decision(F.col("p"), t).alias("decision"),
        t.alias("threshold"),
        risk_band(F.col("p"), t).alias("risk_band"),
        F.lit(model_version).alias("model_version"),
    )


def score_requests(
    requests: DataFrame,
    threshold: float,
    model_version: str,
    scorer: Scorer = fixture_scorer,
    keep: Sequence[str] = (),
    rule: SplitRule | None = None,
    features: Sequence[str] = (),
) -> DataFrame:
    """Valid requests to result rows: validate, features, score, decide. No shuffle.

    ``keep`` names request columns, ``features`` computed ones, that travel along.
    """
    inputs = tuple(dict.fromkeys((*keep, *RAW_INPUTS)))
    built = request_features(accepted(requests), rule, inputs)
    return decide(scorer(built), threshold, model_version, dict.fromkeys((*keep, *features)))


def lost_requests(requests: DataFrame, scored: DataFrame, key: str = "client_id") -> DataFrame:
    """Valid requests without a result; anything here is an error."""
    return accepted(requests).join(scored.select(key), key, "left_anti")


def check_none_lost(requests: DataFrame, scored: DataFrame, key: str = "client_id") -> None:
    """Fail when cleaning dropped a request that validation let through."""
    lost = lost_requests(requests, scored, key).count()
    if lost:
        raise ValueError(f"{lost} valid requests were dropped by a cleaning rule")


def score_counters(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Predictions and flags per group."""
    return results.groupBy(*by).agg(
        F.count("*").alias("predictions"),
        F.count_if(F.col("decision") == "flag").alias("flagged"),
    )


def probability_summary(results: DataFrame, column: str = "default_probability") -> DataFrame:
    """Mean, median, 95th percentile and maximum; percentiles are exact."""
    found = exact_quantiles(results, [column], ["0.5", "0.95"])[column]
    return results.agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.lit(found.values[0]).cast("double").alias("p50"),
        F.lit(found.values[1]).cast("double").alias("p95"),
        F.max(column).alias("max"),
    )
