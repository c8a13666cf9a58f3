"""Scheduled drift check: training split against the prediction log."""

from __future__ import annotations

import logging
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import Monitoring
from riskloom.operators.drift import Profile, drift_table, fit_profile, shared_features
from riskloom.operators.features import split_frame
from riskloom.operators.log import DRIFT_SCHEMA, append_drift
from riskloom.session import materialise

logger = logging.getLogger(__name__)


def fit_baseline(features: DataFrame, log: DataFrame, monitoring: Monitoring) -> Profile:
    """Profile of the tracked features that the log carries too."""
    shared, missing = shared_features(features, log, monitoring.tracked)
    if missing:
        logger.warning("tracked features missing, skipped: %s", ", ".join(missing))
    return fit_profile(split_frame(features, "train"), shared, monitoring.bins)


def drift_check(
    features: DataFrame,
    log: DataFrame | None,
    monitoring: Monitoring | None = None,
    since: str | None = None,
    persist_to: str | None = None,
) -> DataFrame:
    """Drift rows of the log since a day; empty when there is no log or nothing in it.

    ``features`` is the stored feature table. ``since`` prunes whole day partitions.
    """
    m = monitoring or Monitoring()
    spark = features.sparkSession
    ddl = ", ".join(f"{c} {t}" for c, t in DRIFT_SCHEMA.items())
    empty = spark.createDataFrame([], f"{ddl}, constant_baseline boolean")
    if log is None:
        logger.warning("no prediction log yet, drift check skipped")
        return empty
    current = log if since is None else log.filter(F.col("day") >= since)
    if current.isEmpty():
        logger.warning("prediction log is empty, drift check skipped")
        return empty
    now = datetime.now(UTC).replace(tzinfo=None).isoformat(sep=" ")
    rows = drift_table(fit_baseline(features, current, m), current, monitoring=m).select(
        F.lit(now).cast("timestamp").alias("computed_at"), "*"
    )
    # One row per feature, computed once for the table, the alert and the caller.
    result = materialise(rows)
    if persist_to:
        append_drift(result, persist_to)
    found = result.select("feature", "psi", "status").collect()
    alerting = sorted(r["feature"] for r in found if r["status"] == "alert")
    if alerting:
        logger.error("drift alert: %s", ", ".join(alerting))
    else:
        largest = max((r["psi"] for r in found if r["psi"] is not None), default=None)
        logger.info("no drift alert, largest index %s", largest)
    return result
