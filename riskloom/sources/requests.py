"""Scoring traffic: each event asks for a score of the account it names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.joins import join_hot_split
from riskloom.operators.scoring import RECORD_FIELDS

REQUEST_COLUMNS = ("event_id", "batch_id", "predicted_at", "client_id", "shift")


def event_requests(events: DataFrame, *keep: str) -> DataFrame:
    """Request headers from events; requests of one hour form a batch.

    ``shift`` is the percentage by which a perturbed sample moves the limit. ``keep`` names
    further columns to carry along.
    """
    return events.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH").alias("batch_id"),
        F.col("ts").alias("predicted_at"),
        F.col("user_id").alias("client_id"),
        F.col("value").alias("shift"),
        *keep,
    )


def attach_records(headers: DataFrame, latest_accounts: DataFrame) -> DataFrame:
    """Give each request the account record it asks about.

    One account may get a large share of the traffic, hence the hot-key split.
    """
    return join_hot_split(headers, latest_accounts.select(*RECORD_FIELDS), "client_id")


def shift_limits(requests: DataFrame) -> DataFrame:
    """A sample whose limits moved by ``shift`` percent."""
    return requests.withColumn("limit_bal", F.col("limit_bal") * (1.0 + F.col("shift") / 100.0))
