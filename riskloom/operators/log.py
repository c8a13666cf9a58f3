"""Prediction log: declared rows, day-partitioned append, and the questions asked of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Declared, so that an odd batch can never change a column's type.
LOG_SCHEMA = {
    "predicted_at": "timestamp",
    "client_id": "bigint",
    "model_version": "string",
    "default_probability": "double",
    "decision": "string",
    "risk_band": "string",
    "threshold": "double",
    "limit_bal": "double",
    "age": "int",
    "pay_status_1": "int",
    "bill_amt_1": "double",
    "pay_amt_1": "double",
}
CLUSTERING = ("model_version", "decision")
LOG_INPUTS = ("limit_bal", "age", "pay_status_1", "bill_amt_1", "pay_amt_1")

DRIFT_SCHEMA = {
    "computed_at": "timestamp",
    "feature": "string",
    "psi": "double",
    "status": "string",
    "baseline_mean": "double",
    "current_mean": "double",
    "baseline_n": "bigint",
    "current_n": "bigint",
}


def declared(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """``df`` with exactly the declared columns and types."""
    return df.select(*(F.col(c).cast(t).alias(c) for c, t in schema.items()))


def day_of(column: str | Column) -> Column:
    """Calendar day of a timestamp as text, the partition value of the sinks."""
    return F.date_format(column, "yyyy-MM-dd")


def by_day(df: DataFrame, time: str, sort: Sequence[str] = ()) -> DataFrame:
    """Rows with their ``day``, gathered per day for the write.

    ``rebalance`` lets Spark cut a busy day into tasks of even size and merge quiet
    ones, so neither one task nor thousands of small files result.
    """
    parted = df.withColumn("day", day_of(time)).hint("rebalance", "day")
    return parted.sortWithinPartitions("day", *sort)


def append_by_day(df: DataFrame, path: str, time: str, sort: Sequence[str] = ()) -> None:
    """Append to a table partitioned by the day of ``time``."""
    by_day(df, time, sort).write.mode("append").partitionBy("day").parquet(path)


def log_schema(features: Sequence[str] = ()) -> dict[str, str]:
    """The log's columns, and on request features beside the raw inputs, so that drift
    can watch them too."""
    return {**LOG_SCHEMA, **{f: "double" for f in features if f not in LOG_SCHEMA}}


def append_log(results: DataFrame, path: str, features: Sequence[str] = ()) -> None:
    """Append result rows to the prediction log, clustered by version and decision."""
    append_by_day(declared(results, log_schema(features)), path, "predicted_at", CLUSTERING)


def append_drift(drift: DataFrame, path: str) -> None:
    """Append drift rows to the drift table."""
    append_by_day(declared(drift, DRIFT_SCHEMA), path, "computed_at")


def read_log(
    spark: SparkSession, path: str, since_day: str | None = None, features: Sequence[str] = ()
) -> DataFrame:
    """The prediction log; ``since_day`` prunes whole partitions."""
    ddl = ", ".join(f"{c} {t}" for c, t in log_schema(features).items())
    log = spark.read.schema(f"{ddl}, day string").parquet(path)
    return log if since_day is None else log.filter(F.col("day") >= since_day)


def flag_rate(log: DataFrame) -> DataFrame:
    """Volume, flag rate and its change to the day before, per model version."""
    daily = log.groupBy(day_of("predicted_at").alias("day"), "model_version").agg(
        F.count("*").alias("predictions"),
        F.avg((F.col("decision") == "flag").cast("double")).alias("flag_rate"),
    )
    previous = Window.partitionBy("model_version").orderBy("day")
    return daily.withColumn(
        "change", F.col("flag_rate") - F.lag("flag_rate").over(previous)
    )


def latest_decision(log: DataFrame) -> DataFrame:
    """Last decision per client. One row per client is kept on the map side already."""
    order = Window.partitionBy("client_id").orderBy(
        F.desc("predicted_at"), "default_probability", "model_version"
    )
    return log.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def version_history(log: DataFrame) -> DataFrame:
    """Which versions decided on a client, when first and last, and how often they flagged.

    Counted, not listed, so a client with a great many decisions costs no more.
    """
    return log.groupBy("client_id", "model_version").agg(
        F.count("*").alias("decisions"),
        F.count_if(F.col("decision") == "flag").alias("flagged"),
        F.min("predicted_at").alias("first_at"),
        F.max("predicted_at").alias("last_at"),
        F.max_by("decision", F.struct("predicted_at", "default_probability")).alias(
            "last_decision"
        ),
    )


def decisions_of(log: DataFrame, client_id: int) -> DataFrame:
    """Every logged decision on one client, newest first."""
    return log.filter(F.col("client_id") == client_id).orderBy(F.desc("predicted_at"))
