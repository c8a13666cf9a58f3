"""Cleaning: newest row per client, code folding, plausibility filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.months import BILL, PAY, PAY_STATUS

CLEAN_COLUMNS = (
    "client_id", "limit_bal", "sex", "education", "marriage", "age",
    *PAY_STATUS, *BILL, *PAY, "default_next_month", "ingested_at",
)

DOCUMENTED_EDUCATION = (1, 2, 3, 4)
DOCUMENTED_MARRIAGE = (1, 2, 3)


def plausible() -> Column:
    """A positive limit and an age of 18 to 100."""
    return (F.col("limit_bal") > 0) & F.col("age").between(18, 100)


def dedup_latest(raw: DataFrame) -> DataFrame:
    """Newest row per client; equal load times are settled by the row's own content.

    Filtering on ``row_number() == 1`` makes Spark keep one row per client on the map
    side already, so a client with very many copies does not gather in one task.
    """
    rest = [c for c in raw.columns if c not in ("client_id", "ingested_at")]
    newest = Window.partitionBy("client_id").orderBy(F.desc("ingested_at"), *rest)
    return raw.withColumn("row_rank", F.row_number().over(newest)).filter("row_rank = 1").drop(
        "row_rank"
    )


def clean_rows(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Fold undocumented codes, drop implausible rows, project. Safe on a stream.

    ``keep`` names further columns to carry along."""
    education, marriage = F.col("education"), F.col("marriage")
    return (
        df.filter(plausible())
        .withColumns(
            {
                "education": F.when(education.isin(1, 2, 3), education).otherwise(4),
                "marriage": F.when(marriage.isin(1, 2, 3), marriage).otherwise(3),
            }
        )
        .select(*CLEAN_COLUMNS, *(c for c in keep if c not in CLEAN_COLUMNS))
    )


def clean(raw: DataFrame) -> DataFrame:
    """The clean table. The filter stays above the dedup: a client whose newest row is
    implausible disappears instead of falling back on an older row."""
    return clean_rows(dedup_latest(raw))


def clean_audit(raw: DataFrame) -> DataFrame:
    """What cleaning did, as one row of counts."""
    per_client = raw.groupBy("client_id").agg(F.count("*").alias("copies"))
    duplicates = per_client.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows")
    )
    odd_education = ~F.coalesce(F.col("education").isin(*DOCUMENTED_EDUCATION), F.lit(False))
    odd_marriage = ~F.coalesce(F.col("marriage").isin(*DOCUMENTED_MARRIAGE), F.lit(False))
    dropped = ~F.coalesce(plausible(), F.lit(False))
    counted = dedup_latest(raw).agg(
        F.count("*").alias("distinct_clients"),
        F.count_if(odd_education).alias("undocumented_education"),
        F.count_if(odd_marriage).alias("undocumented_marriage"),
        F.count_if(dropped).alias("implausible_rows"),
        F.count_if(~dropped).alias("kept_rows"),
    )
    return counted.select("*", duplicates.scalar().alias("duplicate_rows"))
