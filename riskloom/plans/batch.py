"""Raw table to stored clean and feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.config import Settings
from riskloom.operators.clean import clean
from riskloom.operators.features import features
from riskloom.operators.validate import validate_features


def build_features(
    spark: SparkSession,
    raw: DataFrame,
    clean_path: str,
    features_path: str,
    settings: Settings | None = None,
    validate: bool = True,
) -> DataFrame:
    """Store both tables, check the feature table, and return it as read back.

    The feature table is partitioned by split, so that training and drift read only the
    part they need.
    """
    s = settings or Settings()
    clean(raw).write.mode("overwrite").parquet(clean_path)
    stored = spark.read.parquet(clean_path)
    features(stored, s.split).write.mode("overwrite").partitionBy("split_name").parquet(
        features_path
    )
    table = spark.read.parquet(features_path)
    if validate:
        validate_features(table, s.model.target)
    return table
