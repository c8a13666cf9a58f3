"""Model versions: the fitted pipeline, its metadata, and a pointer to the newest."""

from __future__ import annotations

import json
from dataclasses import asdict
from datetime import UTC, datetime
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.config import CostMatrix

METADATA_SCHEMA = (
    "flavor string, version string, trained_at string, feature_names array<string>, "
    "n_features int, threshold double, cost_matrix map<string,double>, document string"
)
POINTER_SCHEMA = "version string, registered_at string"


def new_version() -> str:
    """UTC time stamp; sorts by age."""
    return datetime.now(UTC).strftime("%Y%m%dT%H%M%S%fZ")


def save_model(
    spark: SparkSession,
    root: str,
    flavor: str,
    model: PipelineModel,
    feature_names: list[str],
    threshold: float,
    cost: CostMatrix,
    extra: dict[str, Any] | None = None,
    version: str | None = None,
) -> str:
    """Write an immutable version, then point at it; returns the version.

    The pointer is appended last and never rewritten, so a crash in between leaves the
    previous version in force.
    """
    version = version or new_version()
    base = f"{root}/{flavor}"
    now = datetime.now(UTC).isoformat()
    # Refuses to overwrite: a version, once written, stays as it is.
    model.write().save(f"{base}/versions/{version}/model")
    document = json.dumps(extra or {}, default=str, sort_keys=True)
    row = (
        flavor, version, now, list(feature_names), len(feature_names), float(threshold),
        {k: float(v) for k, v in asdict(cost).items()}, document,
    )
    spark.createDataFrame([row], METADATA_SCHEMA).coalesce(1).write.json(
        f"{base}/versions/{version}/metadata"
    )
    spark.createDataFrame([(version, now)], POINTER_SCHEMA).coalesce(1).write.mode("append").json(
        f"{base}/latest"
    )
    return version


def latest_version(spark: SparkSession, root: str, flavor: str) -> str:
    """The version registered last."""
    pointers = spark.read.schema(POINTER_SCHEMA).json(f"{root}/{flavor}/latest")
    return pointers.agg(F.max_by("version", F.struct("registered_at", "version"))).first()[0]


def read_metadata(spark: SparkSession, root: str, flavor: str, version: str) -> DataFrame:
    """Metadata of one version as a one-row frame."""
    path = f"{root}/{flavor}/versions/{version}/metadata"
    return spark.read.schema(METADATA_SCHEMA).json(path)


def load_model(
    spark: SparkSession, root: str, flavor: str, version: str = "latest"
) -> tuple[PipelineModel, dict[str, Any]]:
    """The fitted pipeline and its metadata."""
    if version == "latest":
        version = latest_version(spark, root, flavor)
    metadata = read_metadata(spark, root, flavor, version).first().asDict(recursive=True)
    model = PipelineModel.load(f"{root}/{flavor}/versions/{version}/model")
    return model, metadata
