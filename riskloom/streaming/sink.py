"""Folders written once per batch, and waiting for a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether an earlier write of this folder was committed."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def write_batch(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a batch's folder unless an earlier attempt finished it.

    A stream that failed after writing runs its last batch again. Leaving the finished
    folder alone keeps its files, so a stream reading them does not see the rows twice;
    a half-written one is replaced.
    """
    if is_complete(df.sparkSession, path):
        return
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


#: Take what has arrived, then stop. ``{"processingTime": "10 seconds"}`` goes on for ever.
ONCE = {"availableNow": True}


def finish(query: StreamingQuery) -> None:
    """Wait until the query has taken what had arrived; its errors are raised here."""
    query.awaitTermination()
