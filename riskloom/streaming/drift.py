"""Daily drift on a stream of logged predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.config import Monitoring
from riskloom.operators.drift import Profile, count_traffic, drift_rows
from riskloom.streaming.sink import ONCE


def drift_stream(
    log: DataFrame,
    profile: Profile,
    out: str,
    checkpoint: str,
    time: str = "predicted_at",
    monitoring: Monitoring | None = None,
    trigger: dict = ONCE,
) -> StreamingQuery:
    """Bin counts per day as running state; every batch rewrites the days it touched.

    The state is one row of counts per day, whatever the traffic, and no row is ever too
    late for its day. Update mode also reports the day still in progress. The state
    partitions are the session's shuffle partitions at the first start.
    """
    days = count_traffic(
        profile,
        log,
        [F.window(time, "1 day").alias("span")],
    ).withColumn("day", F.date_format("span.start", "yyyy-MM-dd"))

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = drift_rows(profile, batch, ["day"], monitoring)
        rows.write.mode("overwrite").parquet(f"{out}/epoch={batch_id}")

    writer = (
        days.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(**trigger).start()


def read_daily_drift(spark: SparkSession, out: str) -> DataFrame:
    """The newest figures of each day and feature."""
    newest = Window.partitionBy("day", "feature").orderBy(F.desc("epoch"))
    return (
        spark.read.parquet(out)
        .withColumn("_rank", F.row_number().over(newest))
        .filter("_rank = 1")
        .drop("_rank", "epoch")
    )
