"""First arrivals of a stream: each event id is let through once, whatever comes again."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.streaming.sink import write_batch

#: ``arrival`` of a row: the first with its id, one with a known id and other content, one without id.
FIRST, CONFLICT, NO_ID = "first", "conflicting_repeat", "missing_id"
REPEATS_WITHIN = timedelta(days=7)
PER_CORE = 2


@contextmanager
def state_settings(spark: SparkSession):
    """Session settings that a query with this state copies when it starts.

    The state operator needs RocksDB. Its clock is processing time, for which Spark would
    start one empty batch after another; state is swept in the batches that have data. Every
    state partition is a store and a Python worker of its own, so there are at most
    PER_CORE of them for each core, as at the first start; a restart keeps their number.
    """
    cores = spark.sparkContext.defaultParallelism
    wanted = {
        "spark.sql.shuffle.partitions": str(min(int(spark.conf.get("spark.sql.shuffle.partitions")), PER_CORE * cores)),
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def first_arrivals(
    batch: DataFrame, batch_id: int, store: str, names: Sequence[str], key: str = "event_id", within: timedelta = REPEATS_WITHIN
) -> DataFrame:
    """``names`` of the rows of one micro-batch and ``arrival``.

    One row with arrival FIRST per id, however often and in whichever batches it is delivered
    ``within`` that time of its first delivery; of different rows in one batch the smallest by
    ``names`` is first, nulls last. A repeat with the same content is dropped; one with other
    content is let through as CONFLICT, once per batch and content.

    ``store`` holds a hash of the first content per id, in a folder per batch that a retry finds
    again, so every batch is a join with the ids of earlier ones; those older than ``within`` are
    not read. Time is that of arrival, so no event is too late.
    """
    spark, now = batch.sparkSession, int(time.time() * 1000)
    rows = batch.select(*names, F.xxhash64(*names).alias("content")).distinct()
    named = rows.filter(F.col(key).isNotNull())
    schema = f"{key} {dict(batch.dtypes)[key]}, known long, at long, batch long"
    since = F.col("at") > now - int(within.total_seconds() * 1000)

    def kept(condition: Column) -> DataFrame:
        return spark.read.schema(schema).option("basePath", store).parquet(f"{store}/batch=*").filter(condition)

    order = [c for n in names for c in (F.col(n).isNull(), F.col(n))]
    new = named if batch_id == 0 else named.join(kept((F.col("batch") < batch_id) & since), key, "left_anti")
    new = new.groupBy(key).agg(F.min(F.struct(*order, "content")).getField("content").alias("known"))
    write_batch(new.withColumn("at", F.lit(now)), f"{store}/batch={batch_id}")
    mine = F.col("batch") == batch_id
    told = named.join(kept(mine | ((F.col("batch") < batch_id) & since)), key).filter(mine | (F.col("content") != F.col("known")))
    arrival = F.when(F.col("content") == F.col("known"), F.lit(FIRST)).otherwise(F.lit(CONFLICT))
    nameless = batch.filter(F.col(key).isNull()).select(*names, F.lit(NO_ID).alias("arrival"))
    return told.select(*names, arrival.alias("arrival")).unionByName(nameless)
