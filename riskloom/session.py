"""Session defaults, the shared work folder, and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_master(master: str | None) -> bool:
    """One JVM; ``local-cluster`` has executors of its own and is none."""
    return master == "local" or (master or "").startswith("local[")


def get_spark(
    app_name: str = "riskloom",
    master: str | None = None,
    initial_partitions: int = 8192,
    **conf: str,
) -> SparkSession:
    """A session with UTC, AQE and skew-join on; anything in ``conf`` wins.

    AQE merges small partitions but does not cut ordinary ones, so on a cluster shuffles
    start with ``initial_partitions``: 12 GB each at 100 TB, merged again for less data.
    """
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
    if not local_master(master):
        defaults["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall
    back on a folder of its own: on a cluster a machine-local path would vanish with
    its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not local_master(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="riskloom-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


#: Paths handed out since the innermost ``work_scope`` began.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Owns what is stored inside: the intermediate tables are deleted at the end.

    Frames read from them are void from then on, so write or collect results inside. Paths
    asked for in an inner scope, or on other threads, are not this scope's. Gives the list of paths; one taken
    off it is kept.
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Compute ``df`` once into a table in the shared folder and read it from there.

    Used where a frame feeds several jobs. The table outlives the executors, so a lost
    node costs a re-read and not the lineage behind it; later readers take only the
    columns they need, and Spark knows its true size when it picks joins. ``partition_by``
    lets later filters on those columns skip whole folders.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, "table")
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def drop_table(df: DataFrame) -> None:
    """Delete what ``materialise`` stored for ``df``, without folders by column; frames over it are void from then on."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
