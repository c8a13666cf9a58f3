"""The newest row per client, kept up to date by loads that touch only what they change.

The table is cut into slices by client (a partition column) and each slice into buckets. A load
reads and rewrites the slices of its own clients, as a new version beside the old one; then a
manifest, one small file per load, names the version in force of every slice. A reader sees a
whole load or none of it, and a load that failed or ran twice leaves no trace. Stored
rows are never shuffled: they lie in the buckets that the merge needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.clean import dedup_latest
from riskloom.session import new_path

SLICES, BUCKETS = 16, 64
KEY, TIME = "client_id", "ingested_at"


def slice_of(slices: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(slices)).cast("int")


class NewestRows:
    """A bucketed table ``name`` below ``path`` with a row per client, and its manifests.

    ``slices`` and ``buckets`` are fixed when the table is made: a load rewrites whole slices, and
    a task merges one bucket of them.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, schema, slices: int = SLICES, buckets: int = BUCKETS):
        self.spark, self.name, self.path = spark, name, path
        self.slices, self.buckets = slices, buckets
        self.empty = spark.createDataFrame([], schema)
        self.columns = self.empty.columns

    def _manifests(self) -> DataFrame | None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        return self.spark.read.schema("load int, slice int, version int").parquet(f"{self.path}/manifest")

    def versions(self) -> tuple[int, dict[int, int]]:
        """The number of the last load, and the version in force of each slice: a row per slice."""
        found = self._manifests()
        if found is None:
            return 0, {}
        rows = found.groupBy("slice").agg(F.max_by("version", "load").alias("version"), F.max("load").alias("load")).collect()
        return max(r["load"] for r in rows), {r["slice"]: r["version"] for r in rows}

    def _stored(self, versions: dict[int, int]) -> DataFrame:
        if not versions:
            return self.empty
        pairs = " OR ".join(f"(slice = {s} AND version = {v})" for s, v in sorted(versions.items()))
        return self.spark.table(self.name).filter(pairs).select(*self.columns)

    def read(self) -> DataFrame:
        """The newest row of every client."""
        return self._stored(self.versions()[1])

    def merged(self, rows: DataFrame, touched: dict[int, int]) -> DataFrame:
        """Stored rows of the ``touched`` slices and new ones, the newest per client.

        Only ``rows`` are shuffled, once, into the buckets of the table.
        """
        fresh = dedup_latest(rows.select(*self.columns).repartition(self.buckets, KEY))
        if not touched:
            return fresh
        rest = [c for c in self.columns if c not in (KEY, TIME)]
        # The order of ``dedup_latest``: latest first, missing times last, then by content.
        old, new = (F.struct(*(F.col(f"{side}.{c}").alias(c) for c in self.columns)) for side in ("old", "new"))
        told, tnew = F.col(f"old.{TIME}"), F.col(f"new.{TIME}")
        content = [F.struct(*(F.col(f"{side}.{c}") for c in rest)) for side in ("old", "new")]
        keep_old = (
            F.when(F.col(f"new.{KEY}").isNull(), True)
            .when(F.col(f"old.{KEY}").isNull(), False)
            .when(told.eqNullSafe(tnew), content[0] <= content[1])
            .otherwise(F.coalesce(told > tnew, told.isNotNull()))
        )
        joined = self._stored(touched).alias("old").join(fresh.alias("new").hint("merge"), KEY, "full_outer")
        return joined.select(F.when(keep_old, old).otherwise(new).alias("row")).select("row.*")

    def load(self, rows: DataFrame) -> int:
        """Take rows of any age, in any order; returns how many slices were rewritten.

        Rows without a client id are left out. ``rows`` should be cheap to read twice.
        """
        rows = rows.filter(F.col(KEY).isNotNull())
        slices = sorted(r["slice"] for r in rows.select(slice_of(self.slices).alias("slice")).distinct().collect())
        if not slices:
            return 0
        last, versions = self.versions()
        load = last + 1
        touched = {s: versions[s] for s in slices if s in versions}
        # A load that failed after writing may have left this version behind: it is made anew.
        if self.spark.catalog.tableExists(self.name):
            self._drop(F.col("version") == load)
        out = self.merged(rows, touched).withColumns({"slice": slice_of(self.slices), "version": F.lit(load)})
        writer = out.write.mode("append").partitionBy("slice", "version").bucketBy(self.buckets, KEY).sortBy(KEY)
        writer.option("path", f"{self.path}/rows").saveAsTable(self.name)
        entries = self.spark.createDataFrame([(load, s, load) for s in slices], "load int, slice int, version int")
        entries.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return len(slices)

    def _drop(self, which: Column) -> None:
        parts = self.spark.sql(f"SHOW PARTITIONS {self.name}").select(
            F.regexp_extract("partition", r"slice=(\d+)", 1).cast("int").alias("slice"),
            F.regexp_extract("partition", r"version=(\d+)", 1).cast("int").alias("version"),
        )
        for r in parts.filter(which).collect():  # at most a partition per slice and kept version
            where = f"slice = {r['slice']}, version = {r['version']}"
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/rows/slice={r['slice']}/version={r['version']}")
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({where})")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def sweep(self) -> None:
        """Drop the versions that no manifest entry has in force. Nobody may be reading them."""
        _, versions = self.versions()
        kept = F.lit(False)
        for s, v in versions.items():
            kept = kept | ((F.col("slice") == s) & (F.col("version") == v))
        self._drop(~kept)


def new_table(spark: SparkSession, name: str, schema, **cuts: int) -> NewestRows:
    """A table in a new folder of the shared work folder."""
    return NewestRows(spark, name, new_path(spark, "newest"), schema, **cuts)
