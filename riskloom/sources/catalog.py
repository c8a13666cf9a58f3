"""Table operations by catalog name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def query(spark: SparkSession, sql: str, **args) -> DataFrame:
    """Run parameterised SQL. Values bind to ``:name``, tables to ``IDENTIFIER(:name)``;
    an unbound placeholder is an error."""
    return spark.sql(sql, args=args or None)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def row_count(spark: SparkSession, name: str) -> int:
    return spark.table(name).count()


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "replace",
    path: str | None = None,
    bucket_by: tuple[int, str] | None = None,
    partition_by: Sequence[str] = (),
) -> int:
    """Replace a table or append to it; returns its row count.

    Appending creates the table when absent, and matches columns by name, so a frame in
    another column order cannot land its values in the wrong columns. ``bucket_by``
    (buckets, column) stores the table so that dedup and joins on that column need no
    shuffle. Never replace a table by a frame that reads it.
    """
    spark = df.sparkSession
    if mode not in ("replace", "append"):
        raise ValueError(f"mode must be replace or append, got {mode!r}")
    if mode == "append" and spark.catalog.tableExists(name):
        columns = spark.table(name).columns
        if set(columns) != set(df.columns):
            odd = sorted(set(columns) ^ set(df.columns))
            raise ValueError(f"columns of {name} and of the appended rows differ: {odd}")
        df.select(*columns).write.insertInto(name)
    else:
        writer = df.write.mode("overwrite")
        if path:
            writer = writer.option("path", path)
        if bucket_by:
            writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(name)
    return row_count(spark, name)


def load_raw(
    spark: SparkSession, parquet_path: str, name: str, schema, path: str | None = None
) -> int:
    """Load the landed file into the raw table from scratch, so a rerun doubles nothing."""
    return write_table(spark.read.schema(schema).parquet(parquet_path), name, path=path)
