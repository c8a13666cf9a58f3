"""What the operators share: readers, stored tables, numbering without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.session import new_path

#: A word of a text, for Spark, DuckDB and Python alike.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a supplied table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def stored(df: DataFrame, label: str, **options: int) -> DataFrame:
    """``df`` computed once into the shared folder and read back.

    The copy outlives executors, so what follows never depends on their disks. ``options`` are
    the writer's.
    """
    path = new_path(df.sparkSession, label)
    df.write.options(**options).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_crc(column: str | Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; a null counts as an empty text."""
    value = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary"))


def word_count(column: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(column), F.lit("")), F.lit(WORD)).cast("long")


def running_start(
    df: DataFrame, group: list[str], bucket: str, order: list, amount: Column, name: str
) -> DataFrame:
    """Add ``name``: the total of ``amount`` over the rows before this one in its group.

    The rows of a group run by ``bucket``, then ``order``. Each (group, bucket) is summed in
    its own task; the buckets' totals, one short row each, give every bucket its start, so
    a group of any size is spread over as many tasks as it has buckets. ``df`` is read
    twice and should be a stored table.
    """
    keys = [*group, bucket]
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(*keys)
        .agg(F.sum(amount).alias("_total"))
        .withColumn("_start", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_start")
    )
    same = [df[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(starts, same)
        .withColumn(name, F.col("_start") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop("_start", *[f"_k{i}" for i in range(len(keys))])
    )
