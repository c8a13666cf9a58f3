"""Landing of raw account snapshots: schema, row-count and checksum guards, lineage,
dated folders."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.months import MONTHS
from riskloom.sources.panel import with_lineage

# Names in the delivered file, and the row count of a full delivery.
SOURCE_NAMES = {
    "ID": "client_id",
    "LIMIT_BAL": "limit_bal",
    "SEX": "sex",
    "EDUCATION": "education",
    "MARRIAGE": "marriage",
    "AGE": "age",
    # The newest month is numbered 0 and there is no 1.
    **{f"PAY_{0 if i == 1 else i}": f"pay_status_{i}" for i in MONTHS},
    **{f"BILL_AMT{i}": f"bill_amt_{i}" for i in MONTHS},
    **{f"PAY_AMT{i}": f"pay_amt_{i}" for i in MONTHS},
    "default payment next month": "default_next_month",
}
FULL_DELIVERY = 30_000
# Bytes of a file held at a time while it is hashed.
CHECKSUM_PIECE = 8 << 20


class LandingError(ValueError):
    """A delivery that must not be landed."""


def check_columns(df: DataFrame) -> None:
    """Fail naming every expected column that is missing, before any job runs."""
    missing = sorted(set(SOURCE_NAMES) - set(df.columns))
    if missing:
        raise LandingError(f"the delivery lacks these columns: {missing}")


def check_row_count(df: DataFrame, expected: int = FULL_DELIVERY) -> None:
    """Fail when the delivery is not complete."""
    rows = df.count()
    if rows != expected:
        raise LandingError(f"the delivery holds {rows} rows instead of {expected}")


def delivery_report(df: DataFrame, expected: int = FULL_DELIVERY) -> DataFrame:
    """Missing columns, row count and verdict of a delivery, as one row."""
    missing = ",".join(sorted(set(SOURCE_NAMES) - set(df.columns)))
    return df.agg(F.count("*").alias("n")).selectExpr(
        f"'{missing}' AS missing_columns",
        "n",
        f"{expected}L AS expected",
        f"n = {expected} AND '{missing}' = '' AS complete",
    )


def land(df: DataFrame, ingested_at: str, source_uri: str) -> DataFrame:
    """Rename to the raw table's columns in fixed order and add lineage."""
    check_columns(df)
    renamed = df.select(*(F.col(f"`{a}`").alias(b) for a, b in SOURCE_NAMES.items()))
    return with_lineage(renamed, ingested_at, source_uri)


def as_delivered(raw: DataFrame) -> DataFrame:
    """Raw rows under the delivered file's names."""
    return raw.select(*(F.col(b).alias(a) for a, b in SOURCE_NAMES.items()))


def _hash_files(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        sums = []
        for path in frame["path"]:
            files, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
            total = hashlib.sha256()
            with files.open_input_stream(name) as stream:
                while piece := stream.read(CHECKSUM_PIECE):
                    total.update(piece)
            sums.append(total.hexdigest())
        yield frame.assign(file=frame["path"].str.rsplit("/", n=1).str[-1], sha256=sums)[["file", "bytes", "sha256"]]


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of each file below ``path``, of any size.

    Spark lists the files; each is then read in pieces, so memory stays constant. The digest
    of a file is sequential by its definition: one file is one task's work.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = files.select("path", F.col("length").alias("bytes"))
    return listed.mapInPandas(_hash_files, "file string, bytes long, sha256 string")


def verify_checksums(found: DataFrame, expected: dict[str, str]) -> None:
    """Fail naming the files whose content differs from the manifest, or is missing."""
    wanted = found.sparkSession.createDataFrame(
        sorted(expected.items()), "file string, wanted string"
    )
    bad = (
        F.broadcast(wanted)
        .join(found, "file", "left")
        .filter(~F.col("wanted").eqNullSafe(F.col("sha256")))
        .select("file")
        .collect()
    )
    if bad:
        raise LandingError(f"checksum mismatch: {sorted(r['file'] for r in bad)}")


def write_once(df: DataFrame, path: str, force: bool = False) -> None:
    """Write unless the output is there already; ``force`` replaces it."""
    df.write.mode("overwrite" if force else "ignore").parquet(path)


def write_dated(df: DataFrame, path: str, day: str) -> None:
    """Write one load under ``dt=<day>``; repeating a day replaces that day only."""
    df.write.mode("overwrite").parquet(f"{path}/dt={day}")


def replay(spark: SparkSession, path: str, day: str, schema) -> DataFrame:
    """The load of one day, read from its folder alone."""
    return spark.read.schema(schema).parquet(f"{path}/dt={day}")
