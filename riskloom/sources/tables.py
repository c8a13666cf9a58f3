"""Typed readers for the supplied Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Column types as declared by the files; declared so that nothing is inferred.
SCHEMAS = {
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz"
    ),
    "lineitem": (
        "l_orderkey bigint, l_extendedprice double, l_discount double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table with its declared schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
