"""Comparison of two tables by hashes of id buckets; only buckets that differ are joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialise

#: Buckets of ids, and how many of them one node above sums up.
LEAVES, FAN = 65_536, 256
#: Differing buckets up to which a filter names them, so that stored buckets can be skipped.
NAMED = 1000


def bucket_of(key: str, leaves: int = LEAVES) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(leaves)).cast("int")


def leaf_hashes(df: DataFrame, key: str, columns: Sequence[str], bucket: Column) -> DataFrame:
    """One row per bucket: its rows ``n`` and two sums over hashes of its rows.

    Sums do not depend on the order of rows and add up on the map side, so a pass over the table
    shuffles a row per bucket and task. Equal values hash alike, NULL and NaN included.
    """
    row = [F.xxhash64(F.lit(seed), key, *columns) for seed in (1, 2)]
    halves = [(f"h{i}{k}", F.shiftrightunsigned(h, 32 * k).bitwiseAND(0xFFFFFFFF)) for i, h in enumerate(row) for k in (0, 1)]
    return df.groupBy(bucket.alias("leaf")).agg(F.count("*").alias("n"), *(F.sum(h).alias(name) for name, h in halves))


HASHES = ("n", "h00", "h01", "h10", "h11")


def _differ(left: DataFrame, right: DataFrame, level: Column) -> DataFrame:
    """Nodes of a level whose sums differ, or that one side lacks."""
    sums = [F.sum(c).alias(c) for c in HASHES]
    a = left.groupBy(level.alias("node")).agg(*sums)
    b = right.groupBy(level.alias("node")).agg(*sums)
    same = F.lit(True)
    for c in HASHES:
        same = same & a[c].eqNullSafe(b[c])
    return a.join(b, "node", "full_outer").filter(~same).select("node")


def differing_leaves(left: DataFrame, right: DataFrame, fan: int = FAN) -> tuple[DataFrame | None, int]:
    """Buckets (``leaf``) in which two stored tables of ``leaf_hashes`` differ, None if in none, and
    the rows of all others. The nodes above are compared first; of a table without differences
    one row a side is looked at."""
    total = left.agg(F.sum("n")).first()[0] or 0
    if _differ(left, right, F.lit(0)).isEmpty():
        return None, total
    above = F.floor(F.col("leaf") / fan)
    nodes = _differ(left, right, above)
    inside = [side.join(F.broadcast(nodes), above == F.col("node"), "left_semi") for side in (left, right)]
    leaves = materialise(_differ(*inside, F.col("leaf")).select(F.col("node").alias("leaf")))
    equal = left.join(F.broadcast(leaves), "leaf", "left_anti").agg(F.sum("n")).first()[0] or 0
    return leaves, equal


def differing_rows(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], bucket: Column | None = None
) -> tuple[DataFrame | None, DataFrame | None, int]:
    """The rows of both tables in buckets that differ (None, None if none does), and the number of rows
    in the others, which both have alike.

    ``key`` is unique in either table. ``bucket`` may name a column that both are stored by: the
    second read then skips what is equal. At most LEAVES buckets are broadcast.
    """
    bucket = bucket_of(key) if bucket is None else bucket
    trees = [materialise(leaf_hashes(df, key, columns, bucket)) for df in (left, right)]
    leaves, equal = differing_leaves(*trees)
    if leaves is None:
        return None, None, equal
    few = [r["leaf"] for r in leaves.limit(NAMED + 1).collect()]
    if len(few) <= NAMED:
        return left.filter(bucket.isin(few)), right.filter(bucket.isin(few)), equal
    named = F.broadcast(leaves)
    return *(df.join(named, bucket.eqNullSafe(F.col("leaf")), "left_semi") for df in (left, right)), equal
