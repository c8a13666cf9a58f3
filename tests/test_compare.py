"""Tables are compared by hashes of id buckets; what is equal is not joined."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskloom.operators import compare
from riskloom.operators.audits import skew_audit
from riskloom.session import materialise

COLUMNS = ("u", "v")


def plain_audit(a, b):
    joined = a.alias("a").join(b.alias("b"), "client_id")
    out = []
    for c in COLUMNS:
        row = joined.agg(
            F.count("*").alias("n"), F.count_if(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))).alias("d"),
            F.coalesce(F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}"))), F.lit(0.0)).alias("g"),
        ).first()
        out.append((c, row["n"], row["d"], row["g"]))
    return out


@pytest.fixture(scope="module")
def stored(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("client_id"), F.when(F.col("id") % 7 != 0, F.col("id") / 3.0).alias("u"), (F.col("id") % 11).alias("v")
    )
    return materialise(rows)


def told(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("where", ["false", "client_id = 4321", "client_id % 500 = 7", "client_id < 2500"])
def test_audit_equals_a_plain_join(stored, where):
    served = stored.withColumn("u", F.when(F.expr(where), F.coalesce("u", F.lit(0.0)) + 2.5).otherwise(F.col("u")))
    assert told(skew_audit(served, stored, COLUMNS)) == plain_audit(served, stored)


def test_missing_rows_missing_values_and_empty_tables(stored):
    fewer = stored.filter("client_id % 100 <> 3")
    assert told(skew_audit(fewer, stored, COLUMNS)) == plain_audit(fewer, stored)
    nulls = stored.withColumn("v", F.when(F.col("client_id") != 40, F.col("v")))
    assert told(skew_audit(nulls, stored, COLUMNS)) == plain_audit(nulls, stored)
    none = stored.filter("false")
    assert told(skew_audit(none, none, COLUMNS)) == [(c, 0, 0, 0.0) for c in COLUMNS]
    odd = stored.withColumn("v", F.lit(float("nan")))
    assert told(skew_audit(odd, odd, COLUMNS)) == [(c, 5000, 0, 0.0) for c in COLUMNS]


def test_only_the_bucket_that_differs_is_read_again(spark, stored):
    """1,000 stored buckets, one changed row: its bucket alone is scanned for the join."""
    bucket = compare.bucket_of("client_id", 1000)
    kept = materialise(stored.withColumn("part", bucket), ["part"])
    changed = kept.withColumn("v", F.when(F.col("client_id") == 77, F.lit(-1)).otherwise(F.col("v")))
    part = kept.filter("client_id = 77").first()["part"]
    mine, other, equal = compare.differing_rows(changed, kept, "client_id", COLUMNS, F.col("part"))
    inside = kept.filter(F.col("part") == part).count()
    assert mine.count() == other.count() == inside < 30 and equal == 5000 - inside
    for side in (mine, other):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert f"(part#" in plan and f"= {part})" in plan.split("PartitionFilters")[1].split("]")[0]
    assert told(skew_audit(changed, kept, COLUMNS, F.col("part"))) == plain_audit(changed, kept)


def test_no_row_is_joined_where_nothing_differs(stored):
    mine, other, equal = compare.differing_rows(stored, stored, "client_id", COLUMNS)
    assert (mine, other, equal) == (None, None, 5000)


def test_many_differing_buckets_are_not_listed(stored, monkeypatch):
    monkeypatch.setattr(compare, "NAMED", 3)
    served = stored.withColumn("v", F.col("v") + 1)
    assert told(skew_audit(served, stored, COLUMNS)) == plain_audit(served, stored)
