"""The join that keeps large keys apart gives what a plain join gives."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskloom.operators.joins import join_hot_split, large_keys
from riskloom.session import materialise

#: 600 rows of key 1, 300 of key 2, 60 of key 3, five of each of ten more, and some without a key.
COUNTS = {1: 600, 2: 300, 3: 60, **{k: 5 for k in range(10, 20)}, None: 40}
BOUNDS = {"rows_per_task": 50, "most": 2, "most_salted": 1000}


@pytest.fixture(scope="module")
def sides(spark):
    rows = [(k, i) for k, n in COUNTS.items() for i in range(n)]
    big = materialise(spark.createDataFrame(rows, "k long, i long"))
    return big, materialise(spark.createDataFrame([(k, f"partner {k}") for k in (1, 2, 3, 10, 11, 99)], "k long, name string"))


def test_large_keys_are_hot_or_salted(sides):
    hot, salted = large_keys(sides[0], "k", 50, 2, 1000)
    assert [r["k"] for r in hot.collect()] == [1]
    assert {r["k"]: r["pieces"] for r in salted.collect()} == {2: 6, 3: 2}
    # However many rows there are, at most ``most_salted`` keys are salted.
    assert large_keys(sides[0], "k", 50, 2, 10)[1].collect() == [large_keys(sides[0], "k", 50, 2, 10)[1].first()]
    assert large_keys(sides[0], "k", 1000, 2, 1000) == (None, None)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("bounds", [BOUNDS, {**BOUNDS, "most": 1}, {"rows_per_task": 10_000}])
def test_rows_equal_a_plain_join(sides, how, bounds):
    big, unique = sides
    got, want = join_hot_split(big, unique, "k", how, **bounds), big.join(unique, "k", how)
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).isEmpty()


def test_a_salted_key_is_spread_over_tasks(spark, sides):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(before, ("false", "64", "-1")):
        spark.conf.set(k, v)
    try:
        tasks = {}
        for name, bounds in (("plain", {"rows_per_task": 10_000}), ("salted", {**BOUNDS, "most": 1})):
            joined = join_hot_split(*sides, "k", **bounds).filter("k = 2")
            tasks[name] = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(tasks["plain"]) == 1 and tasks["plain"] == [300]
    assert len(tasks["salted"]) >= 4 and max(tasks["salted"]) < 150 and sum(tasks["salted"]) == 300
