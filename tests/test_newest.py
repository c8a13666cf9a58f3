"""Incremental loads keep what a full dedup of all loads gives."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

import pytest

from riskloom.operators.clean import dedup_latest
from riskloom.session import materialise
from riskloom.sources.newest import NewestRows, new_table
from tests.conftest import account


def day(make, clients, when, **kw):
    return materialise(make([account(c, ingested_at=when, **kw) for c in clients]))


@pytest.fixture
def kept(spark, make):
    return new_table(spark, f"newest_{uuid.uuid4().hex}", make([]).schema, slices=5, buckets=3)


def same(a, b):
    return a.count() == b.count() and a.select(*b.columns).exceptAll(b).isEmpty()


START = datetime(2026, 1, 1)


def test_any_order_of_loads_equals_the_full_dedup(spark, make, kept):
    loads = [
        day(make, range(1, 60), START + timedelta(days=2)),
        day(make, range(40, 90), START, limit=7.0),  # older rows of some, new clients
        day(make, range(50, 70), START + timedelta(days=3), limit=9.0),
        day(make, [1, 1, 2], START + timedelta(days=2), limit=50.0),  # equal times: settled by content
        day(make, [None, 5], None),  # no time, no client
    ]
    everything = None
    for rows in [*loads, loads[2]]:  # one twice
        kept.load(rows)
        everything = rows if everything is None else everything.unionByName(rows)
        assert same(kept.read(), dedup_latest(everything.filter("client_id IS NOT NULL")))


def test_a_load_rewrites_only_the_slices_it_touches_and_shuffles_no_stored_row(spark, make, kept):
    assert kept.load(day(make, range(1, 60), START)) == 5
    few = day(make, [3], START + timedelta(days=1))
    _, before = kept.versions()
    plan = kept.merged(few, before)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    old = initial[: initial.index("Bucketed: true")].splitlines()
    depth = min(len(line) - len(line.lstrip(" :+-")) for line in old if "SortMergeJoin" in line)
    between = old[[k for k, line in enumerate(old) if "SortMergeJoin" in line][-1] :]
    assert depth and not any("Exchange" in line for line in between)
    assert initial.count("Exchange") == 1  # that of the new rows
    assert kept.load(few) == 1
    _, after = kept.versions()
    assert sum(after[s] != before[s] for s in after) == 1
    assert kept.load(few.filter("client_id < 0")) == 0


def test_a_failed_load_leaves_no_trace_and_old_versions_are_swept(spark, make, kept, monkeypatch):
    kept.load(day(make, range(1, 30), START))
    first = materialise(kept.read())
    more = day(make, range(20, 40), START + timedelta(days=1))
    real = type(spark).createDataFrame

    def fail(self, data, schema=None, *rest, **kw):
        if schema == "load int, slice int, version int":
            raise OSError("no manifest")
        return real(self, data, schema, *rest, **kw)

    monkeypatch.setattr(type(spark), "createDataFrame", fail)
    with pytest.raises(OSError):
        kept.load(more)
    monkeypatch.undo()
    assert same(kept.read(), first)
    kept.load(more)
    assert kept.read().count() == 39
    again = NewestRows(spark, kept.name, kept.path, first.schema, 5, 3)  # opened by another job
    kept.sweep()
    assert same(again.read(), dedup_latest(first.unionByName(more)))
    assert spark.sql(f"SHOW PARTITIONS {kept.name}").count() == 5
