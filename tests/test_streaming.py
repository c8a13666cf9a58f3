"""Streams give what the batch gives, however the events arrive."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.operators.clean import dedup_latest
from riskloom.operators.drift import drift_table, fit_profile
from riskloom.operators.log import LOG_INPUTS, day_of
from riskloom.operators.scoring import score_requests
from riskloom.session import materialise, new_path
from riskloom.sources.panel import raw_panel
from riskloom.sources.requests import attach_records, event_requests
from riskloom.sources.tables import read_table
from riskloom.streaming.arrivals import PER_CORE, first_arrivals, state_settings
from riskloom.streaming.drift import drift_stream, read_daily_drift
from riskloom.streaming.scoring import (
    event_stream,
    log_stream,
    quarantine_schema,
    read_loads,
    read_quarantine,
    read_results,
    score_stream,
)
from riskloom.streaming.sink import finish, is_complete, write_batch
from tests.conftest import SF, account

KEEP = ("event_id", "predicted_at", *LOG_INPUTS)


@pytest.fixture(scope="module")
def latest(spark):
    return materialise(dedup_latest(raw_panel(spark, SF)))


@pytest.fixture(scope="module")
def batch_results(spark, latest):
    asked = attach_records(event_requests(read_table(spark, SF, "events")), latest)
    return materialise(score_requests(asked, 0.3, "v1", keep=KEEP))


@pytest.fixture(scope="module")
def arrivals(spark, tmp_path_factory):
    """Events in three files by time; the second also repeats part of the first."""
    folder = str(tmp_path_factory.mktemp("events"))
    events = read_table(spark, SF, "events")
    cuts = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-03-01"]
    for k in range(3):
        part = events.filter((F.col("ts") >= cuts[k]) & (F.col("ts") < cuts[k + 1]))
        if k == 1:
            part = part.unionByName(events.filter("ts >= '2024-01-10' AND ts < '2024-01-11'"))
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder


@pytest.fixture(scope="module")
def scored(spark, latest, arrivals):
    out, checkpoint = new_path(spark, "scored"), new_path(spark, "checkpoint")
    for _ in range(2):  # a restart finds nothing new
        source = event_stream(spark, arrivals, files_per_trigger=1)
        finish(score_stream(source, latest, out, checkpoint, 0.3, "v1"))
    return out


def same(a, b):
    a = a.select(*sorted(b.columns))
    b = b.select(*sorted(b.columns))
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def test_stream_scores_every_event_once(spark, scored, batch_results):
    results = read_results(spark, scored).filter("status = 'scored'")
    assert results.select("batch").distinct().count() >= 3
    columns = [c for c in batch_results.columns if c != "predicted_at"]
    assert same(results.select(*columns), batch_results.select(*columns))


def test_log_stream_copies_each_result_once(spark, scored, batch_results):
    log, checkpoint = new_path(spark, "log"), new_path(spark, "checkpoint")
    for _ in range(2):
        finish(log_stream(spark, scored, log, checkpoint))
    loads = read_loads(spark, log)
    assert loads.count() == batch_results.count()
    days = loads.groupBy("day").count()
    expected = batch_results.groupBy(day_of("predicted_at").alias("day")).count()
    assert same(days, expected)


def test_a_repeated_batch_keeps_its_files_and_a_broken_one_is_replaced(spark, tmp_path):
    path = tmp_path / "batch=0"
    write_batch(spark.range(5), str(path))
    files = spark.read.parquet(str(path)).inputFiles()
    write_batch(spark.range(5), str(path))
    assert spark.read.parquet(str(path)).inputFiles() == files
    (path / "_SUCCESS").unlink()
    assert not is_complete(spark, str(path))
    write_batch(spark.range(7), str(path))
    assert spark.read.parquet(str(path)).count() == 7


def test_daily_drift_of_the_stream_equals_the_batch(spark, latest, batch_results, tmp_path):
    profile = fit_profile(latest, ["limit_bal", "age"])
    logged = batch_results.withColumn("predicted_at", F.col("predicted_at").cast("timestamp"))
    folder, out = str(tmp_path / "log"), str(tmp_path / "daily")
    checkpoint = str(tmp_path / "checkpoint")
    # Two arrivals cut through a day, so that day is rewritten by the second.
    for low, high in (("2024-01-01", "2024-01-10 12:00:00"), ("2024-01-10 12:00:00", "2024-03-01")):
        part = logged.filter((F.col("predicted_at") >= low) & (F.col("predicted_at") < high))
        part.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(logged.schema).parquet(folder)
        finish(drift_stream(stream, profile, out, checkpoint))
    daily = read_daily_drift(spark, out)
    batch = drift_table(profile, logged.withColumn("day", day_of("predicted_at")), ["day"])
    rounded = [F.round(c, 9).alias(c) if c in ("psi", "current_mean", "baseline_mean") else F.col(c) for c in batch.columns]
    assert same(daily.select(*rounded), batch.select(*rounded))


def test_no_event_is_too_late_and_none_is_scored_twice(spark, latest, batch_results, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("events", "out", "checkpoint"))
    events = read_table(spark, SF, "events")
    # Newest first, and the last arrival repeats the first one.
    for low, high in (("01-25", "02-28"), ("01-18", "01-25"), ("01-10", "01-18"), ("01-01", "01-10"), ("01-25", "02-28")):
        part = events.filter((F.col("ts") >= f"2024-{low}") & (F.col("ts") < f"2024-{high}"))
        part.coalesce(1).write.mode("append").parquet(folder)
        finish(score_stream(event_stream(spark, folder, files_per_trigger=1), latest, out, checkpoint, 0.3, "v1"))
    results = read_results(spark, out)
    assert results.count() == results.select("event_id").distinct().count() == events.count()
    results = results.filter("status = 'scored'")
    columns = [c for c in batch_results.columns if c != "predicted_at"]
    assert results.select("batch").distinct().count() >= 4
    assert same(results.select(*columns), batch_results.select(*columns))


EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event(spark, *rows):
    """Events (id, client, value) of one moment; None for the id or the client."""
    made = [(i, datetime(2024, 1, 5, 10), c, "ask", v, "") for i, c, v in rows]
    return spark.createDataFrame(made, EVENT).coalesce(1)


def test_every_event_id_has_one_answer_and_odd_ones_are_kept_apart(spark, make, tmp_path):
    bad = account(3, pays=(-5.0,) * 6, age=17)
    accounts = materialise(make([account(1), account(2), bad]))
    folder, out, checkpoint = (str(tmp_path / n) for n in ("events", "out", "checkpoint"))
    deliveries = [
        [(10, 1, 0.5), (11, 3, 0.5), (12, 99, 0.5), (13, None, 0.5), (None, 1, 0.5), (None, 1, 0.5)],
        [(10, 1, 0.5), (11, 3, 0.5), (12, 99, 0.5)],
        [(14, 2, 2.0), (14, 2, 1.0), (14, 2, 1.0), (15, 2, None)],
        [(15, 2, 0.0), (10, 2, 0.5)],
    ]
    for rows in deliveries:  # a restart between any two
        event(spark, *rows).write.mode("append").parquet(folder)
        finish(score_stream(event_stream(spark, folder), accounts, out, checkpoint, 0.3, "v1"))
    answers = {r["event_id"]: r for r in read_results(spark, out).collect()}
    assert read_results(spark, out).count() == len(answers) == 6
    assert {i: (r["status"], r["reasons"]) for i, r in answers.items()} == {
        10: ("scored", []), 14: ("scored", []), 15: ("scored", []),
        11: ("rejected", ["age", *(f"pay_amt_{i}" for i in range(1, 7))]),
        12: ("unknown_client", ["client_id"]), 13: ("unknown_client", ["client_id"]),
    }
    assert all((r["default_probability"] is None) == (r["status"] != "scored") for r in answers.values())
    held = read_quarantine(spark, f"{out}-quarantine").collect()
    told = sorted((str(r["event_id"]), r["status"], str(r["client_id"])) for r in held)
    assert told == [
        ("10", "conflicting_repeat", "2"), ("11", "rejected", "3"), ("12", "unknown_client", "99"), ("13", "unknown_client", "None"),
        ("14", "conflicting_repeat", "2"), ("15", "conflicting_repeat", "2"), ("None", "missing_id", "1"), ("None", "missing_id", "1"),
    ]
    assert [r["age"] for r in held if r["event_id"] == 11] == [17]
    written = spark.read.option("basePath", f"{out}-quarantine").parquet(f"{out}-quarantine")
    assert dict(spark.createDataFrame([], quarantine_schema()).drop("batch").dtypes) == {c: t for c, t in written.dtypes if c != "batch"}


def test_an_id_is_forgotten_after_its_time(spark, make, tmp_path):
    accounts = materialise(make([account(1)]))
    folder, out, checkpoint = (str(tmp_path / n) for n in ("events", "out", "checkpoint"))
    for _ in range(2):
        event(spark, (1, 1, 0.0)).write.mode("append").parquet(folder)
        within = timedelta(milliseconds=1)
        finish(score_stream(event_stream(spark, folder), accounts, out, checkpoint, 0.3, "v1", repeats_within=within))
    assert read_results(spark, out).count() == 2


def test_the_session_keeps_its_settings(spark):
    keys = ("spark.sql.streaming.noDataMicroBatches.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[1], "200")
    try:
        with state_settings(spark):
            assert [spark.conf.get(k) for k in keys] == ["false", str(PER_CORE * spark.sparkContext.defaultParallelism)]
        assert [spark.conf.get(k) for k in keys] == [before[0], "200"]
    finally:
        spark.conf.set(keys[1], before[1])


def test_first_arrivals_of_a_batch_are_a_join_with_stored_ids(spark, tmp_path):
    def told(batch_id, *rows):
        batch = spark.createDataFrame(list(rows), "event_id bigint, value double")
        out = first_arrivals(batch, batch_id, str(tmp_path / "first"), ["event_id", "value"])
        return sorted((str(r["event_id"]), str(r["value"]), r["arrival"]) for r in out.collect())

    first = [("1", "1.0", "first"), ("2", "1.0", "first"), ("2", "2.0", "conflicting_repeat"), ("None", "1.0", "missing_id")]
    rows = [(1, 1.0), (1, 1.0), (2, 2.0), (2, 1.0), (2, None), (None, 1.0)]
    first.append(("2", "None", "conflicting_repeat"))
    assert told(0, *rows) == sorted(first)
    # A conflict is told in every batch it comes in, a repeat never; a retry finds its own ids again.
    for _ in range(2):
        assert told(1, (1, 1.0), (2, 2.0), (2, 2.0), (3, None)) == [("2", "2.0", "conflicting_repeat"), ("3", "None", "first")]
    assert told(2, (3, None), (3, 0.0)) == [("3", "0.0", "conflicting_repeat")]
