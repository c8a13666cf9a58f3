"""Requests, decisions, the log, and joins that meet a hot key."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskloom.functions.decisions import decision, risk_band
from riskloom.operators import log
from riskloom.operators.audits import check_no_skew, skew_audit
from riskloom.operators.clean import clean
from riskloom.operators.features import features, model_columns
from riskloom.operators.joins import hot_keys, join_hot_split
from riskloom.operators.scoring import (
    accepted,
    batch_status,
    check_none_lost,
    duplicate_ids,
    keep_ok_batches,
    probability_summary,
    quarantined,
    request_features,
    require_columns,
    score_counters,
    score_requests,
)
from riskloom.sources.requests import shift_limits
from tests.conftest import account, synthetic

EXAMPLE = dict(
    client_id=77, limit=90000, statuses=(2, 1, 0, 0, -1, 0),
    bills=(45000, 44000, 30000, 20000, 10000, 500), pays=(1500, 15000, 11000, 10500, 9700, 500), age=41,
)


def test_valid_request_gets_one_result(make):
    row = score_requests(make([account(**EXAMPLE)]), 0.3, "v1").collect()
    assert len(row) == 1 and row[0]["decision"] == "flag" and row[0]["model_version"] == "v1"
    assert 0 <= row[0]["default_probability"] <= 1


@pytest.mark.parametrize(
    "change, field",
    [
        ({"age": 17}, "age"),
        ({"age": 101}, "age"),
        ({"limit": 0}, "limit_bal"),
        ({"statuses": (0, 0, -3, 0, 0, 0)}, "pay_status_3"),
        ({"statuses": (0, 0, 0, 0, 0, 10)}, "pay_status_6"),
        ({"education": 7}, "education"),
        ({"marriage": None}, "marriage"),
        ({"sex": 0}, "sex"),
        ({"client_id": -1}, "client_id"),
        ({"pays": (0, 0, 0, -0.01, 0, 0)}, "pay_amt_4"),
        ({"bills": (0, 2e9, 0, 0, 0, 0)}, "bill_amt_2"),
    ],
)
def test_out_of_bounds_requests_are_quarantined_with_the_reason(make, change, field):
    frame = make([account(**{**EXAMPLE, **change})])
    assert accepted(frame).count() == 0
    assert quarantined(frame).first()["reasons"] == [field]


def test_negative_bill_is_accepted(make):
    frame = make([account(**{**EXAMPLE, "bills": (-500, 0, 0, 0, 0, 0)})])
    assert accepted(frame).count() == 1 and quarantined(frame).count() == 0


@pytest.mark.parametrize("change", [{"age": 18}, {"age": 100}, {"limit": 0.01}, {"statuses": (-2, 9, 0, 0, 0, 0)}, {"client_id": 0}])
def test_values_on_the_bounds_are_accepted(make, change):
    assert accepted(make([account(**{**EXAMPLE, **change})])).count() == 1


def test_scores_rise_with_each_month_of_delay(make):
    rows = [account(k, 60000, (k,) * 6, (30000,) * 6, (1000,) * 6) for k in range(5)]
    out = {r["client_id"]: r["default_probability"] for r in score_requests(make(rows), 0.3, "v").collect()}
    assert sorted(out, key=out.get) == list(range(5))


def test_bands_and_decisions_at_their_bounds(spark):
    df = spark.createDataFrame([(v,) for v in (0.09, 0.1, 0.19, 0.2, 0.39, 0.4)], "p double")
    t = F.lit(0.2)
    rows = df.select(risk_band(F.col("p"), t), decision(F.col("p"), t)).collect()
    assert [r[0] for r in rows] == ["low", "medium", "medium", "medium", "medium", "high"]
    assert [r[1] for r in rows] == ["no_flag"] * 3 + ["flag"] * 3


def batches(spark):
    rows = [("a", 1), ("a", 2), ("b", 1), ("b", 1), *(("c", k) for k in range(6))]
    return spark.createDataFrame(rows, "batch_id string, client_id bigint")


def test_batches_with_repeated_ids_or_too_many_records_are_refused(spark):
    frame = batches(spark)
    status = {r["batch_id"]: r["status"] for r in batch_status(frame, 5).collect()}
    assert status == {"a": "ok", "b": "duplicate_ids", "c": "oversized"}
    assert [tuple(r) for r in duplicate_ids(frame).collect()] == [("b", 1, 2)]
    kept = keep_ok_batches(frame, 5)
    assert {r["batch_id"] for r in kept.collect()} == {"a"} and kept.count() == 2


def test_a_dropped_request_is_an_error(make):
    frame = make([account(1), account(2)])
    scored = score_requests(frame, 0.3, "v")
    check_none_lost(frame, scored)
    with pytest.raises(ValueError, match="1 valid requests"):
        check_none_lost(frame, scored.filter("client_id = 1"))


def test_missing_model_inputs_are_named(spark):
    with pytest.raises(ValueError, match="missing: \\['b'\\]"):
        require_columns(spark.range(1).withColumnRenamed("id", "a"), ["a", "b"])


def test_served_features_equal_stored_ones_and_skew_is_found(make):
    raw = make(synthetic(100))
    stored = features(clean(raw))
    served = request_features(raw)
    columns = model_columns(stored)
    audit = skew_audit(served, stored, columns)
    rows = audit.collect()
    assert len(rows) == 32
    assert all(r["n"] == 100 and r["differing"] == 0 and r["max_abs_diff"] == 0 for r in rows)
    check_no_skew(audit)
    off = skew_audit(served.withColumn("age", F.col("age") + 1), stored, columns)
    with pytest.raises(ValueError, match="age"):
        check_no_skew(off)


def test_summary_and_counters(spark):
    rows = [(k / 100, "flag" if k >= 50 else "no_flag", "v") for k in range(100)]
    frame = spark.createDataFrame(rows, "default_probability double, decision string, model_version string")
    s = probability_summary(frame).first()
    assert (s["n"], s["max"]) == (100, 0.99)
    assert (s["mean"], s["p50"], s["p95"]) == (
        pytest.approx(0.495), pytest.approx(0.495), pytest.approx(0.9405),
    )
    c = score_counters(frame, ["model_version"]).first()
    assert (c["predictions"], c["flagged"]) == (100, 50)


# ---- joins ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    rows = [(k, 7 if k % 3 == 0 else k) for k in range(3000)] + [(3000, None), (3001, -5)]
    return spark.createDataFrame(rows, "id bigint, k bigint")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_split_join_equals_a_plain_join(spark, skewed, how):
    unique = spark.range(0, 2000).selectExpr("id AS k", "id * 2 AS twice")
    assert [r["k"] for r in hot_keys(skewed, "k", rows_per_task=100).collect()] == [7]
    mine = join_hot_split(skewed, unique, "k", how, rows_per_task=100)
    plain = skewed.join(unique, "k", how)
    assert mine.count() == plain.count()
    assert mine.exceptAll(plain.select(*mine.columns)).count() == 0


def test_hot_keys_have_a_bound(spark, skewed):
    # Ten keys of 300 rows: over the rows of a task, yet each only 1/10 of the table.
    even = spark.range(3000).selectExpr("id", "id % 10 AS k")
    assert hot_keys(even, "k", rows_per_task=299).count() == 10
    assert hot_keys(even, "k", rows_per_task=300) is None
    assert hot_keys(even, "k", rows_per_task=1, most=10) is None
    assert hot_keys(skewed, "k") is None
    with pytest.raises(ValueError, match="unsupported"):
        join_hot_split(skewed, skewed, "k", "full")


def test_a_key_with_a_three_hundredth_of_the_rows_is_spread(spark):
    big = spark.range(0, 30000, 1, 6).selectExpr("id", "if(id % 300 = 0, -1, id) AS k")
    unique = spark.createDataFrame([(-1, "hot"), (1, "one")], "k bigint, name string")
    # Few rows are broadcast anyway; the split must do it where they would be shuffled.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = join_hot_split(big, unique, "k", rows_per_task=50)
        tasks = met.where("k = -1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in tasks) == 100 and len(tasks) == 6


# ---- log -----------------------------------------------------------------------------


def logged(spark):
    rows = []
    for k in range(60):
        when = datetime(2026, 1, 1 + k % 3, 12, k % 60)
        rows.append((when, k % 5, f"v{k % 2}", k / 60, "flag" if k % 4 == 0 else "no_flag"))
    frame = spark.createDataFrame(
        rows,
        "predicted_at timestamp, client_id bigint, model_version string, "
        "default_probability double, decision string",
    )
    return frame.selectExpr(
        "*", "'low' AS risk_band", "0.5D AS threshold", "1.0D AS limit_bal", "30 AS age",
        "0 AS pay_status_1", "0.0D AS bill_amt_1", "0.0D AS pay_amt_1",
    )


def test_log_appends_by_day_and_prunes(spark, tmp_path):
    path = str(tmp_path / "log")
    frame = logged(spark)
    log.append_log(frame.drop("age").withColumn("age", F.lit(30)), path)  # any column order
    log.append_log(frame, path)
    stored = log.read_log(spark, path)
    assert stored.count() == 120
    assert {r["day"] for r in stored.select("day").distinct().collect()} == {
        "2026-01-01", "2026-01-02", "2026-01-03",
    }
    recent = log.read_log(spark, path, since_day="2026-01-03")
    assert recent.count() == 40
    plan = recent._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_flag_rate_changes_from_day_to_day(spark):
    rows = log.flag_rate(logged(spark)).orderBy("model_version", "day").collect()
    assert len(rows) == 6
    assert rows[0]["change"] is None
    assert rows[1]["change"] == pytest.approx(rows[1]["flag_rate"] - rows[0]["flag_rate"])


def test_latest_decision_and_history(spark):
    frame = logged(spark)
    latest = {r["client_id"]: r["predicted_at"] for r in log.latest_decision(frame).collect()}
    every = frame.collect()
    for client in range(5):
        mine = [r for r in every if r["client_id"] == client]
        assert latest[client] == max(r["predicted_at"] for r in mine)
        assert log.decisions_of(frame, client).count() == len(mine)
    history = log.version_history(frame).collect()
    assert sum(r["decisions"] for r in history) == 60
    for r in history:
        mine = [x for x in every if (x["client_id"], x["model_version"]) == (r["client_id"], r["model_version"])]
        assert (r["first_at"], r["last_at"]) == (
            min(x["predicted_at"] for x in mine), max(x["predicted_at"] for x in mine),
        )


def test_shifted_limits(spark):
    frame = spark.createDataFrame([(100.0, 50.0)], "limit_bal double, shift double")
    assert shift_limits(frame).first()["limit_bal"] == 150.0
