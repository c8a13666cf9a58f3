"""Cleaning and features on hand-made rows."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.config import NON_MODEL_COLUMNS, SplitRule
from riskloom.functions.features import all_features
from riskloom.operators import audits
from riskloom.operators.clean import clean, clean_audit, dedup_latest
from riskloom.operators.features import features, model_columns, split_frame, split_name
from riskloom.operators.validate import (
    FeatureValidationError,
    validate_features,
    validation_report,
)
from tests.conftest import account, synthetic


def one(make, **kw):
    return features(clean(make([account(**kw)]))).first()


def test_payment_settles_the_statement_before(make):
    row = one(make, bills=(9999, 1000, 2000, 0, 0, 0), pays=(500, 1000, 0, 0, 0, 0))
    assert row["avg_payment_ratio"] == pytest.approx(0.2)
    assert row["overall_payment_ratio"] == pytest.approx(1500 / 3000)


def test_dormant_account_keeps_its_null(make):
    row = one(make, statuses=(-2,) * 6, bills=(500, 0, 0, 0, 0, 0))
    assert row["overall_payment_ratio"] is None
    assert row["has_billing_history"] == 0
    assert row["months_no_consumption"] == 6


def test_cancelling_statements_count_as_no_history(make):
    row = one(make, bills=(0, 100, -100, 0, 0, 0))
    assert row["has_billing_history"] == 0 and row["overall_payment_ratio"] is None


def test_negative_bills_and_balances_over_the_limit_survive(make):
    row = one(make, limit=100, bills=(150, -50, 0, 0, 0, 200))
    assert row["months_over_limit"] == 2 and row["ever_over_limit"] == 1
    assert row["credit_headroom"] == pytest.approx(-0.5)


def test_every_feature_against_numpy(make):
    rows = {r["client_id"]: r for r in synthetic(200)}
    out = features(clean(make(list(rows.values())))).collect()
    assert len(out) == 200
    for f in out:
        r = rows[f["client_id"]]
        bill = np.array([r[f"bill_amt_{i}"] for i in range(1, 7)])
        paid = np.array([r[f"pay_amt_{i}"] for i in range(1, 7)])
        status = np.array([r[f"pay_status_{i}"] for i in range(1, 7)])
        limit = r["limit_bal"]
        with np.errstate(divide="ignore", invalid="ignore"):
            ratios = np.where(bill[1:] != 0, paid[:5] / bill[1:], 0)
        expected = {
            "avg_utilization": (bill / limit).mean(),
            "max_utilization": (bill / limit).max(),
            "utilization_trend": (bill[0] - bill[5]) / limit,
            "avg_payment_ratio": ratios.mean(),
            "overall_payment_ratio": paid.sum() / bill[1:].sum(),
            "months_zero_payment": (paid == 0).sum(),
            "total_paid_6m": paid.sum(),
            "max_delinquency": status.max(),
            "months_delinquent": (status >= 1).sum(),
            "delinquency_trend": status[0] - status[5],
            "months_revolving": (status == 0).sum(),
            "months_paid_duly": (status == -1).sum(),
            "months_no_consumption": (status == -2).sum(),
            "avg_bill_amt": bill.mean(),
            "bill_volatility": bill.std(),
            "months_over_limit": (bill > limit).sum(),
            "net_balance_ratio": (bill[0] - paid[0]) / limit,
        }
        for name, value in expected.items():
            assert f[name] == pytest.approx(value, rel=1e-9, abs=1e-9), name


def test_volatility_of_large_steady_balances_is_zero(make):
    row = one(make, bills=(87654321.0,) * 6)
    assert row["bill_volatility"] == 0.0


def test_there_are_32_features_and_the_protected_attribute_is_no_input(make):
    table = features(clean(make([account()])))
    assert len(all_features()) == 32
    assert model_columns(table) == list(all_features())
    assert not set(model_columns(table)) & set(NON_MODEL_COLUMNS)


def test_codes_fold_and_implausible_rows_go(make):
    rows = [
        account(1, education=0, marriage=0),
        account(2, education=6, marriage=2),
        account(3, education=None, marriage=None),
        account(4, limit=0),
        account(5, age=17),
        account(6, age=18),
        account(7, age=100),
        account(8, age=101),
    ]
    out = {r["client_id"]: r for r in clean(make(rows)).collect()}
    assert sorted(out) == [1, 2, 3, 6, 7]
    assert [out[k]["education"] for k in (1, 2, 3)] == [4, 4, 4]
    assert [out[k]["marriage"] for k in (1, 2, 3)] == [3, 2, 3]


def test_replay_keeps_one_row_and_the_newest(make):
    old = synthetic(50)
    new = [{**r, "limit_bal": r["limit_bal"] + 1, "ingested_at": datetime(2026, 1, 5)} for r in old]
    out = clean(make(old + new + old))
    assert out.count() == 50
    assert out.filter(F.col("ingested_at") < "2026-01-05").count() == 0


def test_newest_row_implausible_means_no_row(make):
    rows = [account(1), account(1, limit=0, ingested_at=datetime(2026, 2, 1))]
    assert clean(make(rows)).count() == 0


def test_equal_load_times_are_settled_by_content(make):
    rows = [account(1, limit=k) for k in (300, 100, 200)]
    assert {dedup_latest(make(rows[k:] + rows[:k])).first()["limit_bal"] for k in range(3)} == {100.0}


def test_one_client_with_very_many_copies(make):
    rows = [account(1, limit=100 + k, ingested_at=datetime(2026, 1, 1 + k % 28)) for k in range(300)]
    frame = make(rows + synthetic(40)[1:])
    assert clean(frame).count() == 40
    plan = dedup_latest(frame)._jdf.queryExecution().toString()
    # One row per client is left before the exchange as well as after it.
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("WindowGroupLimit") == 2


def test_clean_audit_counts(make):
    rows = [account(1, education=0), account(2, marriage=0), account(3, limit=-1), account(3, limit=-1)]
    row = clean_audit(make(rows)).first()
    assert row.asDict() == {
        "distinct_clients": 3, "undocumented_education": 1, "undocumented_marriage": 1,
        "implausible_rows": 1, "kept_rows": 2, "duplicate_rows": 1,
    }


def test_split_equals_the_plain_product_and_never_overflows(spark):
    ids = [0, 1, 99, 100, 12345, 3_000_000_000, 9_000_000_000_000_000_000]
    df = spark.createDataFrame([(i,) for i in ids], "client_id bigint")
    for r in df.selectExpr("client_id", f"{split_name(SplitRule())} AS s").collect():
        bucket = r["client_id"] * 2654435761 % 100
        assert r["s"] == ("train" if bucket <= 69 else "valid" if bucket <= 84 else "test")
    negative = spark.createDataFrame([(-i,) for i in range(1, 200)], "client_id bigint")
    assert {r[0] for r in negative.selectExpr(split_name(SplitRule())).collect()} == {"train"}


@pytest.mark.parametrize("train_max, valid_max", [(-1, 5), (50, 50), (60, 100)])
def test_split_bounds_are_checked(train_max, valid_max):
    with pytest.raises(ValueError, match="split bounds"):
        SplitRule(train_max=train_max, valid_max=valid_max)


def test_splits_are_disjoint_and_new_clients_move_nobody(make):
    rows = synthetic(300)
    before = features(clean(make(rows)))
    after = features(clean(make(rows + [{**r, "client_id": r["client_id"] + 10000} for r in rows])))
    assert audits.split_moves(before, after).count() == 0
    assert audits.split_overlap(after).count() == 0
    assert sum(split_frame(after, s).count() for s in ("train", "valid", "test")) == 600


def test_validation_passes_a_healthy_table(make):
    validate_features(features(clean(make(synthetic(300)))))


def test_validation_reports_all_problems_together(make):
    table = features(clean(make(synthetic(300))))
    broken = (
        table.filter("split_name <> 'valid'")
        .withColumn("default_next_month", F.lit(0))
        .withColumn("age", F.lit(None).cast("int"))
        .withColumn("avg_bill_amt", F.lit(float("-inf")))
    )
    with pytest.raises(FeatureValidationError) as e:
        validate_features(broken.unionByName(broken))
    text = str(e.value)
    for part in ("positive_rate", "all_splits", "unique_id", "all_null(age)", "infinite(avg_bill_amt)"):
        assert part in text
    bad = {(r["check"], r["column"]): r["bad_rows"] for r in validation_report(broken).collect()}
    assert bad["all_splits", "split_name"] == 1 and bad["unique_id", "client_id"] == 0


def test_validation_of_odd_labels_missing_target_and_empty_table(make):
    table = features(clean(make(synthetic(300))))
    odd = table.withColumn("default_next_month", F.col("client_id").cast("int") % 3)
    with pytest.raises(FeatureValidationError, match="binary_target"):
        validate_features(odd)
    with pytest.raises(FeatureValidationError, match="target_present"):
        validate_features(table.drop("default_next_month"))
    with pytest.raises(FeatureValidationError, match="is empty"):
        validate_features(table.filter("false"))
