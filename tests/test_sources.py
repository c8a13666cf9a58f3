"""Panel, landing guards, table operations and stored feature tables."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from riskloom.operators.features import split_frame
from riskloom.plans.batch import build_features
from riskloom.session import materialise, work_dir
from riskloom.sources import catalog, landing
from riskloom.sources.panel import accounts, raw_panel
from tests.conftest import RAW_SCHEMA, SF, account, synthetic


def test_panel_has_a_row_per_customer_and_replays_a_tenth(spark):
    customers = spark.read.parquet(f"{SF}/customer.parquet").count()
    raw = raw_panel(spark, SF)
    assert accounts(spark, SF).count() == customers
    assert raw.count() == customers + raw.filter("client_id % 10 = 0").select("client_id").distinct().count()
    pair = raw.filter("client_id = 10").orderBy("ingested_at").collect()
    assert pair[0]["limit_bal"] == 2 * pair[1]["limit_bal"]


def test_published_figures_of_the_panel(spark):
    a = accounts(spark, SF.replace("0.001", "0.01"))
    row = a.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("limit_bal") <= 0).alias("no_limit"),
        F.count_if(F.col("age") < 18).alias("young"),
        F.count_if(F.expr("bill_amt_2 + bill_amt_3 + bill_amt_4 + bill_amt_5 + bill_amt_6 = 0")).alias("dormant"),
        F.count_if(F.col("bill_amt_1") > F.col("limit_bal")).alias("over"),
    ).first()
    assert (row["n"], row["no_limit"], row["young"]) == (1500, 122, 150)


def test_panel_scan_reads_few_columns_and_pushes_filters(spark):
    plan = accounts(spark, SF)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    lineitem = next(line for line in physical.splitlines() if "FileScan" in line and "l_shipdate" in line)
    assert "EqualTo(l_returnflag,N)" in lineitem and "GreaterThanOrEqual(l_shipdate" in lineitem
    assert "l_quantity" not in physical and "CartesianProduct" not in physical


def delivered(make, n=20):
    return landing.as_delivered(make(synthetic(n)))


def test_landing_renames_and_adds_lineage(make):
    out = landing.land(delivered(make), "2026-03-01 00:00:00", "file://x")
    assert out.columns == [f.split()[0] for f in RAW_SCHEMA.split(", ")]
    row = out.orderBy("client_id").first()
    assert row["source_uri"] == "file://x" and str(row["ingested_at"]) == "2026-03-01 00:00:00"
    assert row["pay_status_1"] == synthetic(20)[0]["pay_status_1"]


def test_landing_names_missing_columns(make):
    with pytest.raises(landing.LandingError, match="AGE.*PAY_0"):
        landing.land(delivered(make).drop("AGE", "PAY_0"), "2026-03-01", "x")


def test_row_count_guard(make):
    landing.check_row_count(delivered(make), 20)
    with pytest.raises(landing.LandingError, match="20 rows instead of 30000"):
        landing.check_row_count(delivered(make))


def test_checksums(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"one")
    (tmp_path / "b.bin").write_bytes(b"two")
    expected = {n: hashlib.sha256(c).hexdigest() for n, c in (("a.bin", b"one"), ("b.bin", b"two"))}
    found = landing.file_checksums(spark, str(tmp_path))
    landing.verify_checksums(found, expected)
    with pytest.raises(landing.LandingError, match="b.bin.*c.bin"):
        landing.verify_checksums(found, {**expected, "b.bin": "0", "c.bin": "0"})


def test_checksum_of_a_file_over_two_gigabytes(spark, tmp_path):
    (tmp_path / "small").write_bytes(b"small")
    size = 2**31 + 5
    with (tmp_path / "large").open("wb") as f:
        f.truncate(size)
    total, piece = hashlib.sha256(), bytes(1 << 24)
    for _ in range(size // len(piece)):
        total.update(piece)
    total.update(bytes(size % len(piece)))
    found = {r["file"]: (r["bytes"], r["sha256"]) for r in landing.file_checksums(spark, str(tmp_path)).collect()}
    assert found == {"small": (5, hashlib.sha256(b"small").hexdigest()), "large": (size, total.hexdigest())}


def test_write_once_skips_unless_forced(spark, make, tmp_path):
    path = str(tmp_path / "raw")
    for n, force, rows in ((5, False, 5), (8, False, 5), (8, True, 8)):
        landing.write_once(make(synthetic(n)), path, force)
        assert spark.read.parquet(path).count() == rows


def test_dated_loads_stay_side_by_side(spark, make, tmp_path):
    path = str(tmp_path / "dated")
    for day, n in (("2026-01-01", 5), ("2026-01-02", 7), ("2026-01-01", 6)):
        landing.write_dated(make(synthetic(n)), path, day)
    assert landing.replay(spark, path, "2026-01-01", RAW_SCHEMA).count() == 6
    assert landing.replay(spark, path, "2026-01-02", RAW_SCHEMA).count() == 7


def test_table_operations(spark, make, tmp_path):
    name, path = "accounts_under_test", str(tmp_path / "t")
    frame = make(synthetic(10))
    assert not catalog.table_exists(spark, name)
    assert catalog.write_table(frame, name, path=path) == 10
    assert catalog.write_table(frame, name, path=path) == 10  # idempotent
    other = make([account(99, limit=7)])
    assert catalog.write_table(other.select(*reversed(other.columns)), name, "append") == 11
    found = catalog.query(
        spark, "SELECT limit_bal, age FROM IDENTIFIER(:t) WHERE client_id = :id", t=name, id=99
    ).first()
    assert tuple(found) == (7.0, 30)
    assert catalog.row_count(spark, name) == 11
    with pytest.raises(ValueError, match="differ"):
        catalog.write_table(other.drop("age"), name, "append")
    with pytest.raises(ValueError, match="mode"):
        catalog.write_table(other, name, "merge")
    with pytest.raises(Exception, match="(?i)parameter"):
        catalog.query(spark, "SELECT :missing").collect()
    spark.sql(f"DROP TABLE {name}")


def test_append_creates_an_absent_table(spark, make, tmp_path):
    name = "appended_under_test"
    assert catalog.write_table(make(synthetic(3)), name, "append", str(tmp_path / "a")) == 3
    spark.sql(f"DROP TABLE {name}")


def test_bucketed_table_dedups_without_a_shuffle(spark, make, tmp_path):
    from riskloom.operators.clean import dedup_latest

    name = "bucketed_under_test"
    catalog.write_table(make(synthetic(40)), name, path=str(tmp_path / "b"), bucket_by=(4, "client_id"))
    plan = dedup_latest(spark.table(name))._jdf.queryExecution().toString()
    assert "Exchange" not in plan[plan.index("== Physical Plan ==") :]
    spark.sql(f"DROP TABLE {name}")


def test_feature_build_stores_partitioned_tables(spark, make, tmp_path):
    table = build_features(
        spark, make(synthetic(300)), str(tmp_path / "clean"), str(tmp_path / "features")
    )
    assert table.count() == 300
    plan = split_frame(table, "train")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split_name" in plan
    few = build_features(
        spark, make([account()]), str(tmp_path / "c2"), str(tmp_path / "f2"), validate=False
    )
    assert few.count() == 1


def test_features_need_no_shuffle(spark, make):
    from riskloom.operators.clean import clean_rows
    from riskloom.operators.features import features

    plan = features(clean_rows(make(synthetic(5))))._jdf.queryExecution().toString()
    assert "Exchange" not in plan[plan.index("== Physical Plan ==") :]


def test_materialised_tables_lie_in_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert folder in work_dir(spark)
    frame = materialise(spark.range(10))
    assert frame.count() == 10 and folder in frame.inputFiles()[0]
