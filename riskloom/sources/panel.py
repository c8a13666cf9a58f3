"""The account panel: one row per customer with six half-years of bills and payments.

Money is added up in whole cents (payments in hundredths of a cent). A double holds
such integers exactly up to 2**53, so a retried task or another partition count gives
the same bill to the last digit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.months import BILL, MONTHS, PAY, PAY_STATUS
from riskloom.sources.tables import read_table

# Fixed values of the panel mapping.
NEWEST_YEAR, NEWEST_MONTH = 2001, 7
MONTHS_PER_PERIOD = 6
WINDOW_START = "1998-08-01 00:00:00"
WINDOW_END = "2001-08-01 00:00:00"
INGESTED_AT = "2026-01-02 00:00:00"
REPLAYED_AT = "2026-01-01 00:00:00"
PANEL_URI = "panel://accounts"

RAW_COLUMNS = (
    "client_id", "limit_bal", "sex", "education", "marriage", "age",
    *PAY_STATUS, *BILL, *PAY, "default_next_month", "ingested_at", "source_uri",
)


def _period(date: str) -> str:
    """1 (newest) .. 6 (oldest) half-year of a date inside the window."""
    months_back = f"(({NEWEST_YEAR} - year({date})) * 12 + ({NEWEST_MONTH} - month({date})))"
    return f"cast({months_back} div {MONTHS_PER_PERIOD} + 1 as int)"


def _in_window(date: str) -> str:
    # Compared as plain timestamps so that the bounds reach the Parquet reader.
    return f"({date} >= timestamp_ntz'{WINDOW_START}' AND {date} < timestamp_ntz'{WINDOW_END}')"


def _cents(amount: str) -> str:
    return f"floor({amount} * 100 + 0.5D)"


def _payments(lineitem: DataFrame) -> DataFrame:
    """Payments per order and period, added up before the join with orders."""
    hundredths = f"{_cents('l_extendedprice')} * (100 - {_cents('l_discount')})"
    settled = lineitem.filter(
        f"l_returnflag = 'N' AND l_linestatus = 'F' AND {_in_window('l_shipdate')}"
    ).selectExpr(
        "l_orderkey", f"{_period('l_shipdate')} AS period", f"cast({hundredths} as double) AS paid"
    )
    return settled.groupBy("l_orderkey").agg(
        *(F.expr(f"sum(if(period = {i}, paid, null)) AS paid_{i}") for i in MONTHS)
    )


def _history(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Bills, payments and order counts per customer and period, in one aggregation."""
    billed = orders.selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus = 'O' AS is_open",
        f"cast({_cents('o_totalprice')} as double) AS billed",
        f"if({_in_window('o_orderdate')}, {_period('o_orderdate')}, null) AS period",
    )
    joined = billed.join(
        _payments(lineitem), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    # Orders outside the window that nobody paid for add nothing; drop them early.
    joined = joined.filter("period IS NOT NULL OR l_orderkey IS NOT NULL")
    aggregates = []
    for i in MONTHS:
        aggregates += [
            f"sum(if(period = {i}, billed, null)) AS bill_{i}",
            f"sum(paid_{i}) AS paid_{i}",
            f"count_if(period = {i}) AS orders_{i}",
            f"count_if(period = {i} AND is_open) AS open_{i}",
        ]
    return joined.groupBy("o_custkey").agg(*map(F.expr, aggregates))


def _status(i: int) -> str:
    return (
        f"cast(CASE WHEN coalesce(orders_{i}, 0) = 0 THEN -2 "
        f"WHEN pay_amt_{i} >= bill_amt_{i} THEN -1 "
        f"WHEN open_{i} = 0 THEN 0 ELSE least(open_{i}, 9) END as int)"
    )


# Logistic score of the newest status and utilisation, to four decimals. NULL where the
# limit is not positive (cleaning drops those rows); ``least`` alone would skip the NULL.
FIXTURE_SCORE = (
    "if(limit_bal > 0, round(1.0D / (1.0D + exp(-(-2.0D + 0.55D * pay_status_1 + 1.2D * "
    "least(bill_amt_1 / if(limit_bal > 0, limit_bal, null), 2.0D)))), 4), null)"
)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel without lineage: one row per customer, labelled."""
    history = _history(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"))
    customers = read_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS client_id",
        "round(c_acctbal * 100) AS limit_bal",
        "cast(c_nationkey % 2 + 1 as int) AS sex",
        "cast(c_nationkey % 7 as int) AS education",
        "cast((c_custkey div 3) % 4 as int) AS marriage",
        "cast(16 + (c_custkey * 7) % 70 as int) AS age",
    )
    plain = ("client_id", "limit_bal", "sex", "education", "marriage", "age")
    money = customers.join(history, F.col("client_id") == F.col("o_custkey"), "left").selectExpr(
        *plain,
        *(f"round(coalesce(bill_{i}, 0.0D) / 100) AS bill_amt_{i}" for i in MONTHS),
        *(f"round(coalesce(paid_{i}, 0.0D) / 10000) AS pay_amt_{i}" for i in MONTHS),
        *(f"orders_{i}" for i in MONTHS),
        *(f"open_{i}" for i in MONTHS),
    )
    with_status = money.selectExpr(
        *plain, *(f"{_status(i)} AS pay_status_{i}" for i in MONTHS), *BILL, *PAY
    )
    label = (
        "cast(if((client_id * 7919 + 13) % 10000 < "
        f"cast(round({FIXTURE_SCORE} * 10000) as bigint), 1, 0) as int)"
    )
    return with_status.selectExpr("*", f"{label} AS default_next_month")


def with_lineage(df: DataFrame, ingested_at: str, source_uri: str) -> DataFrame:
    """Add when and from where a row was loaded."""
    return df.withColumns(
        {
            "ingested_at": F.lit(ingested_at).cast("timestamp_ntz"),
            "source_uri": F.lit(source_uri),
        }
    )


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table: every account, plus an older replayed copy of a tenth of them.

    The replay is an extra row made from the same row, so the history is built once.
    """
    base = with_lineage(accounts(spark, sf_dir), INGESTED_AT, PANEL_URI)
    current = "named_struct('limit_bal', limit_bal, 'ingested_at', ingested_at)"
    replay = (
        "named_struct('limit_bal', limit_bal * 2, "
        f"'ingested_at', timestamp_ntz'{REPLAYED_AT}')"
    )
    versions = f"if(client_id % 10 = 0, array({current}, {replay}), array({current}))"
    versioned = ("limit_bal", "ingested_at")
    kept = [c for c in RAW_COLUMNS if c not in versioned]
    return base.selectExpr(*kept, f"explode({versions}) AS v").selectExpr(
        *(f"v.{c} AS {c}" if c in versioned else c for c in RAW_COLUMNS)
    )
