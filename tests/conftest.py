"""Shared session and small hand-made inputs."""

from __future__ import annotations

import os
import sys
import zlib
from datetime import datetime

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.functions.months import BILL, MONTHS, PAY, PAY_STATUS  # noqa: E402
from riskloom.session import get_spark  # noqa: E402

RAW_SCHEMA = ", ".join(
    [
        "client_id bigint", "limit_bal double", "sex int", "education int", "marriage int",
        "age int", *(f"{c} int" for c in PAY_STATUS), *(f"{c} double" for c in (*BILL, *PAY)),
        "default_next_month int", "ingested_at timestamp_ntz", "source_uri string",
    ]
)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            # Plans are checked as text; keep their details whole.
            "spark.sql.maxMetadataStringLength": "100000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def account(client_id=1, limit=100000.0, statuses=(0,) * 6, bills=(0.0,) * 6, pays=(0.0,) * 6, **kw):
    """One raw row."""
    row = {
        "client_id": client_id, "limit_bal": float(limit), "sex": 2, "education": 2,
        "marriage": 1, "age": 30, "default_next_month": 0,
        "ingested_at": datetime(2026, 1, 1), "source_uri": "test://row",
    }
    for i in MONTHS:
        row[f"pay_status_{i}"] = statuses[i - 1]
        row[f"bill_amt_{i}"] = float(bills[i - 1])
        row[f"pay_amt_{i}"] = float(pays[i - 1])
    return {**row, **kw}


def _pick(k, what, low, high):
    """A whole number in [low, high), fixed by row and purpose."""
    return low + zlib.crc32(f"{what}/{k}".encode()) % (high - low)


def synthetic(n=500):
    """Accounts 1 to n. Those late by two months or more mostly default, others rarely."""
    rows = []
    for k in range(1, n + 1):
        limit = 10_000 * _pick(k, "limit", 2, 60)
        late = _pick(k, "late", 0, 10) < 3
        statuses = [_pick(k, f"status{i}", 1, 4) if late else _pick(k, f"status{i}", -2, 1) for i in MONTHS]
        bills = [limit * _pick(k, f"bill{i}", 0, 110) // 100 for i in MONTHS]
        pays = [bills[i - 1] * _pick(k, f"pay{i}", 0, 60) // 100 for i in MONTHS]
        default = _pick(k, "default", 0, 100) < (70 if late and statuses[0] > 1 else 12)
        rows.append(
            account(
                k, limit, statuses, bills, pays, sex=1 + k % 2, education=_pick(k, "education", 0, 7),
                marriage=_pick(k, "marriage", 0, 4), age=_pick(k, "age", 19, 80), default_next_month=int(default),
            )
        )
    return rows


@pytest.fixture(scope="session")
def make(spark):
    """Raw rows to a DataFrame with the declared schema."""
    names = [f.split()[0] for f in RAW_SCHEMA.split(", ")]

    def build(rows):
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], RAW_SCHEMA)

    return build


def graded_scores(n=600, shift=0):
    """Labels and scores on a grid of 97 values, ties included; high scores are mostly 1."""
    place = np.arange(n) + 1000 * shift
    p = ((place * 53 + place // 97) % 97 + 0.5) / 98
    y = np.array([_pick(int(k), "label", 0, 97) < 97 * q**2 for k, q in zip(place, p)], int)
    return y, p


@pytest.fixture(scope="session")
def score_frame(spark):
    def build(y, p, groups=None):
        groups = groups if groups is not None else [1] * len(y)
        rows = [(k, int(a), float(b), int(g)) for k, (a, b, g) in enumerate(zip(y, p, groups))]
        return spark.createDataFrame(rows, "client_id bigint, y int, p double, sex int")

    return build
