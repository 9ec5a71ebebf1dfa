from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskflow.session import get_spark

    s = get_spark(
        "local[4]",
        app="riskflow-tests",
        shuffle_partitions=8,
        conf={
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="riskflow-test-ckpt-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="riskflow-test-wh-"),
        },
    )
    yield s
    s.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def make_logins(spark):
    from riskflow.schemas import LOGINS

    def build(rows):
        """rows: (login_id, user_id, ip, time-str, mfa, lat, lon, city, device)."""
        return spark.createDataFrame(
            [(a, b, c, ts(d) if d else None, e, f, g, h, i) for a, b, c, d, e, f, g, h, i in rows], LOGINS
        )

    return build


@pytest.fixture
def make_txns(spark):
    from riskflow.schemas import TRANSACTIONS

    def build(rows):
        """rows: (transaction_id, user_id, amount, merchant, type, time-str)."""
        return spark.createDataFrame([(a, b, c, d, e, ts(f) if f else None) for a, b, c, d, e, f in rows], TRANSACTIONS)

    return build
