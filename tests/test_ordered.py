"""The ordered pass over logins and transactions against plain Python, and its plan."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from riskflow.functions.timefn import time_bucket
from riskflow.operators.ordered import CONTEXT_COLUMNS, ordered_context
from riskflow.operators.sequence import DEFAULT_BUCKET_SECONDS
from riskflow.plans import catalog
from riskflow.sources import fixtures

BASE = dt.datetime(2024, 1, 1)


def _rows(seed):
    rnd = random.Random(seed)
    places = [(38.72, -9.14), (-1.29, 36.82), (43.65, -79.38), (None, 1.0)]
    when = lambda: None if rnd.random() < 0.05 else BASE + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 40, 20))
    user = lambda: rnd.choice([None, "a", "a", "a", "b", "c", "d"])
    logins = [
        (rnd.choice([None, f"l{i:03d}", f"l{i:03d}"]), user(), rnd.choice(["1", "2", "3", None]), when(), rnd.random() < 0.2, *rnd.choice(places), "x", f"d{rnd.randrange(3)}")
        for i in range(300)
    ]
    # Two rows of a user with one time and no id have no order: keep one of them.
    seen = set()
    logins = [x for x in logins if x[0] is not None or (x[1], x[3]) not in seen and not seen.add((x[1], x[3]))]
    txns = [(f"t{i:03d}", rnd.choice([None, "a", "a", "b", "c", "e"]), 1.0, "m", "wire", when()) for i in range(200)]
    return logins, txns


def _miles(a, b):
    from math import asin, cos, radians, sin, sqrt

    if None in (*a, *b):
        return 0.0
    (y1, x1), (y2, x2) = ((radians(v) for v in p) for p in (a, b))
    return 3958.8 * 2 * asin(sqrt(sin((y2 - y1) / 2) ** 2 + cos(y1) * cos(y2) * sin((x2 - x1) / 2) ** 2))


def _plain(logins, txns):
    out = []
    for t in txns:
        own = [x for x in logins if x[1] is not None and x[1] == t[1] and x[3] is not None]
        own.sort(key=lambda x: (x[3], x[0] is not None, x[0] or ""))
        pairs = list(zip(own, own[1:], strict=False))
        changes = [b for a, b in pairs if a[2] is not None and b[2] is not None and a[2] != b[2]]
        travel = any((b[3] - a[3]).total_seconds() <= 600 and _miles(a[5:7], b[5:7]) >= 500 for a, b in pairs)
        hit = [c for c in changes if t[5] is not None and c[3] <= t[5]]
        mfa = [x[3] for x in own if x[4]]
        hit = (hit[-1][3], *hit[-1][5:7]) if hit else (None,) * 3
        out.append((t[0], *hit, *((own[-1][2], own[-1][8]) if own else (None, None)), max(mfa, default=None), travel))
    return sorted(map(str, out))


@pytest.mark.parametrize("seed, width", [(1, 3600), (2, 86_400), (3, DEFAULT_BUCKET_SECONDS), (4, 10**9)])
def test_equal_to_plain_python(make_logins, make_txns, seed, width):
    logins, txns = _rows(seed)
    text = lambda v: None if v is None else v.isoformat()
    left = make_txns([(*t[:5], text(t[5])) for t in txns])
    right = make_logins([(x[0], x[1], x[2], text(x[3]), *x[4:]) for x in logins])
    got = ordered_context(left.repartition(3), right.repartition(3), width)
    assert got.columns == left.columns + CONTEXT_COLUMNS
    rows = sorted(str(tuple(r)) for r in got.select("transaction_id", *CONTEXT_COLUMNS).collect())
    assert rows == _plain(logins, txns)


def test_no_rows(make_logins, make_txns):
    logins, txns = _rows(5)
    one = [("t", "a", 1.0, "m", "wire", "2024-01-05 00:00:00"), ("u", None, 1.0, "m", "wire", None)]
    got = {r["transaction_id"]: r for r in ordered_context(make_txns(one), make_logins([])).collect()}
    assert all(r["ip_change_time"] is None and r["ip_address"] is None and r["has_travel_flag"] is False for r in got.values()) and len(got) == 2
    assert ordered_context(make_txns([]), make_logins([])).count() == 0


def test_rows_are_shuffled_once_and_summaries_are_few(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name, most in (("silver_asof", 4), ("account_takeover_rate", 6), ("default_risk_score", 4)):
            plan = catalog.queries()[name](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(r"(?<!Reused)Exchange (?:hash|range|Single)", plan)) <= most, name
            assert plan.count("FileScan") <= 3, name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    logins = fixtures.load(spark, "/root/testdata/sf0.1")["logins"]
    tails = logins.select("user_id", time_bucket("login_time", DEFAULT_BUCKET_SECONDS)).distinct().count()
    assert tails < 0.1 * logins.count()
