"""Silver rules, travel and KPIs on hand-built rows (boundaries, ties, NULLs)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from riskflow.functions.geo import miles_between, register_sql_function
from riskflow.operators.features import ip_changes, latest_login, latest_mfa
from riskflow.operators.travel import impossible_travel
from riskflow.plans.kpis import account_takeover_rate, false_positive_ratio
from riskflow.plans.silver import user_activity

NY = (40.71, -74.01, "New York")
HK = (22.28, 114.16, "Hong Kong")


def L(i, user, ip, t, mfa=False, city=NY):
    return (f"L{i:03d}", user, ip, t, mfa, city[0], city[1], city[2], "device-001")


def T(i, user, amount, typ, t):
    return (f"T{i:03d}", user, amount, "M-1", typ, t)


def test_ip_changes_first_login_and_ties(make_logins):
    logins = make_logins(
        [
            L(1, "u1", "1.1.1.1", "2024-01-01 10:00:00"),
            L(2, "u1", "1.1.1.1", "2024-01-01 11:00:00"),
            L(4, "u1", "2.2.2.2", "2024-01-01 12:00:00"),  # same time as L3: L3 comes first by id
            L(3, "u1", "3.3.3.3", "2024-01-01 12:00:00"),
            L(5, "u2", "9.9.9.9", "2024-01-01 12:00:00"),  # first login never counts
        ]
    )
    got = sorted((r["login_id"], r["new_ip"]) for r in ip_changes(logins).collect())
    assert got == [("L003", "3.3.3.3"), ("L004", "2.2.2.2")]


def test_latest_login_and_mfa(make_logins):
    logins = make_logins(
        [
            L(1, "u1", "a", "2024-01-01 10:00:00", mfa=True),
            L(3, "u1", "c", "2024-01-02 10:00:00"),
            L(2, "u1", "b", "2024-01-02 10:00:00", mfa=True),
        ]
    )
    ll = latest_login(logins).collect()[0]
    assert (ll["ip_address"], str(ll["last_login_time"])) == ("c", "2024-01-02 10:00:00")
    assert str(latest_mfa(logins).collect()[0]["last_mfa_change"]) == "2024-01-02 10:00:00"


def test_silver_flag_boundaries(make_logins, make_txns):
    logins = make_logins(
        [
            L(1, "u1", "1.1.1.1", "2024-01-01 08:00:00"),
            L(2, "u1", "2.2.2.2", "2024-01-01 09:00:00.900"),  # IP change; fraction dropped by whole seconds
            L(3, "u2", "1.1.1.1", "2024-01-03 09:00:00", mfa=True),
        ]
    )
    txns = make_txns(
        [
            T(1, "u1", 10000.0, "wire", "2024-01-01 10:00:00.500"),  # 3600 whole seconds → 60.00 → recent
            T(2, "u1", 10000.0, "wire", "2024-01-01 10:00:01"),  # 3601 s → 60.02 → not recent
            T(3, "u1", 9999.99, "wire", "2024-01-01 09:30:00"),  # below 10,000
            T(4, "u1", 50000.0, None, "2024-01-01 09:30:00"),  # NULL type keeps NULL
            T(5, "u1", 50.0, "card", "2024-01-01 07:00:00"),  # before any change
            T(6, "u2", 1.0, "ach", "2024-01-01 23:00:00"),  # MFA change two days *after*: calendar diff -2 ≤ 1
            T(7, "u3", 1.0, "ach", "2024-01-01 23:00:00"),  # unknown user
        ]
    )
    rows = {r["transaction_id"]: r for r in user_activity(txns, logins).collect()}
    assert rows["T001"]["minutes_since_ip_change"] == 60.0 and rows["T001"]["ip_changed_recently"]
    assert rows["T001"]["wire_over_10k_within_1h_ip_change"] is True
    assert rows["T002"]["minutes_since_ip_change"] == 60.02 and not rows["T002"]["ip_changed_recently"]
    assert rows["T003"]["high_value_wire"] is False
    assert rows["T004"]["high_value_wire"] is None
    assert rows["T004"]["wire_over_10k_within_1h_ip_change"] in (None, False)
    assert rows["T005"]["minutes_since_ip_change"] is None and rows["T005"]["ip_latitude"] is None
    assert rows["T006"]["mfa_change_flag"] is True
    assert rows["T007"]["ip_address"] is None and rows["T007"]["mfa_change_flag"] is False
    trailing = {r["transaction_id"]: r for r in user_activity(txns, logins, mfa_mode="trailing_24h").collect()}
    assert trailing["T006"]["mfa_change_flag"] is False


def test_fanout_has_one_row_per_earlier_change_and_matches_asof_flag(make_logins, make_txns):
    logins = make_logins(
        [
            L(1, "u1", "a", "2024-01-01 08:00:00"),
            L(2, "u1", "b", "2024-01-01 09:00:00"),
            L(3, "u1", "c", "2024-01-01 09:30:00"),
        ]
    )
    txns = make_txns([T(1, "u1", 20000.0, "wire", "2024-01-01 10:00:00")])
    fan = user_activity(txns, logins, ip_mode="all")
    assert fan.count() == 2
    asof = user_activity(txns, logins).collect()[0]
    assert asof["minutes_since_ip_change"] == 30.0
    assert fan.agg(F.max("wire_over_10k_within_1h_ip_change")).collect()[0][0] == asof["wire_over_10k_within_1h_ip_change"]
    interval = user_activity(txns, logins, ip_mode="interval")
    assert interval.count() == 2  # both changes are within the hour


def test_travel_thresholds_and_distance(spark, make_logins):
    logins = make_logins(
        [
            L(1, "u1", "a", "2024-01-01 10:00:00", city=NY),
            L(2, "u1", "a", "2024-01-01 10:10:00", city=HK),  # exactly 10 minutes → flagged
            L(3, "u1", "a", "2024-01-01 10:20:01", city=NY),  # 10:01 → not flagged
            L(4, "u2", "a", "2024-01-01 10:00:00", city=NY),
            L(5, "u2", "a", "2024-01-01 10:01:00", city=NY),  # 0 miles
        ]
    )
    out = impossible_travel(logins).collect()
    assert len(out) == 1
    assert out[0]["miles_traveled"] == 8053.54 and out[0]["minutes_between_logins"] == 10.0
    assert out[0]["city"] == "Hong Kong"


def test_miles_between_null_is_null_not_zero(spark):
    df = spark.createDataFrame([(40.71, -74.01, None, 114.16)], "a double, b double, c double, d double")
    assert df.select(miles_between("a", "b", "c", "d")).collect()[0][0] is None
    register_sql_function(spark)
    v = spark.sql("SELECT round(miles_between(40.71D, -74.01D, 22.28D, 114.16D), 2)").collect()[0][0]
    assert v == 8053.54


def test_kpis(spark, make_logins, make_txns):
    from riskflow.schemas import TRIAGE

    tri = spark.createDataFrame(
        [
            ("t1", "u", 90.0, "CRITICAL", "BLOCK", None, None, "APPROVED", None, None, None),
            ("t2", "u", 75.0, "HIGH", "CHALLENGE", None, None, "REJECTED", None, None, None),
            ("t3", "u", 10.0, "LOW", "APPROVE", None, None, "APPROVED", None, None, None),
            ("t4", "u", 10.0, "LOW", "BLOCK", None, None, "ESCALATED", None, None, None),
        ],
        TRIAGE,
    )
    r = false_positive_ratio(tri).collect()[0]
    assert (r["false_positive_ratio"], r["total_flagged"]) == (1 / 3, 3)
    empty = false_positive_ratio(tri.filter("false")).collect()[0]
    assert empty["false_positive_ratio"] is None and empty["total_flagged"] == 0

    logins = make_logins(
        [
            L(1, "u1", "a", "2024-01-01 10:00:00", mfa=True, city=NY),
            L(2, "u1", "a", "2024-01-01 10:05:00", city=HK),
            L(3, "u2", "a", "2024-01-01 10:00:00", mfa=True),
        ]
    )
    txns = make_txns(
        [
            T(1, "u1", 5.0, "card", "2024-01-01 11:00:00"),
            T(2, "u1", 6.0, "card", "2024-01-01 12:00:00"),
            T(3, "u2", 20000.0, "wire", "2024-01-01 12:00:00"),
            T(4, "u2", 5.0, "card", "2024-01-01 12:00:00"),
        ]
    )
    ato = account_takeover_rate(user_activity(txns, logins), impossible_travel(logins)).collect()[0]
    assert (ato["ato_user_count"], ato["ato_event_count"]) == (2, 3)


def test_interval_and_trailing_mfa_modes_match_brute_force(spark):
    """On the sf0.001 fixture: the interval form pairs each transaction with every IP change in the
    preceding hour (whole seconds), and the trailing-24h MFA flag uses the latest MFA change at or
    before the transaction within 24 hours."""
    from riskflow.operators.features import ip_changes
    from riskflow.sources import fixtures
    from tests.conftest import SF001

    rel = fixtures.load(spark, SF001)
    tx = rel["transactions"].toPandas()
    ch = ip_changes(rel["logins"]).toPandas()
    lg = rel["logins"].toPandas()
    secs = lambda s: s.astype("datetime64[us]").astype("int64") // 1_000_000

    got = user_activity(rel["transactions"], rel["logins"], ip_mode="interval").toPandas()
    pairs = got[got["minutes_since_ip_change"].notna()]
    m = tx.merge(ch, on="user_id")
    d = secs(m["transaction_time"]) - secs(m["ip_change_time"])
    want = m[(m["transaction_time"] >= m["ip_change_time"]) & (d <= 3600)]
    assert len(pairs) == len(want)
    assert set(got["transaction_id"]) == set(tx["transaction_id"])  # unmatched transactions kept once
    assert got["ip_changed_recently"].sum() == len(want)

    trailing = user_activity(rel["transactions"], rel["logins"], mfa_mode="trailing_24h").toPandas()
    mfa = lg[lg["mfa_changed"]]
    expect = {}
    for _, t in tx.iterrows():
        cand = mfa[(mfa["user_id"] == t["user_id"]) & (mfa["login_time"] <= t["transaction_time"])]
        if len(cand):
            last = cand["login_time"].max()
            expect[t["transaction_id"]] = (secs(pd.Series([t["transaction_time"]]))[0] - secs(pd.Series([last]))[0]) / 60 <= 1440
        else:
            expect[t["transaction_id"]] = False
    assert dict(zip(trailing["transaction_id"], trailing["mfa_change_flag"])) == expect
