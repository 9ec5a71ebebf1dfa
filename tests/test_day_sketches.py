"""Takeover counts kept by day against the exact counts over all events."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskflow.plans import kpis

SCHEMA = "user_id string, transaction_time timestamp_ntz, mfa_change_flag boolean, high_value_wire boolean, has_travel_flag boolean"


def test_days_merge_to_the_whole(spark):
    n = 60_000
    activity = spark.range(n).select(
        F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(25_000))).alias("user_id"),
        F.when(F.col("id") % 97 != 0, F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 30 as int))")).alias("transaction_time"),
        (F.col("id") % 2 == 0).alias("mfa_change_flag"), (F.col("id") % 3 != 0).alias("high_value_wire"), (F.col("id") % 50 == 0).alias("has_travel_flag"),
    )
    want = kpis.account_takeover_rate(activity).first()
    days = kpis.takeover_days(activity)
    got = kpis.takeovers_from_days(days).first()
    assert got["ato_event_count"] == want["ato_event_count"]
    assert got["ato_user_estimate"] == pytest.approx(want["ato_user_count"], rel=0.025)
    # A day that came in halves: its row is replaced, the others are kept as they are.
    late = (F.to_date("transaction_time") == F.lit("2024-01-05").cast("date")) | F.col("transaction_time").isNull()
    kept = kpis.takeover_days(activity.filter(~F.coalesce(late, F.lit(False)) | F.col("mfa_change_flag")))
    again = kpis.refresh_days(kept, kpis.takeover_days(activity.filter(late)))
    cols = ["day", "ato_event_count", "ato_user_count"]
    assert sorted(map(str, again.select(*cols).collect())) == sorted(map(str, days.select(*cols).collect()))
    assert kpis.takeovers_from_days(again).first() == got


def test_no_events(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert kpis.takeover_days(none).count() == 0
    assert tuple(kpis.takeovers_from_days(kpis.takeover_days(none)).first()) == (0, 0)
