"""Bucketed lag / as-of / interval join against brute force on hand-built and random inputs."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from riskflow.operators.sequence import asof_join, interval_join, previous_in_sequence

EV = StructType(
    [
        StructField("k", StringType()),
        StructField("id", StringType()),
        StructField("t", TimestampNTZType()),
        StructField("v", LongType()),
    ]
)


def _random_events(n, keys, seed, span_hours=200, hot=None):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        k = hot if hot and rnd.random() < 0.4 else rnd.choice(keys)
        t = base + dt.timedelta(seconds=rnd.randrange(span_hours * 3600))
        rows.append((k, f"id{i:05d}", t, rnd.randrange(5)))
    return rows


def _brute_lag(rows):
    out = {}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for k, rs in by.items():
        rs.sort(key=lambda r: (r[2], r[1]))
        prev = None
        for r in rs:
            out[r[1]] = prev[3] if prev else None
            prev = r
    return out


def test_previous_in_sequence_matches_brute_force(spark):
    rows = _random_events(600, ["a", "b", "c"], seed=1, hot="hot")
    # Same-time rows are ordered by id; a key with a single row; a long gap between buckets.
    rows += [("tie", "x2", dt.datetime(2024, 1, 1, 5), 2), ("tie", "x1", dt.datetime(2024, 1, 1, 5), 1)]
    rows += [("solo", "s1", dt.datetime(2024, 3, 1), 9)]
    rows += [("gap", "g1", dt.datetime(2024, 1, 1), 1), ("gap", "g2", dt.datetime(2024, 6, 1), 2)]
    df = spark.createDataFrame(rows, EV)
    for bucket in (60, 3600, 86400 * 365):
        got = {
            r["id"]: r["prev_v"]
            for r in previous_in_sequence(df, "k", "t", "id", ["v"], bucket_seconds=bucket).collect()
        }
        assert got == _brute_lag(rows)


def test_previous_in_sequence_skips_null_key_and_time(spark):
    rows = [("a", "1", dt.datetime(2024, 1, 1), 1), (None, "2", dt.datetime(2024, 1, 1), 2), ("a", "3", None, 3)]
    got = previous_in_sequence(spark.createDataFrame(rows, EV), "k", "t", "id", ["v"]).collect()
    assert [(r["id"], r["prev_v"]) for r in got] == [("1", None)]


def _brute_asof(left, right):
    out = {}
    for lk, lid, lt, _ in left:
        best = None
        for rk, rid, rt, rv in right:
            if lk is not None and lt is not None and rk == lk and rt is not None and rt <= lt:
                if best is None or (rt, rid) > (best[0], best[1]):
                    best = (rt, rid, rv)
        out[lid] = best[2] if best else None
    return out


def test_asof_join_matches_brute_force(spark):
    left = _random_events(300, ["a", "b", "c", "d"], seed=2, hot="hot")
    right = [(k, "r" + i, t, v) for k, i, t, v in _random_events(300, ["a", "b", "c", "e"], seed=3, hot="hot")]
    # Equal times count as "at or before"; a NULL-key and a NULL-time left row get no match.
    right.append(("a", "rz", dt.datetime(2024, 1, 2, 0, 0, 0), 7))
    left.append(("a", "lz", dt.datetime(2024, 1, 2, 0, 0, 0), 0))
    left.append((None, "lnull", dt.datetime(2024, 1, 3), 0))
    left.append(("a", "lnotime", None, 0))
    l_df = spark.createDataFrame(left, EV)
    r_df = spark.createDataFrame(right, EV).select(
        F.col("k").alias("rk"), F.col("id").alias("rid"), F.col("t").alias("rt"), F.col("v").alias("rv")
    )
    for bucket in (600, 3600, 86400 * 30):
        got = asof_join(l_df, r_df, "k", "t", "rt", ["rv"], right_tie="rid", right_by="rk", bucket_seconds=bucket)
        res = {r["id"]: r["rv"] for r in got.collect()}
        assert len(res) == len(left)
        assert res == _brute_asof(left, right)
    assert res["lz"] == 7


def test_asof_join_key_attrs_reach_every_keyed_row(spark):
    left = spark.createDataFrame(
        [("a", "1", dt.datetime(2024, 1, 1), 0), ("a", "2", None, 0), ("z", "3", dt.datetime(2024, 1, 1), 0)], EV
    )
    right = spark.createDataFrame([], EV).select(F.col("k"), F.col("t").alias("rt"), F.col("v").alias("rv"))
    attrs = spark.createDataFrame([("a", "x")], "k string, attr string")
    got = {r["id"]: r["attr"] for r in asof_join(left, right, "k", "t", "rt", ["rv"], key_attrs=attrs).collect()}
    assert got == {"1": "x", "2": "x", "3": None}


def test_interval_join_matches_brute_force(spark):
    left = _random_events(200, ["a", "b"], seed=4, span_hours=30)
    right = [(k, "r" + i, t, v) for k, i, t, v in _random_events(200, ["a", "b"], seed=5, span_hours=30)]
    l_df = spark.createDataFrame(left, EV)
    r_df = spark.createDataFrame(right, EV).select(
        F.col("k").alias("rk"), F.col("id").alias("rid"), F.col("t").alias("rt")
    )
    got = {
        (r["id"], r["rid"])
        for r in interval_join(l_df, r_df, "k", "t", "rt", 3600, right_by="rk").select("id", "rid").collect()
    }
    want = {
        (li, ri)
        for lk, li, lt, _ in left
        for rk, ri, rt, _ in right
        if lk == rk and rt <= lt and int(lt.timestamp()) - int(rt.timestamp()) <= 3600
    }
    assert got == want


def test_hot_key_is_spread_over_tasks(spark):
    """A user holding 40 % of the rows must not land in one task: rows are partitioned by
    (user, hour), so the hot user's hours are hashed across partitions."""
    rows = _random_events(3000, [f"u{i}" for i in range(50)], seed=7, span_hours=400, hot="hot")
    df = spark.createDataFrame(rows, EV)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = previous_in_sequence(df, "k", "t", "id", ["v"], bucket_seconds=3600).withColumn("pid", F.spark_partition_id())
        hot = out.filter(F.col("k") == "hot")
        parts = hot.select("pid").distinct().count()
        total = hot.count()
        biggest = hot.groupBy("pid").count().agg(F.max("count")).collect()[0][0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert biggest < total / 2


def test_asof_hot_key_is_spread_over_tasks(spark):
    left = _random_events(3000, [f"u{i}" for i in range(50)], seed=8, span_hours=400, hot="hot")
    right = [(k, "r" + i, t, v) for k, i, t, v in _random_events(1000, ["hot", "u1"], seed=9, span_hours=400)]
    l_df = spark.createDataFrame(left, EV)
    r_df = spark.createDataFrame(right, EV).select(
        F.col("k").alias("rk"), F.col("id").alias("rid"), F.col("t").alias("rt"), F.col("v").alias("rv")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = asof_join(l_df, r_df, "k", "t", "rt", ["rv"], right_tie="rid", right_by="rk")
        hot = out.withColumn("pid", F.spark_partition_id()).filter(F.col("k") == "hot")
        total = hot.count()
        biggest = hot.groupBy("pid").count().agg(F.max("count")).collect()[0][0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert biggest < total / 2
