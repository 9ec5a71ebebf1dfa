"""Triage state operators: upsert, merge, queue, reviews, sync, change feed."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskflow.operators import triage
from riskflow.schemas import REVIEW_DECISION, TRIAGE, TRIAGE_UPDATE

D = dt.datetime


def gold(spark, rows):
    return spark.createDataFrame(rows, TRIAGE)


def row(tid, user="u", score=10.0, level="LOW", action="APPROVE", status="PENDING", created=D(2024, 1, 1), by=None):
    return (tid, user, score, level, action, "r", created, status, by, None, created)


def test_upsert_keeps_review_fields_and_inserts_defaults(spark):
    state = triage.to_operational(gold(spark, [row("t1", status="APPROVED", by="ann"), row("t2")]))
    updates = spark.createDataFrame(
        [("t1", "other-user", 90.0, "CRITICAL", "BLOCK", "new"), ("t3", "u3", 55.0, "MEDIUM", "MONITOR", "x")],
        TRIAGE_UPDATE,
    )
    out = {r["transaction_id"]: r for r in triage.upsert_triage(state, updates, "2024-02-01 00:00:00").collect()}
    assert out["t1"]["user_id"] == "u" and out["t1"]["review_status"] == "APPROVED" and out["t1"]["reviewed_by"] == "ann"
    assert out["t1"]["risk_score"] == 90.0 and out["t1"]["action_timestamp"] == D(2024, 2, 1)
    assert out["t1"]["created_at"] == D(2024, 1, 1)
    assert out["t2"]["risk_score"] == 10.0 and out["t2"]["action_timestamp"] == D(2024, 1, 1)
    assert out["t3"]["review_status"] == "PENDING" and out["t3"]["created_at"] == D(2024, 2, 1)


def test_upsert_duplicate_update_keys(spark):
    state = triage.to_operational(gold(spark, [row("t1")]))
    dup = spark.createDataFrame(
        [("t9", "u", 1.0, "LOW", "APPROVE", "a"), ("t9", "u", 2.0, "LOW", "APPROVE", "b")], TRIAGE_UPDATE
    )
    with pytest.raises(Exception, match="duplicate update key"):
        triage.upsert_triage(state, dup, "2024-02-01").collect()
    seq = dup.withColumn("seq", F.when(F.col("action_reason") == "b", 2).otherwise(1))
    out = triage.upsert_triage(state, seq, "2024-02-01", order=["seq"]).filter("transaction_id = 't9'").collect()
    assert [r["action_reason"] for r in out] == ["b"]


def test_merge_replaces_all_columns_and_is_idempotent(spark):
    target = gold(spark, [row("t1", status="APPROVED", by="ann"), row("t2")])
    source = gold(spark, [row("t1", score=80.0), row("t3")])
    once = triage.merge_gold(target, source)
    got = {r["transaction_id"]: r for r in once.collect()}
    assert set(got) == {"t1", "t2", "t3"}
    assert got["t1"]["review_status"] == "PENDING" and got["t1"]["reviewed_by"] is None and got["t1"]["risk_score"] == 80.0
    twice = triage.merge_gold(once, source)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_merge_rejects_duplicate_source_keys(spark):
    target = gold(spark, [row("t1")])
    source = gold(spark, [row("t1", score=1.0), row("t1", score=2.0)])
    with pytest.raises(Exception, match="duplicate merge source key"):
        triage.merge_gold(target, source).collect()


def test_review_queue_filter_order_ties_and_limit(spark):
    rows = [row(f"t{i:03d}", action="CHALLENGE" if i % 2 else "MONITOR", created=D(2024, 1, 1 + i % 5)) for i in range(150)]
    rows += [row("blocked", action="BLOCK", created=D(2030, 1, 1)), row("done", action="CHALLENGE", status="APPROVED", created=D(2030, 1, 1))]
    q = triage.review_queue(gold(spark, rows)).collect()
    assert len(q) == 100
    keys = [(r["created_at"], r["transaction_id"]) for r in q]
    assert keys == sorted(keys, key=lambda k: (-k[0].timestamp(), k[1]))
    assert {"blocked", "done"}.isdisjoint(r["transaction_id"] for r in q)


def test_apply_reviews_mapping_defaults_and_unknown_ids(spark):
    state = triage.to_operational(gold(spark, [row("t1"), row("t2"), row("t3"), row("t4")]))
    decisions = spark.createDataFrame(
        [
            ("t1", "ALLOW", None, "ok", D(2024, 1, 5), 1),
            ("t2", "BLOCK", "", None, D(2024, 1, 5), 1),
            ("t3", "ESCALATE", "bob", None, D(2024, 1, 5), 1),
            ("t3", "ALLOW", "bob", "later", D(2024, 1, 6), 2),
            ("t4", None, "bob", None, None, 1),
            ("nope", "ALLOW", "x", None, D(2024, 1, 5), 1),
        ],
        "transaction_id string, action string, reviewed_by string, notes string, decided_at timestamp_ntz, decision_id long",
    )
    out = {r["transaction_id"]: r for r in triage.apply_reviews(state, decisions, "2024-02-01").collect()}
    assert set(out) == {"t1", "t2", "t3", "t4"}
    assert (out["t1"]["review_status"], out["t1"]["reviewed_by"], out["t1"]["review_notes"]) == ("APPROVED", "analyst", "ok")
    assert (out["t2"]["review_status"], out["t2"]["reviewed_by"]) == ("REJECTED", "analyst")
    assert (out["t3"]["review_status"], out["t3"]["review_notes"]) == ("APPROVED", "later")
    assert out["t4"]["review_status"] == "ESCALATED" and out["t4"]["review_timestamp"] == D(2024, 2, 1)


def test_sync_then_fpr_sees_reviews(spark):
    from riskflow.plans.kpis import false_positive_ratio

    g = gold(spark, [row("t1", action="BLOCK"), row("t2", action="CHALLENGE")])
    op = triage.to_operational(g)
    decisions = spark.createDataFrame(
        [("t1", "ALLOW", "ann", None, D(2024, 1, 2), 1), ("t2", "BLOCK", "ann", None, D(2024, 1, 2), 1)],
        REVIEW_DECISION.add("decision_id", "long"),
    )
    synced = triage.sync_reviews(g, triage.apply_reviews(op, decisions, "2024-02-01"))
    assert false_positive_ratio(g).collect()[0]["total_flagged"] == 0
    r = false_positive_ratio(synced).collect()[0]
    assert (r["false_positive_ratio"], r["total_flagged"]) == (0.5, 2)


def test_snapshot_diff_then_apply_changes_reproduces_new(spark):
    old = gold(spark, [row("t1"), row("t2"), row("t3", by=None)])
    new = gold(spark, [row("t1"), row("t2", score=99.0), row("t4")])
    diff = triage.snapshot_diff(old, new, ["transaction_id"])
    kinds = sorted((r["transaction_id"], r["_change_type"]) for r in diff.collect())
    assert kinds == [("t2", "update_postimage"), ("t2", "update_preimage"), ("t3", "delete"), ("t4", "insert")]
    applied = triage.apply_changes(old, diff, ["transaction_id"])
    assert sorted(map(tuple, applied.collect())) == sorted(map(tuple, new.collect()))


def test_key_checks_composite_and_null_keys_and_naive_as_of(spark):
    target = spark.createDataFrame([("k", "1", 1)], "a string, b string, v int")
    changes = spark.createDataFrame(
        [("k", "1", 2, "update_postimage"), ("k", "1", 3, "update_postimage")], "a string, b string, v int, _change_type string"
    )
    with pytest.raises(Exception, match="duplicate change key: k, 1"):
        triage.apply_changes(target, changes, ["a", "b"]).collect()
    state = triage.to_operational(gold(spark, [row("t1")]))
    nullkey = spark.createDataFrame(
        [(None, "u", 1.0, "LOW", "APPROVE", "a")],
        "transaction_id string, user_id string, risk_score double, risk_level string, automated_action string, action_reason string",
    )
    with pytest.raises(Exception, match="NULL update key"):
        triage.upsert_triage(state, nullkey, "2024-02-01").collect()
    # A naive datetime is a wall-clock value, whatever the session time zone.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = triage.gold_rows(
            spark.createDataFrame([("t", "u", 1.0, "LOW", "APPROVE", "r")], "transaction_id string, user_id string, risk_score double, risk_level string, automated_action string, reason string"),
            D(2024, 2, 1),
        ).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got["action_timestamp"] == D(2024, 2, 1)
