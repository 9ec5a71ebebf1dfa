"""The table-backed pipeline gives the same results as the registered (single-plan) queries."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskflow.plans import jobs
from riskflow.plans.oracle import AS_OF
from riskflow.sources import fixtures
from tests.conftest import SF001


def _same(a, b):
    return a.count() == b.count() and a.exceptAll(b.select(*a.columns)).count() == 0


def test_pipeline_matches_queries(spark):
    rel = fixtures.load(spark, SF001)
    names = jobs.Names(prefix=f"p{uuid.uuid4().hex[:6]}_")
    jobs.run_pipeline(spark, rel["transactions"], rel["logins"], AS_OF, names, bucket_count=4)
    q = entry.queries()
    assert _same(spark.table(names.activity), q["silver_asof"](spark, SF001))
    assert _same(spark.table(names.travel), q["impossible_travel"](spark, SF001))
    # Gold starts empty, so after one run it holds exactly the scored batch.
    assert _same(spark.table(names.gold), q["score_batch"](spark, SF001))
    ato = spark.table(f"{names.view('v_account_takeover_rate')}").collect()[0]
    want = q["account_takeover_rate"](spark, SF001).collect()[0]
    assert tuple(ato) == tuple(want)
    assert _same(spark.table(f"{names.view('v_wire_10k_mfa_24h')}"), q["wire_10k_mfa_24h"](spark, SF001))
    fpr = spark.table(f"{names.view('v_false_positive_ratio')}").collect()[0]
    assert fpr["total_flagged"] == 0 and fpr["false_positive_ratio"] is None  # nothing reviewed yet

    # Another session reads all three views, and C4 keeps its IN under OR (an existence join).
    other = spark.newSession()
    assert tuple(other.table(names.view("v_account_takeover_rate")).collect()[0]) == tuple(want)
    assert other.table(names.view("v_wire_10k_mfa_24h")).count() > 0 and other.table(names.view("v_false_positive_ratio")).count() == 1
    assert "ExistenceJoin" in spark.table(names.view("v_account_takeover_rate"))._jdf.queryExecution().toString()

    # A second run merges the same keys again: gold is unchanged; operational keeps one row per key.
    # It starts after a crash between the two renames of a swap: the state is recovered, not lost.
    before = spark.table(names.gold).count()
    spark.sql(f"ALTER TABLE {names.gold} RENAME TO {names.gold}__previous")
    jobs.score_and_store(spark, names, AS_OF)
    assert spark.table(names.gold).count() == before
    op = spark.table(names.operational)
    assert op.count() == op.select("transaction_id").distinct().count() == before
    assert op.filter(F.col("review_status") != "PENDING").count() == 0


@pytest.mark.parametrize("in_buckets", [False, True])
def test_pipeline_reviews_reach_the_fpr_view(spark, in_buckets):
    import datetime as dt

    rel = fixtures.load(spark, SF001)
    names = jobs.Names(prefix=f"r{uuid.uuid4().hex[:6]}_")
    jobs.run_pipeline(spark, rel["transactions"], rel["logins"], AS_OF, names)
    if in_buckets:
        jobs.keep_in_buckets(spark, names, 8)
    # Allow every BLOCK/CHALLENGE and block everything else: FPR = flagged share of the reviewed.
    gold = spark.table(names.gold)
    decisions = gold.select(
        "transaction_id",
        F.when(F.col("automated_action").isin("BLOCK", "CHALLENGE"), "ALLOW").otherwise("BLOCK").alias("action"),
        F.lit("ann").alias("reviewed_by"),
        F.lit(None).cast("string").alias("notes"),
        F.lit(dt.datetime(2024, 2, 2)).cast("timestamp_ntz").alias("decided_at"),
    )
    total = gold.count()
    flagged = gold.filter(F.col("automated_action").isin("BLOCK", "CHALLENGE")).count()
    jobs.apply_review_decisions(spark, names, decisions, AS_OF)
    fpr = spark.table(f"{names.view('v_false_positive_ratio')}").collect()[0]
    assert fpr["total_flagged"] == total
    assert fpr["false_positive_ratio"] == flagged / total
    assert spark.table(names.gold).filter(F.col("reviewed_by") != "ann").count() == 0
