"""One user holding a third of all events: results stay exact and the work stays spread.

The sf0.01 events are rewritten so every third event belongs to user 0, in Spark and in a DuckDB
view over the same Parquet file; silver (as-of) and impossible travel are compared with the oracle
SQL, and the hot user's rows must not sit in a single task.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskflow.operators.travel import impossible_travel
from riskflow.plans import oracle, silver
from riskflow.sources import fixtures
from tests.conftest import SF01
from tests.oracle_check import digest, duck, duck_rows, spark_rows

HOT = "event_id % 3 = 0"


def _skewed(spark):
    events = fixtures.table(spark, SF01, "events").withColumn(
        "user_id", F.when(F.expr(HOT), F.lit(0)).otherwise(F.col("user_id")).cast("bigint")
    )
    return fixtures.transactions_from_events(events), fixtures.logins_from_events(events)


def _skewed_duck():
    con = duck(SF01)
    con.execute(
        f"""CREATE OR REPLACE VIEW events AS
        SELECT event_id, ts, CASE WHEN {HOT} THEN 0 ELSE user_id END AS user_id, event_type, value, props
        FROM read_parquet('{SF01}/events.parquet')"""
    )
    return con


def test_hot_user_results_match_oracle(spark):
    txns, logins = _skewed(spark)
    con = _skewed_duck()
    hot_share = txns.filter(F.col("user_id") == "USER-00000").count() / txns.count()
    assert hot_share > 0.3
    for df, sql in (
        (silver.user_activity(txns, logins), oracle.BASE + "SELECT * FROM silver"),
        (impossible_travel(logins), oracle.BASE + "SELECT * FROM travel"),
    ):
        scols, srows = spark_rows(df)
        dcols, drows = duck_rows(con, sql)
        assert scols == dcols
        assert len(srows) == len(drows)
        assert digest(srows) == digest(drows)


def test_hot_user_is_spread_over_tasks(spark):
    txns, logins = _skewed(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # The month of data has 30 day buckets; with years of it, weeks would do as well.
        out = silver.user_activity(txns, logins, bucket_seconds=86_400).withColumn("pid", F.spark_partition_id())
        # All columns are read: a plan pruned to the counted ones would leave the windows out.
        pids = [r["pid"] for r in out.collect() if r["user_id"] == "USER-00000"]
        per_task = [pids.count(p) for p in set(pids)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(per_task) < 0.25 * sum(per_task)
