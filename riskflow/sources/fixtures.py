"""Adapters from the shared test tables to the pipeline's relations.

The pipeline's own inputs (transactions, logins, triage) do not exist in the test tables, so they
are derived, deterministically and over whole tables, from ``events`` and ``orders``. Each adapter
is a projection plus a pushed-down filter on one Parquet scan; no shuffle.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.constants import FRAUD_SIGNATURE_ROWS
from riskflow.schemas import FRAUD_SIGNATURES, SOURCE_TABLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source table; declared schemas skip schema inference (no footer reads at plan time)."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    if name in SOURCE_TABLES:
        return spark.read.schema(SOURCE_TABLES[name]).parquet(path)
    return spark.read.parquet(path)


def _padded(prefix: str, col: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(col.cast("string"), width, "0"))


def _k() -> Column:
    # The integer in the JSON ``props`` column.
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Purchases become transactions (TXN-%08d, USER-%05d, amount = value * 200)."""
    k = _k()
    return events.filter(F.col("event_type") == "purchase").select(
        _padded("TXN-", F.col("event_id"), 8).alias("transaction_id"),
        _padded("USER-", F.col("user_id"), 5).alias("user_id"),
        (F.col("value") * 200.0).alias("amount"),
        _padded("MERCHANT-", k % 50, 3).alias("merchant_id"),
        F.when(k % 4 == 0, "wire")
        .when(k % 4 == 1, "ach")
        .when(k % 4 == 2, "pos")
        .otherwise("card")
        .alias("transaction_type"),
        F.col("ts").alias("transaction_time"),
    )


def _by_event_mod5(values: list) -> Column:
    m = F.col("event_id") % 5
    expr = F.when(m == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:-1], start=1):
        expr = expr.when(m == i, F.lit(v))
    return expr.otherwise(F.lit(values[-1]))


def logins_from_events(events: DataFrame) -> DataFrame:
    """Every non-purchase event is a login; signups are MFA changes; five fixed cities."""
    k = _k()
    return events.filter(F.col("event_type") != "purchase").select(
        _padded("LOGIN-", F.col("event_id"), 8).alias("login_id"),
        _padded("USER-", F.col("user_id"), 5).alias("user_id"),
        F.concat(F.lit("10.0.0."), (k % 8).cast("string")).alias("ip_address"),
        F.col("ts").alias("login_time"),
        (F.col("event_type") == "signup").alias("mfa_changed"),
        _by_event_mod5([38.72, -1.29, 43.65, 34.69, -12.05]).cast("double").alias("latitude"),
        _by_event_mod5([-9.14, 36.82, -79.38, 135.5, -77.04]).cast("double").alias("longitude"),
        _by_event_mod5(["Lisbon", "Nairobi", "Toronto", "Osaka", "Lima"]).alias("city"),
        _padded("device-", k % 20, 3).alias("device_id"),
    )


def triage_from_orders(orders: DataFrame) -> DataFrame:
    """Orders become a reviewed triage table (score from total price, status from order status)."""
    price = F.col("o_totalprice")

    def band(critical: str, high: str, medium: str, low: str) -> Column:
        return (
            F.when(price >= 425000, critical)
            .when(price >= 350000, high)
            .when(price >= 250000, medium)
            .otherwise(low)
        )

    return orders.select(
        _padded("TXN-", F.col("o_orderkey"), 8).alias("transaction_id"),
        _padded("USER-", F.col("o_custkey"), 5).alias("user_id"),
        (price / 5000.0).alias("risk_score"),
        band("CRITICAL", "HIGH", "MEDIUM", "LOW").alias("risk_level"),
        band("BLOCK", "CHALLENGE", "MONITOR", "APPROVE").alias("automated_action"),
        F.col("o_orderpriority").alias("action_reason"),
        F.col("o_orderdate").alias("action_timestamp"),
        F.when(F.col("o_orderkey") % 7 == 0, "ESCALATED")
        .when(F.col("o_orderstatus") == "F", "APPROVED")
        .when(F.col("o_orderstatus") == "O", "REJECTED")
        .otherwise("PENDING")
        .alias("review_status"),
        F.lit(None).cast("string").alias("reviewed_by"),
        F.lit(None).cast("timestamp_ntz").alias("review_timestamp"),
        F.col("o_orderdate").alias("created_at"),
    )


def decisions_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Each line item is an analyst decision on its order's transaction (several per key: the
    latest wins). Return flag A → ALLOW, R → BLOCK, else ESCALATE; finished lines name a clerk."""
    return lineitem.select(
        _padded("TXN-", F.col("l_orderkey"), 8).alias("transaction_id"),
        F.when(F.col("l_returnflag") == "A", "ALLOW")
        .when(F.col("l_returnflag") == "R", "BLOCK")
        .otherwise("ESCALATE")
        .alias("action"),
        F.when(F.col("l_linestatus") == "F", _padded("clerk-", F.col("l_suppkey"), 3)).alias("reviewed_by"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("notes"),
        F.col("l_shipdate").alias("decided_at"),
        F.col("l_linenumber").cast("long").alias("decision_id"),
    )


def fraud_signatures(spark: SparkSession) -> DataFrame:
    """The fixed 6-row signature dimension (a literal relation; its size is bounded by the code)."""
    return spark.createDataFrame(FRAUD_SIGNATURE_ROWS, FRAUD_SIGNATURES)


class Relations(dict):
    """The pipeline relations over one scale-factor folder, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        spark, d = self._spark, self._dir
        if name in ("transactions", "logins"):
            events = table(spark, d, "events")
            df = transactions_from_events(events) if name == "transactions" else logins_from_events(events)
        elif name == "triage":
            df = triage_from_orders(table(spark, d, "orders"))
        elif name == "decisions":
            df = decisions_from_lineitem(table(spark, d, "lineitem"))
        elif name == "signatures":
            df = fraud_signatures(spark)
        else:
            raise KeyError(name)
        self[name] = df
        return df


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The pipeline relations over one scale-factor folder (transactions, logins, triage,
    decisions, signatures), built lazily on first access."""
    return Relations(spark, sf_dir)
