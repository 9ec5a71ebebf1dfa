"""One explicit schema per relation. Nothing in the package infers a schema from rows."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Raw CSV files: every column is read as a string, then typed by the bronze step.
RAW_TRANSACTIONS = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField("user_id", StringType()),
        StructField("amount", StringType()),
        StructField("merchant_id", StringType()),
        StructField("transaction_type", StringType()),
        StructField("timestamp", StringType()),
    ]
)

RAW_LOGINS = StructType(
    [
        StructField("login_id", StringType()),
        StructField("user_id", StringType()),
        StructField("ip_address", StringType()),
        StructField("timestamp", StringType()),
        StructField("mfa_change_flag", StringType()),
        StructField("latitude", StringType()),
        StructField("longitude", StringType()),
        StructField("city", StringType()),
        StructField("device_id", StringType()),
    ]
)

# Canonical typed inputs of the feature operators.
TRANSACTIONS = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField("user_id", StringType()),
        StructField("amount", DoubleType()),
        StructField("merchant_id", StringType()),
        StructField("transaction_type", StringType()),
        StructField("transaction_time", TimestampNTZType()),
    ]
)

LOGINS = StructType(
    [
        StructField("login_id", StringType()),
        StructField("user_id", StringType()),
        StructField("ip_address", StringType()),
        StructField("login_time", TimestampNTZType()),
        StructField("mfa_changed", BooleanType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("city", StringType()),
        StructField("device_id", StringType()),
    ]
)

USER_ACTIVITY = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField("user_id", StringType()),
        StructField("amount", DoubleType()),
        StructField("merchant_id", StringType()),
        StructField("transaction_type", StringType()),
        StructField("transaction_time", TimestampNTZType()),
        StructField("ip_address", StringType()),
        StructField("device_id", StringType()),
        StructField("ip_changed_recently", BooleanType()),
        StructField("minutes_since_ip_change", DoubleType()),
        StructField("mfa_change_flag", BooleanType()),
        StructField("high_value_wire", BooleanType()),
        StructField("wire_over_10k_within_1h_ip_change", BooleanType()),
        StructField("ip_latitude", DoubleType()),
        StructField("ip_longitude", DoubleType()),
    ]
)

IMPOSSIBLE_TRAVEL = StructType(
    [
        StructField("user_id", StringType()),
        StructField("login_time", TimestampNTZType()),
        StructField("prev_time", TimestampNTZType()),
        StructField("minutes_between_logins", DoubleType()),
        StructField("miles_traveled", DoubleType()),
        StructField("ip_address", StringType()),
        StructField("city", StringType()),
    ]
)

FRAUD_SIGNATURES = StructType(
    [
        StructField("signature_id", StringType(), False),
        StructField("signature_type", StringType(), False),
        StructField("description", StringType(), False),
        StructField("risk_weight", DoubleType(), True),
    ]
)

# Gold triage table (analytics copy). Times are zone-less like the source tables.
TRIAGE = StructType(
    [
        StructField("transaction_id", StringType(), False),
        StructField("user_id", StringType(), False),
        StructField("risk_score", DoubleType(), False),
        StructField("risk_level", StringType(), False),
        StructField("automated_action", StringType(), False),
        StructField("action_reason", StringType(), True),
        StructField("action_timestamp", TimestampNTZType(), True),
        StructField("review_status", StringType(), True),
        StructField("reviewed_by", StringType(), True),
        StructField("review_timestamp", TimestampNTZType(), True),
        StructField("created_at", TimestampNTZType(), True),
    ]
)

TRIAGE_COLUMNS = [f.name for f in TRIAGE.fields]

# Operational triage state carries the review notes the review step writes.
OPERATIONAL_TRIAGE = StructType(TRIAGE.fields + [StructField("review_notes", StringType(), True)])

# Upsert input of the operational store.
TRIAGE_UPDATE = StructType(
    [
        StructField("transaction_id", StringType(), False),
        StructField("user_id", StringType(), False),
        StructField("risk_score", DoubleType(), False),
        StructField("risk_level", StringType(), False),
        StructField("automated_action", StringType(), False),
        StructField("action_reason", StringType(), True),
    ]
)

REVIEW_DECISION = StructType(
    [
        StructField("transaction_id", StringType(), False),
        StructField("action", StringType(), True),
        StructField("reviewed_by", StringType(), True),
        StructField("notes", StringType(), True),
        StructField("decided_at", TimestampNTZType(), True),
    ]
)

# Reply of an external scorer, after parsing.
SCORER_REPLY = StructType(
    [
        StructField("risk_score", DoubleType()),
        StructField("risk_level", StringType()),
        StructField("reason", StringType()),
        StructField("matched_signatures", ArrayType(StringType())),
    ]
)

# Source tables of the test folders (declared, so reads need no schema inference).
SOURCE_TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
