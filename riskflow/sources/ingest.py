"""Bronze ingestion: header CSV files → typed relations (batch and streaming readers).

Schemas are explicit (no inference pass over the data) and malformed values become NULL
(``try_*``) instead of failing the job under ANSI mode; ``operators.quality`` counts them.
CSV with an explicit schema is splittable, so a large file is read by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.constants import MFA_TRUE_STRING
from riskflow.functions.timefn import parse_timestamp
from riskflow.schemas import RAW_LOGINS, RAW_TRANSACTIONS


def read_raw_transactions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_TRANSACTIONS).option("header", True).csv(path)


def read_raw_logins(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_LOGINS).option("header", True).csv(path)


def stream_raw_transactions(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_TRANSACTIONS).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def stream_raw_logins(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_LOGINS).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def bronze_transactions(raw: DataFrame) -> DataFrame:
    """Raw strings → typed transactions (amount double, transaction_time zone-less timestamp)."""
    return raw.select(
        "transaction_id",
        "user_id",
        F.col("amount").try_cast("double").alias("amount"),
        "merchant_id",
        "transaction_type",
        parse_timestamp("timestamp").alias("transaction_time"),
    )


def bronze_logins(raw: DataFrame) -> DataFrame:
    """Raw strings → typed logins (mfa flag 'True' → true, coordinates double)."""
    return raw.select(
        "login_id",
        "user_id",
        "ip_address",
        parse_timestamp("timestamp").alias("login_time"),
        (F.col("mfa_change_flag") == F.lit(MFA_TRUE_STRING)).alias("mfa_changed"),
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        "city",
        "device_id",
    )


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return bronze_transactions(read_raw_transactions(spark, path))


def read_logins(spark: SparkSession, path: str) -> DataFrame:
    return bronze_logins(read_raw_logins(spark, path))


_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def to_raw_transactions(transactions: DataFrame) -> DataFrame:
    """Typed transactions → the raw CSV layout (second-resolution timestamp strings)."""
    return transactions.select(
        "transaction_id",
        "user_id",
        F.col("amount").cast("string").alias("amount"),
        "merchant_id",
        "transaction_type",
        F.date_format("transaction_time", _TS_FORMAT).alias("timestamp"),
    )


def to_raw_logins(logins: DataFrame) -> DataFrame:
    return logins.select(
        "login_id",
        "user_id",
        "ip_address",
        F.date_format("login_time", _TS_FORMAT).alias("timestamp"),
        F.when(F.col("mfa_changed"), F.lit("True")).otherwise(F.lit("False")).alias("mfa_change_flag"),
        F.col("latitude").cast("string").alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"),
        "city",
        "device_id",
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)
