"""Behavioural login features: IP change events, latest login, latest MFA change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators.sequence import DEFAULT_BUCKET_SECONDS, previous_in_sequence


def ip_changes(logins: DataFrame, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """One row per login whose IP differs from the user's previous login (by time, then login_id).

    A user's first login never counts. Columns: user_id, new_ip, ip_change_time, ip_lat, ip_lon,
    login_id. The per-user ``lag`` runs bucketed (see ``operators.sequence``).
    """
    seq = previous_in_sequence(
        logins.select("user_id", "login_id", "login_time", "ip_address", "latitude", "longitude"),
        by="user_id",
        time_col="login_time",
        tie_col="login_id",
        cols=["ip_address"],
        bucket_seconds=bucket_seconds,
    )
    changed = F.col("prev_ip_address").isNotNull() & (F.col("ip_address") != F.col("prev_ip_address"))
    return seq.filter(F.coalesce(changed, F.lit(False))).select(
        "user_id",
        F.col("ip_address").alias("new_ip"),
        F.col("login_time").alias("ip_change_time"),
        F.col("latitude").alias("ip_lat"),
        F.col("longitude").alias("ip_lon"),
        "login_id",
    )


def latest_login(logins: DataFrame) -> DataFrame:
    """Latest login per user (by time, then login_id): user_id, ip_address, device_id, last_login_time.

    An arg-max aggregate rather than ``row_number() = 1``: it combines map-side, so the shuffle
    carries one row per user per task and a hot user costs nothing extra.
    """
    order = F.struct(F.col("login_time"), F.col("login_id"))
    latest = F.max_by(F.struct("ip_address", "device_id", "login_time"), order)
    return (
        logins.filter(F.col("login_time").isNotNull())
        .groupBy("user_id")
        .agg(latest.alias("l"))
        .select(
            "user_id",
            F.col("l.ip_address").alias("ip_address"),
            F.col("l.device_id").alias("device_id"),
            F.col("l.login_time").alias("last_login_time"),
        )
    )


def latest_mfa(logins: DataFrame) -> DataFrame:
    """Time of each user's latest MFA change: user_id, last_mfa_change."""
    return (
        logins.filter(F.col("mfa_changed"))
        .groupBy("user_id")
        .agg(F.max("login_time").alias("last_mfa_change"))
    )


def user_login_state(logins: DataFrame) -> DataFrame:
    """``latest_login`` and ``latest_mfa`` in one aggregation pass (one shuffle, one join later)."""
    order = F.when(F.col("login_time").isNotNull(), F.struct(F.col("login_time"), F.col("login_id")))
    latest = F.max_by(F.struct("ip_address", "device_id", "login_time"), order)
    return logins.groupBy("user_id").agg(
        latest.getField("ip_address").alias("ip_address"),
        latest.getField("device_id").alias("device_id"),
        latest.getField("login_time").alias("last_login_time"),
        F.max(F.when(F.col("mfa_changed"), F.col("login_time"))).alias("last_mfa_change"),
    )
