"""Silver user activity: transactions enriched with login context and rule flags.

Three forms of the IP-change enrichment:

* ``asof`` (default) — the latest IP change at or before each transaction; one row per transaction.
* ``all`` — every IP change at or before the transaction (the source pipeline's exact join); one
  row per (transaction, earlier change). Its size grows with the square of a user's history, so
  it is meant for parity checks, not as an input to keyed stores.
* ``interval`` — only changes inside the recency window before the transaction; one row per
  (transaction, change in the window), plus unmatched transactions once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.constants import (
    HIGH_VALUE_AMOUNT,
    MFA_RECENT_DAYS,
    RECENT_IP_CHANGE_MINUTES,
    WIRE_TYPE,
)
from riskflow.functions.timefn import day_diff, minutes_between
from riskflow.operators.features import ip_changes, user_login_state
from riskflow.operators.ordered import ordered_context
from riskflow.operators.sequence import DEFAULT_BUCKET_SECONDS, asof_join, interval_join

ACTIVITY_COLUMNS = [
    "transaction_id",
    "user_id",
    "amount",
    "merchant_id",
    "transaction_type",
    "transaction_time",
    "ip_address",
    "device_id",
    "ip_changed_recently",
    "minutes_since_ip_change",
    "mfa_change_flag",
    "high_value_wire",
    "wire_over_10k_within_1h_ip_change",
    "ip_latitude",
    "ip_longitude",
]


def high_value_wire(type_col="transaction_type", amount_col="amount") -> Column:
    """``type = 'wire' AND amount >= 10000`` with SQL three-valued logic kept: a NULL type gives
    NULL when the amount test is true or NULL, and false when the amount is below 10,000."""
    return (F.col(type_col) == F.lit(WIRE_TYPE)) & (F.col(amount_col) >= F.lit(HIGH_VALUE_AMOUNT))


def _with_flags(df: DataFrame, mfa_mode: str, extra: list[str] | None = None) -> DataFrame:
    minutes = F.when(
        F.col("ip_change_time").isNotNull(),
        F.round(minutes_between("transaction_time", "ip_change_time"), 2),
    )
    recent = F.when(
        F.col("ip_change_time").isNotNull() & (F.col("minutes_since_ip_change") <= RECENT_IP_CHANGE_MINUTES),
        True,
    ).otherwise(False)
    if mfa_mode == "calendar":
        mfa = F.when(
            F.col("last_mfa_change").isNotNull()
            & (day_diff("transaction_time", "last_mfa_change") <= MFA_RECENT_DAYS),
            True,
        ).otherwise(False)
    elif mfa_mode == "trailing_24h":
        mfa = F.when(
            F.col("last_mfa_change").isNotNull()
            & (minutes_between("transaction_time", "last_mfa_change") <= 24 * 60),
            True,
        ).otherwise(False)
    else:
        raise ValueError(f"unknown mfa_mode {mfa_mode!r}")
    return (
        df.withColumn("minutes_since_ip_change", minutes)
        .withColumns(
            {
                "ip_changed_recently": recent,
                "mfa_change_flag": mfa,
                "high_value_wire": high_value_wire(),
            }
        )
        .withColumn(
            "wire_over_10k_within_1h_ip_change",
            F.col("high_value_wire") & F.col("ip_changed_recently"),
        )
        .withColumnsRenamed({"ip_lat": "ip_latitude", "ip_lon": "ip_longitude"})
        .select(*ACTIVITY_COLUMNS, *(extra or []))
    )


def travel_flags(travel: DataFrame) -> DataFrame:
    """``user_id, has_travel_flag``: one row per user with an impossible-travel flag."""
    return (
        travel.select("user_id").where(F.col("user_id").isNotNull()).distinct()
        .withColumn("has_travel_flag", F.lit(True))
    )


def user_activity(
    transactions: DataFrame,
    logins: DataFrame,
    ip_mode: str = "asof",
    mfa_mode: str = "calendar",
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    with_travel: bool = False,
) -> DataFrame:
    """``silver_user_activity`` (15 columns; ``with_travel`` adds the user's ``has_travel_flag``).

    ``ip_address``/``device_id`` come from the user's latest login overall and ``ip_latitude``/
    ``ip_longitude`` from the matched IP change, as in the source pipeline. ``mfa_mode='calendar'``
    keeps the source rule (latest MFA change at most one calendar day before — or any time after —
    the transaction); ``'trailing_24h'`` uses the latest MFA change in the 24 hours before it.
    """
    if ip_mode == "asof":
        # One ordered pass over both inputs gives the change, the latest login and the travel flag.
        enriched = ordered_context(transactions, logins, bucket_seconds)
        if mfa_mode == "trailing_24h":
            enriched = enriched.drop("last_mfa_change")
        extra = ["has_travel_flag"] if with_travel else []
        return _with_flags(_trailing_mfa(enriched, logins, mfa_mode, bucket_seconds), mfa_mode, extra)
    if with_travel:
        raise ValueError("with_travel needs ip_mode='asof'")
    state = user_login_state(logins).select("user_id", "ip_address", "device_id", "last_mfa_change")
    if mfa_mode == "trailing_24h":
        state = state.drop("last_mfa_change")
    changes = ip_changes(logins, bucket_seconds).select(
        "user_id", "ip_change_time", "ip_lat", "ip_lon", F.col("login_id").alias("change_login_id")
    )
    if ip_mode == "all":
        ch = changes.withColumnRenamed("user_id", "ip_user_id").drop("change_login_id")
        with_state = transactions.join(state, "user_id", "left")
        cond = (with_state["user_id"] == ch["ip_user_id"]) & (
            with_state["transaction_time"] >= ch["ip_change_time"]
        )
        enriched = with_state.join(ch, cond, "left").drop("ip_user_id")
    elif ip_mode == "interval":
        ch = changes.withColumnRenamed("user_id", "ip_user_id").drop("change_login_id")
        with_state = transactions.join(state, "user_id", "left")
        enriched = interval_join(
            with_state,
            ch,
            by="user_id",
            right_by="ip_user_id",
            left_time="transaction_time",
            right_time="ip_change_time",
            lookback_seconds=int(RECENT_IP_CHANGE_MINUTES * 60),
            how="left",
        ).drop("ip_user_id")
    else:
        raise ValueError(f"unknown ip_mode {ip_mode!r}")

    return _with_flags(_trailing_mfa(enriched, logins, mfa_mode, bucket_seconds), mfa_mode)


def _trailing_mfa(enriched: DataFrame, logins: DataFrame, mfa_mode: str, bucket_seconds: int) -> DataFrame:
    """For ``trailing_24h``: the latest MFA change at or before each transaction."""
    if mfa_mode != "trailing_24h":
        return enriched
    mfa_events = logins.filter(F.col("mfa_changed")).select(
        "user_id", F.col("login_time").alias("last_mfa_change"), F.col("login_id").alias("mfa_login_id")
    )
    return asof_join(
        enriched, mfa_events, by="user_id", left_time="transaction_time", right_time="last_mfa_change",
        right_cols=["last_mfa_change"], right_tie="mfa_login_id", bucket_seconds=bucket_seconds,
    )
