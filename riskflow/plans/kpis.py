"""Certified KPI views over silver and gold relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.constants import FPR_FLAGGED_ACTIONS, FPR_REVIEWED_STATUSES, HIGH_VALUE_AMOUNT, WIRE_TYPE

SKETCH_LG_K = 14


def false_positive_ratio(triage: DataFrame) -> DataFrame:
    """Among reviewed rows (APPROVED or REJECTED): the share approved although the automated action
    was BLOCK or CHALLENGE, and the number of reviewed rows. The ratio is NULL when none were
    reviewed. One global aggregate (partial per task, one final row)."""
    reviewed = triage.filter(F.col("review_status").isin(*FPR_REVIEWED_STATUSES))
    approved_flagged = F.count(
        F.when(
            (F.col("review_status") == "APPROVED") & F.col("automated_action").isin(*FPR_FLAGGED_ACTIONS),
            1,
        )
    )
    total = F.count(F.lit(1))
    return reviewed.agg(
        (approved_flagged.cast("double") / F.nullif(total, F.lit(0)).cast("double")).alias(
            "false_positive_ratio"
        ),
        total.alias("total_flagged"),
    )


def _takeovers(activity: DataFrame, travel: DataFrame | None) -> DataFrame:
    """The events of ``account_takeover_rate``."""
    if "has_travel_flag" in activity.columns:
        marked, flag = activity, F.col("has_travel_flag")
    elif travel is None:
        raise ValueError("pass the impossible-travel flags (travel=...) or an activity with has_travel_flag")
    else:
        flagged_users = travel.select("user_id").where(F.col("user_id").isNotNull()).distinct().select(
            "user_id", F.lit(True).alias("__traveller")
        )
        marked, flag = activity.join(flagged_users, "user_id", "left"), F.col("__traveller")
    cond = (F.col("mfa_change_flag") & F.col("high_value_wire")) | F.coalesce(flag, F.lit(False))
    return marked.filter(cond)


def account_takeover_rate(activity: DataFrame, travel: DataFrame | None = None) -> DataFrame:
    """Distinct users and events where (MFA flag AND high-value wire) OR the user has an
    impossible-travel flag.

    The ``IN (subquery)`` under ``OR`` becomes a left-semi membership column: the distinct flagged
    users (an aggregate of the travel table) are left-joined as a marker, which Spark plans as a
    shuffle or a broadcast depending on the runtime size of that user set. When the activity
    already carries ``has_travel_flag`` (see ``silver.user_activity(..., with_travel=True)``) no join is needed.
    """
    return _takeovers(activity, travel).agg(
        F.countDistinct("user_id").alias("ato_user_count"),
        F.count(F.lit(1)).alias("ato_event_count"),
    )


def takeover_days(activity: DataFrame, travel: DataFrame | None = None) -> DataFrame:
    """``account_takeover_rate`` by day: (day, ato_event_count, ato_user_count, users), the counts exact and
    ``users`` a mergeable HLL sketch of the distinct users. Events without a time have a NULL day."""
    return _takeovers(activity, travel).groupBy(F.to_date("transaction_time").alias("day")).agg(
        F.count(F.lit(1)).alias("ato_event_count"),
        F.countDistinct("user_id").alias("ato_user_count"),
        F.hll_sketch_agg("user_id", SKETCH_LG_K).alias("users"),
    )


def refresh_days(kept: DataFrame, new: DataFrame) -> DataFrame:
    """``kept`` with the days of ``new`` replaced. A user who gets a travel flag turns events of earlier
    days into takeovers: recompute the days of that user's events too."""
    days = new.select(F.col("day").alias("__day"))
    return kept.join(days, kept["day"].eqNullSafe(F.col("__day")), "left_anti").unionByName(new)


def takeovers_from_days(days: DataFrame) -> DataFrame:
    """(ato_user_estimate, ato_event_count) of any set of days, from their rows alone: events exact, users
    within a relative standard error of about 0.7 % (1 / sqrt(2 ^ ``SKETCH_LG_K``)) when there are many."""
    return days.agg(
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("users")), F.lit(0)).cast("long").alias("ato_user_estimate"),
        F.coalesce(F.sum("ato_event_count"), F.lit(0)).alias("ato_event_count"),
    )


def wire_10k_mfa_24h(activity: DataFrame) -> DataFrame:
    """Wires of at least 10,000 whose user has the MFA flag."""
    return activity.filter(
        (F.col("transaction_type") == WIRE_TYPE)
        & (F.col("amount") >= HIGH_VALUE_AMOUNT)
        & (F.col("mfa_change_flag") == F.lit(True))
    ).select(
        "transaction_id",
        "user_id",
        "amount",
        "transaction_time",
        "mfa_change_flag",
        "ip_changed_recently",
    )
