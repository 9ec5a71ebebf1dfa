"""Impossible travel: consecutive logins of a user too far apart for the time between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.constants import TRAVEL_MILES_THRESHOLD, TRAVEL_MINUTES_THRESHOLD
from riskflow.functions.geo import miles_between
from riskflow.functions.timefn import minutes_between
from riskflow.operators.sequence import DEFAULT_BUCKET_SECONDS, previous_in_sequence


def login_pairs(logins: DataFrame, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Each login that has a user and a time, with the user's previous login (by time, then
    login_id; NULL ids first).

    Columns: user_id, login_id, login_time, prev_time, minutes_diff (whole seconds / 60,
    unrounded), miles_diff (unrounded), ip_address, city. A user's first login has NULL
    prev_time, minutes_diff and miles_diff.
    """
    seq = previous_in_sequence(
        logins.select(
            "user_id",
            "login_id",
            "login_time",
            "ip_address",
            "city",
            F.col("latitude").alias("lat"),
            F.col("longitude").alias("lon"),
        ),
        by="user_id",
        time_col="login_time",
        tie_col="login_id",
        cols=["lat", "lon", "login_time"],
        bucket_seconds=bucket_seconds,
    )
    return seq.select(
        "user_id",
        "login_id",
        "login_time",
        F.col("prev_login_time").alias("prev_time"),
        minutes_between("login_time", "prev_login_time").alias("minutes_diff"),
        miles_between("prev_lat", "prev_lon", "lat", "lon").alias("miles_diff"),
        "ip_address",
        "city",
    )


def impossible_travel(
    logins: DataFrame,
    miles: float = TRAVEL_MILES_THRESHOLD,
    minutes: float = TRAVEL_MINUTES_THRESHOLD,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """``impossible_travel_flags``: consecutive logins >= ``miles`` apart within <= ``minutes``.

    Thresholds apply to unrounded values; only the output is rounded to 2 places.
    """
    pairs = login_pairs(logins, bucket_seconds)
    return pairs.filter(
        F.col("minutes_diff").isNotNull()
        & (F.col("minutes_diff") <= F.lit(float(minutes)))
        & (F.col("miles_diff") >= F.lit(float(miles)))
    ).select(
        "user_id",
        "login_time",
        "prev_time",
        F.round("minutes_diff", 2).alias("minutes_between_logins"),
        F.round("miles_diff", 2).alias("miles_traveled"),
        "ip_address",
        "city",
    )
