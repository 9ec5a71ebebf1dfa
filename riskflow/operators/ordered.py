"""One ordered pass over a user's logins and transactions.

IP changes, impossible travel, the as-of change of each transaction and the user's latest login all follow
from one (user, time) order. ``ordered_context`` unions both inputs, shuffles the rows once on (user, time
bucket) and computes everything inside a bucket by windows over one sort. What crosses buckets is one
summary row for each user and bucket: those are ordered by user, and each bucket gets back what came before it
(and what holds for the user as a whole). A bucket is a week by default, so that summaries are few; a user
with a third of all rows is spread over the buckets.

The bucket's first login has its predecessor in an earlier bucket. Whether it is an IP change is settled from the
summaries, so an as-of match is, in this order: the latest change in the bucket after its first login; the
first login itself, if it turns out to be a change; the latest change of the buckets before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskflow.constants import TRAVEL_MILES_THRESHOLD, TRAVEL_MINUTES_THRESHOLD
from riskflow.functions.geo import miles_between
from riskflow.functions.timefn import minutes_between, time_bucket
from riskflow.operators.sequence import DEFAULT_BUCKET_SECONDS

#: Transactions without a time match no change; they are dealt over so many buckets of their own.
TIMELESS_BUCKETS = 64
CONTEXT_COLUMNS = ["ip_change_time", "ip_lat", "ip_lon", "ip_address", "device_id", "last_mfa_change", "has_travel_flag"]


def _is_change(login: Column, before: Column) -> Column:
    return F.coalesce(before["ip_address"].isNotNull() & (login["ip_address"] != before["ip_address"]), F.lit(False))


def _is_travel(login: Column, before: Column, miles: float, minutes: float) -> Column:
    near = minutes_between(login["login_time"], before["login_time"]) <= F.lit(float(minutes))
    far = miles_between(before["latitude"], before["longitude"], login["latitude"], login["longitude"]) >= F.lit(float(miles))
    return F.coalesce(near & far, F.lit(False))


def _change(login: Column) -> Column:
    return F.struct(login["login_time"].alias("ip_change_time"), login["latitude"].alias("ip_lat"), login["longitude"].alias("ip_lon"))


def bucket_summaries(rows: DataFrame, miles: float, minutes: float) -> DataFrame:
    """Adds to the union of both sides what the windows inside a bucket give, up to and with each row."""
    order = Window.partitionBy("__key", "__bucket").orderBy(F.col("__t").asc_nulls_first(), "__side", F.col("__id").asc_nulls_first())
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    login, prev = F.col("__login"), F.col("__prev")
    rows = rows.withColumns({"__prev": F.last("__login", ignorenulls=True).over(before), "__tail": F.lead(F.lit(1)).over(order).isNull()})
    rows = rows.withColumns(
        {
            "__first": F.first("__login", ignorenulls=True).over(upto),
            "__latest": F.last("__login", ignorenulls=True).over(upto),
            "__mfa": F.max(F.when(login["mfa_changed"], login["login_time"])).over(upto),
            "__change": F.last(F.when(login.isNotNull() & _is_change(login, prev), _change(login)), ignorenulls=True).over(upto),
            "__travel": F.max(login.isNotNull() & _is_travel(login, prev, miles, minutes)).over(upto),
        }
    )
    return rows.drop("__prev")


def ordered_context(
    transactions: DataFrame,
    logins: DataFrame,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    miles: float = TRAVEL_MILES_THRESHOLD,
    minutes: float = TRAVEL_MINUTES_THRESHOLD,
) -> DataFrame:
    """Every transaction once, with ``CONTEXT_COLUMNS``: its user's latest IP change at or before it (time, place), the
    user's latest login (``ip_address``, ``device_id``) and MFA change overall, and whether the user has an
    impossible-travel pair.

    Logins are ordered by time, then ``login_id`` (NULL ids first); those without a user or a time take no part. A change
    at the very time of a transaction counts as before it. Transactions without a user get NULLs and false; without a
    time no change.
    """
    clash = set(transactions.columns) & set(CONTEXT_COLUMNS)
    if clash:
        raise ValueError(f"context columns clash with transaction columns: {sorted(clash)}")
    names = transactions.columns
    login = F.struct("login_time", "ip_address", "device_id", "mfa_changed", F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"))
    timeless = F.pmod(F.xxhash64("transaction_id"), F.lit(TIMELESS_BUCKETS)) - F.lit(2**40)
    keyless = transactions.filter("user_id is null")
    txn_type = StructType(transactions.schema.fields)
    left = transactions.filter("user_id is not null").select(
        F.col("user_id").alias("__key"), F.coalesce(time_bucket("transaction_time", bucket_seconds), timeless).alias("__bucket"),
        F.col("transaction_time").alias("__t"), F.lit(1).alias("__side"), F.lit(None).cast("string").alias("__id"),
        F.struct(*names).alias("__txn"),
    )
    right = logins.filter("user_id is not null and login_time is not null").select(
        F.col("user_id").alias("__key"), time_bucket("login_time", bucket_seconds).alias("__bucket"),
        F.col("login_time").alias("__t"), F.lit(0).alias("__side"), F.col("login_id").alias("__id"), login.alias("__login"),
    )
    rows = left.withColumn("__login", F.lit(None).cast(right.schema["__login"].dataType)).unionByName(right.withColumn("__txn", F.lit(None).cast(txn_type)))
    rows = bucket_summaries(rows, miles, minutes)

    # Summaries also carry the transaction of their row, which the output reads in a branch that never applies: both
    # uses of the union then need the same columns, and Spark shuffles it once.
    tails = rows.filter("__tail").select("__key", "__bucket", "__first", "__latest", "__mfa", "__change", "__travel", F.col("__txn").alias("__tail_txn"))
    user = Window.partitionBy("__key").orderBy("__bucket")
    earlier, whole = user.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("__key")
    first, prev = F.col("__first"), F.col("__prev")
    tails = tails.withColumn("__prev", F.last("__latest", ignorenulls=True).over(earlier))
    tails = tails.withColumns(
        {
            "__first_change": F.when(first.isNotNull() & _is_change(first, prev), _change(first)),
            "__any_travel": F.coalesce("__travel", F.lit(False)) | (first.isNotNull() & _is_travel(first, prev, miles, minutes)),
        }
    )
    tails = tails.withColumns(
        {
            "__prev_change": F.last(F.coalesce("__change", "__first_change"), ignorenulls=True).over(earlier),
            # The last in bucket order, over the whole user.
            "__user_latest": F.max_by("__latest", F.when(F.col("__latest").isNotNull(), F.col("__bucket"))).over(whole),
            "__user_mfa": F.max("__mfa").over(whole),
            "__user_travel": F.max("__any_travel").over(whole),
        }
    )
    carried = tails.select("__key", "__bucket", "__first_change", "__prev_change", "__user_latest", "__user_mfa", "__user_travel", "__tail_txn")

    joined = rows.filter("__side = 1").join(carried, ["__key", "__bucket"], "left")
    txn = F.when(F.col("__side") == 1, F.col("__txn")).otherwise(F.col("__tail_txn"))
    change = F.coalesce(F.col("__change"), F.when(F.col("__first").isNotNull(), F.col("__first_change")), F.col("__prev_change"))
    change = F.when(F.col("__t").isNotNull(), change)
    out = joined.select(
        *[txn.getField(c).alias(c) for c in names],
        *[change.getField(c).alias(c) for c in ("ip_change_time", "ip_lat", "ip_lon")],
        F.col("__user_latest.ip_address").alias("ip_address"), F.col("__user_latest.device_id").alias("device_id"),
        F.col("__user_mfa").alias("last_mfa_change"), F.coalesce("__user_travel", F.lit(False)).alias("has_travel_flag"),
    )
    kinds = {f.name: f.dataType for f in out.schema.fields}
    nulls = {c: F.lit(None).cast(kinds[c]) for c in CONTEXT_COLUMNS} | {"has_travel_flag": F.lit(False)}
    return out.unionByName(keyless.select(*names, *[nulls[c].alias(c) for c in CONTEXT_COLUMNS]))
