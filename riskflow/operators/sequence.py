"""Per-key ordered operators that stay parallel when one key holds a large share of the rows.

A plain ``Window.partitionBy(user)`` puts every row of a user into one task, so a user with a third
of all logins becomes a third of the job in one task. Both operators here partition by
``(key, time bucket)`` instead. The only per-key step runs on a one-row-per-bucket summary, and the big
side is shuffled once, on ``(key, bucket)``; the joins back to the summary reuse that partitioning. Results
are the same for any width. A week, the default, leaves few summaries where a key has several rows a week;
a narrower bucket spreads a hot key over more tasks.

Rows whose key or time is NULL are not ordered and take part in no sequence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from riskflow.functions.timefn import time_bucket

DEFAULT_BUCKET_SECONDS = 7 * 86_400

_B = "__bucket"
_NO_TIME_BUCKET = -(2**62)


def _ordered(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def previous_in_sequence(
    df: DataFrame,
    by: str,
    time_col: str,
    tie_col: str,
    cols: Sequence[str],
    prefix: str = "prev_",
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """``lag(c)`` for each ``c`` in ``cols`` over ``partitionBy(by).orderBy(time_col, tie_col)``.

    Adds ``prefix + c`` columns (NULL on a key's first row). Rows with a NULL key or time are
    dropped. Plan: one shuffle of ``df`` on (by, bucket) feeding one Window that yields both the
    in-bucket ``lag`` and each bucket's last row (where ``lead`` is NULL). Only those bucket tails
    are shuffled by key to find each bucket's predecessor, and joined back on (by, bucket).
    """
    base = df.filter(F.col(by).isNotNull() & F.col(time_col).isNotNull()).withColumn(
        _B, time_bucket(time_col, bucket_seconds)
    )
    payload = F.struct(*[F.col(c).alias(c) for c in cols])
    w_in = Window.partitionBy(by, _B).orderBy(*_ordered([time_col, tie_col]))
    rows = base.withColumns(
        {
            "__prev_in": F.lag(payload).over(w_in),
            "__is_tail": F.lead(F.lit(1)).over(w_in).isNull(),
            "__self": payload,
        }
    )
    tails = rows.filter("__is_tail").select(by, _B, F.col("__self").alias("__last"))
    carried = tails.withColumn(
        "__prev_bucket", F.lag("__last").over(Window.partitionBy(by).orderBy(_B))
    ).select(by, _B, "__prev_bucket")

    joined = rows.join(carried, [by, _B], "left")
    prev = F.coalesce(F.col("__prev_in"), F.col("__prev_bucket"))
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[prev.getField(c).alias(prefix + c) for c in cols],
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_time: str,
    right_time: str,
    right_cols: Sequence[str],
    right_tie: str | None = None,
    right_by: str | None = None,
    key_attrs: DataFrame | None = None,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """Left as-of join: each left row with the latest right row of the same key at or before it.

    ``right.right_time <= left.left_time``; among right rows with equal times the greatest
    ``right_tie`` wins. Returns every left row once, plus ``right_cols`` (NULL when no match). No
    pairs are formed: both sides are unioned, shuffled once on (key, bucket), and one Window carries
    the last right row forward inside the bucket and marks each bucket's tail. The tails (one row
    per key and bucket) are shuffled by key to carry values across buckets and joined back.

    ``key_attrs`` (one row per key, keyed by ``by``) is an optional N:1 left join fused into the
    same plan: it is joined to the small per-bucket tails, so the left rows are still shuffled
    only once.
    """
    right_by = right_by or by
    lcols = left.columns
    clash = set(lcols) & set(right_cols)
    if clash:
        raise ValueError(f"right columns clash with left columns: {sorted(clash)}")
    # Equal-time right rows need a total order: the tie column, else the payload itself.
    tie = F.col(right_tie) if right_tie else F.struct(*[F.col(c).alias(c) for c in right_cols])
    # Types for the typed NULLs of each side, from the inputs' schemas (no extra analysis).
    lschema, rschema = left.schema, right.schema
    tie_type = (
        rschema[right_tie].dataType
        if right_tie
        else StructType([StructField(c, rschema[c].dataType, True) for c in right_cols])
    )
    payload_struct = StructType([StructField(c, rschema[c].dataType, True) for c in right_cols])

    payload_type = F.struct(*[F.col(c).alias(c) for c in right_cols])
    # Left rows without a key match nothing; they skip the union and are appended at the end.
    # Filtering them explicitly also keeps both consumers of the union identical (see below).
    keyless = left.filter(F.col(by).isNull())
    left = left.filter(F.col(by).isNotNull())
    lname = {c: f"__l{i}" for i, c in enumerate(lcols)}
    l_side = left.select(
        F.col(by).alias("__key"),
        F.col(left_time).alias("__t"),
        F.lit(1).alias("__side"),
        F.lit(None).cast(tie_type).alias("__tie"),
        *[F.col(c).alias(lname[c]) for c in lcols],
        F.lit(None).cast(payload_struct).alias("__r"),
    )
    r_side = right.filter(F.col(right_by).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(right_by).alias("__key"),
        F.col(right_time).alias("__t"),
        F.lit(0).alias("__side"),
        tie.alias("__tie"),
        *[F.lit(None).cast(lschema[c].dataType).alias(lname[c]) for c in lcols],
        payload_type.alias("__r"),
    )
    # Left rows without a time still need their key attributes: give them a sentinel bucket.
    u = l_side.unionByName(r_side).withColumn(
        _B, F.coalesce(time_bucket("__t", bucket_seconds), F.lit(_NO_TIME_BUCKET))
    )

    # Right rows sort before left rows at equal times, so "at or before" includes equality.
    order = Window.partitionBy("__key", _B).orderBy(*_ordered(["__t", "__side", "__tie"]))
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    win = u.withColumns(
        {
            "__in": F.last("__r", ignorenulls=True).over(running),
            "__is_tail": F.lead(F.lit(1)).over(order).isNull(),
        }
    )
    rows = win.filter(F.col("__side") == 1).withColumnRenamed("__side", "__row_side")
    # The tails also carry the left columns of their tail row, which the output reads only in a
    # branch that never applies (``__row_side`` is always 1). Both consumers of the union then need
    # the same columns, so Spark plans one shuffle of the union and reuses it for both.
    tail_l = {c: f"__t{lname[c]}" for c in lcols}
    tails = win.filter("__is_tail").select(
        "__key", _B, F.col("__in").alias("__last"), *[F.col(lname[c]).alias(tail_l[c]) for c in lcols]
    )
    carried = tails.withColumn(
        "__before",
        F.last("__last", ignorenulls=True).over(
            Window.partitionBy("__key").orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
        ),
    ).drop("__last")
    attr_cols: list[str] = []
    if key_attrs is not None:
        attr_cols = [c for c in key_attrs.columns if c != by]
        clash = (set(attr_cols) & set(lcols)) | (set(attr_cols) & set(right_cols))
        if clash:
            raise ValueError(f"key attribute columns clash: {sorted(clash)}")
        attrs = key_attrs.select(F.col(by).alias("__key"), F.struct(*attr_cols).alias("__attrs"))
        carried = carried.join(attrs, "__key", "left")

    joined = rows.join(carried, ["__key", _B], "left")
    matched = F.when(
        F.col("__key").isNotNull() & F.col("__t").isNotNull(),
        F.coalesce(F.col("__in"), F.col("__before")),
    )
    is_row = F.col("__row_side") == 1
    out = joined.select(
        *[F.when(is_row, F.col(lname[c])).otherwise(F.col(tail_l[c])).alias(c) for c in lcols],
        *[matched.getField(c).alias(c) for c in right_cols],
        *[F.col("__attrs").getField(c).alias(c) for c in attr_cols],
    )
    attr_types = {c: key_attrs.schema[c].dataType for c in attr_cols} if key_attrs is not None else {}
    null_types = {**{c: rschema[c].dataType for c in right_cols}, **attr_types}
    nulls = keyless.select(
        *lcols,
        *[F.lit(None).cast(null_types[c]).alias(c) for c in right_cols + attr_cols],
    )
    return out.unionByName(nulls)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_time: str,
    right_time: str,
    lookback_seconds: int,
    right_by: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Pairs (left, right) of the same key with ``left_time - lookback <= right_time <= left_time``.

    A range join done as an equi-join on (key, bucket): each right row is copied into the buckets
    its window reaches (at most ``lookback / bucket + 2``), so a hot key is spread over its time
    buckets instead of forming one key-wide product. Whole-second arithmetic is used for the
    window, matching ``unix_timestamp`` semantics. ``how``: inner, left, left_semi or left_anti
    (right rows are copied per bucket, so right-preserving joins are not offered). Output columns:
    the left columns, then the right columns (the right key is dropped when it has the left key's
    name).
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"interval_join supports inner/left/left_semi/left_anti, not {how!r}")
    right_by = right_by or by
    bucket = max(int(lookback_seconds), 1)
    r = right.filter(F.col(right_by).isNotNull() & F.col(right_time).isNotNull())
    r = r.withColumnsRenamed({right_by: "__rk", right_time: "__rt"})
    r_start = F.floor(F.unix_timestamp("__rt") / bucket).cast("long")
    r_end = F.floor((F.unix_timestamp("__rt") + F.lit(lookback_seconds)) / bucket).cast("long")
    r = r.withColumn("__rb", F.explode(F.sequence(r_start, r_end)))
    l_ = left.withColumn("__lb", F.floor(F.unix_timestamp(left_time) / bucket).cast("long"))
    diff = F.unix_timestamp(F.col(left_time)) - F.unix_timestamp(F.col("__rt"))
    cond = (
        (F.col(by) == F.col("__rk"))
        & (F.col("__lb") == F.col("__rb"))
        & (F.col(left_time) >= F.col("__rt"))
        & (diff <= F.lit(lookback_seconds))
    )
    out = l_.join(r, cond, how).drop("__lb", "__rb")
    if how in ("left_semi", "left_anti"):
        return out
    out = out.withColumnRenamed("__rt", right_time)
    return out.drop("__rk") if right_by == by else out.withColumnRenamed("__rk", right_by)
