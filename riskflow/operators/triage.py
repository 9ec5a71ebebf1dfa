"""Keyed triage state: upsert, merge, review queue, review decisions, sync, change feed.

Every operator returns the new state as a DataFrame; ``sources.tables.publish`` writes it. All
joins are on the unique key ``transaction_id``, so there is no key skew. Repeated runs against a
large state should keep the state bucketed by the key (``publish(..., bucket_by=...)``): the state
side of these joins is then read without a shuffle and only the (smaller) change side moves.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.constants import (
    DEFAULT_REVIEWER,
    PENDING,
    QUEUE_ACTIONS,
    QUEUE_SIZE,
    REVIEW_ACTION_TO_STATUS,
    REVIEW_OTHER_STATUS,
)
from riskflow.schemas import OPERATIONAL_TRIAGE, TRIAGE_COLUMNS

KEY = "transaction_id"
OPERATIONAL_COLUMNS = [f.name for f in OPERATIONAL_TRIAGE.fields]


def _ts(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    if isinstance(as_of, dt.datetime):
        # Wall-clock value as given: never through the driver's or the session's time zone.
        return F.lit(as_of.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple (arg-max, combined map-side).

    Rows equal on ``order`` are ranked by their remaining columns (NULL lowest), so the choice is
    deterministic whatever the input order."""
    cols = df.columns
    rest = [c for c in cols if c != key and c not in order]
    best = F.max_by(F.struct(*cols), F.struct(*[F.col(c) for c in order + rest]))
    return df.groupBy(key).agg(best.alias("__row")).select(*[F.col("__row").getField(c).alias(c) for c in cols])


def unique_by_key(df: DataFrame, key, what: str) -> DataFrame:
    """``df`` unchanged, but the job fails if a key occurs twice or is NULL (checked lazily, in
    the plan). ``key``: a column name or a list of them.

    The aggregation partitions by the key, which the following keyed join reuses.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = df.columns
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*cols)).alias("__row"))
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    checked = F.when(any_null, F.raise_error(F.concat(F.lit(f"NULL {what} key: "), shown))).when(
        F.col("__n") > 1, F.raise_error(F.concat(F.lit(f"duplicate {what} key: "), shown))
    )
    first = keys[0]
    return agg.select(
        *[
            (
                F.coalesce(checked.cast(df.schema[c].dataType), F.col("__row").getField(c))
                if c == first
                else F.col("__row").getField(c)
            ).alias(c)
            for c in cols
        ]
    )


def to_operational(triage: DataFrame) -> DataFrame:
    """Gold-shaped rows as operational state (adds an empty ``review_notes``)."""
    if "review_notes" in triage.columns:
        return triage.select(*OPERATIONAL_COLUMNS)
    return triage.withColumn("review_notes", F.lit(None).cast("string")).select(*OPERATIONAL_COLUMNS)


def upsert_triage(state: DataFrame, updates: DataFrame, as_of, order: list[str] | None = None) -> DataFrame:
    """Operational upsert (INSERT … ON CONFLICT DO UPDATE), set-based.

    New key: inserted with defaults (review_status PENDING, action_timestamp and created_at =
    ``as_of``). Existing key: risk_score, risk_level, automated_action, action_reason replaced and
    action_timestamp = ``as_of``; user_id, review fields and created_at kept. Duplicate update keys
    keep the greatest ``order`` tuple if given, else the job fails.
    """
    now = _ts(as_of)
    upd_cols = ["transaction_id", "user_id", "risk_score", "risk_level", "automated_action", "action_reason"]
    if order:
        u = latest_per_key(updates.select(*upd_cols, *[c for c in order if c not in upd_cols]), KEY, order)
    else:
        u = unique_by_key(updates.select(*upd_cols), KEY, "update")
    u = u.select(*[F.col(c).alias("u_" + c) for c in upd_cols])
    s = state.select(*OPERATIONAL_COLUMNS)
    j = s.join(u, s[KEY] == u["u_" + KEY], "full_outer")
    matched_u = F.col("u_" + KEY).isNotNull()
    new = F.col(KEY).isNull()

    def pick(col: str, on_update: Column, on_insert: Column) -> Column:
        return F.when(new, on_insert).when(matched_u, on_update).otherwise(F.col(col)).alias(col)

    return j.select(
        F.coalesce(F.col(KEY), F.col("u_" + KEY)).alias(KEY),
        pick("user_id", F.col("user_id"), F.col("u_user_id")),
        pick("risk_score", F.col("u_risk_score"), F.col("u_risk_score")),
        pick("risk_level", F.col("u_risk_level"), F.col("u_risk_level")),
        pick("automated_action", F.col("u_automated_action"), F.col("u_automated_action")),
        pick("action_reason", F.col("u_action_reason"), F.col("u_action_reason")),
        pick("action_timestamp", now, now),
        pick("review_status", F.col("review_status"), F.lit(PENDING)),
        pick("reviewed_by", F.col("reviewed_by"), F.lit(None).cast("string")),
        pick("review_timestamp", F.col("review_timestamp"), F.lit(None).cast("timestamp_ntz")),
        pick("created_at", F.col("created_at"), now),
        pick("review_notes", F.col("review_notes"), F.lit(None).cast("string")),
    )


def merge_gold(target: DataFrame, source: DataFrame) -> DataFrame:
    """Keyed MERGE (update all columns when matched, insert when not).

    Source keys must be unique (a matched duplicate is an error under MERGE rules; the job fails).
    Plan: the source is aggregated by key (the uniqueness check), the target anti-joined to it on
    the same partitioning, and the source appended.
    """
    src = unique_by_key(source.select(*TRIAGE_COLUMNS), KEY, "merge source")
    kept = target.select(*TRIAGE_COLUMNS).join(src.select(KEY), KEY, "left_anti")
    return kept.unionByName(src)


def gold_rows(scored: DataFrame, as_of) -> DataFrame:
    """Gold triage rows from scored transactions: PENDING, no reviewer, stamped with ``as_of``."""
    now = _ts(as_of)
    return scored.select(
        KEY,
        "user_id",
        F.col("risk_score").cast("double").alias("risk_score"),
        "risk_level",
        "automated_action",
        F.col("reason").alias("action_reason"),
        now.alias("action_timestamp"),
        F.lit(PENDING).alias("review_status"),
        F.lit(None).cast("string").alias("reviewed_by"),
        F.lit(None).cast("timestamp_ntz").alias("review_timestamp"),
        now.alias("created_at"),
    )


QUEUE_COLUMNS = [
    "transaction_id",
    "user_id",
    "risk_score",
    "risk_level",
    "automated_action",
    "action_reason",
    "review_status",
    "created_at",
]


def review_queue(state: DataFrame, n: int = QUEUE_SIZE) -> DataFrame:
    """Pending CHALLENGE/MONITOR items, newest first (ties by transaction_id), first ``n``.

    Planned as a top-k (each task keeps its best ``n``; one small final merge)."""
    return (
        state.filter((F.col("review_status") == PENDING) & F.col("automated_action").isin(*QUEUE_ACTIONS))
        .orderBy(F.col("created_at").desc_nulls_last(), F.col(KEY).asc())
        .limit(n)
        .select(*QUEUE_COLUMNS)
    )


def review_status_for(action: Column) -> Column:
    """ALLOW → APPROVED, BLOCK → REJECTED, anything else (incl. NULL) → ESCALATED."""
    expr = None
    for act, status in REVIEW_ACTION_TO_STATUS:
        expr = F.when(action == act, status) if expr is None else expr.when(action == act, status)
    return expr.otherwise(REVIEW_OTHER_STATUS)


def apply_reviews(state: DataFrame, decisions: DataFrame, as_of) -> DataFrame:
    """Apply analyst decisions (keyed UPDATE). The latest decision per key wins (by decided_at,
    then decision_id); reviewer defaults to ``analyst`` (also for an empty name); review_timestamp
    is the decision time, else ``as_of``. Decisions for unknown keys change nothing."""
    order = [c for c in ("decided_at", "decision_id") if c in decisions.columns]
    d = latest_per_key(decisions, KEY, order) if order else unique_by_key(decisions, KEY, "decision")
    decided = (
        F.col("decided_at").cast("timestamp_ntz") if "decided_at" in decisions.columns else F.lit(None).cast("timestamp_ntz")
    )
    d = d.select(
        F.col(KEY).alias("d_key"),
        review_status_for(F.col("action")).alias("d_status"),
        F.coalesce(F.nullif(F.col("reviewed_by"), F.lit("")), F.lit(DEFAULT_REVIEWER)).alias("d_by"),
        F.col("notes").alias("d_notes"),
        F.coalesce(decided, _ts(as_of)).alias("d_at"),
    )
    s = to_operational(state)
    j = s.join(d, s[KEY] == d["d_key"], "left")
    hit = F.col("d_key").isNotNull()
    repl = {
        "review_status": "d_status",
        "reviewed_by": "d_by",
        "review_notes": "d_notes",
        "review_timestamp": "d_at",
    }
    return j.select(
        *[
            (F.when(hit, F.col(repl[c])).otherwise(F.col(c)) if c in repl else F.col(c)).alias(c)
            for c in OPERATIONAL_COLUMNS
        ]
    )


def sync_reviews(gold: DataFrame, operational: DataFrame) -> DataFrame:
    """Copy review_status, reviewed_by, review_timestamp from the operational store to gold."""
    o = operational.select(
        F.col(KEY).alias("o_key"),
        F.col("review_status").alias("o_status"),
        F.col("reviewed_by").alias("o_by"),
        F.col("review_timestamp").alias("o_at"),
    )
    g = gold.select(*TRIAGE_COLUMNS)
    j = g.join(o, g[KEY] == o["o_key"], "left")
    hit = F.col("o_key").isNotNull()
    repl = {"review_status": "o_status", "reviewed_by": "o_by", "review_timestamp": "o_at"}
    return j.select(
        *[(F.when(hit, F.col(repl[c])).otherwise(F.col(c)) if c in repl else F.col(c)).alias(c) for c in TRIAGE_COLUMNS]
    )


CHANGE_TYPE = "_change_type"


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Change rows between two snapshots: insert, delete, update_preimage, update_postimage.

    One full outer join on the keys; rows compare null-safely as whole structs."""
    cols = [c for c in new.columns]
    o = old.select(*keys, F.struct(*cols).alias("__o"))
    n = new.select(*keys, F.struct(*cols).alias("__n"))
    j = o.join(n, keys, "full_outer")
    change = (
        F.when(F.col("__o").isNull(), F.array(F.lit("insert")))
        .when(F.col("__n").isNull(), F.array(F.lit("delete")))
        .when(~F.col("__o").eqNullSafe(F.col("__n")), F.array(F.lit("update_preimage"), F.lit("update_postimage")))
    )
    rows = j.withColumn("__ct", F.explode(change))
    image = F.when(F.col("__ct").isin("delete", "update_preimage"), F.col("__o")).otherwise(F.col("__n"))
    return rows.select(*[image.getField(c).alias(c) for c in cols], F.col("__ct").alias(CHANGE_TYPE))


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Apply a change feed by key: delete removes, insert / update_postimage upsert (whole row);
    preimages are ignored. Changes for one key must not repeat (the job fails)."""
    cols = target.columns
    effective = changes.filter(F.col(CHANGE_TYPE).isin("insert", "delete", "update_postimage"))
    effective = unique_by_key(effective.select(*cols, CHANGE_TYPE), keys, "change")
    kept = target.join(effective.select(*keys), keys, "left_anti")
    upserts = effective.filter(F.col(CHANGE_TYPE) != "delete").select(*cols)
    return kept.unionByName(upserts)
