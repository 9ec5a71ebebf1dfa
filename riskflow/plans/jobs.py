"""The batch pipeline as a chain of Spark jobs over managed tables.

Each shared intermediate (silver activity, travel flags) is written once as a table and read by
every later step, so it is computed once and the lineage is cut: a lost executor later in the chain
recomputes from the last table, not from the raw inputs. State tables (gold, operational) are
replaced with a staged swap (``sources.tables.publish``) because each new state reads the old one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskflow.constants import FPR_FLAGGED_ACTIONS, FPR_REVIEWED_STATUSES
from riskflow.operators import scoring, triage
from riskflow.operators.travel import impossible_travel
from riskflow.plans import silver
from riskflow.schemas import OPERATIONAL_TRIAGE, TRIAGE
from riskflow.sources import state, tables


@dataclass(frozen=True)
class Names:
    """Table names; ``prefix`` keeps several pipelines apart in one catalog."""

    prefix: str = ""

    def _t(self, layer: str, name: str) -> str:
        return f"{layer}.{self.prefix}{name}"

    @property
    def bronze_transactions(self) -> str:
        return self._t("raw", "bronze_transactions")

    @property
    def bronze_logins(self) -> str:
        return self._t("raw", "bronze_login_logs")

    @property
    def activity(self) -> str:
        return self._t("silver", "silver_user_activity")

    @property
    def travel(self) -> str:
        return self._t("silver", "impossible_travel_flags")

    @property
    def gold(self) -> str:
        return self._t("gold", "real_time_fraud_triage")

    @property
    def operational(self) -> str:
        return self._t("gold", "operational_triage")

    def view(self, name: str) -> str:
        return self._t("gold", name)


def build_silver(spark: SparkSession, transactions: DataFrame, logins: DataFrame, names: Names) -> None:
    """Bronze inputs, then silver activity (as-of form) and travel flags, each written once."""
    tables.create_namespaces(spark)
    tables.overwrite_table(transactions, names.bronze_transactions)
    tables.overwrite_table(logins, names.bronze_logins)
    txns, lgs = spark.table(names.bronze_transactions), spark.table(names.bronze_logins)
    tables.overwrite_table(impossible_travel(lgs), names.travel)
    tables.overwrite_table(silver.user_activity(txns, lgs), names.activity)


def score_and_store(spark: SparkSession, names: Names, as_of, bucket_count: int | None = None) -> None:
    """Score every silver row, merge the rows into gold (all columns replaced, review fields reset)
    and upsert them into the operational state (review fields kept)."""
    tables.create_empty(spark, names.gold, TRIAGE)
    tables.create_empty(spark, names.operational, OPERATIONAL_TRIAGE)
    activity = spark.table(names.activity)
    flags = silver.travel_flags(spark.table(names.travel))
    scored = scoring.default_score(activity.join(flags, "user_id", "left")).withColumn(
        "automated_action", scoring.risk_action("risk_level", "risk_score")
    )
    bucket = (bucket_count, [triage.KEY]) if bucket_count else None
    gold_rows = triage.gold_rows(scored, as_of)
    gold = tables.read_state(spark, names.gold)
    tables.publish(spark, triage.merge_gold(gold, gold_rows), names.gold, bucket_by=bucket)
    updates = scored.withColumnRenamed("reason", "action_reason")
    new_state = triage.upsert_triage(tables.read_state(spark, names.operational), updates, as_of)
    tables.publish(spark, new_state, names.operational, bucket_by=bucket)


def apply_review_decisions(spark: SparkSession, names: Names, decisions: DataFrame, as_of, bucket_count: int | None = None) -> None:
    """Apply analyst decisions to the operational state, then copy the review fields to gold so
    the false-positive view sees them (the source pipeline never copies them back). States kept in key
    buckets (``keep_in_buckets``) have the buckets of the decided keys rewritten, and no others."""
    if state.is_bucketed(spark, names.operational) and state.is_bucketed(spark, names.gold):
        touched = state.change_state(spark, names.operational, decisions, lambda rows, d: triage.apply_reviews(rows, d, as_of))
        decided = state.read_buckets(spark, names.operational, touched).join(decisions.select(triage.KEY).distinct(), triage.KEY, "left_semi")
        state.change_state(spark, names.gold, decided, triage.sync_reviews)
        return
    reviewed = triage.apply_reviews(tables.read_state(spark, names.operational), decisions, as_of)
    bucket = (bucket_count, [triage.KEY]) if bucket_count else None
    tables.publish(spark, reviewed, names.operational, bucket_by=bucket)
    synced = triage.sync_reviews(tables.read_state(spark, names.gold), spark.table(names.operational))
    tables.publish(spark, synced, names.gold, bucket_by=bucket)


def keep_in_buckets(spark: SparkSession, names: Names, buckets: int) -> None:
    """Turn the gold and operational tables into states in key buckets (``sources.state``)."""
    for name in (names.gold, names.operational):
        if not state.is_bucketed(spark, name):
            kept = f"{name}__whole"
            spark.sql(f"DROP TABLE IF EXISTS {kept}")
            spark.sql(f"ALTER TABLE {name} RENAME TO {kept}")
            state.create_state(spark, spark.table(kept), name, [triage.KEY], buckets)
            spark.sql(f"DROP TABLE {kept}")


def create_kpi_views(spark: SparkSession, names: Names) -> None:
    """The three certified queries (``kpis``) as views of the catalog's gold layer. They name their tables, so
    that they outlive the session and follow the tables as they are republished."""
    quoted = lambda values: ", ".join(f"'{v}'" for v in values)
    views = {
        "v_false_positive_ratio": f"""
            SELECT avg(if(review_status = 'APPROVED' AND automated_action IN ({quoted(FPR_FLAGGED_ACTIONS)}), 1D, 0D)) AS false_positive_ratio,
                   count(*) AS total_flagged
            FROM {names.gold} WHERE review_status IN ({quoted(FPR_REVIEWED_STATUSES)})""",
        "v_account_takeover_rate": f"""
            SELECT count(DISTINCT user_id) AS ato_user_count, count(*) AS ato_event_count
            FROM {names.activity}
            WHERE (mfa_change_flag AND high_value_wire) OR user_id IN (SELECT user_id FROM {names.travel})""",
        "v_wire_10k_mfa_24h": f"""
            SELECT transaction_id, user_id, amount, transaction_time, mfa_change_flag, ip_changed_recently
            FROM {names.activity} WHERE high_value_wire AND mfa_change_flag""",
    }
    for name, body in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {names.view(name)} AS {body}")


def run_pipeline(
    spark: SparkSession,
    transactions: DataFrame,
    logins: DataFrame,
    as_of,
    names: Names | None = None,
    bucket_count: int | None = None,
    decisions: DataFrame | None = None,
) -> Names:
    """Bronze → silver + travel → scoring → gold and operational triage → (review decisions and
    review sync) → KPI views."""
    names = names or Names()
    build_silver(spark, transactions, logins, names)
    score_and_store(spark, names, as_of, bucket_count)
    if decisions is not None:
        apply_review_decisions(spark, names, decisions, as_of, bucket_count)
    create_kpi_views(spark, names)
    return names
