"""Operational store over JDBC: parallel reads, and a set-based keyed upsert.

The source pipeline opens one connection per row and upserts rows one at a time. Here a whole
batch is written in parallel (one connection per partition) into a staging table, and a single
set-based statement merges it into the target inside the database. Review decisions are applied
the same way. Statement execution uses one connection on the driver — only the statement text
crosses it, never the rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import NumericType, StringType

from riskflow.constants import PENDING

UPDATE_COLUMNS = ["risk_score", "risk_level", "automated_action", "action_reason"]
INSERT_COLUMNS = ["transaction_id", "user_id", "risk_score", "risk_level", "automated_action", "action_reason"]
# Staging column types matching the target's (default string mappings may not compare with keys).
UPDATE_STAGE_TYPES = (
    "transaction_id VARCHAR(255), user_id VARCHAR(255), risk_level VARCHAR(20), "
    "automated_action VARCHAR(20), action_reason VARCHAR(4000)"
)
REVIEW_STAGE_TYPES = (
    "transaction_id VARCHAR(255), action VARCHAR(20), reviewed_by VARCHAR(255), notes VARCHAR(4000), "
    "decided_at TIMESTAMP"
)


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Read a table; ``predicates`` (one WHERE clause per partition, e.g. ``key_predicates``) split the
    read across tasks."""
    props = dict(properties or {})
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    return spark.read.jdbc(url, table, properties=props)


def key_predicates(
    spark: SparkSession, url: str, table: str, key: str, parts: int, properties: dict | None = None, sample: int = 64
) -> list[str]:
    """WHERE clauses that cut ``table`` into at most ``parts`` ranges of ``key`` with about as many rows each:
    complete, without overlap, rows with a NULL key in the first.

    The borders are quantiles of every n-th row's key, at most ``parts * sample`` keys, picked and sorted by the
    database (its collation decides what lies between two borders), so that neither the table nor its keys
    pass the driver. Rows that share one key stay in one range. The key is a string or a number."""
    kind = read_table(spark, url, table, properties).select(key).schema[0].dataType
    if not isinstance(kind, StringType | NumericType):
        raise ValueError(f"{key} is neither a string nor a number")
    rows = int(query(spark, url, f"SELECT COUNT(*) FROM {table}", properties)[0] or 0)
    step = max(1, -(-rows // (parts * sample)))
    numbered = f"SELECT {key} AS k, ROW_NUMBER() OVER () AS n FROM {table}"
    picked = query(spark, url, f"SELECT k FROM ({numbered}) t WHERE MOD(n, {step}) = 0 AND k IS NOT NULL ORDER BY k", properties)
    borders = list(dict.fromkeys(picked[i * len(picked) // parts] for i in range(1, parts) if picked))
    literal = (lambda v: v) if isinstance(kind, NumericType) else (lambda v: "'" + v.replace("'", "''") + "'")
    if not borders:
        return [f"{key} IS NULL OR {key} IS NOT NULL"]
    cuts = [literal(v) for v in borders]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in itertools.pairwise(cuts)]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *inner, f"{key} >= {cuts[-1]}"]


def read_by_key(
    spark: SparkSession, url: str, table: str, key: str, parts: int, properties: dict | None = None
) -> DataFrame:
    """Read a table with one task for each of ``parts`` ranges of its key (see ``key_predicates``). Rows
    that others write meanwhile are seen or not, as each range is read by a query of its own."""
    return read_table(spark, url, table, properties, key_predicates(spark, url, table, key, parts, properties))


def query(spark: SparkSession, url: str, sql: str, properties: dict | None = None) -> list[str | None]:
    """First column of a small result (counts, borders), read by the driver as text."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        stmt = conn.createStatement()
        try:
            rows, out = stmt.executeQuery(sql), []
            while rows.next():
                out.append(rows.getString(1))
            return out
        finally:
            stmt.close()
    finally:
        conn.close()


def execute(spark: SparkSession, url: str, statements: Sequence[str], properties: dict | None = None) -> list[int]:
    """Run statements in one transaction; returns the update counts."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        conn.setAutoCommit(False)
        counts = []
        stmt = conn.createStatement()
        try:
            for sql in statements:
                counts.append(int(stmt.executeUpdate(sql)))
        finally:
            stmt.close()
        conn.commit()
        return counts
    except Exception:
        try:
            conn.rollback()
        except Exception:  # noqa: BLE001 - keep the original error
            pass
        raise
    finally:
        conn.close()


def _q(c: str) -> str:
    # The staging table is created by Spark's JDBC writer, which quotes (case-preserves) names.
    return f'"{c}"'


def upsert_statements(target: str, staging: str, dialect: str = "ansi") -> list[str]:
    """The set-based upsert: existing keys get new score/level/action/reason and a fresh
    action_timestamp; new keys are inserted (the table's defaults fill the rest).

    ``ansi``: correlated UPDATE of existing keys, then INSERT of missing ones (run in one
    transaction); ``merge``: one MERGE statement; ``postgres``: INSERT … ON CONFLICT.
    """
    cols = ", ".join(INSERT_COLUMNS)
    src = ", ".join(f"s.{_q(c)}" for c in INSERT_COLUMNS)
    key = f"s.{_q('transaction_id')} = {target}.transaction_id"
    if dialect == "postgres":
        sets = ", ".join(f"{c} = EXCLUDED.{c}" for c in UPDATE_COLUMNS)
        return [
            f"INSERT INTO {target} ({cols}) SELECT {src} FROM {staging} s "
            f"ON CONFLICT (transaction_id) DO UPDATE SET {sets}, action_timestamp = CURRENT_TIMESTAMP"
        ]
    if dialect == "merge":
        sets = ", ".join(f"{c} = s.{_q(c)}" for c in UPDATE_COLUMNS)
        return [
            f"MERGE INTO {target} USING {staging} s ON {key} "
            f"WHEN MATCHED THEN UPDATE SET {sets}, action_timestamp = CURRENT_TIMESTAMP "
            f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({src})"
        ]
    sets = ", ".join(f"{c} = (SELECT s.{_q(c)} FROM {staging} s WHERE {key})" for c in UPDATE_COLUMNS)
    return [
        f"UPDATE {target} SET {sets}, action_timestamp = CURRENT_TIMESTAMP "
        f"WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {key})",
        f"INSERT INTO {target} ({cols}) SELECT {src} FROM {staging} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {target} WHERE {key})",
    ]


def upsert_batch(
    spark: SparkSession,
    updates: DataFrame,
    url: str,
    target: str,
    staging: str,
    properties: dict | None = None,
    dialect: str = "ansi",
) -> int:
    """Upsert a batch of score updates (keys must be unique in the batch; dedupe first with
    ``operators.triage.latest_per_key``). Scores are rounded to 2 places (DECIMAL(5,2))."""
    from pyspark.sql import functions as F

    staged = updates.select(
        "transaction_id",
        "user_id",
        F.round("risk_score", 2).alias("risk_score"),
        "risk_level",
        "automated_action",
        "action_reason",
    )
    (
        staged.write.mode("overwrite")
        .option("createTableColumnTypes", UPDATE_STAGE_TYPES)
        .jdbc(url, staging, properties=dict(properties or {}))
    )
    return sum(execute(spark, url, upsert_statements(target, staging, dialect), properties))


def apply_reviews_batch(
    spark: SparkSession,
    decisions: DataFrame,
    url: str,
    target: str,
    staging: str,
    properties: dict | None = None,
) -> int:
    """Stage one decision per key (dedupe first) and apply them with one keyed statement; the
    review time is the decision time when given (``decided_at``), else the database's now."""
    from pyspark.sql import functions as F

    decided = F.col("decided_at") if "decided_at" in decisions.columns else F.lit(None).cast("timestamp_ntz")
    (
        decisions.select("transaction_id", "action", "reviewed_by", "notes", decided.cast("timestamp").alias("decided_at"))
        .write.mode("overwrite")
        .option("createTableColumnTypes", REVIEW_STAGE_TYPES)
        .jdbc(url, staging, properties=dict(properties or {}))
    )
    return execute(spark, url, [review_statement(target, staging)], properties)[0]


def review_statement(target: str, staging: str) -> str:
    """Apply staged decisions (one per key): status from the action, reviewer default, notes,
    timestamp. Keys absent from the target change nothing."""
    key = f"s.{_q('transaction_id')} = {target}.transaction_id"
    action, reviewer, notes = f"s.{_q('action')}", f"s.{_q('reviewed_by')}", f"s.{_q('notes')}"
    decided = f"COALESCE(s.{_q('decided_at')}, CURRENT_TIMESTAMP)"
    status = (
        f"CASE WHEN {action} = 'ALLOW' THEN 'APPROVED' "
        f"WHEN {action} = 'BLOCK' THEN 'REJECTED' ELSE 'ESCALATED' END"
    )
    by = f"COALESCE(NULLIF({reviewer}, ''), 'analyst')"

    def pick(expr: str) -> str:
        return f"(SELECT {expr} FROM {staging} s WHERE {key})"

    return (
        f"UPDATE {target} SET review_status = {pick(status)}, reviewed_by = {pick(by)}, "
        f"review_notes = {pick(notes)}, "
        f"review_timestamp = {pick(decided)} "
        f"WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {key})"
    )


def triage_ddl(table: str) -> str:
    """Operational table DDL (primary key, NOT NULLs, defaults) plus the review notes column."""
    return (
        f"CREATE TABLE {table} ("
        "transaction_id VARCHAR(255) PRIMARY KEY, user_id VARCHAR(255) NOT NULL, "
        "risk_score DECIMAL(5,2) NOT NULL, risk_level VARCHAR(20) NOT NULL, "
        "automated_action VARCHAR(20) NOT NULL, action_reason VARCHAR(4000), "
        "action_timestamp TIMESTAMP DEFAULT CURRENT_TIMESTAMP, review_status VARCHAR(20) DEFAULT 'PENDING', "
        "reviewed_by VARCHAR(255), review_timestamp TIMESTAMP, created_at TIMESTAMP DEFAULT CURRENT_TIMESTAMP, "
        "review_notes VARCHAR(4000))"
    )
