"""Streaming jobs: continuous ingestion, the wire-after-IP-change rule, and the triage sink.

All jobs keep their progress in checkpoints under the shared ``spark.checkpoint.dir`` so they
resume after a failure; sinks are idempotent per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskflow.constants import HIGH_VALUE_AMOUNT, RECENT_IP_CHANGE_MINUTES, WIRE_TYPE
from riskflow.operators import triage
from riskflow.sources import ingest
from riskflow.sources import state as state_tables
from riskflow.schemas import OPERATIONAL_TRIAGE
from riskflow.session import scratch_path


def _path_key(path: str) -> str:
    import hashlib

    return hashlib.sha1(path.encode()).hexdigest()[:12]


def start_ingest(
    spark: SparkSession,
    kind: str,
    source_dir: str,
    target_path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Continuous CSV → typed bronze Parquet (``kind``: transactions | logins)."""
    if kind == "transactions":
        stream = ingest.bronze_transactions(ingest.stream_raw_transactions(spark, source_dir, max_files_per_trigger))
    elif kind == "logins":
        stream = ingest.bronze_logins(ingest.stream_raw_logins(spark, source_dir, max_files_per_trigger))
    else:
        raise ValueError(kind)
    w = (
        stream.writeStream.format("parquet")
        .option("path", target_path)
        .option("checkpointLocation", checkpoint or scratch_path(spark, f"ckpt-ingest-{kind}-{_path_key(target_path)}"))
        .outputMode("append")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def wire_after_ip_change_stream(
    transactions: DataFrame,
    ip_changes: DataFrame,
    watermark: str = "10 minutes",
    lookback_minutes: float = RECENT_IP_CHANGE_MINUTES,
) -> DataFrame:
    """High-value wires with an IP change of the same user in the preceding hour.

    A stream–stream interval join: watermarks on both sides plus the time bound let Spark evict
    join state (a change older than the lookback plus the delay can no longer match), so state
    stays bounded. The one-sided "any earlier change" join of the batch pipeline cannot be
    evicted and is not offered on streams.
    """
    t = (
        transactions.withColumn("transaction_time", F.col("transaction_time").cast("timestamp"))
        .filter((F.col("transaction_type") == WIRE_TYPE) & (F.col("amount") >= HIGH_VALUE_AMOUNT))
        .withWatermark("transaction_time", watermark)
    )
    c = (
        ip_changes.withColumn("ip_change_time", F.col("ip_change_time").cast("timestamp"))
        .select(F.col("user_id").alias("ip_user_id"), "new_ip", "ip_change_time")
        .withWatermark("ip_change_time", watermark)
    )
    lookback = int(lookback_minutes * 60)
    secs = F.unix_timestamp("transaction_time") - F.unix_timestamp("ip_change_time")
    cond = (
        (F.col("user_id") == F.col("ip_user_id"))
        & (F.col("ip_change_time") <= F.col("transaction_time"))
        & (F.col("ip_change_time") >= F.col("transaction_time") - F.expr(f"INTERVAL {lookback + 1} SECONDS"))
        & (secs <= lookback)
    )
    return t.join(c, cond, "inner").select(
        "transaction_id", "user_id", "amount", "transaction_time", "new_ip", "ip_change_time",
        F.round(secs / 60.0, 2).alias("minutes_since_ip_change"),
    )


class TriageSink:
    """``foreachBatch`` sink applying each micro-batch of score updates to a triage state table.

    Per batch: keep the latest update per key, upsert into the current state, publish the new
    state (staged swap) and record the batch id; a replayed batch id is skipped, so the sink is
    idempotent under retries. With ``buckets`` the state is kept in that many key buckets
    (``sources.state``): a batch reads and writes the buckets of its keys only, and the batch id is a
    property of the table.
    """

    def __init__(self, spark: SparkSession, table: str, order: list[str], log_table: str | None = None, buckets: int | None = None):
        self.buckets = buckets
        self.spark = spark
        self.table = table
        self.order = order
        self.log_table = log_table or f"{table}__batches"

    def _done(self, batch_id: int) -> bool:
        if not self.spark.catalog.tableExists(self.log_table):
            return False
        return self.spark.table(self.log_table).filter(F.col("batch_id") == batch_id).limit(1).count() > 0

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from riskflow.sources.tables import publish, read_state

        if self.buckets is None and self._done(batch_id):
            return
        batch = batch.persist()  # read twice below (the batch time, then the upsert)
        try:
            as_of = batch.agg(F.max(self.order[0])).collect()[0][0]
            stamp = as_of if as_of is not None else F.current_timestamp()
            if self.buckets is not None:
                if not state_tables.is_bucketed(self.spark, self.table):
                    empty = self.spark.createDataFrame([], OPERATIONAL_TRIAGE)
                    state_tables.create_state(self.spark, empty, self.table, [triage.KEY], self.buckets)
                upsert = lambda rows, changes: triage.upsert_triage(rows, changes, stamp, order=self.order)
                state_tables.change_state(self.spark, self.table, batch, upsert, batch_id)
                return
            state = read_state(self.spark, self.table, OPERATIONAL_TRIAGE)
            new_state = triage.upsert_triage(state, batch, stamp, order=self.order)
            publish(self.spark, new_state, self.table)
            self.spark.createDataFrame([(batch_id,)], "batch_id long").write.mode("append").saveAsTable(self.log_table)
        finally:
            batch.unpersist()


def start_triage_sink(updates: DataFrame, sink: TriageSink, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    w = updates.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


class JdbcTriageSink:
    """``foreachBatch`` sink upserting each micro-batch of score updates into an operational SQL
    table: latest update per key, parallel write to a staging table, one set-based statement.

    Replays of a batch id are skipped using a small log table in the same database, written in the
    same transaction as the upsert statements.
    """

    def __init__(self, url: str, target: str, staging: str, order: list[str], properties: dict | None = None,
                 dialect: str = "ansi", log_table: str | None = None):
        self.url, self.target, self.staging, self.order = url, target, staging, order
        self.properties, self.dialect = properties or {}, dialect
        self.log_table = log_table or f"{target}_BATCHES"

    def _ensure_log(self, spark: SparkSession) -> None:
        """Create the batch log table once per sink (if the database does not have it yet)."""
        from riskflow.sources import jdbc

        if getattr(self, "_log_ready", False):
            return
        try:
            jdbc.read_table(spark, self.url, self.log_table, self.properties).schema
        except Exception:  # noqa: BLE001 - not there yet
            jdbc.execute(spark, self.url, [f"CREATE TABLE {self.log_table} (batch_id BIGINT PRIMARY KEY)"], self.properties)
        self._log_ready = True

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from riskflow.sources import jdbc

        spark = batch.sparkSession
        self._ensure_log(spark)
        done = jdbc.read_table(spark, self.url, self.log_table, self.properties).filter(F.col("BATCH_ID") == batch_id)
        if done.limit(1).count():
            return
        latest = triage.latest_per_key(batch, triage.KEY, self.order)
        (
            latest.select("transaction_id", "user_id", F.round("risk_score", 2).alias("risk_score"), "risk_level",
                          "automated_action", "action_reason")
            .write.mode("overwrite")
            .option("createTableColumnTypes", jdbc.UPDATE_STAGE_TYPES)
            .jdbc(self.url, self.staging, properties=dict(self.properties))
        )
        statements = jdbc.upsert_statements(self.target, self.staging, self.dialect)
        statements.append(f"INSERT INTO {self.log_table} (batch_id) VALUES ({int(batch_id)})")
        jdbc.execute(spark, self.url, statements, self.properties)


def progress_summary(query: StreamingQuery) -> dict:
    """Latency and throughput of a stream from its recent progress reports: batches, input rows,
    rows/s while processing, the slowest trigger (ms) and the state rows kept."""
    reports = [p for p in (query.recentProgress or []) if p]
    rows = sum(int(p.get("numInputRows", 0)) for p in reports)
    millis = sum(int(p.get("durationMs", {}).get("triggerExecution", 0)) for p in reports)
    state = [
        sum(int(op.get("numRowsTotal", 0)) for op in p.get("stateOperators", []))
        for p in reports
    ]
    return {
        "batches": len(reports),
        "input_rows": rows,
        "rows_per_sec": round(rows / (millis / 1000), 1) if millis else None,
        "max_trigger_ms": max((int(p.get("durationMs", {}).get("triggerExecution", 0)) for p in reports), default=0),
        "state_rows": state[-1] if state else 0,
    }
