"""Streaming twins against their batch forms (multi-file, out-of-order input), and the sinks."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from riskflow.operators import triage
from riskflow.operators.features import ip_changes
from riskflow.operators.travel import impossible_travel
from riskflow.sources import fixtures, ingest
from riskflow.streaming.pipeline import (
    TriageSink,
    progress_summary,
    start_ingest,
    start_triage_sink,
    wire_after_ip_change_stream,
)
from riskflow.streaming.timeline import ip_change_stream, travel_stream, wire_rule_stream
from tests.conftest import SF01


@pytest.fixture(scope="module")
def rel(spark):
    return fixtures.load(spark, SF01)


@pytest.fixture(scope="module")
def login_files(spark, rel):
    """Logins split into files processed one per micro-batch. Rows from the 5 minutes before the
    split point arrive one batch late (within the 10-minute watermark), and a sentinel login far
    in the future advances the watermark past every real row at the end."""
    lg = rel["logins"]
    lo, hi = lg.agg(F.min("login_time"), F.max("login_time")).collect()[0]
    mid = lo + (hi - lo) / 2
    late = (F.col("login_time") >= mid - dt.timedelta(minutes=5)) & (F.col("login_time") < mid)
    d = tempfile.mkdtemp(prefix="riskflow-stream-")
    lg.filter((F.col("login_time") < mid) & ~late).coalesce(1).write.parquet(f"{d}/data/a")
    lg.filter((F.col("login_time") >= mid) | late).coalesce(1).write.parquet(f"{d}/data/b")
    sentinel = [("LOGIN-SENTINEL", "USER-SENTINEL", "0.0.0.0", hi + dt.timedelta(days=60), False, 0.0, 0.0, "X", "d")]
    spark.createDataFrame(sentinel, lg.schema).write.parquet(f"{d}/data/c")
    return d, lg.schema


def _run_memory(df, name, ckpt):
    q = (
        df.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return q


def test_ip_change_and_travel_streams_equal_batch(spark, rel, login_files):
    d, schema = login_files
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/data/*")
    q = _run_memory(ip_change_stream(stream), "ipc_stream", f"{d}/ck1")
    assert q.lastProgress is not None
    stats = progress_summary(q)
    assert stats["input_rows"] == 8020 and stats["batches"] >= 3 and stats["rows_per_sec"] > 0
    got = spark.table("ipc_stream").withColumn("ip_change_time", F.col("ip_change_time").cast("timestamp_ntz"))
    want = ip_changes(rel["logins"])
    assert got.count() == want.count() == 6869
    assert want.subtract(got.select(*want.columns)).count() == 0

    _run_memory(travel_stream(stream), "travel_stream", f"{d}/ck2")
    st = spark.table("travel_stream")
    for c in ("login_time", "prev_time"):
        st = st.withColumn(c, F.col(c).cast("timestamp_ntz"))
    bt = impossible_travel(rel["logins"])
    assert st.count() == bt.count() == 81
    assert bt.subtract(st.select(*bt.columns)).count() == 0


def test_wire_after_ip_change_interval_join_equals_batch(spark, rel):
    d = tempfile.mkdtemp(prefix="riskflow-w3-")
    rel["transactions"].repartition(3).write.parquet(f"{d}/tx")
    ip_changes(rel["logins"]).repartition(3).write.parquet(f"{d}/ipc")
    tx = spark.readStream.schema(rel["transactions"].schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/tx")
    ch = spark.readStream.schema(spark.read.parquet(f"{d}/ipc").schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/ipc")
    _run_memory(wire_after_ip_change_stream(tx, ch, watermark="90 days"), "w3", f"{d}/ck")
    import __spark_entry__ as entry

    batch = entry.queries()["wire_after_ip_change_interval"](spark, SF01)
    got = spark.table("w3").withColumn("transaction_time", F.col("transaction_time").cast("timestamp_ntz")).withColumn(
        "ip_change_time", F.col("ip_change_time").cast("timestamp_ntz")
    )
    assert got.count() == batch.count() == 13
    assert batch.subtract(got.select(*batch.columns)).count() == 0


def test_csv_ingest_stream_equals_batch_read(spark, rel):
    d = tempfile.mkdtemp(prefix="riskflow-w1-")
    raw = ingest.to_raw_transactions(rel["transactions"])
    for i in range(3):
        ingest.write_csv(raw.filter(F.abs(F.hash("transaction_id")) % 3 == i), f"{d}/src/{i}")
    os.makedirs(f"{d}/flat")
    n = 0
    for root, _, files in os.walk(f"{d}/src"):
        for f in files:
            if f.endswith(".csv"):
                os.link(os.path.join(root, f), f"{d}/flat/{n:03d}.csv")
                n += 1
    q = start_ingest(spark, "transactions", f"{d}/flat", f"{d}/bronze", checkpoint=f"{d}/ck", max_files_per_trigger=1)
    q.awaitTermination()
    got = spark.read.parquet(f"{d}/bronze")
    want = ingest.read_transactions(spark, f"{d}/flat")
    assert got.count() == want.count() == 1981
    assert want.subtract(got).count() == 0


@pytest.mark.parametrize("buckets", [None, 8])
def test_triage_sink_is_idempotent_per_batch(spark, buckets):
    name = f"default.triage_{uuid.uuid4().hex[:6]}"
    d = tempfile.mkdtemp(prefix="riskflow-w6-")
    rows = [
        ("t1", "u1", 10.0, "LOW", "APPROVE", "a", dt.datetime(2024, 1, 1, 10)),
        ("t1", "u1", 90.0, "CRITICAL", "BLOCK", "b", dt.datetime(2024, 1, 1, 11)),
        ("t2", "u2", 60.0, "MEDIUM", "MONITOR", "c", dt.datetime(2024, 1, 1, 9)),
    ]
    schema = "transaction_id string, user_id string, risk_score double, risk_level string, automated_action string, action_reason string, scored_at timestamp_ntz"
    spark.createDataFrame(rows, schema).write.parquet(f"{d}/updates")
    sink = TriageSink(spark, name, order=["scored_at"], buckets=buckets)
    q = start_triage_sink(spark.readStream.schema(schema).parquet(f"{d}/updates"), sink, f"{d}/ck")
    q.awaitTermination()
    state = {r["transaction_id"]: r for r in spark.table(name).collect()}
    assert state["t1"]["risk_score"] == 90.0 and state["t1"]["review_status"] == "PENDING"
    assert state["t1"]["action_timestamp"] == dt.datetime(2024, 1, 1, 11)
    before = sorted(map(tuple, spark.table(name).collect()))
    # A replay of batch 0 (e.g. after a driver restart) changes nothing.
    sink(spark.createDataFrame([("t1", "u1", 1.0, "LOW", "APPROVE", "z", dt.datetime(2025, 1, 1))], schema), 0)
    assert sorted(map(tuple, spark.table(name).collect())) == before
    assert triage.KEY == "transaction_id"


def test_late_rows_within_watermark_are_reordered_and_state_expires(spark):
    """One file per micro-batch. u1: A 10:00 and B 10:30, then C 10:20 (late, within the 20-minute
    delay) and D 12:00 → changes C (A→C) and B (C→B), none at D (same IP as B). E 09:00 arrives
    after the watermark passed it and is dropped by Spark; F on Jan 3 (within the 3-day idle limit)
    changes D→F. G on Jan 9 is more than 3 days after F, so it starts a new sequence (no change) —
    whether or not u1's state was already dropped. Logins of u2 move the watermark and flush."""
    d = tempfile.mkdtemp(prefix="riskflow-late-")
    schema = "login_id string, user_id string, ip_address string, login_time timestamp_ntz, mfa_changed boolean, latitude double, longitude double, city string, device_id string"

    def write(name, rows):
        spark.createDataFrame(
            [(i, u, ip, dt.datetime.fromisoformat(t), False, 0.0, 0.0, "X", "d") for i, u, ip, t in rows], schema
        ).coalesce(1).write.parquet(f"{d}/data/{name}")

    write("1", [("A", "u1", "1.1.1.1", "2024-01-01 10:00:00"), ("B", "u1", "2.2.2.2", "2024-01-01 10:30:00")])
    write("2", [("C", "u1", "3.3.3.3", "2024-01-01 10:20:00"), ("D", "u1", "2.2.2.2", "2024-01-01 12:00:00")])
    write("3", [("E", "u1", "9.9.9.9", "2024-01-01 09:00:00"), ("F", "u1", "5.5.5.5", "2024-01-03 12:00:00")])
    write("4", [("S1", "u2", "7.7.7.7", "2024-01-05 12:00:00")])
    write("5", [("G", "u1", "6.6.6.6", "2024-01-09 12:00:00")])
    write("6", [("S2", "u2", "7.7.7.7", "2024-01-20 12:00:00")])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/data/*")
    _run_memory(ip_change_stream(stream, watermark="20 minutes", expire_after="3 days"), "late_ipc", f"{d}/ck")
    got = sorted(r["login_id"] for r in spark.table("late_ipc").collect())
    assert got == ["B", "C", "F"]


def test_jdbc_triage_sink_upserts_latest_per_key_and_skips_replays(spark):
    from riskflow.sources import jdbc
    from riskflow.streaming.pipeline import JdbcTriageSink

    url = f"jdbc:derby:memory:s{uuid.uuid4().hex[:8]};create=true"
    jdbc.execute(spark, url, [jdbc.triage_ddl("TRIAGE")])
    d = tempfile.mkdtemp(prefix="riskflow-jdbc-sink-")
    schema = "transaction_id string, user_id string, risk_score double, risk_level string, automated_action string, action_reason string, scored_at timestamp_ntz"
    rows = [
        ("t1", "u1", 10.0, "LOW", "APPROVE", "a", dt.datetime(2024, 1, 1, 10)),
        ("t1", "u1", 90.0, "CRITICAL", "BLOCK", "b", dt.datetime(2024, 1, 1, 11)),
        ("t2", "u2", 60.0, "MEDIUM", "MONITOR", "c", dt.datetime(2024, 1, 1, 9)),
    ]
    spark.createDataFrame(rows, schema).write.parquet(f"{d}/updates")
    sink = JdbcTriageSink(url, "TRIAGE", "TRIAGE_STAGE", order=["scored_at"])
    q = start_triage_sink(spark.readStream.schema(schema).parquet(f"{d}/updates"), sink, f"{d}/ck")
    q.awaitTermination()
    got = {r["TRANSACTION_ID"]: r for r in jdbc.read_table(spark, url, "TRIAGE").collect()}
    assert float(got["t1"]["RISK_SCORE"]) == 90.0 and got["t1"]["AUTOMATED_ACTION"] == "BLOCK"
    assert got["t2"]["REVIEW_STATUS"] == "PENDING"
    sink(spark.createDataFrame([("t1", "u1", 1.0, "LOW", "APPROVE", "z", dt.datetime(2025, 1, 1))], schema), 0)
    again = {r["TRANSACTION_ID"]: r for r in jdbc.read_table(spark, url, "TRIAGE").collect()}
    assert float(again["t1"]["RISK_SCORE"]) == 90.0


def test_login_csv_ingest_stream_equals_batch_read(spark, rel):
    d = tempfile.mkdtemp(prefix="riskflow-w1l-")
    ingest.write_csv(ingest.to_raw_logins(rel["logins"]).repartition(3), f"{d}/src")
    q = start_ingest(spark, "logins", f"{d}/src", f"{d}/bronze", checkpoint=f"{d}/ck", max_files_per_trigger=1)
    q.awaitTermination()
    got = spark.read.parquet(f"{d}/bronze")
    want = ingest.read_logins(spark, f"{d}/src")
    assert got.count() == want.count() == 8019
    assert want.subtract(got).count() == 0
    assert got.filter("mfa_changed").count() == 2017


def test_registered_streams_on_a_folder_of_shuffled_parts(spark, tmp_path):
    """A table of several part files, rows out of order, gives the batch results to the last row."""
    import os

    from riskflow.plans import catalog

    source = "/root/testdata/sf0.001"
    d = str(tmp_path)
    for name in os.listdir(source):
        if name != "events.parquet":
            os.symlink(f"{source}/{name}", f"{d}/{name}")
    spark.read.parquet(f"{source}/events.parquet").repartition(4, F.xxhash64("event_id")).sortWithinPartitions(F.xxhash64("ts")).write.parquet(f"{d}/events.parquet")
    qs = catalog.queries()
    for stream, batch in (("ip_change_stream", "ip_changes"), ("travel_stream", "impossible_travel"), ("wire_after_ip_change_stream", "wire_after_ip_change_interval")):
        want = qs[batch](spark, source)
        want = want.select(*(F.col(c).cast("timestamp_ntz").alias(c) if t.startswith("timestamp") else F.col(c) for c, t in want.dtypes))
        for at in (source, d):
            got = qs[stream](spark, at)
            assert sorted(got.columns) == sorted(want.columns)
            assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())), (stream, at)


def _skewed(spark, rel, d: str):
    """A third of the logins on one user, logins and wires in four micro-batches by time, rows of the last two
    minutes of each a batch late, and end markers."""
    lg = rel["logins"].withColumn("user_id", F.when(F.xxhash64("login_id") % 3 == 0, "USER-00001").otherwise(F.col("user_id")))
    tx = rel["transactions"].withColumn("user_id", F.when(F.xxhash64("transaction_id") % 3 == 0, "USER-00001").otherwise(F.col("user_id")))
    tx = tx.withColumn("transaction_type", F.lit("wire")).withColumn("amount", F.lit(20000.0))
    lo, hi = lg.agg(F.min("login_time"), F.max("login_time")).collect()[0]
    out = []
    for name, rows, time in (("lg", lg, "login_time"), ("tx", tx, "transaction_time")):
        rows.write.parquet(f"{d}/{name}")
        late = F.col(time) - F.expr("INTERVAL 2 MINUTES") * (F.xxhash64(time) % 2 + 1)
        cut = F.least(F.floor(4 * (F.unix_micros(late.cast("timestamp")) - F.lit(int(lo.timestamp() * 1e6))) / F.lit(int((hi - lo).total_seconds() * 1e6) + 1)), F.lit(3))
        made = spark.read.parquet(f"{d}/{name}").withColumn("k", F.greatest(cut, F.lit(0)))
        for k in range(4):
            made.filter(F.col("k") == k).drop("k").coalesce(1).write.parquet(f"{d}/{name}-parts/{k}")
        end = made.limit(1).drop("k").withColumn(time, F.lit(hi + dt.timedelta(days=900)).cast(dict(made.dtypes)[time])).withColumn("user_id", F.lit("end"))
        end.coalesce(1).write.parquet(f"{d}/{name}-parts/4")
        out += [spark.read.parquet(f"{d}/{name}"), spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/{name}-parts/*")]
    return out


def _as_batch(df, want):
    kinds = dict(want.dtypes)
    return sorted(map(str, df.select(*(F.col(c).cast(kinds[c]).alias(c) for c in want.columns)).collect()))


def test_a_user_with_a_third_of_the_rows_in_several_batches(spark, rel):
    """IP changes, travel and the wire rule equal the batch forms, and the state ends."""
    from riskflow.operators.sequence import interval_join

    d = tempfile.mkdtemp(prefix="riskflow-skew-")
    logins, login_stream, wires, wire_stream = _skewed(spark, rel, d)
    for name, stream, want in (
        ("skew_ip", ip_change_stream(login_stream, bucket="2 days"), ip_changes(logins)),
        ("skew_travel", travel_stream(login_stream), impossible_travel(logins)),
    ):
        q = _run_memory(stream, name, f"{d}/{name}")
        assert len([p for p in q.recentProgress if p["numInputRows"]]) == 5
        assert _as_batch(spark.table(name), want) == sorted(map(str, want.collect()))
        users, buckets = (op["numRowsTotal"] for op in q.recentProgress[-1]["stateOperators"])
        assert buckets <= 2 and users <= 151

    stream = wire_rule_stream(wire_stream, login_stream)
    q = _run_memory(stream, "skew_wire", f"{d}/wire")
    changes = ip_changes(logins).select(F.col("user_id").alias("ip_user_id"), "new_ip", "ip_change_time")
    pairs = interval_join(wires, changes, by="user_id", right_by="ip_user_id", left_time="transaction_time", right_time="ip_change_time", lookback_seconds=3600)
    want = pairs.select("transaction_id", "user_id", "new_ip", "ip_change_time")
    got = _as_batch(spark.table("skew_wire"), want)
    assert got == sorted(map(str, want.collect())) and len(got) > 100
    hours = q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert hours <= 4


def test_no_call_sees_more_than_a_bucket(spark):
    """The operators with plain stand-ins for state: what one call reads and keeps."""
    from riskflow.streaming import timeline as tl

    class Handle:
        def __init__(self):
            self.timers, self.lists, self.values = [], {}, {}

        def registerTimer(self, ms):
            self.timers.append(ms)

        def getListState(self, name, schema):
            held = self.lists.setdefault(name, [])

            class State:
                appendList, clear, get = held.extend, held.clear, lambda self: list(held)

                def put(self, rows):
                    held[:] = rows

            return State()

        def getValueState(self, name, schema):
            held = self.values.setdefault(name, [])

            class State:
                exists, get, clear = (lambda self: bool(held)), (lambda self: held[0]), held.clear

                def update(self, row):
                    held[:] = [row]

            return State()

    class Times:
        def __init__(self, now):
            self.getCurrentWatermarkInMs = lambda: now

    import json

    from pyspark.sql import Row

    handle = Handle()
    p = tl._Buckets(tl._changed, None, tl._us("1 day"))
    p.init(handle)
    rows = [Row(us=k * 1_000_000, row=json.dumps({"us": k * 1_000_000, "login_id": str(k), "ip": str(k % 2)})) for k in range(5000)]
    list(p.handleInputRows(("u", 0), iter(rows[::-1]), Times(0)))
    assert len(handle.lists["pending"]) == 5 and all(len(x[0].split("\n")) == tl.CHUNK for x in handle.lists["pending"])
    assert handle.timers == [1]
    out = list(p.handleExpiredTimer(("u", 0), Times(2_500_000), None))
    kinds = [r.kind for r in out]
    assert kinds.count(tl._RESULT) == 2499 and kinds[0] == tl._FIRST and kinds[-1] == tl._LAST
    assert sum(len(x[0].split("\n")) for x in handle.lists["pending"]) == 2500
    out = list(p.handleExpiredTimer(("u", 0), Times(90_000_000), None))
    assert [r.kind for r in out].count(tl._RESULT) == 2500 and not handle.lists["pending"] and not handle.values["last"]


def test_users_of_a_slot_share_a_call(spark, rel):
    """One call holds many users (calls and state accesses cost by the key), each with a sequence of its own; results
    leave in frames of bounded size."""
    import json

    from pyspark.sql import Row

    from riskflow.operators.sequence import interval_join
    from riskflow.streaming import timeline as tl

    class Held(list):
        exists, update = (lambda self: bool(self)), (lambda self, row: self.__init__([row]))
        get, appendList, put = (lambda self: list(self)), (lambda self, rows: self.extend(rows)), (lambda self, rows: self.__init__(rows))

    class Handle:
        registerTimer = getListState = getValueState = lambda self, *a: Held()

    class Times:
        getCurrentWatermarkInMs = lambda self: 10**9

    p = tl._Frames(tl._Buckets(tl._changed, None, tl._us("1 day")), tuple(tl._Step))
    p.init(Handle())
    line = lambda k: json.dumps({"us": k, "user": f"u{k % 3}", "login_id": str(k), "ip": "a" if k < 2400 else "b"})
    frame = spark.createDataFrame([Row(us=k, row=line(k)) for k in range(3000)]).toPandas()
    list(p.handleInputRows((7, 0), iter([frame[::-1], frame]), Times()))
    out = list(p.handleExpiredTimer((7, 0), Times(), None))
    assert all(len(f) <= tl.CHUNK for f in out)
    rows = [r for f in out for r in f.itertuples()]
    assert [(r.user_id, json.loads(r.row)["us"], json.loads(r.prev)["us"]) for r in rows if r.kind == tl._RESULT] == [(f"u{k % 3}", k, k - 3) for k in (2400, 2401, 2402)]
    assert sorted((r.user_id, r.kind) for r in rows if r.kind != tl._RESULT) == [(f"u{u}", k) for u in range(3) for k in (tl._FIRST, tl._LAST)]

    d = tempfile.mkdtemp(prefix="riskflow-slots-")
    logins, login_stream, wires, wire_stream = _skewed(spark, rel, d)
    _run_memory(wire_rule_stream(wire_stream, login_stream, slots=2, wire_slots=1), "slot_wire", f"{d}/wire")
    changes = ip_changes(logins).select(F.col("user_id").alias("ip_user_id"), "new_ip", "ip_change_time")
    pairs = interval_join(wires, changes, by="user_id", right_by="ip_user_id", left_time="transaction_time", right_time="ip_change_time", lookback_seconds=3600)
    want = pairs.select("transaction_id", "user_id", "amount", "transaction_time", "new_ip", "ip_change_time")
    assert _as_batch(spark.table("slot_wire"), want) == sorted(map(str, want.collect()))
