"""State tables in key buckets: only touched buckets change, interrupted batches are finished or dropped."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from riskflow.operators import triage
from riskflow.sources import state, tables

SCHEMA = "k string, v int, tags array<string>"


def _name(spark):
    tables.create_namespaces(spark)
    return f"gold.s_{uuid.uuid4().hex[:8]}"


def _files(spark, name):
    out = {}
    for r in spark.table(name).select(state.BUCKET, F.input_file_name().alias("f")).distinct().collect():
        out.setdefault(r[0], set()).add(r["f"])
    return out


def _put(rows, changes):
    return rows.join(changes, "k", "left_anti").unionByName(changes.filter("v is not null"))


def _content(spark, name):
    return sorted((r["k"] or "", r["v"]) for r in state.read_buckets(spark, name).collect())


def test_a_batch_rewrites_its_buckets_only(spark, tmp_path):
    for root in (None, str(tmp_path)):
        name = _name(spark)
        rows = [(f"k{i}", i, ["a"]) for i in range(400)] + [(None, -1, None)]
        state.create_state(spark, spark.createDataFrame(rows, SCHEMA), name, ["k"], 16, root)
        before = _files(spark, name)
        changes = spark.createDataFrame([("k7", 70, None), ("new", 1, None), ("k8", None, None)], SCHEMA)
        touched = state.change_state(spark, name, changes, _put)
        assert 1 <= len(touched) <= 3
        after = _files(spark, name)
        assert {b for b in after if before.get(b) != after[b]} <= set(touched)
        want = {(k or "", v) for k, v, _ in rows if k not in ("k7", "k8")} | {("k7", 70), ("new", 1)}
        assert _content(spark, name) == sorted(want)
        # Digests follow: they equal those of the rows.
        d = state.bucket_digests(state.read_buckets(spark, name), ["k"], 16)
        assert state.changed_buckets(spark.table(f"{name}__digests").select(*d.columns), d) == []
        # A bucket that loses its last row goes.
        key = spark.createDataFrame([("k7",), ("k9",)], "k string").select(state.key_bucket(["k"], 16)).first()[0]
        gone = state.read_buckets(spark, name).filter(state.key_bucket(["k"], 16) == key).withColumn("v", F.lit(None).cast("int"))
        state.change_state(spark, name, gone, _put)
        assert key not in _files(spark, name) and key not in {r[0] for r in spark.table(f"{name}__digests").select(state.BUCKET).collect()}


def test_batches_replay_and_interrupted_ones_recover(spark, monkeypatch):
    name = _name(spark)
    state.create_state(spark, spark.createDataFrame([("a", 1, None), ("b", 2, None)], SCHEMA), name, ["k"], 4)
    one = spark.createDataFrame([("a", 10, None)], SCHEMA)
    assert state.change_state(spark, name, one, _put, batch_id=0)
    assert state.change_state(spark, name, spark.createDataFrame([("a", 99, None)], SCHEMA), _put, batch_id=0) == []
    assert _content(spark, name) == [("a", 10), ("b", 2)]
    # Lost after the staging table was complete: the next reader finishes the batch.
    with monkeypatch.context() as m:
        m.setattr(state, "_overwrite", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            state.change_state(spark, name, spark.createDataFrame([("b", 20, None)], SCHEMA), _put, batch_id=1)
    assert _content(spark, name) == [("a", 10), ("b", 20)]
    assert state.change_state(spark, name, one, _put, batch_id=1) == []
    # Lost before that: the old state stays.
    with monkeypatch.context() as m:
        m.setattr(state, "_set", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            state.change_state(spark, name, spark.createDataFrame([("b", 30, None)], SCHEMA), _put, batch_id=2)
    assert _content(spark, name) == [("a", 10), ("b", 20)]
    assert state.change_state(spark, name, spark.createDataFrame([], SCHEMA), _put, batch_id=3) == []


def test_sync_reads_differing_buckets_only(spark):
    a, b = _name(spark), _name(spark)
    rows = spark.createDataFrame([(f"k{i}", i, ["x", None]) for i in range(200)], SCHEMA)
    for name in (a, b):
        state.create_state(spark, rows, name, ["k"], 16)
    assert state.sync_state(spark, a, b) == []
    touched = state.change_state(spark, a, spark.createDataFrame([("k3", 33, None), ("k4", None, None), ("k900", 9, None)], SCHEMA), _put)
    before = _files(spark, b)
    assert set(state.sync_state(spark, a, b)) <= set(touched)
    assert _content(spark, a) == _content(spark, b)
    after = _files(spark, b)
    assert {x for x in after if before.get(x) != after[x]} <= set(touched)
    other = _name(spark)
    state.create_state(spark, rows, other, ["k"], 8)
    with pytest.raises(ValueError):
        state.sync_state(spark, a, other)


def test_diff_by_bucket_equals_the_whole_diff(spark):
    s = "k long, x string, y string"
    old = spark.createDataFrame([(i, "a", None) for i in range(50)] + [(60, None, "z")], s)
    new = spark.createDataFrame([(i, "a" if i % 9 else "b", None) for i in range(45)] + [(60, "z", None), (70, None, None)], s)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(state.diff_by_bucket(old, new, ["k"], 8)) == rows(triage.snapshot_diff(old, new, ["k"]))
    assert state.diff_by_bucket(old, old, ["k"], 8).count() == 0
    assert rows(state.diff_by_bucket(old.limit(0), new, ["k"], 8)) == rows(triage.snapshot_diff(old.limit(0), new, ["k"]))
