"""Removal of repeated strings against a dictionary of all 50-byte strings."""

from __future__ import annotations

import hashlib
import random
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskflow.llm import queries
from riskflow.llm import suffix_dedup as sd

from .conftest import LONG


def _plain(rows, n=50):
    big = 2**63 - 1
    rows = [(i if i is not None else big, (t or "").encode()) for i, t in rows]
    first: dict[bytes, int] = {}
    for i, t in rows:
        for p in range(len(t) - n + 1):
            s = t[p : p + n]
            if first.get(s, big + 1) > i:
                first[s] = i
    out = []
    for i, t in rows:
        gone = np.zeros(len(t) + n, bool)
        for p in range(len(t) - n + 1):
            if first[t[p : p + n]] < i:
                gone[p : p + n] = True
        gone = gone[: len(t)]
        left = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        out.append((i if i < big else -1, len(t), len(t) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out)


def _got(df):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def _corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé ") for _ in range(rnd.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(rnd.randrange(4, 60))) for _ in range(12)]
    rows = []
    for i in range(80):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else " ".join(word() for _ in range(20)) for _ in range(rnd.randrange(6))]
        parts = [p[rnd.randrange(30) :] if rnd.random() < 0.3 else p for p in parts]
        rows.append((i * 7 % 83, "".join(parts)))
    return rows


def test_odd_texts(spark, docs):
    ab = "".join(chr(97 + i * i % 26) for i in range(120))
    rows = [(1, None), (2, ""), (3, ab[:50]), (4, "x" + ab[:49]), (5, ab[:50]), (5, "y" + ab[:50]), (6, "a" * 300), (7, "b" + "a" * 49), (8, "b" + "a" * 50 + "b"), (9, LONG), (10, LONG[7:]), (None, ab), (None, ab), (-5, ab[40:]), (11, "é" * 30), (12, "zé" + "é" * 30)]
    assert _got(sd.remove_repeats(docs(rows))) == _plain(rows)
    assert sd.remove_repeats(docs([])).count() == 0
    assert _got(sd.remove_repeats(docs([(1, "a" * 99)]))) == _plain([(1, "a" * 99)])


@pytest.mark.parametrize("size", [(8 << 20, 400_000), (600, 40)])
def test_random_texts_in_many_batches(spark, docs, size, monkeypatch):
    rows = _corpus(1)
    assert _got(sd.remove_repeats(docs(rows), batch_bytes=size[0], range_keys=size[1])) == _plain(rows)


def test_index_levels_in_small_batches(spark, docs, monkeypatch):
    rng = np.random.default_rng(2)
    texts = [rng.choice([b"ab", b"ba", b"c"], 60).tobytes() for _ in range(40)]
    texts += [texts[3][5:] + texts[9][:70], texts[20]] * 3
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    size = np.array([len(t) for t in texts])
    at = np.cumsum(size) - size
    doc = np.sort(rng.integers(0, 20, len(texts)))
    monkeypatch.setattr(sd, "INDEX_WINDOWS", 90)
    got = {s: set(w.tolist()) for s, w in sd.covered(data, at, size, doc)}
    first: dict[bytes, int] = {}
    for t, d in zip(texts, doc, strict=True):
        for p in range(len(t) - 49):
            first.setdefault(t[p : p + 50], d)
    want = {i: {p for p in range(len(t) - 49) if first[t[p : p + 50]] < d} for i, (t, d) in enumerate(zip(texts, doc, strict=True))}
    assert got == {i: w for i, w in want.items() if w}


def test_index_of_some_keys_at_a_time(monkeypatch):
    """The same windows as with one index, in memory that the number of windows does not set."""
    rng = np.random.default_rng(3)
    text = rng.integers(97, 123, 2_000_000, np.uint8).tobytes()
    texts = [text[i : i + 40_000] for i in rng.integers(0, len(text) - 40_000, 100)]
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    _, row, at, end = sd.segments(data[: offsets[-1]], offsets)
    size, doc = end - at + sd.LENGTH - 1, rng.permutation(100)[row]
    order = np.argsort(doc, kind="stable")
    want = {int(order[s]): w.tolist() for s, w in sd.covered(data, at[order], size[order], doc[order])}
    monkeypatch.setattr(sd, "INDEX_MOST", 1 << 17)
    monkeypatch.setattr(sd, "INDEX_WINDOWS", 1 << 13)
    tracemalloc.start()
    got = {}
    for s, w in sd.covered_by_keys(data, at, size, doc):
        got[s] = w.tolist()
        w = None
        if len(got) == 1:
            tracemalloc.reset_peak()
            before = tracemalloc.get_traced_memory()[0]
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert got == want and len(got) > 1000
    assert peak < 60 << 20


def _key_table(keys, many):
    return pa.table({
        "range": pa.array([3] * len(keys), pa.int32()),
        "batch": pa.array(range(len(keys)), pa.int32()),
        "keys": pa.chunked_array([pa.array([k.astype("<u4").tobytes() for k in part], pa.binary()) for part in (keys[:2], keys[2:])]),
        "many": pa.array([np.packbits(m).tobytes() for m in many], pa.binary()),
    })


def test_keys_of_many_batches_cost_as_those_of_few():
    """The same keys in 2,000 batches of a range as in 4; each batch searched for in all shared keys took 340 times as long."""
    rng = np.random.default_rng(5)
    keys = np.repeat(rng.choice(2**32, 100_000, replace=False).astype(np.uint32), 2)
    many = np.zeros(len(keys), bool)
    rng.shuffle(keys)
    seconds = []
    for n in (4, 2000):
        table = _key_table(np.array_split(keys, n), np.array_split(many, n))
        begun = time.process_time()
        assert sd.shared_keys(table).num_rows == n
        seconds.append(time.process_time() - begun)
    assert seconds[1] < 10 * seconds[0] + 0.5


def test_shared_keys_of_two_batches_or_documents():
    rng = np.random.default_rng(6)
    keys = [rng.choice(60, n, replace=False).astype(np.uint32) for n in (1, 9, 8, 17, 3)]
    keys.append(np.array([77, 78, 77], np.uint32))  # low bits that two keys of a batch share
    many = [rng.random(len(k)) < 0.2 for k in keys]
    got = sd.shared_keys(_key_table(keys, many))
    batches = Counter(k for blob in keys for k in set(blob.tolist()))
    own = {k for blob, m in zip(keys, many, strict=True) for k in blob[m].tolist()}
    want = [[batches[k] > 1 or k in own for k in blob.tolist()] for blob in keys]
    masks = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(k)).astype(bool).tolist() for m, k in zip(got["mask"].to_pylist(), keys, strict=True)]
    assert masks == want
    assert got["batch"].to_pylist() == list(range(6)) and got["range"].to_pylist() == [3] * 6


def test_kept_text_and_spans(spark, docs):
    text = "".join(chr(97 + i * i * 3 % 26) for i in range(90)) + "0123456789" * 6
    r = sd.remove_repeats(docs([(1, text), (2, "<<" + text[10:75] + ">>")]), with_text=True).filter("doc_id = 2").first()
    assert r["kept"] == b"<<>>" and [(s["start"], s["stop"]) for s in r["spans"]] == [(2, 67)]


def test_query_on_all_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert _got(queries.queries()["op1_suffix_dedup"](spark, sf)) == _plain(rows)
