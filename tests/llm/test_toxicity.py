"""Toxicity scores: held-out rows, whole texts, odd rows, and the pooling against a plain loop."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from riskflow.llm import queries
from riskflow.llm import toxicity as tx
from tests.conftest import SF01

BAD = {"en": ["idiot", "moron", "scum", "loser"], "fr": ["crétin", "ordure", "abruti"]}
GOOD = {"en": "the of and to in that is was for with house river stone green seven paper window light".split(), "fr": "le la les des une dans pour avec maison pierre verte sept papier fenêtre lumière".split()}


def _rows(n, seed, first=0):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        lang = rnd.choice(["en", "fr"])
        words, toxic = rnd.choices(GOOD[lang], k=rnd.randrange(20, 120)), int(rnd.random() < 0.3)
        for _ in range(rnd.randrange(2, 5) if toxic else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(BAD[lang]))
        rows.append((first + i, " ".join(words).capitalize() + ".", lang, toxic))
    return rows


def _tables(spark, rows):
    docs = spark.createDataFrame([(i, t, g, "s", 0.5, -1) for i, t, g, _ in rows], "doc_id long, text string, lang string, source string, score double, label int")
    return docs, spark.createDataFrame([(i, x) for i, _, _, x in rows], "doc_id long, toxic int")


def test_new_rows_and_odd_texts(spark):
    model = tx.fit(*_tables(spark, _rows(500, 1)))
    rows = _rows(200, 2, 1000)
    long = "the river " * 60_000
    odd = [(1, None, None, 0), (2, "", "en", 0), (3, " \n.,", "fr", 0), (4, long, "en", 0), (5, long + "you idiot and moron, scum", "en", 1), (None, "a moron idiot", None, 1), (6, "x" * 300_000, None, 0)]
    docs, _ = _tables(spark, rows + odd + rows[:2])
    got = tx.predict(docs, model, keep=("source",)).collect()
    assert len(got) == len(rows) + len(odd) + 2
    truth = {r[0]: r[3] for r in rows}
    right = [g["predicted"] == truth[g["doc_id"]] for g in got if g["doc_id"] in truth]
    assert np.mean(right) > 0.97
    by_id = {g["doc_id"]: g for g in got}
    assert by_id[4]["predicted"] == 0 and by_id[5]["predicted"] == 1 and by_id[1]["score"] == by_id[2]["score"] == by_id[3]["score"]
    assert all(0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.5) for g in got)


def test_nothing_or_one_label_to_learn(spark):
    docs, labels = _tables(spark, _rows(30, 3))
    assert {(r["score"], r["predicted"]) for r in tx.predict(docs, tx.fit(docs, labels.limit(0))).collect()} == {(0.0, 0)}
    assert {(r["score"], r["predicted"]) for r in tx.predict(docs, tx.fit(docs, labels.filter("toxic = 1"))).collect()} == {(1.0, 1)}
    null = labels.withColumn("toxic", F.lit(None).cast("int"))
    assert {r["score"] for r in tx.predict(docs, tx.fit(docs, null)).collect()} == {0.0}
    model = tx.fit(docs.limit(0), labels)
    assert model is None and tx.predict(docs.limit(0), model).count() == 0


def test_pooling_equals_a_plain_loop(monkeypatch):
    draw = np.random.default_rng(4)
    feats = draw.integers(0, 1 << tx.BUCKETS_LOG2, (30, 5)).astype(np.uint16)
    doc = np.sort(draw.integers(0, 40, 300))
    which = draw.integers(0, 30, 300)
    filters = [draw.normal(size=(w, tx.DIM, tx.FILTERS)).astype(np.float32) for w in tx.WIDTHS]
    made = len(filters) * tx.FILTERS
    emb = draw.normal(size=(1 << tx.BUCKETS_LOG2, tx.DIM)).astype(np.float32)
    model = tx.Model(emb, filters, np.zeros(made * tx.LARGEST), np.ones(made * tx.LARGEST), 0.0, None)
    want = np.zeros((42, tx.LARGEST, made))
    for d in range(42):
        own = which[doc == d]
        x = np.concatenate([emb[feats[own]].mean(axis=1), np.zeros((2, tx.DIM))]) if len(own) else np.zeros((2, tx.DIM))
        r = np.array([np.concatenate([sum(x[i + j] @ f[j] for j in range(len(f))) for f in filters]) for i in range(len(own))]).reshape(-1, made)
        want[d, : min(tx.LARGEST, len(own))] = -np.sort(-r, axis=0)[: tx.LARGEST]
    for block in (1 << 16, 64, 7):
        monkeypatch.setattr(tx, "BLOCK", block)
        assert np.allclose(model.largest(doc, which, feats, 42), want.reshape(42, -1), atol=1e-4)


def test_held_out_rows_of_the_tables(spark):
    got = queries.queries()["op12_toxicity"](spark, SF01)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    assert got.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()
    seen = got.join(labels, "doc_id").filter("held_out and toxic is not null").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in seen]) > 0.93
    toxic, clean = ([r["score"] for r in seen if r["toxic"] == k] for k in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) > 0.9


def test_labels_of_the_held_out_fold_are_not_read(spark, tmp_path):
    """Other labels, languages and sources on the held-out fold change no score."""
    made = []
    for k in range(2):
        docs, labels = _tables(spark, _rows(150, 5))
        held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
        if k:
            docs = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("other"))
            labels = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
        docs.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{k}/labels.parquet")
        made.append(sorted(queries.queries()["op12_toxicity"](spark, f"{tmp_path}/{k}").collect()))
    assert made[0] == made[1] and len(made[0]) == 150


def test_all_labelled_texts_are_learned_from_whole(spark):
    """More rows of a label than 1,500 and texts of more than 2,000 words: each is in a shard once, with all its words."""
    rows = [(i, f"river stone w{i}", "en", 0) for i in range(1600)] + [(5000 + i, "green window " * 1500 + f"scum w{i}", "en", 1) for i in range(12)]
    docs, labels = _tables(spark, rows + [(9000, "river stone w7", "en", 0), (9001, "...", "en", 0), (9002, "no label", "en", None)])
    shards = [x for b in tx.labelled(docs, labels, None).toArrow().to_batches() for x in tx._shards(iter([b]))]
    assert sum(len(x.label) for x in shards) == 1612 and sum(int((x.label == 1).sum()) for x in shards) == 12
    sizes = sorted(n for x in shards for n in np.diff(x.cuts).tolist())
    assert sizes == [3] * 1600 + [3002] * 12


def test_shards_are_added_and_averaged(spark, monkeypatch):
    """Many shards: counts are exact, however the shards lie, and the model made of all of them is right on new rows."""
    monkeypatch.setattr(tx, "SHARD_BYTES", 20_000)
    train, new = _rows(600, 6), _rows(150, 7, 5000)
    docs, labels = _tables(spark, train)
    shards = tx.stage(tx.labelled(docs, labels, None), "shards")
    rows = [x for b in shards.toArrow().to_batches() for x in tx._shards(iter([b]))]
    assert len(rows) > 5 and len({x.number for x in rows}) == len(rows)
    each = lambda x: np.bincount(x.label, minlength=1000) * -(2**40)
    got = tx.total(shards, each, 1000)
    assert (got == tx.total(shards.repartition(3), each, 1000)).all()
    assert (got[:2] // -(2**40)).tolist() == [sum(r[3] == k for r in train) for k in (0, 1)]
    model = tx.fit(docs, labels)
    seen = tx.predict(_tables(spark, new)[0], model).collect()
    truth = {r[0]: r[3] for r in new}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in seen]) > 0.97
    again = tx.predict(_tables(spark, new)[0], tx.fit(docs.repartition(5), labels.repartition(2))).collect()
    assert sorted(tuple(r) for r in seen) == sorted(tuple(r) for r in again)


def test_languages_are_read_where_a_curve_needs_them(spark):
    docs, labels = _tables(spark, _rows(60, 11))
    languages = tx.language_id.fit(docs)
    for short in (False, True):
        shards = [x for b in tx.labelled(docs, labels, languages, short).toArrow().to_batches() for x in tx._shards(iter([b]))]
        judged = {r["text"]: r["lang_pred"] for r in tx.language_id.predict(docs, languages, keep=("text",)).collect()}
        seen = sorted(x for s in shards for x in s.lang[s.held(short)])
        kept = docs.selectExpr("text", "xxhash64(text) as pick").collect()
        assert seen == sorted(judged[r["text"]] for r in kept if short or r["pick"] % 5 == 0)
        assert sum(bool(x) for s in shards for x in s.lang) == len(seen) and 0 < len(seen) <= 60
