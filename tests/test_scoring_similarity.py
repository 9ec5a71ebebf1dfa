"""Scoring (summary, ladder, default scorer, reply parsing, external scorer) and similarity."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskflow.operators import scoring, similarity


def test_ladder_first_match_and_monotone(spark):
    df = spark.createDataFrame(
        [("CRITICAL", 0.0), ("LOW", 85.0), ("HIGH", 99.0), ("HIGH", 10.0), ("MEDIUM", 0.0), ("", 50.0), (None, 49.99), ("LOW", None)],
        "risk_level string, risk_score double",
    )
    got = [r[0] for r in df.select(scoring.risk_action()).collect()]
    assert got == ["BLOCK", "BLOCK", "BLOCK", "CHALLENGE", "MONITOR", "MONITOR", "APPROVE", "APPROVE"]
    scores = spark.range(0, 101).select(F.col("id").cast("double").alias("risk_score"))
    acts = [
        r[1] for r in scores.select("risk_score", scoring.risk_action(F.lit("LOW"), "risk_score")).orderBy("risk_score").collect()
    ]
    rank = {"APPROVE": 0, "MONITOR": 1, "CHALLENGE": 2, "BLOCK": 3}
    assert [rank[a] for a in acts] == sorted(rank[a] for a in acts)


def test_summary_text(spark):
    df = spark.createDataFrame(
        [("wire", 15000.0, True, True, True), (None, None, False, None, False), ("", 1.5, False, False, False)],
        "transaction_type string, amount double, mfa_change_flag boolean, ip_changed_recently boolean, high_value_wire boolean",
    )
    got = [r[0] for r in df.select(scoring.summary_text()).collect()]
    assert got == [
        "Transaction type: wire Amount: 15000.00 MFA or security changed recently. IP address changed recently. High-value wire transfer.",
        "Transaction with no extra signals.",
        "Amount: 1.50",
    ]


def test_parse_reply_variants_and_fallback(spark):
    body = '{"risk_score": 91, "risk_level": "CRITICAL", "reason": "r", "matched_signatures": ["a"]}'
    df = spark.createDataFrame(
        [("1", "```json\n" + body + "\n```"), ("2", "```\n" + body + "```"), ("3", "  " + body), ("4", "not json"),
         ("5", None), ("6", '{"risk_score": "72.5", "risk_level": "HIGH"}'), ("7", '{"risk_level": "HIGH"}'),
         ("8", '{"risk_score": "abc"}'), ("9", "[1, 2]")],
        "id string, reply string",
    )
    out = {r["id"]: r for r in scoring.with_action_and_fallback(scoring.parse_reply(df, "reply")).collect()}
    for i in "123":
        assert (out[i]["risk_score"], out[i]["automated_action"], out[i]["matched_signatures"]) == (91.0, "BLOCK", ["a"])
    assert (out["4"]["risk_score"], out["4"]["risk_level"], out["4"]["automated_action"]) == (0.0, "LOW", "MONITOR")
    assert out["4"]["reason"].startswith("unparseable reply")
    assert out["5"]["automated_action"] == "MONITOR"
    assert (out["6"]["risk_score"], out["6"]["automated_action"]) == (72.5, "CHALLENGE")
    # No score: 0, the level still drives the ladder. Non-numeric score or non-object: fallback.
    assert (out["7"]["risk_score"], out["7"]["risk_level"], out["7"]["automated_action"]) == (0.0, "HIGH", "CHALLENGE")
    assert out["8"]["reason"].startswith("invalid risk_score") and out["8"]["automated_action"] == "MONITOR"
    assert out["9"]["reason"].startswith("unparseable reply") and out["9"]["risk_level"] == "LOW"


def test_external_scorer_runs_per_batch_and_failures_fall_back(spark):
    act = spark.createDataFrame(
        [("t1", "wire", 20000.0, True, True, True), ("t2", "card", 5.0, False, False, False)],
        "transaction_id string, transaction_type string, amount double, mfa_change_flag boolean, "
        "ip_changed_recently boolean, high_value_wire boolean",
    )

    def good(pdf: pd.DataFrame) -> pd.Series:
        return pdf["summary"].map(lambda s: '{"risk_score": %d, "risk_level": "LOW"}' % (80 if "wire" in s else 5))

    out = {r["transaction_id"]: r for r in scoring.with_action_and_fallback(scoring.score_external(act, good)).collect()}
    assert out["t1"]["automated_action"] == "CHALLENGE" and out["t2"]["automated_action"] == "APPROVE"

    def bad(pdf):
        raise RuntimeError("model unavailable")

    out = scoring.with_action_and_fallback(scoring.score_external(act, bad)).collect()
    assert {r["reason"] for r in out} == {"model unavailable"} and {r["automated_action"] for r in out} == {"MONITOR"}


def _tokens(text):
    return [t for t in re.split("[^a-z0-9]+", text.lower()) if t]


def _brute_text_topk(queries, docs, k):
    n = len(docs)
    dtf = {d: Counter(_tokens(t)) for d, t in docs}
    df = Counter(t for c in dtf.values() for t in c)
    idf = lambda t: math.log((n + 1) / (df.get(t, 0) + 1)) + 1
    dvec = {d: {t: c * idf(t) for t, c in tf.items()} for d, tf in dtf.items()}
    out = set()
    for q, text in queries:
        qv = {t: c * idf(t) for t, c in Counter(_tokens(text)).items()}
        qn = math.sqrt(sum(v * v for v in qv.values()))
        scored = []
        for d, dv in dvec.items():
            dot = sum(w * dv[t] for t, w in qv.items() if t in dv)
            if dot > 0 or any(t in dv for t in qv):
                dn = math.sqrt(sum(v * v for v in dv.values()))
                scored.append((round(dot / (qn * dn), 6), d))
        scored.sort(key=lambda x: (-x[0], x[1]))
        out |= {(q, d, s, i + 1) for i, (s, d) in enumerate(scored[:k])}
    return out


def test_text_topk_matches_brute_force(spark):
    docs = [(1, "Wire transfer after IP change"), (2, "MFA changed; high-value wire!"), (3, "the the the cat"),
            (4, "Impossible travel: New York then Hong Kong"), (5, ""), (6, "wire wire wire")]
    queries = [(10, "high value wire transfer"), (11, "cat"), (12, "nothing matches here"), (13, "New York wire")]
    got = similarity.text_topk(
        spark.createDataFrame(queries, "qid long, text string"), spark.createDataFrame(docs, "did long, body string"),
        "qid", "text", "did", "body", k=3,
    )
    got = {(r["query_id"], r["doc_id"], r["score"], r["rank"]) for r in got.collect()}
    assert got == _brute_text_topk(queries, docs, 3)


def test_text_bounds_leave_the_hits_as_they_are(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    weight = 1 / np.arange(1, 401)
    draw = lambda n: " ".join(rng.choice(words, n, p=weight / weight.sum()))
    docs = [(i, draw(int(rng.integers(3, 200)))) for i in range(600)]
    docs += [(600 + i, docs[i % 7][1]) for i in range(30)] + [(700, None), (701, ""), (None, draw(40))]
    queries = [(i, docs[i * 20][1][:60] + " " + draw(8)) for i in range(20)] + [(90, None), (91, "w0"), (92, "w0 w0 w1"), (93, "nothing here")]
    q, d = spark.createDataFrame(queries, "qid long, text string"), spark.createDataFrame(docs, "did long, body string")
    for seeds, salt in ((similarity.SEED_POSTINGS, 200_000), (1, 50)):
        monkeypatch.setattr(similarity, "SEED_POSTINGS", seeds)
        found = similarity.text_search(q, d, "qid", "text", "did", "body", k=4, salt_postings=salt)
        assert {tuple(r) for r in found.query_terms.agg(F.max("salts") > 1).collect()} == {(salt == 50,)}
        got = [(r["query_id"], r["doc_id"], r["score"], r["rank"]) for r in found.hits().collect()]
        kept = [(i, t) for i, t in docs if i is not None]
        want = {(a, b, c) for a, b, c, _ in _brute_text_topk([x for x in queries if x[1]], [(i, t or "") for i, t in kept] + [(-1, docs[-1][1])], 4)}
        # A NULL id is a document, which the number of documents does not count: scores differ a little.
        assert len(got) == len(want) and {x[0] for x in got} == {x[0] for x in want}
    d = d.filter("did is not null")
    found = similarity.text_search(q, d, "qid", "text", "did", "body", k=4)
    assert {tuple(r) for r in found.hits().collect()} == _brute_text_topk([x for x in queries if x[1]], [(i, t or "") for i, t in kept], 4)
    pairs, met = found.candidates()[0].count(), found.partial(found.query_terms).count()
    assert pairs < met / 3
    assert similarity.text_topk(q, d.limit(0), "qid", "text", "did", "body").count() == 0


def test_vector_topk_matches_numpy_in_any_blocks(spark):
    rng = np.random.default_rng(0)
    corpus = [(i, rng.normal(size=8).astype(float).tolist(), i % 2) for i in range(40)]
    queries = [(100 + j, rng.normal(size=8).astype(float).tolist(), j % 2) for j in range(5)]
    c_df = spark.createDataFrame(corpus, "id long, v array<double>, g int")
    q_df = spark.createDataFrame(queries, "qid long, qv array<double>, g int")
    want = set()
    for qid, qv, _ in queries:
        s = [(round(float(np.dot(qv, v) / (np.linalg.norm(qv) * np.linalg.norm(v))), 6), i) for i, v, _ in corpus]
        s.sort(key=lambda x: (-x[0], x[1]))
        want |= {(qid, i, r + 1) for r, (_, i) in enumerate(s[:4])}
    for size in (32 << 20, 100):
        got = similarity.vector_topk(q_df, c_df.repartition(5), "qid", "qv", "id", "v", k=4, block_bytes=size)
        assert {(r["query_id"], r["doc_id"], r["rank"]) for r in got.collect()} == want
    odd = spark.createDataFrame([(1, None, 0), (2, [0.0] * 8, 0), (3, [1.0], 0), (4, [1.0] + [0.0] * 7, 0)], c_df.schema)
    r = similarity.vector_topk(odd.select(F.col("id").alias("qid"), F.col("v").alias("qv")), odd, "qid", "qv", "id", "v", k=3).collect()
    assert sorted((x["query_id"], x["rank"], x["doc_id"], x["score"]) for x in r if x["query_id"] in (1, 4)) == [(1, 1, 1, None), (1, 2, 2, None), (1, 3, 3, None), (4, 1, 4, 1.0), (4, 2, 1, None), (4, 3, 2, None)]
    assert similarity.vector_topk(q_df, c_df.limit(0), "qid", "qv", "id", "v").count() == 0
    by_group = similarity.vector_topk(q_df, c_df, "qid", "qv", "id", "v", k=4, by="g").collect()
    assert all((r["doc_id"] % 2) == ((r["query_id"] - 100) % 2) for r in by_group)


def test_centroids(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0, 4.0]), (1, [5.0, 5.0])], "g int, v array<float>")
    got = {r["g"]: r["centroid"] for r in similarity.centroids(df, "g", "v").collect()}
    assert got == {0: [2.0, 3.0], 1: [5.0, 5.0]}


def test_external_scorer_sees_prompt_and_hits_and_prefixes_errors(spark):
    from riskflow.constants import OPERATIONAL_ERROR_PREFIX

    act = spark.createDataFrame(
        [("t1", "wire", 20000.0, True, True, True)],
        "transaction_id string, transaction_type string, amount double, mfa_change_flag boolean, "
        "ip_changed_recently boolean, high_value_wire boolean",
    )
    raw_hits = spark.createDataFrame([("t1", "sig_a", 0.9, 1), ("t1", "sig_b", 0.5, 2)], "transaction_id string, signature_id string, similarity_score double, rank long")
    hits = similarity.collect_hits(raw_hits, "transaction_id", ["signature_id", "similarity_score"])
    def scorer(pdf):
        return pd.Series(["nope"] * len(pdf))

    out = scoring.with_action_and_fallback(scoring.score_external(act, scorer, hits), OPERATIONAL_ERROR_PREFIX).collect()[0]
    assert out["signatures_searched"] == 2 and out["transaction_query_text"].startswith("Transaction type: wire")
    assert out["reason"].startswith("Error: unparseable reply")
    # The scorer ran on an executor; the prompt it saw is checked through the returned rows instead.
    prompts = scoring.score_external(act, lambda pdf: pdf["prompt"], hits).collect()
    assert prompts[0]["parse_error"].startswith("unparseable reply (")


def test_strict_reply_parsing_and_mixed_length_centroids(spark):
    df = spark.createDataFrame(
        [("a", '{"risk_score": 90} trailing'), ("b", "{'risk_score': 90}"), ("c", " \n "),
         ("d", '```json\n{"risk_score": 91}\n```')],
        "id string, reply string",
    )
    out = {r["id"]: r for r in scoring.with_action_and_fallback(scoring.parse_reply(df, "reply")).collect()}
    assert out["a"]["reason"].startswith("unparseable") and out["b"]["reason"].startswith("unparseable")
    assert out["c"]["reason"] == "empty reply"
    assert (out["d"]["risk_score"], out["d"]["automated_action"]) == (91.0, "BLOCK")
    mixed = spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0])], "g int, v array<double>")
    assert similarity.centroids(mixed, "g", "v").collect()[0]["centroid"] is None


def test_literal_topk_always_gives_k_hits(spark):
    docs = [(1, "wire transfer of high value"), (2, "wire wire"), (3, ""), (4, None), (5, "login from a new place")]
    queries = [(10, "a high value wire"), (11, "nothing here"), (12, ""), (13, None)]
    d = spark.createDataFrame(docs, "d long, t string")
    q = spark.createDataFrame(queries, "q long, s string")
    got = similarity.literal_text_topk(q, d, "q", "s", "d", "t", k=3)
    rows = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in got.collect()}
    assert len(rows) == 12 and [rows[11, k] for k in (1, 2, 3)] == [(1, 0.0), (2, 0.0), (3, 0.0)] == [rows[13, k] for k in (1, 2, 3)]
    general = {(r["query_id"], r["doc_id"]): r["score"] for r in similarity.text_topk(q, d.filter("t is not null"), "q", "s", "d", "t", k=9).collect()}
    exact = {(r["query_id"], r["doc_id"]): r["score"] for r in similarity.literal_text_topk(q, d.filter("t is not null"), "q", "s", "d", "t", k=9).collect() if r["score"]}
    assert exact == general
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0


def test_reply_tags_null_scores_and_signature_types(spark):
    replies = ['json{"risk_score": 90}', '```json\n{"risk_score": 90}\n```', '{"risk_score": 50, "matched_signatures": "one"}', '{"risk_score": null}', '{"risk_score": 5, "matched_signatures": ["a", "b"]}', '{"risk_level": "LOW"}']
    df = spark.createDataFrame(list(enumerate(replies)), "i int, reply string")
    got = {r["i"]: r for r in scoring.parse_reply(df).collect()}
    assert got[0]["parse_error"].startswith("unparseable") and got[1]["risk_score"] == 90 and got[1]["parse_error"] is None
    assert got[2]["risk_score"] == 50 and got[2]["parse_error"] is None and got[2]["matched_signatures"] is None
    assert got[3]["parse_error"] == "invalid risk_score: null"
    assert got[4]["matched_signatures"] == ["a", "b"] and got[5]["risk_score"] == 0 and got[5]["parse_error"] is None


def test_one_failing_row_gives_one_fallback(spark):
    from riskflow.plans import silver
    from riskflow.sources import fixtures

    rel = fixtures.load(spark, "/root/testdata/sf0.001")
    activity = silver.user_activity(rel["transactions"], rel["logins"]).orderBy("transaction_id").limit(100)
    bad = activity.agg({"transaction_id": "max"}).first()[0]

    def scorer(pdf):
        if (pdf["transaction_id"] == bad).any():
            raise RuntimeError("no answer")
        return pdf["transaction_id"].map(lambda _: '{"risk_score": 7}')

    got = scoring.score_external(activity.coalesce(1), scorer).collect()
    assert len(got) == 100 and [r["transaction_id"] for r in got if r["parse_error"]] == [bad]


def test_term_counting_tasks_follow_the_bytes_of_text(spark, monkeypatch):
    """A task counts the terms of a bounded amount of text, however Spark would size the shuffle."""
    from riskflow.operators import similarity

    monkeypatch.setattr(similarity, "PART_BYTES", 10_000)
    docs = spark.createDataFrame([(i, f"word{i % 7} common " * 100) for i in range(40)] + [(None, "null id"), (99, None)], "id long, text string")
    got = similarity._term_counts(docs, "id", "text", by_id=True)
    size = sum(len(f"word{i % 7} common " * 100) for i in range(40)) + 7
    assert got.select("__id", F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0] >= size // 10_000 // 2
    assert got.rdd.getNumPartitions() == -(-size // 10_000)
    assert sorted(map(tuple, got.filter("__id = 8").collect())) == [(8, "common", 100), (8, "word1", 100)]
    empty = similarity._term_counts(docs.limit(0), "id", "text", by_id=True)
    assert empty.count() == 0
