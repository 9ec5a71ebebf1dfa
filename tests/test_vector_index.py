"""The vector index against a search of all rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from riskflow.operators import similarity, vector_index

SCHEMA = "id long, v array<double>"


def _rows(n, groups, spread, seed=0):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(groups, 12))
    return [(i, (at[rng.integers(groups)] + spread * rng.normal(size=12)).tolist()) for i in range(n)]


def test_exact_form_equals_all_rows_and_probes_reach_the_recall(spark):
    for spread in (0.05, 3.0):  # clear groups; nearly none
        rows = _rows(1500, 12, spread) + [(5000 + i, v) for i, (_, v) in enumerate(_rows(1500, 12, spread)[:40])]
        corpus = spark.createDataFrame(rows, SCHEMA).repartition(5)
        queries = corpus.filter("id % 20 = 0")
        index = vector_index.build_index(corpus, "id", "v", lists=16, sample_rows=500)
        assert index.rows.count() == len(rows) == index.sizes.sum()
        want = {tuple(r) for r in similarity.vector_topk(queries, corpus, "id", "v", "id", "v").collect()}
        got = {tuple(r) for r in vector_index.search(index, queries, "id", "v", probes=2, part_rows=37).collect()}
        assert got == want
        probes = vector_index.probes_for(index, corpus.filter("id % 20 = 7"), "id", "v")
        near = {tuple(r)[:2] for r in vector_index.search(index, queries, "id", "v", probes=probes, exact=False).collect()}
        assert len(near & {w[:2] for w in want}) >= 0.9 * len(want)
        assert spread > 1 or probes <= 4


def test_bound_leaves_out_far_lists(spark):
    rows = _rows(2000, 16, 0.02)
    corpus = spark.createDataFrame(rows, SCHEMA)
    index = vector_index.build_index(corpus, "id", "v", lists=16)
    queries = corpus.filter("id % 40 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("vec"))
    first = vector_index.search(index, queries, "query_id", "vec", probes=2, exact=False)
    floors = first.groupBy("query_id").agg(F.min("score").alias("floor"))
    more = vector_index._asked(index, queries.join(floors, "query_id", "left"), 2, True).count()
    assert more < queries.count() * 16 / 4


def test_odd_vectors_and_empty_tables(spark):
    odd = [(1, None), (2, [0.0] * 3), (3, [1.0]), (4, [1.0, 0.0, 0.0]), (5, [float("nan"), 1.0, 0.0]), (6, [2.0, 0.0, 0.0]), (6, [2.0, 0.0, 0.0]), (7, [0.0, 1.0, 0.0]), (8, [None, 1.0, 1.0])]
    corpus = spark.createDataFrame(odd, SCHEMA).withColumn("list", F.lit("x"))
    index = vector_index.build_index(corpus, "id", "v", lists=4)
    got = vector_index.search(index, corpus.filter("id in (1, 4)"), "id", "v", k=3).collect()
    assert sorted((r["query_id"], r["doc_id"], r["score"]) for r in got) == [(4, 4, 1.0), (4, 6, 1.0), (4, 6, 1.0)]
    none = vector_index.build_index(corpus.limit(0), "id", "v")
    assert vector_index.search(none, corpus, "id", "v").count() == 0
    assert vector_index.search(index, corpus.limit(0), "id", "v").count() == 0


def test_open_search_holds_few_scores_at_once():
    """A task's memory follows the block of queries and its hits, not queries times rows; hits equal brute force."""
    import tracemalloc

    import pandas as pd

    from riskflow.operators import similarity

    rng = np.random.default_rng(3)
    queries, docs = rng.integers(-3, 4, (6000, 8)).astype(float), rng.integers(-3, 4, (3000, 8)).astype(float)
    docs[:3] = 0
    asked = [(i, list(v)) for i, v in enumerate(queries)] + [(None, list(queries[0])), (-1, None), (-2, [1.0])]

    class Sent:
        value = similarity._by_length(asked)

    frames = [pd.DataFrame({"doc_id": np.arange(a, a + 1000)[::-1], "__dv": list(docs[a : a + 1000][::-1])}) for a in range(0, 3000, 1000)]
    tracemalloc.start()
    got = pd.concat(similarity._block_search(Sent, 5)(iter(frames)), ignore_index=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6, peak
    assert len(got) == 5 * len(asked) and got[got.query_id.isin([-1, -2])].score.isna().all()
    unit = lambda m: m / np.where((m * m).sum(1) == 0, np.nan, np.sqrt((m * m).sum(1)))[:, None]
    sim = np.round(unit(queries) @ unit(docs).T, similarity.SCORE_DIGITS)
    for i in (0, 1, 77, 5999):
        best = np.lexsort((np.arange(3000), np.where(np.isnan(sim[i]), np.inf, -sim[i])))[:5]
        assert got[got.query_id == i].doc_id.tolist() == best.tolist()
