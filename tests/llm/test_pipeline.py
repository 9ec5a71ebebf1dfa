"""The pipeline's stages against plain versions on whole small tables."""

from __future__ import annotations

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as cp

from .test_lines_syncmers import _plain_lines
from .test_near_dup import _classes

SF = "/root/testdata/sf0.001"


def test_stages_on_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit(1)).withColumn("__rid", F.lit(2))
    for name in ("__text", "__judged_rejected", "__lines_n_dropped", "__gone"):
        docs = docs.withColumn(name, F.lit("x"))
    seen = [docs]
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, seen[-1], SF)
        assert out.columns == docs.columns, name
        seen.append(spark.createDataFrame(out.collect(), docs.schema))
    rows = [sorted((r["doc_id"], r["text"]) for r in s.collect()) for s in seen]
    assert len(rows[0]) - len(rows[1]) <= 2  # few documents are rejected, all without a clear language
    want = [(i, t) for i, t, n in _plain_lines(rows[1], 5) if not n or t.strip()]
    assert rows[2] == sorted(want)
    kept = {i for i, c in _classes(rows[2]) if i == c}
    assert rows[3] == [r for r in rows[2] if r[0] in kept]
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {i for i, t in rows[3] if any(b in t for b in bench)}
    assert not whole & {i for i, _ in rows[4]} and len(rows[3]) - len(rows[4]) <= len(whole) + 2
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    last = cp.STAGES[-1][1](spark, seen[-1], SF).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["decoded"]) for r in last) == sorted((i, len(lib.encode(t)) + 2, t) for i, t in rows[4])


def test_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    empty = spark.createDataFrame([], schema)
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "a", 0), (None, "the dog and the cat", "en", "b", 19), (4, "the dog and the cat", "en", "b", 19), (4, "the dog and the cat", "en", "b", 19)], schema)
    for docs in (empty, odd):
        for _, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            assert docs is odd or out.count() == 0
            out.collect()


def test_one_row_of_each_class_is_left(spark):
    rows = [(None, "the dog and the cat"), (4, "the dog and the cat"), (4, "the dog and the cat"), (5, "the dog and the cat"), (5, "clean words of its own"), (None, "no id at all here")] + [(None, "copied without an id")] * 3
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = cp.near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    want = [(4, "the dog and the cat"), (4, "the dog and the cat"), (5, "clean words of its own"), (None, "no id at all here"), (None, "copied without an id")]
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(want, key=str)


def test_rows_that_stay_are_not_shuffled(spark):
    rows = [(i, " ".join(f"w{i * k % 97}" for k in range(20))) for i in range(1, 60)]
    docs = spark.createDataFrame(rows + [(70 + i, t) for i, t in rows[:5]], "doc_id long, text string")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if very many rows went
    try:
        out = cp.near_duplicates(spark, docs, SF)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["doc_id"] for r in out.collect()) == list(range(1, 60))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    stay = plan[plan.index("Union") : plan.index("LeftAnti")]
    assert "LeftOuter" in stay and "text" in stay.split("LeftOuter")[0]
    assert "hashpartitioning" not in stay.split("SortMergeJoin")[0]
