"""Corpus pipeline over ``documents``: language, repeated lines, near duplicates, benchmark passages, token ids.

Each stage's decisions take effect on what its predecessor kept; all but the last return the columns
of the documents that they got.
"""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import decontaminate, language_id, line_dedup, near_dup, sentencepiece_bpe
from riskflow.llm.common import fresh, parted, prepare, stage, table
from riskflow.session import scratch_path


def _prefix(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` starts with it."""
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification does not reject; it learns from those with a language.

    Null and empty texts and texts without a letter go; without a labelled text all go. Repeated rows are
    judged alike, each on its own; null ids and further columns are kept; an empty table stays empty."""
    prepare(spark)
    own = _prefix(docs, "__judged_")
    judged = language_id.predict(docs, language_id.fit(docs), keep=tuple(c for c in docs.columns if c != "doc_id"), prefix=own)
    return judged.filter(f"not `{own}rejected`").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their recurring lines; a document that loses its last words goes.

    Null and empty texts, from which nothing is dropped, stay; so do null ids, repeated rows and further
    columns, as ``line_dedup.dedup`` states; an empty table stays empty."""
    prepare(spark)
    own = _prefix(docs, "__lines_")
    left = line_dedup.dedup(docs, prefix=own)
    dropped = F.col(f"{own}n_dropped")
    left = left.filter((dropped == 0) | (F.btrim("text", F.lit(" \t\r\n")) != ""))
    if "n_chars" in docs.columns:
        changed = F.when(dropped == 0, F.col("n_chars")).otherwise(F.length("text"))
        left = left.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id, or one row if none has an id."""
    prepare(spark)
    key, text, own = fresh(docs, "__gone", "__gone_text", "__text")
    gone = near_dup.members(docs).filter("not kept").select(F.col("doc_id").alias(key), F.col("same").alias(text)).distinct()
    gone = stage(gone, "gone")
    rows = docs.withColumn(own, near_dup.digest(F.col("text")))
    # Few rows go: those that surely stay are not shuffled.
    hashes = gone.filter(F.col(key).isNotNull()).select(near_dup.row_hash(F.col(key), F.col(text)))
    likely, stay = parted(rows.filter("doc_id is not null"), near_dup.row_hash(F.col("doc_id"), F.col(own)), hashes)
    named = stay.unionByName(likely.join(gone, (F.col("doc_id") == F.col(key)) & (F.col(own) == F.col(text)), "left_anti"))
    bare = rows.filter("doc_id is null").dropDuplicates([own]).join(gone.filter(F.col(key).isNull()), F.col(own) == F.col(text), "left_anti")
    return named.unionByName(bare).select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of each document."""
    prepare(spark)
    return sentencepiece_bpe.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


#: (name, function): each takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("token_ids", token_ids),
]

#: Learned models and tokenizers have no SQL form; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = os.path.join(scratch_path(spark, "pipeline"), f"{k}-{name}-{uuid.uuid4().hex}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
