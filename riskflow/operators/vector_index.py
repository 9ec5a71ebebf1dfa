"""Vector search over an index of lists: rows go to the nearest of a few centres, queries meet some lists.

The centres are fitted to a bounded sample; every row is indexed, in one scan. A query meets the lists whose
centres are nearest to it (``probes``). In the exact form it then meets every further list that may still
hold a better row: a list's rows lie within a known angle of its centre, so that by the triangle inequality of
angles no row of it is nearer to the query than the centre's angle less the list's.

Both sides may be large: a list is cut into parts of ``part_rows`` rows and the queries that meet it into
blocks of ``part_rows``; a task scores one part against one block in numpy and keeps k rows a query.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from riskflow.constants import DEFAULT_TOP_K
from riskflow.operators.similarity import MARGIN, SCORE_DIGITS, _top_k
from riskflow.session import scratch_path

SAMPLE_ROWS = 20_000
PART_ROWS = 20_000
ROUNDS = 10


@dataclass(frozen=True)
class VectorIndex:
    """``rows``: (doc_id, list, vec), unit vectors; ``centres``: one unit vector a list; ``reach``: the
    smallest cosine of a list's rows to its centre; ``sizes``: rows of each list."""

    rows: DataFrame
    centres: np.ndarray
    reach: np.ndarray
    sizes: np.ndarray


def _fit(sample: list, lists: int) -> np.ndarray:
    """Centres of a sample by cosine k-means (fixed seed); vectors of the most frequent length count."""
    got = [np.asarray([np.nan if x is None else x for x in v], float) for v in sample if v is not None and len(v)]
    if not got:
        return np.zeros((0, 0))
    sizes, n = np.unique([len(v) for v in got], return_counts=True)
    rows = np.stack([v for v in got if len(v) == sizes[n.argmax()]])
    norm = np.sqrt((rows * rows).sum(axis=1))
    rows = rows[np.isfinite(norm) & (norm > 0)] / norm[np.isfinite(norm) & (norm > 0)][:, None]
    rows = np.unique(rows, axis=0)
    rng = np.random.default_rng(0)
    centres = rows[rng.permutation(len(rows))[:lists]]
    for _ in range(ROUNDS):
        near = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


def build_index(corpus: DataFrame, doc_id: str, doc_vec: str, lists: int = 64, sample_rows: int = SAMPLE_ROWS) -> VectorIndex:
    """Index every row of ``corpus`` that has a direction (vectors that are NULL, zero, not finite or of another
    length than the most frequent one in the sample are not indexed and never hits).

    Centres are fitted to ``sample_rows`` rows, those with the smallest hashes of their ids. ``lists`` should
    grow like the square root of the rows; the centres (``lists`` vectors) are sent to all tasks."""
    spark = corpus.sparkSession
    src = corpus.select(F.col(doc_id).alias("doc_id"), F.col(doc_vec).cast("array<double>").alias("vec"))
    sample = src.orderBy(F.xxhash64("doc_id"), F.xxhash64("vec")).limit(sample_rows).collect()
    centres = _fit([r["vec"] for r in sample], lists)
    dims = centres.shape[1]
    sent = spark.sparkContext.broadcast(centres)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = sent.value
        for pdf in batches:
            keep = np.array([v is not None and dims and len(v) == dims for v in pdf["vec"]], bool)
            pdf = pdf[keep]
            if not len(pdf):
                continue
            m = np.stack([np.asarray([np.nan if x is None else x for x in v], float) for v in pdf["vec"]])
            norm = np.sqrt((m * m).sum(axis=1))
            good = np.isfinite(norm) & (norm > 0)
            unit = m[good] / norm[good][:, None]
            cos = unit @ at.T
            near = cos.argmax(axis=1)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[good], "list": near.astype("int32"), "cos": cos[np.arange(len(near)), near], "vec": pd.Series(list(unit), dtype=object)})

    out = StructType([src.schema["doc_id"], StructField("list", IntegerType()), StructField("cos", DoubleType()), StructField("vec", ArrayType(DoubleType()))])
    path = os.path.join(scratch_path(spark, "vector-index"), uuid.uuid4().hex)
    src.mapInPandas(place, out).write.parquet(path)
    rows = spark.read.schema(out).parquet(path)
    reach, sizes = np.ones(len(centres)), np.zeros(len(centres), np.int64)
    for r in rows.groupBy("list").agg(F.min("cos").alias("cos"), F.count(F.lit(1)).alias("n")).collect():
        reach[r["list"]], sizes[r["list"]] = r["cos"], r["n"]
    return VectorIndex(rows.drop("cos"), centres, reach, sizes)


def _asked(index: VectorIndex, queries: DataFrame, probes: int, rest: bool) -> DataFrame:
    """(query_id, vec, list) of the ``probes`` nearest lists of each query; with ``rest``, of the further
    lists that may hold a row above the query's ``floor``."""
    sent = queries.sparkSession.sparkContext.broadcast((index.centres, index.reach, index.sizes))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, reach, sizes = sent.value
        for pdf in batches:
            pdf = pdf[np.array([v is not None and centres.size and len(v) == centres.shape[1] for v in pdf["vec"]], bool)]
            if not len(pdf):
                continue
            m = np.stack([np.asarray([np.nan if x is None else x for x in v], float) for v in pdf["vec"]])
            norm = np.sqrt((m * m).sum(axis=1))
            good = np.isfinite(norm) & (norm > 0)
            unit, pdf = m[good] / norm[good][:, None], pdf[good]
            cos = unit @ centres.T
            order = np.argsort(-cos, axis=1, kind="stable")
            place = np.empty_like(order)
            np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), axis=1)
            meet = place < probes
            if rest:
                angle = np.arccos(np.clip(cos, -1, 1)) - np.arccos(np.clip(reach, -1, 1))
                floor = pdf["floor"].to_numpy(float)[:, None]
                meet = ~meet & ~(np.cos(np.maximum(angle, 0)) < floor - MARGIN)
            q, at = np.nonzero(meet & (sizes > 0))
            yield pd.DataFrame({"query_id": pdf["query_id"].to_numpy()[q], "list": at.astype("int32"), "vec": pd.Series(list(unit[q]), dtype=object)})

    out = StructType([queries.schema["query_id"], StructField("list", IntegerType()), StructField("vec", ArrayType(DoubleType()))])
    return queries.mapInPandas(pick, out)


def _scored(index: VectorIndex, asked: DataFrame, k: int, part_rows: int) -> DataFrame:
    """(query_id, doc_id, score): the k best rows of each part of a list for each query that meets it."""
    blocks = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("blocks"))
    parts = asked.sparkSession.createDataFrame([(i, -(-int(n) // part_rows)) for i, n in enumerate(index.sizes) if n], "list int, parts int")
    cut = F.broadcast(blocks.join(parts, "list"))  # at most a row a list
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    rows = index.rows.join(cut, "list").withColumn("part", F.pmod(F.xxhash64("doc_id"), "parts").cast("int")).withColumn("block", upto("blocks"))
    q = asked.join(cut, "list").withColumn("block", F.pmod(F.xxhash64("query_id"), "blocks").cast("int")).withColumn("part", upto("parts"))
    out = StructType([asked.schema["query_id"], index.rows.schema["doc_id"], StructField("score", DoubleType())])

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series(dtype="object") for c in ("query_id", "doc_id", "score")})
        right = right.sort_values("doc_id", kind="stable")
        docs, ids = np.stack(right["vec"].to_numpy()), right["doc_id"].to_numpy()
        found = []
        for a in range(0, len(left), 256):
            some = left.iloc[a : a + 256]
            sim = np.round(np.stack(some["vec"].to_numpy()) @ docs.T, SCORE_DIGITS)
            order = np.argsort(-sim, axis=1, kind="stable")[:, :k]
            found.append(pd.DataFrame({"query_id": np.repeat(some["query_id"].to_numpy(), order.shape[1]), "doc_id": ids[order].ravel(), "score": np.take_along_axis(sim, order, 1).ravel()}))
        return pd.concat(found)

    keys = ["list", "part", "block"]
    return q.select(*keys, "query_id", "vec").groupBy(*keys).cogroup(rows.select(*keys, "doc_id", "vec").groupBy(*keys)).applyInPandas(best, out)


def search(
    index: VectorIndex,
    queries: DataFrame,
    query_id: str,
    query_vec: str,
    k: int = DEFAULT_TOP_K,
    probes: int = 8,
    exact: bool = True,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """The k indexed rows with the highest cosine for each query (rounded to 6 places, ties by ``doc_id``).

    ``exact=False`` meets the ``probes`` nearest lists only (``probes_for`` finds how many a recall needs);
    ``exact=True`` goes on to all lists that the bound leaves. Query ids are unique and not NULL; a query
    without a direction has no hits. Columns: query_id, doc_id, score, rank."""
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).cast("array<double>").alias("vec"))
    first = _scored(index, _asked(index, q, probes, False), k, part_rows)
    order = [F.col("score").desc(), F.col("doc_id").asc()]
    near = _top_k(first, "query_id", order, k)
    if not exact:
        return near
    path = os.path.join(scratch_path(q.sparkSession, "vector-search"), uuid.uuid4().hex)
    near.write.parquet(path)
    near = q.sparkSession.read.schema(near.schema).parquet(path)
    floors = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("floor"))
    more = _scored(index, _asked(index, q.join(floors, "query_id", "left"), probes, True), k, part_rows)
    return _top_k(near.drop("rank").unionByName(more), "query_id", order, k)


def probes_for(index: VectorIndex, sample: DataFrame, query_id: str, query_vec: str, recall: float = 0.95, k: int = DEFAULT_TOP_K) -> int:
    """The smallest number of probes that finds the share ``recall`` of the true k best of a sample of
    queries (a few thousand at most: their hits are collected). Ask for somewhat more than the recall that
    other queries shall have."""
    hits = search(index, sample, query_id, query_vec, k).join(index.rows.select("doc_id", "list"), "doc_id")
    vecs = sample.select(F.col(query_id).alias("query_id"), F.col(query_vec).cast("array<double>").alias("vec"))
    rows = hits.join(vecs, "query_id").select("list", "vec").collect()
    if not rows:
        return 1
    cos = np.array([r["vec"] for r in rows]) @ index.centres.T
    place = (cos > cos[np.arange(len(rows)), [r["list"] for r in rows]][:, None]).sum(axis=1)
    return int(np.sort(place)[int(np.ceil(recall * len(place))) - 1]) + 1
