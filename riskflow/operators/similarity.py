"""Similarity top-k: TF-IDF text search and cosine vector search, as relational plans.

The source pipeline sends a transaction summary to a hosted vector index over the fraud-signature
descriptions (embedding model hosted too). Scores therefore differ from the source by design; the
contract kept is "top-k signature hits with a similarity score, best first".

Text plan: tokens are counted into (doc, term, tf) postings, joined to the queries on the term, the
rarest terms first; a bound of the k-th best score then leaves out the frequent terms' postings and
the documents that cannot reach it, so that near all pairs are never scored. Top-k per query is
``row_number() <= k``, which Spark runs as a per-task group limit before the shuffle, so a query with
many candidates never sends more than k rows per task.
"""

from __future__ import annotations

import math
import os
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskflow.constants import DEFAULT_TOP_K
from riskflow.session import scratch_path

TOKEN_PATTERN = "[^a-z0-9]+"
SCORE_DIGITS = 6
# Scores are compared after rounding to SCORE_DIGITS places: bounds leave that much room, and more.
MARGIN = 2e-6
# The first guess of a query's best documents: terms with this many postings in all, and this many
# candidates for each wanted hit. Both only steer the work: results are exact at any value.
SEED_POSTINGS = 500
SEED_ROWS = 4
# Terms are grouped by hash for the last bound of a pair (a document holds at most one length a group).
TERM_GROUPS = 64
# Text of a task that counts terms.
PART_BYTES = 8 << 20
# A term's postings are met in parts of about this many.
SALT_POSTINGS = 200_000


def tokens(text) -> Column:
    """Lower-cased alphanumeric runs of the whole text (no empties)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), TOKEN_PATTERN), lambda x: x != "")


def _term_counts(df: DataFrame, id_col: str, text_col: str, by_id: bool = False) -> DataFrame:
    """(id, term, tf) postings. ``by_id`` hash-partitions the *rows* by id before tokenising: one
    shuffle of whole texts (not of their tokens) that spreads the tokenising over all tasks, and
    that every later per-id step (term counts, norm windows, dot-product sums, the top-k window)
    reuses without another exchange."""
    src = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    if by_id:
        # A task's term counts take tens of times its text: the number of tasks follows the bytes of text (a
        # 200-row query set must not become hundreds of thousands of tasks on a large cluster).
        size = src.agg(F.sum(F.octet_length(F.col("__text").cast("string")))).first()[0] or 0
        src = src.repartition(int(-(-size // PART_BYTES)) or 1, "__id")
    toks = src.select("__id", F.explode(tokens("__text")).alias("term"))
    return toks.groupBy("__id", "term").agg(F.count(F.lit(1)).alias("tf"))


def _top_k(scored: DataFrame, part: str, order: list[Column], k: int) -> DataFrame:
    w = Window.partitionBy(part).orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


def _stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back (cuts the lineage)."""
    path = os.path.join(scratch_path(df.sparkSession, "similarity"), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on ``cols`` that keeps the left side's copy of them (a NULL id is an id)."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in cols else F.col(c) for c in right.columns])
    on = None
    for c in cols:
        one = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        on = one if on is None else on & one
    return left.join(r, on, how).drop(*[f"__r_{c}" for c in cols])


@dataclass(frozen=True)
class TextSearch:
    """A prepared search over unit vectors: the queries' terms, and their postings in the corpus.

    Documents are told apart by size class (the binary logarithm of their number of terms), in
    which a term's largest weight says much more than over all documents.

    ``query_terms``: (q, size, term, qu, salts, rest, at), a row for each class that has the term:
    ``qu`` the weight in the query's unit vector, ``rest`` the most that this term and the query's more
    frequent ones can add to the score of a document of the class, ``at`` the number of postings of this
    term and the rarer ones.
    ``postings``: (term, size, salt, d, u), ``u`` the weight in the document's unit vector.
    ``lengths``: (d, held), what a document holds of each of ``TERM_GROUPS`` groups of terms: the
    lengths of these parts of its vector, as an array of (g, length).
    """

    query_terms: DataFrame
    postings: DataFrame
    lengths: DataFrame
    k: int

    def partial(self, terms: DataFrame) -> DataFrame:
        """(q, size, d, dot, seen): what ``terms`` add, and the share of the document's squared length met.

        A frequent term's postings lie in ``salts`` parts, each met by its own copy of the query row, so
        that no task reads all postings of a term that a third of the documents hold."""
        spread = terms.select("q", "size", "term", "qu", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        met = spread.join(self.postings, ["term", "size", "salt"])
        return met.groupBy("q", "size", "d").agg(F.sum(F.col("qu") * F.col("u")).alias("dot"), F.sum(F.col("u") * F.col("u")).alias("seen"))

    def completed(self, pairs: DataFrame, terms: DataFrame) -> DataFrame:
        """(q, d, dot) of ``pairs``, with what ``terms`` add to each."""
        asked = _same(pairs.select("q", "size", "d"), terms.select("q", "size", "term", "qu"), ["q", "size"])
        more = _same(asked, self.postings.select("term", "d", "u"), ["term", "d"])
        more = more.select("q", "d", (F.col("qu") * F.col("u")).alias("dot"))
        return pairs.select("q", "d", "dot").unionByName(more).groupBy("q", "d").agg(F.sum("dot").alias("dot"))

    def floors(self) -> DataFrame:
        """(q, floor): a lower bound of each query's k-th best score, where k documents were met.

        The rarest terms of each class, as far as they have ``SEED_POSTINGS`` postings (the rarest one
        always), name the candidates; the best of these are scored in full."""
        first = (F.col("at") <= SEED_POSTINGS) | (F.col("at") == F.col("n"))
        best = _top_k(self.partial(self.query_terms.filter(first)), "q", [F.col("dot").desc(), F.col("d").asc()], SEED_ROWS * self.k)
        full = _top_k(self.completed(_stage(best, "seeds"), self.query_terms.filter(~first)), "q", [F.col("dot").desc(), F.col("d").asc()], self.k)
        return full.groupBy("q").agg(F.min("dot").alias("floor"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == self.k).select("q", "floor")

    def candidates(self) -> tuple[DataFrame, DataFrame]:
        """((q, size, d, dot) that can be among the k best, the terms that are still to be added to them).

        A document of a class that holds none but terms whose ``rest`` is below the floor cannot reach it:
        their postings are not read. What a document that was met can still gain is bounded by the
        inequality of Cauchy and Schwarz, first with what is left of its unit length, then by groups of
        terms with the lengths that it holds of them."""
        terms = _same(self.query_terms, self.floors(), ["q"], "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)) - MARGIN)
        terms = _stage(terms.withColumn("read", F.col("rest") >= F.col("floor")), "terms")
        square = F.col("qu") * F.col("qu")
        rest = terms.filter("not read")
        groups = rest.groupBy("q", "size", _group("term").alias("g")).agg(F.sum(square).alias("s"), F.max("rest").alias("more"))
        left = groups.groupBy("q", "size").agg(
            F.max("more").alias("more"),
            F.sqrt(F.sum("s")).alias("length"),
            F.map_from_entries(F.collect_list(F.struct("g", F.sqrt("s")))).alias("asked"),
        )
        floors = terms.select("q", "size", "floor").distinct()
        met = _same(_same(self.partial(terms.filter("read")), floors, ["q", "size"]), left, ["q", "size"], "left")
        gain = F.least(F.col("more"), F.col("length") * F.sqrt(F.greatest(F.lit(0.0), 1.0 - F.col("seen")) + MARGIN))
        near = met.filter(F.col("dot") + F.coalesce(gain, F.lit(0.0)) >= F.col("floor"))
        add = lambda s, x: s + x.getField("length") * F.coalesce(F.try_element_at("asked", x.getField("g")), F.lit(0.0))
        within = F.when(F.col("asked").isNotNull(), F.aggregate("held", F.lit(0.0), add)).otherwise(0.0)
        near = _same(near, self.lengths, ["d"]).filter(F.col("dot") + within >= F.col("floor"))
        return near.select("q", "size", "d", "dot"), rest

    def hits(self) -> DataFrame:
        pairs, rest = self.candidates()
        scored = self.completed(_stage(pairs, "pairs"), rest).select(
            F.col("q").alias("query_id"), F.col("d").alias("doc_id"), F.round("dot", SCORE_DIGITS).alias("score")
        )
        return _top_k(scored, "query_id", [F.col("score").desc(), F.col("doc_id").asc()], self.k)


def _group(term: str) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(TERM_GROUPS)).cast("int")


def text_search(
    queries: DataFrame,
    corpus: DataFrame,
    query_id: str,
    query_text: str,
    doc_id: str,
    doc_text: str,
    k: int = DEFAULT_TOP_K,
    salt_postings: int = SALT_POSTINGS,
) -> TextSearch:
    """Tokenise both sides once and keep what the queries' terms need (see ``text_topk``). Term counts and
    postings are written to the shared checkpoint folder, where every later step reads them."""
    n_docs = F.lit(float(corpus.select(F.count_distinct(F.col(doc_id))).first()[0]))
    d_tf = _stage(_term_counts(corpus, doc_id, doc_text, by_id=True), "counts")
    idf = (
        d_tf.groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .withColumn("idf", F.log((n_docs + 1.0) / (F.col("df") + 1.0)) + 1.0)
    )
    q_w = _term_counts(queries, query_id, query_text, by_id=True).join(idf, "term", "left").select(
        F.col("__id").alias("q"), "term", (F.col("tf") * F.coalesce(F.col("idf"), F.log(n_docs + 1.0) + 1.0)).alias("w"), "idf", "df"
    )
    q_u = q_w.withColumn("qu", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("q"))))
    q_u = _stage(q_u.filter("df is not null").withColumn("salts", F.ceil(F.col("df") / F.lit(salt_postings)).cast("int")), "queries")
    weights = d_tf.join(idf, "term").select("__id", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norms = weights.groupBy("__id").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.floor(F.log2(F.count(F.lit(1)))).cast("int").alias("size")
    )
    asked = q_u.groupBy("term").agg(F.max("idf").alias("idf"), F.max("salts").alias("salts"))
    found = d_tf.join(asked, "term").select(
        "term", "__id", (F.col("tf") * F.col("idf")).alias("w"), F.pmod(F.xxhash64("__id"), F.col("salts")).cast("int").alias("salt")
    )
    postings = _same(found, norms, ["__id"]).select("term", "size", "salt", F.col("__id").alias("d"), (F.col("w") / F.col("norm")).alias("u"))
    postings = _stage(postings, "postings")
    tops = postings.groupBy("term", "size").agg(F.max("u").alias("top"), F.count(F.lit(1)).alias("n"))
    rare = Window.partitionBy("q", "size").orderBy(F.col("df").asc(), F.col("term").asc())
    onward = rare.rowsBetween(0, Window.unboundedFollowing)
    terms = q_u.join(tops, "term").select(
        "q", "size", "term", "qu", "salts", "n",
        F.least(F.sqrt(F.sum(F.col("qu") * F.col("qu")).over(onward)), F.sum(F.col("qu") * F.col("top")).over(onward)).alias("rest"),
        F.sum("n").over(rare.rowsBetween(Window.unboundedPreceding, 0)).alias("at"),
    )
    held = postings.groupBy("d", _group("term").alias("g")).agg(F.sqrt(F.sum(F.col("u") * F.col("u"))).alias("length"))
    lengths = held.groupBy("d").agg(F.collect_list(F.struct("g", "length")).alias("held"))
    return TextSearch(_stage(terms, "terms"), postings, lengths, k)


def text_topk(
    queries: DataFrame,
    corpus: DataFrame,
    query_id: str,
    query_text: str,
    doc_id: str,
    doc_text: str,
    k: int = DEFAULT_TOP_K,
) -> DataFrame:
    """For each query, the ``k`` corpus rows with the highest TF-IDF cosine (rounded to 6 places
    before ranking; ties by ``doc_id``). Documents are identified by ``doc_id`` (rows sharing an id
    form one document). Weight = tf · (ln((N + 1) / (df + 1)) + 1) with N the number of documents
    and df the number of documents holding the term; query terms absent from the corpus count in
    the query norm with df = 0. Only documents that share a term with the query are hits, so a query
    without a token (NULL and empty texts) has none. Columns: query_id, doc_id, score, rank.

    Exact, with score bounds: the rarest terms give a lower bound of the k-th best score, and postings
    of frequent terms are read only where they can still lift a document over it (``TextSearch``).
    """
    return text_search(queries, corpus, query_id, query_text, doc_id, doc_text, k).hits()


def literal_text_topk(
    queries: DataFrame,
    corpus: DataFrame,
    query_id: str,
    query_text: str,
    doc_id: str,
    doc_text: str,
    k: int = DEFAULT_TOP_K,
    max_rows: int = 1000,
) -> DataFrame:
    """``text_topk`` against a small dimension: always its ``k`` best rows (all of fewer), scores of 0
    included, each query row scored where it lies, without a join or a shuffle.

    The dimension is read to the driver (more than ``max_rows`` rows are refused: use ``text_topk``)
    and becomes literals. A text without a token scores 0 everywhere.
    """
    docs = corpus.groupBy(F.col(doc_id).alias("d")).agg(F.flatten(F.collect_list(tokens(doc_text))).alias("t")).limit(max_rows + 1).collect()
    if len(docs) > max_rows:
        raise ValueError(f"the dimension has more than {max_rows} rows; use text_topk")
    terms = {r["d"]: Counter(r["t"] or []) for r in docs}
    df = Counter(t for c in terms.values() for t in c)
    idf = {t: math.log((len(docs) + 1.0) / (n + 1.0)) + 1.0 for t, n in df.items()}
    unknown = math.log(len(docs) + 1.0) + 1.0
    weights = F.create_map(*(F.lit(x) for t, w in idf.items() for x in (t, w))) if idf else F.create_map().cast("map<string,double>")
    q = queries.select(F.col(query_id).alias("query_id"), tokens(query_text).alias("__t"))
    tf = lambda term: F.size(F.filter("__t", lambda x: x == term)).cast("double")
    own = F.transform(F.array_distinct("__t"), lambda t: F.struct(t.alias("t"), (F.size(F.filter("__t", lambda x: x == t)) * F.coalesce(F.try_element_at(weights, t), F.lit(unknown))).alias("w")))
    q = q.withColumn("__w", own)
    q = q.withColumn("__norm", F.sqrt(F.aggregate("__w", F.lit(0.0), lambda s, x: s + x.getField("w") * x.getField("w"))))
    scores = []
    for d, counted in terms.items():
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in counted.items()))
        dot = F.lit(0.0)
        for t, n in sorted(counted.items()):
            dot = dot + tf(t) * F.lit(idf[t] * n * idf[t])
        score = F.round(F.coalesce(dot / F.nullif(F.col("__norm") * F.lit(norm), F.lit(0.0)), F.lit(0.0)), SCORE_DIGITS)
        scores.append(F.struct((-score).alias("below"), F.lit(d).alias("doc_id")))
    if not scores:
        return q.select("query_id", F.lit(None).cast(corpus.schema[doc_id].dataType).alias("doc_id"), F.lit(0.0).alias("score"), F.lit(1).cast("long").alias("rank")).limit(0)
    best = F.slice(F.sort_array(F.array(*scores)), 1, k)
    return q.select("query_id", F.posexplode(best).alias("pos", "hit")).select(
        "query_id", F.col("hit.doc_id").alias("doc_id"), (F.lit(0.0) - F.col("hit.below")).alias("score"), (F.col("pos") + 1).cast("long").alias("rank")
    )


def cosine(a, b) -> Column:
    """Cosine similarity of two numeric arrays (NULL if either norm is 0 or an input is NULL)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    dot = F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v
    )
    na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))
    nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))
    return dot / F.nullif(na * nb, F.lit(0.0))


def centroids(vectors: DataFrame, group: str, vec: str) -> DataFrame:
    """Per-group mean vector (element-wise), as ``group, centroid array<double>``.

    Element sums combine map-side (one partial row per group and position per task)."""
    per_pos = (
        vectors.select(group, F.posexplode(vec).alias("pos", "x"))
        .groupBy(group, "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("m"), F.count(F.lit(1)).alias("n"))
    )
    parts = F.array_sort(F.collect_list(F.struct("pos", "m", "n")))
    counts = F.transform(parts, lambda s: s.getField("n"))
    # Vectors of different lengths have no element-wise mean: NULL instead of a skewed one.
    return per_pos.groupBy(group).agg(
        F.when(
            F.array_min(counts) == F.array_max(counts), F.transform(parts, lambda s: s.getField("m"))
        ).alias("centroid")
    )


def vector_topk(
    queries: DataFrame,
    corpus: DataFrame,
    query_id: str,
    query_vec: str,
    doc_id: str,
    doc_vec: str,
    k: int = DEFAULT_TOP_K,
    by: str | None = None,
    block_bytes: int = 32 << 20,
) -> DataFrame:
    """Exact cosine top-k (scores rounded to 6 places, ties by ``doc_id``; a NULL or zero vector scores
    NULL, last; so do vectors of other lengths than the query's).

    With ``by``, queries only meet corpus rows of the same ``by`` value (an equi-join, e.g. a
    partitioned index), and the top k per query come from a per-task group limit.

    Without ``by`` the whole corpus is searched. The queries are a stated set: they are sent to the
    tasks in blocks of at most ``block_bytes``; each task scores its corpus rows against the block in
    numpy and keeps k per query, and the k best of all tasks stay. Columns: query_id, doc_id, score, rank.
    """
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("__qv"), *([F.col(by)] if by else []))
    d = corpus.select(F.col(doc_id).alias("doc_id"), F.col(doc_vec).alias("__dv"), *([F.col(by)] if by else []))
    order = [F.col("score").desc_nulls_last(), F.col("doc_id").asc()]
    if by:
        scored = q.join(d, by).select(
            "query_id", "doc_id", F.round(cosine("__qv", "__dv"), SCORE_DIGITS).alias("score")
        )
        return _top_k(scored, "query_id", order, k)

    total = q.agg(F.coalesce(F.sum(F.coalesce(F.size("__qv"), F.lit(0)) * 8 + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    schema = StructType([q.schema["query_id"], d.schema["doc_id"], StructField("score", DoubleType())])
    found = None
    for b in range(blocks):
        block = q.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b).collect()
        sent = q.sparkSession.sparkContext.broadcast(_by_length([(r[0], None if r[1] is None else [float("nan") if x is None else float(x) for x in r[1]]) for r in block]))
        part = d.mapInPandas(_block_search(sent, k), schema)
        found = part if found is None else found.unionByName(part)
    return _top_k(found, "query_id", order, k)


#: Queries and corpus rows that are scored at once.
SCORE_QUERIES, SCORE_ROWS = 256, 2048


def _matrix(rows: list, size: int) -> np.ndarray:
    """The vectors, those that are NULL or have another length as NaN."""
    m = np.full((len(rows), size), np.nan)
    for i, v in enumerate(rows):
        if v is not None and len(v) == size:
            m[i] = v
    return m


def _by_length(rows: list) -> list[tuple[int, list, np.ndarray]]:
    """(length, ids, vectors as one array) of (id, vector) rows; -1 is the length of NULL."""
    found: dict[int, list] = {}
    for r in rows:
        found.setdefault(-1 if r[1] is None else len(r[1]), []).append(r)
    return [(n, [r[0] for r in some], _matrix([r[1] for r in some], max(n, 0))) for n, some in found.items()]


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(norm == 0, np.nan, norm)


def _block_search(sent, k: int):
    """Scores of a block of queries against a task's rows: the k best of each query. A task holds the block and its
    hits as arrays, and the scores of ``SCORE_QUERIES`` queries against ``SCORE_ROWS`` rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = [(n, ids, _unit(m)) for n, ids, m in sent.value]
        best: list = [None] * len(asked)
        for pdf in batches:
            for a in range(0, len(pdf), SCORE_ROWS):
                some = pdf.iloc[a : a + SCORE_ROWS].sort_values("doc_id", kind="stable")
                ids, vecs = some["doc_id"].to_numpy(), list(some["__dv"])
                for at, (n, queries, units) in enumerate(asked):
                    docs = _unit(_matrix(vecs, max(n, 0)))
                    if best[at] is None:
                        best[at] = np.zeros((len(queries), 0)), np.zeros((len(queries), 0), ids.dtype)
                    width = min(k, best[at][0].shape[1] + len(ids))
                    score, doc = np.empty((len(queries), width)), np.empty((len(queries), width), np.result_type(ids, best[at][1]))
                    for i in range(0, len(queries), SCORE_QUERIES):
                        j = min(len(queries), i + SCORE_QUERIES)
                        sim = np.round(units[i:j] @ docs.T, SCORE_DIGITS) if n > 0 else np.full((j - i, len(ids)), np.nan)
                        # Rows lie by id, so that of equal scores the smallest ids stay.
                        top = np.argsort(np.where(np.isnan(sim), np.inf, -sim), axis=1, kind="stable")[:, :k]
                        new = np.concatenate([best[at][0][i:j], np.take_along_axis(sim, top, 1)], axis=1)
                        who = np.concatenate([best[at][1][i:j], ids[top]], axis=1)
                        order = np.lexsort((who, np.where(np.isnan(new), np.inf, -new)), axis=1)[:, :width]
                        score[i:j], doc[i:j] = np.take_along_axis(new, order, 1), np.take_along_axis(who, order, 1)
                    best[at] = score, doc
        for at, (_, queries, _) in enumerate(asked):
            for i in range(0, len(queries) if best[at] is not None else 0, SCORE_ROWS):
                score, doc = best[at][0][i : i + SCORE_ROWS], best[at][1][i : i + SCORE_ROWS]
                got = pd.DataFrame({"query_id": pd.Series(queries[i : i + SCORE_ROWS], dtype=object).repeat(score.shape[1]).to_numpy(), "doc_id": doc.ravel(), "score": score.ravel()})
                yield got.assign(score=got["score"].astype("object").where(got["score"].notna(), None))

    return run


def collect_hits(hits: DataFrame, query_id: str, fields: list[str]) -> DataFrame:
    """One row per query: ``hits`` (array of structs in rank order) and ``signatures_searched``
    (its size). ``hits`` holds at most k rows per query, so each list is bounded by k."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", *fields)))
    return (
        hits.groupBy(query_id)
        .agg(ordered.alias("__h"))
        .select(
            query_id,
            F.transform("__h", lambda h: F.struct(*[h.getField(f).alias(f) for f in fields])).alias("hits"),
            F.size("__h").alias("signatures_searched"),
        )
    )
