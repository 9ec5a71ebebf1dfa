"""Document fingerprints of closed syncmers, in DataFrame functions only.

A k-mer is a run of K words, an s-mer one of S words. A k-mer is a closed syncmer if its smallest s-mer
(by hash) is its first or last: this depends on the k-mer alone, so equal passages give equal anchors
whatever stands around them. The fingerprint keeps the SKETCH smallest anchors' hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S = 5, 2
SKETCH = 64
#: Documents per range in which neighbours are looked for, and ranges at most.
RANGE_DOCS, RANGES = 500, 20_000


def _word_hashes(text: Column) -> Column:
    return F.transform(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "), lambda w: F.xxhash64(w))


def _smers(hashes: Column) -> Column:
    n = F.size(hashes)
    return F.when(n >= K, F.transform(F.sequence(F.lit(0), n - S), lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1))))


def _anchor(smers: Column, i: Column) -> Column:
    """The hash of the k-mer at word i if it is a closed syncmer, else null."""
    a, b, c, d = (F.get(smers, i + j) for j in range(K - S + 1))
    return F.when(F.least(a, d) <= F.least(b, c), F.shiftrightunsigned(F.xxhash64(a, c, d), 32))


def _with_smers(df: DataFrame, text_col: str, out: str) -> DataFrame:
    return df.withColumn(out, _word_hashes(F.col(text_col))).withColumn(out, _smers(F.col(out)))


def with_sketch(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Adds the sorted smallest anchors as an array of 32-bit values. Texts without an anchor (fewer than
    five words, or none of them closed) have the hash of all their words; texts without a word none."""
    df = _with_smers(df, text_col, out)
    found = F.filter(F.transform(F.sequence(F.lit(0), F.size(out) - (K - S + 1)), lambda i: _anchor(F.col(out), i)), lambda x: x.isNotNull())
    df = df.withColumn(out, F.when(F.size(out) > 0, found))
    words = F.trim(F.regexp_replace(F.col(text_col), r"\s+", " "))
    alone = F.when(words == "", F.expr("cast(array() as array<bigint>)")).otherwise(F.array(F.shiftrightunsigned(F.xxhash64(words), 32)))
    return df.withColumn(out, F.when(F.size(out) > 0, F.slice(F.sort_array(F.array_distinct(out)), 1, SKETCH)).otherwise(alone))


def anchors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, word, hash) of each closed syncmer: its first word's place, for positional matching."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = _with_smers(src, "text", "smers").filter(F.size("smers") > 0)
    every = F.transform(F.sequence(F.lit(0), F.size("smers") - (K - S + 1)), lambda i: _anchor(F.col("smers"), i))
    return src.select("doc_id", F.posexplode(every).alias("word", "hash")).filter("hash is not null")


def as_string(sketch: Column) -> Column:
    return F.concat_ws("", F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity estimated from two sketches: the share of the smallest values of both that
    each of them has. Two texts without a word are alike, one with a text with words is not."""
    small = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    both = F.size(F.array_intersect(F.array_intersect(a, b), small))
    return F.when(F.size(small) == 0, F.lit(1.0)).otherwise(both / F.size(small)).cast("double")


def with_next(df: DataFrame, carried: list[str]) -> DataFrame:
    """Adds next (a struct of ``carried``) and head, of the next row by descending doc_id (then text),
    after the last the first. ``df`` has doc_id and text, and ``carried``. Null ids come last.

    Rows are dealt into ranges of ids, RANGES at most. In a range the next row comes from a window; the
    last row of a range has a null next, and in head the text of the first row of the next range.
    """
    low, high, n = df.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    low, high = low or 0, high or 0
    width = min(2**63 - 1, max(1, -(-(high - low + 1) // max(1, min(RANGES, n // RANGE_DOCS)))))
    cut = lambda x: abs(x) // width * (1 if x >= 0 else -1)  # noqa: E731  as SQL's div
    dealt = df.withColumn("__part", F.coalesce(F.expr(f"doc_id div {width}L"), F.lit(cut(low) - 1)))
    texts = dealt.select("__part", "doc_id", "text")
    first = texts.groupBy("__part").agg(F.max(F.struct("doc_id", "text")).alias("__first"))
    link = texts.select("__part").distinct()
    link = link.withColumn("__to", F.coalesce(F.lead("__part").over(Window.orderBy(F.desc("__part"))), F.max("__part").over(Window.partitionBy(F.lit(1)))))
    heads = link.join(first.withColumnRenamed("__part", "__to"), "__to").select("__part", F.col("__first.text").alias("__head"))
    inside = Window.partitionBy("__part").orderBy(F.desc_nulls_last("doc_id"), F.desc("text"))
    rows = dealt.withColumn("next", F.lead(F.struct(*carried)).over(inside)).join(heads, "__part", "left")
    return rows.select(*df.columns, "next", F.when(F.col("next").isNull(), F.col("__head")).alias("head"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), a row for
    each row of ``docs``.

    Null texts count as empty, with an empty fingerprint; equal texts have equal fingerprints; rows of
    one doc_id are ordered by text, descending; a single row is its own next; no rows give none.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(with_sketch(src, "text", "own"), ["text", "own"])
    tail = F.floor(F.length("text") / 3).cast("int")
    rows = with_sketch(rows, "head", "head_own")
    rows = rows.select("doc_id", "text", "own", F.coalesce("next.text", "head").alias("next_text"), F.coalesce("next.own", "head_own").alias("following"), tail.alias("tail"))
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - F.col("tail")), F.substring(F.col("next_text"), F.lit(1), F.col("tail"))))
    rows = with_sketch(rows, "edited", "changed")
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_string(F.col("own")).alias("fingerprint"),
        as_string(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
