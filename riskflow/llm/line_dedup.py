"""Line dedup by a log-template tree, in DataFrame functions only.

A line's tokens with a digit are variable fields (``<*>``). The tree has a fixed depth: token count,
then the leading tokens. In a leaf, a token at a place that fewer than ``min_docs`` documents of the
leaf have there is variable too; a line whose other tokens are enough (``FIXED_SHARE``, and at least
``MIN_TOKENS``) has the template that is left. Lines and templates in at least ``min_docs`` different documents
recur: they are dropped from all documents but the first that has them. A line of any length recurs as
it is; only a template with variable tokens needs ``MIN_TOKENS``.

Only hashes are shuffled to count lines. Texts of lines are read for leaves that recur and hold lines
which do not recur as they are, one line for each distinct masked line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import fresh, stage

MIN_DOCS = 5
MIN_TOKENS = 4
LEADING = 3
FIXED_SHARE = 0.8
WILD = "<*>"
#: Up to so many document keys (16 bytes each) are sent to all tasks to find the texts of lines.
BROADCAST_KEYS = 200_000

_VARIABLE = r"(?<![^ \t])[^ \t0-9]*+[0-9][^ \t]*+"


def _line_no(text: Column) -> Column:
    return F.posexplode(F.split(text, "\n")).alias("line_no", "line")


def _parsed(lines: DataFrame) -> DataFrame:
    """Adds toks (masked tokens) to rows with a line; blank lines go."""
    body = lines.withColumn("toks", F.split(F.regexp_replace(F.btrim("line", F.lit(" \t\r")), _VARIABLE, WILD), "[ \t]+"))
    return body.filter(F.element_at("toks", 1) != "")


def _leaf() -> Column:
    return F.xxhash64(F.size("toks"), F.slice("toks", 1, LEADING))


def recurring(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(lines, drops) of rows with doc_id, rid and text: lines has doc_id, rid, line_no, leaf, full; drops
    has leaf, full and the first document of their template."""
    parsed = _parsed(docs.select("doc_id", "rid", _line_no(F.col("text"))))
    lines = stage(parsed.select("doc_id", "rid", "line_no", _leaf().alias("leaf"), F.xxhash64("toks").alias("full"), (F.size("toks") >= MIN_TOKENS).alias("long")), "lines")
    per = lines.groupBy("leaf", "full", "doc_id").agg(F.min("rid").alias("rid"), F.first("long").alias("long")).groupBy("leaf", "full")
    per = stage(per.agg(F.count("doc_id").alias("docs"), F.min(F.struct("doc_id", "rid")).alias("first"), F.first("long").alias("long")), "line-counts")
    whole = per.filter(F.col("docs") >= min_docs).select("leaf", "full", F.col("first.doc_id").alias("first_doc"))

    # Leaves whose lines may come together to a template.
    leaves = per.filter("long").groupBy("leaf").agg(F.sum("docs").alias("docs"), F.min("docs").alias("least"))
    leaves = leaves.filter((F.col("docs") >= min_docs) & (F.col("least") < min_docs)).select("leaf")
    wanted = stage(per.filter("long").join(leaves, "leaf").select("leaf", "full", "docs", "first.doc_id", "first.rid"), "wanted-lines")
    keys = wanted.select("doc_id", "rid").distinct()
    if wanted.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    texts = docs.join(keys, ["doc_id", "rid"], "left_semi")
    read = _parsed(texts.select("doc_id", "rid", _line_no(F.col("text")))).select("doc_id", "rid", _leaf().alias("leaf"), F.xxhash64("toks").alias("full"), "toks")
    reps = read.join(wanted, ["leaf", "full", "doc_id", "rid"]).dropDuplicates(["leaf", "full"])
    reps = stage(reps.select("leaf", "full", "docs", "doc_id", "toks"), "line-texts")
    cells = reps.select("leaf", "full", "docs", "doc_id", F.posexplode("toks").alias("at", "tok"))
    often = _in_documents(cells, ["leaf", "at", "tok"], lines, min_docs).select("leaf", "at", "tok", F.lit(True).alias("fixed"))
    marked = cells.join(often, ["leaf", "at", "tok"], "left")
    shown = F.when(F.col("fixed"), F.col("tok")).otherwise(F.lit(WILD))
    made = marked.groupBy("leaf", "full").agg(
        F.max("docs").alias("docs"),
        F.min("doc_id").alias("doc_id"),
        F.count("*").alias("n"),
        F.sum(F.when(F.col("fixed") & (F.col("tok") != WILD), 1).otherwise(0)).alias("n_fixed"),
        F.sort_array(F.collect_list(F.struct("at", shown.alias("tok")))).alias("cells"),
    )
    made = made.filter((F.col("n_fixed") >= MIN_TOKENS) & (F.col("n_fixed") >= FIXED_SHARE * F.col("n")))
    made = stage(made.select("leaf", "full", "docs", "doc_id", F.xxhash64("cells.tok").alias("template")), "line-templates")
    common = _in_documents(made, ["leaf", "template"], lines, min_docs)
    varied = made.select("leaf", "full", "template").join(common.select("leaf", "template", "first_doc"), ["leaf", "template"]).select("leaf", "full", "first_doc")
    drops = whole.unionByName(varied).groupBy("leaf", "full").agg(F.min("first_doc").alias("first_doc"))
    return lines, drops


def _in_documents(variants: DataFrame, by: list[str], lines: DataFrame, min_docs: int) -> DataFrame:
    """(``by``, first_doc) of the groups of line variants that lie in at least ``min_docs`` different documents.
    One variant may do by itself; where only several together could, their documents are looked up and counted,
    fewer than ``min_docs`` for each of them."""
    groups = variants.groupBy(*by).agg(F.sum("docs").alias("most"), F.max("docs").alias("least"), F.min("doc_id").alias("first_doc"))
    groups = stage(groups.filter(F.col("most") >= min_docs), "line-groups")
    unsure = stage(variants.join(groups.filter(F.col("least") < min_docs).select(*by), by).select("full", *by), "unsure-lines")
    own = lines.join(unsure.select("leaf", "full").distinct(), ["leaf", "full"]).select("leaf", "full", "doc_id").distinct()
    counted = unsure.join(own, ["leaf", "full"]).select(*by, "doc_id").distinct().groupBy(*by).count().filter(F.col("count") >= min_docs)
    sure = groups.filter(F.col("least") >= min_docs).select(*by, "first_doc")
    return sure.unionByName(groups.join(counted.select(*by), by).select(*by, "first_doc"))


def dedup(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text", prefix: str = "__") -> DataFrame:
    """All columns of ``docs``, its text without the dropped lines, and n_lines, n_dropped behind ``prefix``,
    a row for each row of ``docs``.

    Null and empty texts stay as they are (0 and 1 lines); blank lines are never dropped; rows of one doc_id count as one document, and repeated rows
    are treated alike; rows with a null doc_id are neither counted nor changed.
    """
    rid = F.xxhash64(F.col(id_col), F.col(text_col))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), rid.alias("rid"), F.col(text_col).alias("text")).filter("doc_id is not null and text is not null")
    lines, drops = recurring(src, min_docs)
    k_doc, k_rid, k_gone, own = fresh(docs, "__gone_doc", "__gone_rid", "__gone", "__rid")
    gone = lines.join(drops, ["leaf", "full"]).filter(F.col("doc_id") > F.col("first_doc"))
    gone = gone.groupBy(F.col("doc_id").alias(k_doc), F.col("rid").alias(k_rid)).agg(F.collect_set("line_no").alias(k_gone))
    rows = docs.withColumn(own, rid)
    out = rows.join(gone, (F.col(id_col).cast("long") == F.col(k_doc)) & (F.col(own) == F.col(k_rid)), "left")
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda x, i: ~F.array_contains(F.col(k_gone), i))
    text = F.when(F.col(k_gone).isNull(), F.col(text_col)).otherwise(F.concat_ws("\n", kept))
    n = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(F.col(text_col), "\n")))
    names = [text.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return out.select(*names, n.cast("long").alias(f"{prefix}n_lines"), F.coalesce(F.size(k_gone), F.lit(0)).cast("long").alias(f"{prefix}n_dropped"))
