"""Registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import collocations, decontaminate, language_id, line_dedup, near_dup, pii, sentencepiece_bpe, suffix_dedup, syncmers, token_files, toxicity, url_rules, whitening
from riskflow.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the strings of documents before it."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's digest of ids and of the decoded text."""
    got = sentencepiece_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written and read back: place, length and checksum of each document's ids."""
    shards = token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.checksums(token_files.read(shards))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class of near duplicates; the smallest id of a class stays, of a class without ids one text."""
    got = near_dup.members(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "class_id", "kept", F.hex("class_key").alias("class_key"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)))
    model = language_id.fit(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    return language_id.predict(docs, model, keep=("held_out",)).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's lines, dropped lines, and digest of the text that is left."""
    got = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they cover."""
    got = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "item_id", "coverage", "n_tiles", "longest", "item_words")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts and digest, and all spans."""
    return pii.find(table(spark, sf_dir, "documents"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    rules = spark.createDataFrame(url_rules.RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-scoring phrases of two or three words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = toxicity.fit(docs.filter(fold != 0), labels.filter(fold != 0))
    docs = docs.withColumn("held_out", F.coalesce(fold == 0, F.lit(False)))
    return toxicity.predict(docs, model, keep=("held_out",))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened components of all embeddings."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


_QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_syncmers": op2_syncmers,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_token_files": op4_token_files,
    "op5_near_dup": op5_near_dup,
    "op6_language_id": op6_language_id,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_pii": op9_pii,
    "op10_url_rules": op10_url_rules,
    "op11_collocations": op11_collocations,
    "op12_toxicity": op12_toxicity,
    "op13_whitening": op13_whitening,
}

_SQL = {
    "op7_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, text, unnest(range(len(l))) AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)),
parsed AS (
  SELECT doc_id, text, line_no, list_transform(string_split_regex(trim(line, ' ' || chr(9) || chr(13)), '[ \t]+'), lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS toks
  FROM lines),
long AS (SELECT *, len(toks) || ' ' || array_to_string(toks[1:3], ' ') AS leaf FROM parsed WHERE toks[1] <> ''),
mine AS (SELECT DISTINCT leaf, toks, doc_id FROM long),
per AS (SELECT leaf, toks, count(*) AS docs, min(doc_id) AS first_doc FROM mine GROUP BY ALL),
cells AS (SELECT leaf, toks, unnest(range(len(toks))) AS place, unnest(toks) AS tok FROM per WHERE len(toks) >= 4),
often AS (SELECT leaf, place, tok FROM (SELECT leaf, unnest(range(len(toks))) AS place, unnest(toks) AS tok, doc_id FROM mine WHERE len(toks) >= 4) GROUP BY ALL HAVING count(DISTINCT doc_id) >= 5),
made AS (
  SELECT c.leaf, c.toks, count(*) AS n,
         sum(CASE WHEN o.tok IS NOT NULL AND c.tok <> '<*>' THEN 1 ELSE 0 END) AS fixed,
         list(CASE WHEN o.tok IS NOT NULL THEN c.tok ELSE '<*>' END ORDER BY c.place) AS template
  FROM cells c LEFT JOIN often o USING (leaf, place, tok) GROUP BY c.leaf, c.toks),
templates AS (SELECT leaf, template, min(doc_id) AS first_doc FROM made JOIN mine USING (leaf, toks) WHERE fixed >= 4 AND fixed >= 0.8 * n GROUP BY ALL HAVING count(DISTINCT doc_id) >= 5),
drops AS (
  SELECT leaf, toks, min(first_doc) AS first_doc FROM (
    SELECT leaf, toks, first_doc FROM per WHERE docs >= 5
    UNION ALL
    SELECT m.leaf, m.toks, t.first_doc FROM made m JOIN templates t USING (leaf, template) WHERE fixed >= 4 AND fixed >= 0.8 * n)
  GROUP BY ALL),
gone AS (SELECT DISTINCT l.doc_id, l.text, l.line_no FROM long l JOIN drops d USING (leaf, toks) WHERE l.doc_id > d.first_doc),
kept AS (
  SELECT l.doc_id, l.text, count(*) AS n_lines, count(g.line_no) AS n_dropped, coalesce(string_agg(CASE WHEN g.line_no IS NULL THEN l.line END, chr(10) ORDER BY l.line_no), '') AS left_text
  FROM lines l LEFT JOIN gone g USING (doc_id, text, line_no) GROUP BY l.doc_id, l.text)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE coalesce(k.n_lines, len(string_split(d.text, chr(10)))) END::BIGINT AS n_lines, coalesce(k.n_dropped, 0)::BIGINT AS n_dropped,
       sha256(coalesce(k.left_text, d.text)) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id, text)
""",
    "op10_url_rules": r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^[\s\S]*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^[\s\S]*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
SELECT page_id, host, path,
       (SELECT h || p FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) ORDER BY length(h) + length(p) DESC LIMIT 1) AS rule,
       coalesce((SELECT v FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) ORDER BY length(h) + length(p) DESC LIMIT 1), 'allow') AS verdict
FROM parts
""",
    "op11_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, unnest(w) AS w1, unnest(list_append(w[2:], NULL)) AS w2, unnest(list_append(list_append(w[3:], NULL), NULL)) AS w3 FROM split WHERE len(w) > 0),
c1 AS (SELECT lang, w1, count(*) AS f FROM places WHERE w1 IS NOT NULL GROUP BY ALL),
c2 AS (SELECT lang, w1, w2, count(*) AS f FROM places WHERE w1 IS NOT NULL AND w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
c3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM places WHERE w1 IS NOT NULL AND w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cover AS (SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM c3 UNION ALL SELECT lang, w2, w3, f FROM c3) GROUP BY ALL),
twos AS (
  SELECT lang, p.w1 || ' ' || p.w2 AS phrase, p.f AS a, x.f AS l, y.f AS r
  FROM c2 p JOIN c1 x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, f FROM c1) y USING (lang, w2) LEFT JOIN cover c USING (lang, w1, w2)
  WHERE c.f IS NULL OR 100 * c.f < 50 * p.f),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, x1.f AS l1, p23.f AS r1, p12.f AS l2, x3.f AS r2,
         1000000::HUGEINT * t.f * t.f // (x1.f::HUGEINT * p23.f) AS s1, 1000000::HUGEINT * t.f * t.f // (p12.f::HUGEINT * x3.f) AS s2
  FROM c3 t JOIN c1 x1 ON x1.lang = t.lang AND x1.w1 = t.w1 JOIN c1 x3 ON x3.lang = t.lang AND x3.w1 = t.w3
       JOIN c2 p12 ON p12.lang = t.lang AND p12.w1 = t.w1 AND p12.w2 = t.w2 JOIN c2 p23 ON p23.lang = t.lang AND p23.w1 = t.w2 AND p23.w2 = t.w3),
scored AS (
  SELECT lang, phrase, a, l, r, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM twos
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)::BIGINT FROM cuts),
best AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, s.n::BIGINT AS n, score
FROM best JOIN (SELECT lang, sum(f) AS n FROM c1 GROUP BY lang) s USING (lang) WHERE rank <= 2000
""",
}


def queries() -> dict[str, Query]:
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        return run

    return {name: wrap(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
