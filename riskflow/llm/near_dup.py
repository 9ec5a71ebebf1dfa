"""Near duplicates by BagMinHash signatures, banding and verified multiset overlap.

A document is the multiset of its five-word shingles. Each shingle has a Poisson process of points
(x, register, level) over its discretised weights: a block of levels [0, 1), [1, 2), [2, 4), [4, 8)...
has a process of its own whose rate is the block's length, and of a block that the weight covers in
part only the points below the weight count. A register's value is its smallest point, so that two
documents agree in a register with the probability of their weighted Jaccard similarity. Points are
drawn in rounds, only while they can still fall below the largest register of their document.

Equal texts collapse to one row first. Signatures are banded; in a band's bucket a maximum spanning
forest over the estimated similarities proposes links, which are verified by the exact multiset
overlap; then all pairs of a bucket whose documents are still apart are verified where they meet, in
blocks, each in the first band that it shares, and only links that join two components leave a block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm import words as W
from riskflow.llm.common import column, doc_text, mixed, parted, runs, shuffle_partitions, stage, text_bytes
from riskflow.llm.components import components

SHINGLE = 5
#: Registers; those that are banded, and in a band.
REGISTERS, BANDED, ROWS = 256, 64, 4
SIMILARITY = 0.8
#: Pairs are verified from this estimate on: 3.6 standard errors below 0.8 with 256 registers.
ESTIMATE = 0.71
#: Bytes of text whose shingles are worked on at once.
CHUNK = 1 << 19
#: Rows of a bucket, and about so many bytes of multisets, that are compared with each other in one block.
BLOCK, BLOCK_BYTES = 1024, 32 << 20


def multiset(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, count), ordered by row, then hash."""
    h, row, _, _ = W.words(data, offsets)
    s, r, _ = W.shingles(h, row, len(offsets) - 1, k)
    order = np.lexsort((s, r))
    s, r = s[order], r[order]
    if not len(s):
        return r, s, np.zeros(0, np.int64)
    edge = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (r[1:] != r[:-1])]))
    return r[edge], s[edge], np.diff(np.append(edge, len(s)))


def signatures(row: np.ndarray, shingle: np.ndarray, count: np.ndarray, n_rows: int, m: int = REGISTERS) -> np.ndarray:
    """n_rows x m uint64; rows without shingles are zero."""
    # A process for each block of levels that the weight reaches into.
    top = np.frexp(count.astype(np.float64) - 0.5)[1].clip(0) if len(count) else np.zeros(0, np.int64)
    blocks = top.astype(np.int64) + 1
    doc = np.repeat(row, blocks)
    block = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    low = np.where(block == 0, 0.0, np.exp2(block - 1.0))
    length = np.where(block == 0, 1.0, low)
    weight = np.repeat(count, blocks).astype(np.float64)
    seed = mixed(np.repeat(shingle, blocks) + block.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    x = np.zeros(len(doc))
    best = np.full(n_rows * m, np.inf)
    drawn = 0
    while len(doc):
        # The next points of each process: few rounds, as those left are ever fewer.
        n = min(32, max(1, drawn // 2))
        state = mixed(seed[:, None] + np.arange(drawn + 1, drawn + 1 + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        drawn += n
        # Two draws of a point: its distance from the last, and register and level.
        at = x[:, None] + np.cumsum(-np.log1p(-(state >> np.uint64(11)).astype(np.float64) * 2.0**-53), axis=1) / (length * m)[:, None]
        other = mixed(state ^ np.uint64(0xD6E8FEB86659FD93))
        register = (other >> np.uint64(40)).astype(np.int64) % m + (doc * m)[:, None]
        level = low[:, None] + (other & np.uint64(0xFFFFFFFFFF)).astype(np.float64) * 2.0**-40 * length[:, None]
        counts = level < weight[:, None]
        np.minimum.at(best, register[counts], at[counts])
        x = at[:, -1]
        live = x < best.reshape(n_rows, m).max(axis=1)[doc]
        doc, x, seed, low, length, weight = doc[live], x[live], seed[live], low[live], length[live], weight[live]
    out = best.reshape(n_rows, m)
    got = mixed(np.where(np.isinf(out), 0.0, out).view(np.uint64).copy())
    got[np.isinf(out)] = 0
    return got


def digest(text: Column) -> Column:
    """16 bytes that identify equal texts; a null text counts as the empty text."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def row_hash(doc_id: Column, same: Column) -> Column:
    """Hash of an id and the digest of its text, never null."""
    return F.xxhash64(doc_id.cast("long"), same)


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, same, n_shingles, keys, low) of rows with doc_id, text and same: ``keys`` are band keys,
    ``low`` has the low byte of each register."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets, data = text_bytes(column(b, "text"))
            for i, j in runs(offsets, CHUNK):
                cut = offsets[i : j + 1] - offsets[i]
                row, sh, count = multiset(data[offsets[i] : offsets[j]], cut)
                sig = signatures(row, sh, count, j - i)
                bands = BANDED // ROWS
                key = sig[:, :BANDED].reshape(j - i, bands, ROWS)
                key = mixed(key @ np.array([pow(0xD1342543DE82EF95, e + 1, 1 << 64) for e in range(ROWS)], np.uint64) + np.arange(bands, dtype=np.uint64))
                size = np.bincount(row, weights=count, minlength=j - i).astype(np.int64)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i) * bands + 1, bands), pa.int32()), pa.array(key.reshape(-1).view(np.int64)))
                low = (sig >> np.uint64(24)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([column(b, "doc_id").slice(i, j - i), column(b, "same").slice(i, j - i), pa.array(size), flat, pa.array([r.tobytes() for r in low], pa.binary())], ["doc_id", "same", "n_shingles", "keys", "low"])

    return docs.select("doc_id", "text", "same").mapInArrow(run, "doc_id long, same binary, n_shingles long, keys array<long>, low binary")


def _agree(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Estimated similarity, freed of the chance of equal bytes."""
    return ((many == one).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def forest(low: np.ndarray) -> list[tuple[int, int]]:
    """Maximum spanning forest over estimates of at least ESTIMATE (Prim, a row at a time)."""
    n = len(low)
    best, link = np.full(n, -1.0), np.zeros(n, np.int64)
    out = np.zeros(n, bool)
    links, at = [], 0
    for _ in range(n - 1):
        out[at] = True
        sim = _agree(low[at], low)
        better = ~out & (sim > best)
        best[better], link[better] = sim[better], at
        at = int(np.where(out, -2.0, best).argmax())
        if best[at] >= ESTIMATE:
            links.append((at, int(link[at])))
    return links


def across(g: pd.DataFrame, least: float) -> list[tuple[int, int]]:
    """Verified links between rows of different components: of an asking row (``ask``) with a base row.

    A pair is verified in the first band that it shares, once if both rows ask, and not if the links
    found so far in the block join its components or if the sizes alone rule it out."""
    ids, root, asking = g["id"].to_numpy(), g["root"].to_numpy(), g["asks"].to_numpy(bool)
    ask, size, key = g["ask"].to_numpy(bool), g["n_shingles"].to_numpy(), g["key"].iloc[0]
    low = np.frombuffer(b"".join(g["low"]), np.uint8).reshape(len(g), -1)
    keys = np.stack(g["keys"].to_list())
    bag = g["bag"].to_list()
    joined: dict[int, int] = {}

    def find(x: int) -> int:
        while joined.setdefault(x, x) != x:
            joined[x] = joined[joined[x]]
            x = joined[x]
        return x

    links = []
    for i in np.flatnonzero(ask):
        agree = _agree(low[i], low)
        fit = np.minimum(size, size[i]) >= least * np.maximum(size, size[i]) - 1e-9
        near = np.flatnonzero(~ask & (root != root[i]) & (agree >= ESTIMATE) & fit & ~(asking & (ids < ids[i])))
        near = near[keys[near, (keys[near] == keys[i]).argmax(axis=1)] == key]
        own = _unpack(bag[i])
        for j in near[np.argsort(-agree[near], kind="stable")].tolist():
            x, y = find(int(root[i])), find(int(root[j]))
            if x != y and overlap(*own, *_unpack(bag[j])) >= least:
                joined[x] = y
                links.append((int(ids[i]), int(ids[j])))
    return links


def _grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of equal keys from sorted batches."""
    rest: pd.DataFrame | None = None
    for b in batches:
        got = b.to_pandas()
        rest = got if rest is None or not len(rest) else pd.concat([rest, got], ignore_index=True)
        if not len(rest):
            continue
        v = rest[keys].to_numpy()
        edge = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]).any(axis=1)]))
        for a, z in zip(edge[:-1], edge[1:], strict=True):
            yield rest.iloc[a:z]
        rest = rest.iloc[edge[-1] :].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


def _pairs(found: Iterator[list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int]] = []
    for links in found:
        held += links
        if len(held) >= 50_000:
            yield pa.RecordBatch.from_pandas(pd.DataFrame(held, columns=["a", "b"]), preserve_index=False)
            held = []
    if held:
        yield pa.RecordBatch.from_pandas(pd.DataFrame(held, columns=["a", "b"]), preserve_index=False)


def _in_blocks(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartition(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys, "id")


def first_pairs(rows: DataFrame) -> DataFrame:
    """Links proposed by the forests of all buckets; ``rows`` has key, size, id, low. A bucket of more
    than BLOCK rows is dealt into blocks by a hash that differs between the bands."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "key"), F.ceil(F.col("size") / BLOCK)).cast("int")).select("key", "block", "id", "low")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links() -> Iterator[list[tuple[int, int]]]:
            for g in _grouped(batches, ["key", "block"]):
                if len(g) > 1:
                    ids = g["id"].to_numpy()
                    low = np.frombuffer(b"".join(g["low"]), np.uint8).reshape(len(g), -1)
                    yield [(int(ids[i]), int(ids[j])) for i, j in forest(low)]

        yield from _pairs(links())

    return _ordered(_in_blocks(dealt, ["key", "block"]).mapInArrow(run, "a long, b long"))


def later_links(rows: DataFrame, packed: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Verified links of all pairs of a bucket whose rows are in different components, but for those that
    other links of their block join already; ``rows`` has key, id, low, keys, n_shingles, root. Rows
    outside their bucket's largest component ask; they are compared with all rows of the bucket, in
    blocks of asking rows against blocks of all rows."""
    per = rows.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
    size = per.groupBy("key").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.max(F.struct("n", "root", "w")).alias("m"), F.count("*").alias("roots")).filter("roots > 1")

    def blocks(n: Column, w: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.ceil(w * 8 / BLOCK_BYTES)).cast("int")

    size = size.select("key", F.col("m.root").alias("main"), blocks(F.col("n"), F.col("w")).alias("nb"), blocks(F.col("n") - F.col("m.n"), F.col("w") - F.col("m.w")).alias("na"))
    got = rows.join(size, "key").join(packed, "id").withColumn("asks", F.col("root") != F.col("main"))
    own_b, own_a = F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"), F.pmod(F.xxhash64("id", F.lit(1)), F.col("na")).cast("int")
    # Each row as a base row in every block of asking rows, an asking row also in every block of base rows.
    base = F.transform(F.sequence(F.lit(0), F.col("na") - 1), lambda x: F.struct(own_b.alias("bb"), x.alias("ab"), F.lit(False).alias("ask")))
    ask = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda x: F.struct(x.alias("bb"), own_a.alias("ab"), F.lit(True).alias("ask")))
    dealt = got.withColumn("at", F.explode(F.when(F.col("asks"), F.concat(base, ask)).otherwise(base)))
    dealt = dealt.select("key", "at.bb", "at.ab", "at.ask", "id", "low", "keys", "n_shingles", "root", "asks", "bag")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _pairs(across(g, least) for g in _grouped(batches, ["key", "bb", "ab"]) if len(g) > 1)

    return _ordered(_in_blocks(dealt, ["key", "bb", "ab"]).mapInArrow(run, "a long, b long"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def overlap(ha: np.ndarray, ca: np.ndarray, hb: np.ndarray, cb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets given by sorted hashes and counts."""
    _, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[i], cb[j]).sum())
    every = int(ca.sum() + cb.sum()) - both
    return both / every if every else 1.0


def bags(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, bag): the packed multiset of each wanted text; ``docs`` has doc_id, text, same, ``wanted`` has
    id, same and rep (a doc_id with that text, null if it has none)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets, data = text_bytes(column(b, "text"))
            for i, j in runs(offsets, CHUNK):
                row, sh, count = multiset(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                # 48 bits of the hash and 16 of the count; a larger count goes on in further items.
                items = (count - 1) // 0xFFFF + 1
                nth = np.arange(int(items.sum())) - np.repeat(np.cumsum(items) - items, items)
                row, sh, count = np.repeat(row, items), np.repeat(sh, items), np.repeat(count, items) - nth * 0xFFFF
                sh = sh + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                packed = sh & ~np.uint64(0xFFFF) | np.minimum(count, 0xFFFF).astype(np.uint64)
                at = np.searchsorted(row, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays([column(b, "id").slice(i, j - i), pa.array([packed[a:z].tobytes() for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())], ["id", "bag"])

    # Few texts are wanted: the others are not shuffled.
    likely, _ = parted(docs.filter("doc_id is not null"), row_hash(F.col("doc_id"), F.col("same")), wanted.filter("rep is not null").select(row_hash(F.col("rep"), F.col("same"))))
    named = likely.join(wanted.withColumnRenamed("rep", "doc_id"), ["doc_id", "same"]).select("id", "text")
    # Rows without an id can be very many copies of a text.
    bare = docs.filter("doc_id is null").select("same", "text").dropDuplicates(["same"])
    got = named.unionByName(bare.join(wanted.filter("rep is null"), "same").select("id", "text"))
    return got.mapInArrow(run, "id long, bag binary")


def _unpack(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(bag, np.uint64)
    return v >> np.uint64(16), (v & np.uint64(0xFFFF)).astype(np.int64)


def verify(pairs: DataFrame, packed: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(a, b, similarity) of the pairs that reach ``least``; AQE splits the rows of a text in very many pairs.

    Each pair is compared once: a filter on a column UDF would be pushed below it and take a second run
    of the UDF, in a second Python worker for each core."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            found = np.array([overlap(*_unpack(one.as_py()), *_unpack(two.as_py())) for one, two in zip(column(x, "one"), column(x, "two"), strict=True)], float)
            fit = pa.array(np.flatnonzero(found >= least))
            yield pa.RecordBatch.from_arrays([column(x, "a").take(fit), column(x, "b").take(fit), pa.array(found).take(fit)], ["a", "b", "similarity"])

    left = pairs.join(packed.select(F.col("id").alias("a"), F.col("bag").alias("one")), "a")
    both = left.join(packed.select(F.col("id").alias("b"), F.col("bag").alias("two")), "b")
    return both.select("a", "b", "one", "two").mapInArrow(run, "a long, b long, similarity double").distinct()


def members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(doc_id, same, class_id, class_key, kept), a row for each row of ``docs``; ``same`` is the digest of
    the row's text. ``class_id`` is the smallest id of the documents that the row is linked to, over any path,
    by equal text or a similarity of at least ``least``, and null only if none of them has an id;
    ``class_key`` is the smallest digest of their texts. ``kept`` marks the rows of the document that stands
    for the class: those with its ``class_id``, or the text of its ``class_key`` if that is null.

    Null texts count as empty; all empty texts are equal, texts without words else only to themselves.
    A text of fewer than five words has one shingle of all its words. Rows of one doc_id are taken as
    one document's versions: each is classed by its text. So are rows without an id.
    """
    src = doc_text(docs, id_col, text_col).withColumn("same", digest(F.col("text")))
    marks = stage(sketch(src), "sketches")
    # Equal texts, and rows of one id with different texts, by their smallest id.
    same = marks.select("doc_id", "same")
    reps = marks.groupBy("same").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("low").alias("low"))
    reps = stage(reps.withColumn("id", F.xxhash64("same")), "reps")
    whole = reps.filter("n_shingles > 0")
    keyed = whole.select("id", F.explode("keys").alias("key"))
    crowded = keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    rows = stage(keyed.join(crowded, "key").join(whole.select("id", "rep", "same", "low", "keys", "n_shingles"), "id"), "buckets")
    wanted = stage(rows.select("id", "rep", "same").distinct(), "wanted")
    packed = stage(bags(src, wanted), "bags")
    first = stage(first_pairs(rows), "pairs")
    links = stage(verify(first, packed, least), "verified")
    roots = components(links.select("a", "b"))
    named = rows.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    later = stage(later_links(named, packed, least), "later")
    if not later.isEmpty():
        # The stars of the first links, not those links again.
        roots = components(roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(later))
    member = reps.select("id", "same", "rep").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least_id = member.groupBy("root").agg(F.min("rep").alias("class_id"), F.min("same").alias("class_key"))
    named = member.join(least_id, "root").select("same", "class_id", "class_key")
    kept = F.when(F.col("class_id").isNull(), F.col("same") == F.col("class_key")).otherwise(F.col("doc_id").eqNullSafe(F.col("class_id")))
    return same.join(named, "same").select("doc_id", "same", "class_id", "class_key", kept.alias("kept"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) of ``members``."""
    return members(docs, id_col, text_col, least).select("doc_id", "class_id")

