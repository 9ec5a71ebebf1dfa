"""Phrase collocations, counted exactly in burstable tries of word ids.

Each task keeps a trie over the paths of its word triples: shallow nodes branch on five bits of the path,
leaves are containers that count equal triples, and a container that grows too large bursts into a node. When a
task's trie is full, its largest subtrees are written out as sorted runs, packed as tries and cut by path
prefix; one group for each prefix partition merges the runs. A triple's path is its first word's id. For a
frequent first word, whose subtree could hold a third of all triples, the second word takes part as well,
and the third if both are frequent, so that no partition depends on one word or pair.

A word id is a 64-bit hash of language and word. The vocabulary pass compares the bytes of all words with
an equal id; if two words share one, ids are made anew with the next seed. Counts are therefore exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.byte_words import ENDS, LOWER, WordHash, tokens
from riskflow.llm.common import column, gather, mixed, stage, text_bytes

UNDETERMINED = "und"
MIN_COUNT, TOP = 10, 2000
#: Parts in which a language's phrases are ranked first.
RANK_PARTS = 64
#: A bigram goes if a longer candidate that holds it has this share (in percent) of its occurrences.
COVERED = 50
#: A word is frequent from HOT_LEAST occurrences on and from a 1/HOT_MAX share of all: at most HOT_MAX words.
HOT_LEAST, HOT_MAX = 50_000, 1 << 16
#: Triples in a task's trie before subtrees go out, in a container before it bursts, and words for each prefix partition.
MEMORY, BURST, PARTITION_WORDS = 1 << 20, 1 << 14, 2_000_000
_DIGIT, _DEPTH = 5, 8


def _source(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDETERMINED)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def _word_ids(batch: pa.RecordBatch, hasher: WordHash):
    """Lower-cased bytes, words (start, end, row), their ids, and each row's language number and the languages."""
    offsets, data = text_bytes(column(batch, "text"))
    data = LOWER[data]
    starts, ends, doc, ids = tokens(data, offsets, hasher)
    coded = column(batch, "lang").dictionary_encode()
    names = coded.dictionary.to_pylist()
    l_off, l_data = text_bytes(coded.dictionary)
    salt = hasher(l_data, l_off[:-1], l_off[1:]) if len(names) else np.zeros(0, np.uint64)
    lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ids = mixed(ids ^ mixed(salt[lang[doc]] + np.uint64(1)))
    ids[ids == 0] = 1
    return data, starts, ends, doc, ids, lang, names


def _count_words(seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHash(seed)
        for b in batches:
            data, starts, ends, doc, ids, lang, names = _word_ids(b, hasher)
            if not len(ids):
                continue
            found, first, which, n = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
            size, as_first = ends - starts, first[which]
            clash = (size != size[as_first]) | (lang[doc] != lang[doc[as_first]])
            if not clash.any():
                for i in range(0, len(ids), 1 << 17):
                    j, like = slice(i, i + (1 << 17)), as_first[i : i + (1 << 17)]
                    if (data[gather(starts[j], size[j])] != data[gather(starts[like], size[like])]).any():
                        clash[i] = True
            bounds = np.concatenate([[0], np.cumsum(size[first])]).astype(np.int64)
            raw = data[gather(starts[first], size[first])]
            words = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds), pa.py_buffer(raw)).cast(pa.string())
            langs = pa.array(names, pa.string()).take(pa.array(lang[doc[first]]))
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), langs, words, pa.array(n.astype(np.int64))], ["id", "lang", "word", "n"])
            if clash.any():  # a row without a word: the seed is no good
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([""]), pa.array([None], pa.string()), pa.array([0], pa.int64())], ["id", "lang", "word", "n"])

    return run


def vocabulary(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, int]:
    """(id, lang, word, n) of all words, and the seed that gives each its own id."""
    src, seed = _source(docs, lang_col, text_col), 0
    while True:
        counted = src.mapInArrow(_count_words(seed), "id long, lang string, word string, n long")
        words = stage(counted.groupBy("id", "lang", "word").agg(F.sum("n").alias("n")), "vocabulary")
        shared = words.groupBy("id").agg((F.count("*") > F.count("word")).alias("lost"), F.count("*").alias("k")).filter("lost or k > 1")
        if shared.isEmpty():
            return words, seed
        seed += 1


def _is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _paths(triples: list[np.ndarray], hot: np.ndarray) -> np.ndarray:
    w1, w2, w3 = triples[:3]
    path = w1.copy()
    at = np.flatnonzero(_is_in(w1, hot))
    path[at] = mixed(path[at] + mixed(w2[at] + np.uint64(3)))
    at = at[_is_in(w2[at], hot)]
    path[at] = mixed(path[at] + mixed(w3[at] + np.uint64(5)))
    return path


def _summed(cols: list[np.ndarray], order: np.ndarray, keys: int) -> list[np.ndarray]:
    """Rows in ``order``, equal neighbours (by the first ``keys`` columns) made one; the last column is summed."""
    cols = [c[order] for c in cols]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in cols[:keys]:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    return [c[at] for c in cols[:-1]] + [np.add.reduceat(cols[-1], at) if len(at) else cols[-1]]


class _Node:
    __slots__ = ("kids", "parts", "size")

    def __init__(self) -> None:
        self.kids: dict[int, _Node] | None = None
        self.parts: list[list[np.ndarray]] = []
        self.size = 0

    def rows(self) -> list[list[np.ndarray]]:
        return self.parts if self.kids is None else [x for kid in self.kids.values() for x in kid.rows()]


class Trie:
    """Counts of (path, w1, w2, w3); columns are numpy arrays, the last one the count."""

    def __init__(self) -> None:
        self.root = _Node()
        self.root.kids = {}

    def add(self, cols: list[np.ndarray]) -> None:
        self._add(self.root, cols, 0)

    def _add(self, node: _Node, cols: list[np.ndarray], depth: int) -> int:
        before = node.size
        if node.kids is not None:
            digit = ((cols[0] >> np.uint64(64 - _DIGIT * (depth + 1))) & np.uint64((1 << _DIGIT) - 1)).astype(np.uint8)
            order = np.argsort(digit, kind="stable")
            cuts = np.searchsorted(digit[order], np.arange((1 << _DIGIT) + 1))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                take = order[cuts[k] : cuts[k + 1]]
                node.size += self._add(node.kids.setdefault(k, _Node()), [c[take] for c in cols], depth + 1)
            return node.size - before
        node.parts.append(cols)
        node.size += len(cols[0])
        if node.size > BURST:
            whole = [np.concatenate(x) for x in zip(*node.parts, strict=True)]
            # Container order is that of a hash; if two triples share it, equal ones may not meet here. They do in the merge.
            h = mixed(whole[1] + mixed(whole[2] + mixed(whole[3] + np.uint64(7))))
            whole = _summed(whole, np.argsort(h), 4)
            node.parts, node.size = [whole], len(whole[0])
            if node.size > BURST // 2 and depth < _DEPTH:
                node.kids, node.parts, node.size = {}, [], 0
                self._add(node, whole, depth)
        return node.size - before

    def spill(self) -> list[np.ndarray]:
        """Takes the largest subtree out, as a run in trie order."""
        assert self.root.kids
        k = max(self.root.kids, key=lambda x: self.root.kids[x].size)
        node = self.root.kids.pop(k)
        self.root.size -= node.size
        whole = [np.concatenate(x) for x in zip(*node.rows(), strict=True)]
        return _summed(whole, np.lexsort((whole[3], whole[2], whole[1])), 4)


def _pack(w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, n: np.ndarray) -> bytes:
    """A sorted run as a trie: each first word once, under it each second word once, under it third words and counts."""
    new1 = np.ones(len(w1), bool)
    new1[1:] = w1[1:] != w1[:-1]
    new2 = new1.copy()
    new2[1:] |= w2[1:] != w2[:-1]
    at1, at2 = np.flatnonzero(new1), np.flatnonzero(new2)
    kids1 = np.diff(np.append(np.cumsum(new2)[at1] - 1, len(at2))).astype(np.uint32)
    kids2 = np.diff(np.append(at2, len(w1))).astype(np.uint32)
    count = n.astype(np.uint32 if n.max() < 2**32 else np.uint64)
    head = np.array([len(at1), len(at2), len(w1), count.itemsize], np.int64)
    return b"".join(x.tobytes() for x in (head, w1[at1], kids1, w2[at2], kids2, w3, count))


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    k1, k2, k3, item = (int(x) for x in np.frombuffer(raw, np.int64, 4))
    at, out = 32, []
    for size, kind in ((k1, np.uint64), (k1, np.uint32), (k2, np.uint64), (k2, np.uint32), (k3, np.uint64), (k3, np.uint32 if item == 4 else np.uint64)):
        out.append(np.frombuffer(raw, kind, size, at))
        at += size * np.dtype(kind).itemsize
    w1, kids1, w2, kids2, w3, n = out
    return np.repeat(np.repeat(w1, kids1), kids2), np.repeat(w2, kids2), w3, n.astype(np.int64)


def _runs(seed: int, hot: np.ndarray, partitions: int):
    def packed(run: list[np.ndarray]) -> pa.RecordBatch:
        part = ((run[0] >> np.uint64(32)) * np.uint64(partitions)) >> np.uint64(32)
        order = np.argsort(part, kind="stable")
        cols = [c[order] for c in run[1:]]
        cuts = np.append(np.flatnonzero(np.diff(part[order], prepend=np.uint64(partitions))), len(order))
        blobs = [_pack(*(c[i:j] for c in cols)) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(part[order][cuts[:-1]].astype(np.int64)), pa.array(blobs, pa.binary())], ["part", "run"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, trie = WordHash(seed), Trie()
        for b in batches:
            data, starts, _, doc, ids, _, _ = _word_ids(b, hasher)
            if not len(ids):
                continue
            piece = np.searchsorted(np.flatnonzero(ENDS[data]), starts) + doc
            next1 = np.zeros(len(ids), np.uint64)
            next1[:-1] = np.where(piece[1:] == piece[:-1], ids[1:], 0)
            next2 = np.zeros(len(ids), np.uint64)
            next2[:-1] = np.where(next1[:-1] != 0, next1[1:], 0)
            # A word that ends its piece alone is in the vocabulary already.
            for i in range(0, len(ids), 1 << 18):
                w = [x[i : i + (1 << 18)] for x in (ids, next1, next2)]
                w = [x[w[1] != 0] for x in w]
                if len(w[0]):
                    trie.add([_paths(w, hot), *w, np.ones(len(w[0]), np.int64)])
                if trie.root.size > MEMORY:
                    while trie.root.size > MEMORY // 2:
                        yield packed(trie.spill())
        while trie.root.kids:
            yield packed(trie.spill())

    return run


def _merge(hot: np.ndarray, least: int):
    def run(group: pa.Table) -> pa.Table:
        cols = [np.concatenate(x) for x in zip(*(_unpack(r) for r in group["run"].to_pylist()), strict=True)]
        w1, w2, w3, n = _summed(cols, np.lexsort((cols[2], cols[1], cols[0])), 3)
        keep = (w3 != 0) & (n >= least)
        pairs = np.ones(len(w1), bool)
        pairs[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
        at = np.flatnonzero(pairs)
        p1, p2, total = w1[at], w2[at], np.add.reduceat(n, at)
        # The triples of two frequent words lie in several partitions: their pair is summed afterwards.
        p_keep = (total >= least) | (_is_in(p1, hot) & _is_in(p2, hot))
        out = [np.concatenate([x[keep], y[p_keep]]) for x, y in ((w1, p1), (w2, p2), (w3, np.zeros(len(p1), np.uint64)), (n, total))]
        return pa.table([pa.array(x.view(np.int64)) for x in out], ["w1", "w2", "w3", "n"])

    return run


def phrase_counts(docs: DataFrame, words: DataFrame, seed: int, least: int = MIN_COUNT, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """((w1, w2, n), (w1, w2, w3, n)): pairs and triples of word ids with at least ``least`` occurrences."""
    total = words.agg(F.sum("n")).first()[0] or 0
    floor = _hot_from(total)
    hot = np.sort(np.array([r[0] for r in words.filter(F.col("n") >= floor).select("id").collect()], np.int64).view(np.uint64))
    partitions = max(1, -(-total // PARTITION_WORDS))
    runs = _source(docs, lang_col, text_col).mapInArrow(_runs(seed, hot, partitions), "part long, run binary")
    made = stage(runs.groupBy("part").applyInArrow(_merge(hot, least), "w1 long, w2 long, w3 long, n long"), "phrases")
    pairs = made.filter("w3 = 0").groupBy("w1", "w2").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return pairs, made.filter("w3 <> 0")


def _hot_from(total: int) -> int:
    return max(HOT_LEAST, -(-total // HOT_MAX))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in 38 digits."""
    whole = a.cast("decimal(15,0)") * a.cast("decimal(15,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", whole, left.cast("decimal(18,0)") * right.cast("decimal(18,0)"))


def _named(pairs: DataFrame, words: DataFrame, floor: int, key: str, name: str) -> DataFrame:
    """Joins the word of the id in ``key``: frequent ones (at most HOT_MAX) by broadcast, others by their id."""
    info = F.struct("lang", "word", "n")
    hot = words.filter(F.col("n") >= floor).select(F.col("id").alias("__hot_id"), info.alias("__hot"))
    cold = words.filter(F.col("n") < floor).select(F.col("id").alias("__cold_id"), info.alias("__cold"))
    out = pairs.join(F.broadcast(hot), F.col(key) == F.col("__hot_id"), "left")
    # Rows that are done are spread, so that no task gets all of them.
    at = F.when(F.col("__hot").isNull(), F.col(key)).otherwise(F.xxhash64("w1", "w2"))
    out = out.join(cold, at == F.col("__cold_id"), "left")
    return out.withColumn(name, F.coalesce("__hot", "__cold")).drop("__hot_id", "__hot", "__cold_id", "__cold")


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two or three words by score,
    occurrences, phrase (byte order).

    Null texts are empty; rows without a language are those of ``und``; repeated rows count each time; an
    empty table gives no rows; other columns are not read. Whole texts are read, and words of any length.
    ``l`` and ``r`` are the occurrences of the two parts at the lowest-scoring cut (ties: the first cut).
    Pairs inside a triple that has half of their occurrences go.
    """
    words, seed = vocabulary(docs, lang_col, text_col)
    pairs, triples = phrase_counts(docs, words, seed, least, lang_col, text_col)
    floor = _hot_from(words.agg(F.sum("n")).first()[0] or 0)
    pairs = stage(_named(_named(pairs, words, floor, "w1", "x1"), words, floor, "w2", "x2"), "pairs")
    left = pairs.select("w1", "w2", F.col("n").alias("n12"), "x1", "x2")
    right = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("n23"), F.col("x2").alias("x3"))
    threes = stage(triples.join(left, ["w1", "w2"]).join(right, ["w2", "w3"]), "triples")

    covers = threes.select("w1", "w2", "n").unionByName(threes.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "n"))
    covers = covers.groupBy("w1", "w2").agg(F.max("n").alias("cover"))
    twos = pairs.join(covers, ["w1", "w2"], "left").filter(F.col("cover").isNull() | (100 * F.col("cover") < COVERED * F.col("n")))
    twos = twos.select(
        F.col("x1.lang").alias("lang"), F.concat_ws(" ", "x1.word", "x2.word").alias("phrase"), F.col("n").alias("a"),
        F.col("x1.n").alias("l"), F.col("x2.n").alias("r"), _score(F.col("n"), F.col("x1.n"), F.col("x2.n")).alias("score"),
    )
    first, second = _score(F.col("n"), F.col("x1.n"), F.col("n23")), _score(F.col("n"), F.col("n12"), F.col("x3.n"))
    threes = threes.withColumns({"s1": first, "s2": second})
    cut = F.col("s1") <= F.col("s2")
    threes = threes.select(
        F.col("x1.lang").alias("lang"), F.concat_ws(" ", "x1.word", "x2.word", "x3.word").alias("phrase"), F.col("n").alias("a"),
        F.when(cut, F.col("x1.n")).otherwise(F.col("n12")).alias("l"), F.when(cut, F.col("n23")).otherwise(F.col("x3.n")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    order = F.desc("score"), F.desc("a"), F.col("phrase")
    # Ranked in parts first, so that a language's last step sees at most RANK_PARTS times ``top`` phrases.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    best = twos.unionByName(threes).withColumn("part", part)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
