"""Benchmark decontamination by greedy string tiling.

Karp-Rabin hashes of all windows of ``MIN_MATCH`` words are looked up in those of the benchmark items;
equal windows on one diagonal chain to maximal matches. Of these the longest is marked first; what
marked words cut off another match is put back if it is still long enough, until none is left. The
marked share of an item's words is its coverage, however the passages are ordered in the document.

The benchmark is a stated query set. It is sent to the tasks in blocks of bounded size, each of which
scans all documents; one block is enough up to ``BLOCK_BYTES`` of benchmark text.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import words as W
from riskflow.llm.common import column, doc_text, runs, text_bytes

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_BYTES = 8 << 20
CHUNK = 1 << 20
_TABLE_LOG2 = 20


def tile(doc: np.ndarray, item: np.ndarray, seeds: list[tuple[int, int]], k: int) -> list[tuple[int, int, int]]:
    """(document word, item word, length) of each tile; ``seeds`` are (document, item) places of equal
    windows of ``k`` words. Of equally long matches the one earliest in the item, then in the document, is marked."""
    heap = []
    at = sorted(seeds, key=lambda s: (s[0] - s[1], s[0]))
    i = 0
    while i < len(at):
        j = i
        while j + 1 < len(at) and at[j + 1][0] - at[j + 1][1] == at[i][0] - at[i][1] and at[j + 1][0] <= at[j][0] + 1:
            j += 1
        p, q = at[i]
        heap.append((-(at[j][0] - p + k), q, p))
        i = j + 1
    heapq.heapify(heap)
    used_doc: set[int] = set()
    used_item = np.zeros(len(item), bool)
    tiles = []
    while heap:
        n, q, p = heapq.heappop(heap)
        n = -n
        free = [not used_item[q + x] and p + x not in used_doc for x in range(n)]
        if all(free):
            tiles.append((p, q, n))
            used_item[q : q + n] = True
            used_doc.update(range(p, p + n))
            continue
        x = 0
        while x < n:
            y = x
            while y < n and free[y]:
                y += 1
            if y - x >= k:
                heapq.heappush(heap, (-(y - x), q + x, p + x))
            x = y + 1
    return tiles


class Block:
    """Some benchmark items with their window hashes."""

    def __init__(self, items: list[tuple[int, str]], k: int) -> None:
        self.ids = [i for i, _ in items]
        raw = [t.encode() for _, t in items]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        h, row, _, _ = W.words(data, offsets)
        edge = np.searchsorted(row, np.arange(len(items) + 1))
        self.words = [h[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
        #: By window length: the sorted hashes with item and place, and a table of their low bits. Items
        #: of fewer than k words are looked up as one window of all their words.
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        size = np.diff(edge)
        for n in sorted({min(k, int(s)) for s in size if s}):
            own = np.flatnonzero(np.minimum(size, k) == n)
            pick = np.isin(row, own)
            s, r, first = W.shingles(h[pick], row[pick], len(items), n)
            place = np.flatnonzero(pick)[first] - edge[r]
            order = np.lexsort((place, r, s))
            s, r, place = s[order], r[order], place[order]
            table = np.zeros(1 << _TABLE_LOG2, bool)
            table[(s & np.uint64((1 << _TABLE_LOG2) - 1)).astype(np.int64)] = True
            self.by_length[n] = (s, r, place, table)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float, list[tuple[int, int, int]]]]:
        """(row, item index, coverage, tiles) of each row and item with a common window."""
        h, row, _, _ = W.words(data, offsets)
        begin = np.searchsorted(row, np.arange(len(offsets)))
        seeds: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for n, (keys, item, place, table) in self.by_length.items():
            s, r, first = W.shingles(h, row, len(offsets) - 1, n)
            whole = begin[r + 1] - first >= n  # not the shorter window of a row with fewer words
            maybe = np.flatnonzero(table[(s & np.uint64((1 << _TABLE_LOG2) - 1)).astype(np.int64)] & whole)
            lo, hi = np.searchsorted(keys, s[maybe]), np.searchsorted(keys, s[maybe], side="right")
            for x, a, b in zip(maybe[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                for y in range(a, b):
                    seeds.setdefault((int(r[x]), int(item[y])), []).append((int(first[x] - begin[r[x]]), int(place[y])))
        out = []
        for (r, i), found in seeds.items():
            item = self.words[i]
            tiles = tile(h[begin[r] : begin[r + 1]], item, found, min(MIN_MATCH, len(item)))
            out.append((r, i, sum(t[2] for t in tiles) / len(item), tiles))
        return out


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str, block_bytes: int) -> Iterator[Broadcast]:
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).filter("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        yield spark.sparkContext.broadcast(Block([tuple(r) for r in own], MIN_MATCH))


_COLUMNS = "doc_id long, item_id long, coverage double, n_tiles long, longest long, item_words long, tiles array<struct<doc_word:long,item_word:long,length:long>>"


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, longest, item_words, tiles), a row for each document and
    benchmark item whose words it covers to at least ``least``.

    Null and empty texts, and texts without words, match nothing on either side; repeated rows of a
    document or an item give repeated rows; empty tables give none. Whole texts are read.
    """
    src = doc_text(docs, id_col, text_col)
    out = None
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):

        def scan(batches: Iterable[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                offsets, data = text_bytes(column(batch, "text"))
                names = column(batch, "doc_id").to_pylist()
                for i, j in runs(offsets, CHUNK):
                    hits = [(names[i + r], block.value.ids[x], c, len(t), max(n for _, _, n in t), len(block.value.words[x]), [{"doc_word": p, "item_word": q, "length": n} for p, q, n in sorted(t)]) for r, x, c, t in block.value.matches(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) if c >= least and t]
                    cols = list(zip(*hits, strict=True)) or [[]] * 7
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("length", pa.int64())]))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "item_id", "coverage", "n_tiles", "longest", "item_words", "tiles"])

        found = src.mapInArrow(scan, _COLUMNS)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, least: float = COVERAGE, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` whose text covers no benchmark item, with all columns; rows are judged where
    they lie, nothing is shuffled. Rows with a null text stay."""
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):

        def sift(batches: Iterable[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                offsets, data = text_bytes(column(batch, text_col))
                good = np.ones(batch.num_rows, bool)
                for i, j in runs(offsets, CHUNK):
                    good[[i + r for r, _, c, t in block.value.matches(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) if c >= least and t]] = False
                yield batch.filter(pa.array(good))

        docs = docs.mapInArrow(sift, docs.schema)
    return docs
