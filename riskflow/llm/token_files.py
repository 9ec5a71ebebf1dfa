"""Token ids in binary shards under Re-Pair grammar compression.

Documents are tokenised in ascending id order and cut into shards. In each shard frequent pairs of
adjacent symbols are replaced by nonterminals, round after round; a round takes the most frequent
pairs at once, leftmost first, and no rule crosses a document's border. A shard stores its rules, the
expansion length of each rule and where each document's symbols start, so that one document can be
decoded without the others.

Shard layout (little-endian): ``RPG1``, then unsigned 32-bit: first symbol that is a rule, rules R,
symbols S, documents D; 32-bit pairs of R rules, expansion lengths of R rules, D + 1 symbol offsets,
the S symbols (16-bit if they fit, as the following flag byte says), flag byte first.
Shards lie in a Parquet table, one binary value each, which Spark's committer writes: a task that is
lost and run again leaves no half or double shard, on any store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm import words as W
from riskflow.llm.common import column, doc_text, gather, runs, shuffle_partitions, stage, text_bytes

END_ID = 2
#: A shard is closed at the first document that brings it to so many ids.
SHARD_IDS = 1 << 20
ROUNDS, RULES_PER_ROUND, LEAST_COUNT = 5, 2048, 8
#: Chunks of more bytes are not known by their hash.
LONG_CHUNK = 64
#: Bytes of text that are tokenised at once.
CHUNK = 1 << 20
_HASH_LOG2 = 17


class Known:
    """Open-addressing table of 64-bit hashes to numbers, looked up for whole arrays."""

    def __init__(self, log2: int = 22) -> None:
        self.shift, self.mask = np.uint64(64 - log2), (1 << log2) - 1
        self.keys, self.value = np.zeros(1 << log2, np.uint64), np.zeros(1 << log2, np.int32)
        self.n, self.most = 0, (1 << log2) // 2

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, or -1."""
        out = np.full(len(h), -1, np.int64)
        at, slot = np.arange(len(h)), (h >> self.shift).astype(np.int64)
        while len(at):
            key = self.keys[slot]
            hit = key == h[at]
            out[at[hit]] = self.value[slot[hit]]
            more = ~hit & (key != 0)
            at, slot = at[more], (slot[more] + 1) & self.mask
        return out

    def add(self, h: np.ndarray, value: np.ndarray) -> None:
        """New, distinct hashes."""
        self.n += len(h)
        at, slot = np.arange(len(h)), (h >> self.shift).astype(np.int64)
        while len(at):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = h[at[free]]
            done = self.keys[slot] == h[at]
            self.value[slot[done]] = value[at[done]]
            at, slot = at[~done], (slot[~done] + 1) & self.mask


class Tokens:
    """The library's ids of whole texts. A text is cut at blanks and line ends, which its pre-tokeniser
    drops and across which neither its normaliser nor its merges reach; each distinct chunk is encoded
    by the library once and known by its hash from then on (chunks of over LONG_CHUNK bytes each time)."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.known = Known()
        self.ids, self.at, self.len = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        got = [e.ids for e in self.library.encode_batch_fast([raw[a:z].decode() for a, z in zip(start.tolist(), end.tolist(), strict=True)], add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.int32, int(size.sum())), size

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text) of UTF-8 texts that lie between ``offsets``."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        start, end = W.spans((data != 32) & (data != 10), offsets)
        h = W.hashes(data, start, end) | np.uint64(1)
        place = self.known.find(h)
        long = end - start > LONG_CHUNK
        place[long] = -1
        all_ids, all_at, all_len = self.ids, self.at, self.len
        new = np.flatnonzero((place < 0) & ~long)
        distinct, first, back = np.unique(h[new], return_index=True, return_inverse=True)
        own = np.concatenate([new[first], np.flatnonzero(long)])
        if len(own):
            more, size = self._learn(data, start[own], end[own])
            n = len(all_at)
            place[new] = n + back
            place[long] = n + len(first) + np.arange(int(long.sum()))
            all_at = np.concatenate([all_at, len(all_ids) + np.cumsum(size) - size])
            all_len, all_ids = np.concatenate([all_len, size]), np.concatenate([all_ids, more])
            if self.known.n + len(distinct) <= self.known.most:  # a full table keeps what came first
                self.known.add(distinct, np.arange(n, n + len(distinct)))
                self.ids, self.at, self.len = all_ids, all_at, all_len
        size = all_len[place]
        ends = np.concatenate([[0], np.cumsum(size)])
        return all_ids[gather(all_at[place], size)], np.diff(ends[np.searchsorted(start, offsets)])


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def expansions(symbols: np.ndarray, base: int, size: np.ndarray) -> np.ndarray:
    """Ids that each symbol stands for."""
    out = np.ones(symbols.shape, np.int64)
    rule = symbols >= base
    out[rule] = size[symbols[rule] - base]
    return out


def compress(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """A shard of documents of ``lengths`` ids."""
    seq = ids.astype(np.uint32)
    closes = np.zeros(len(seq), bool)  # the last symbol of a document: no pair starts here
    closes[np.cumsum(lengths)[lengths > 0] - 1] = True
    base = int(seq.max()) + 1 if len(seq) else 0
    rules: list[np.ndarray] = []
    size = np.zeros(0, np.int64)  # ids that each rule stands for
    made = 0
    for _ in range(ROUNDS):
        if len(seq) < 2 * LEAST_COUNT:
            break
        small = base + made + RULES_PER_ROUND < 1 << 16
        key = (seq[:-1] << np.uint32(16) | seq[1:]) if small else (seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:])
        inner = np.flatnonzero(~closes[:-1])
        # Pairs are counted by hash slot: each slot stands for one of its pairs, whose count is exact;
        # pairs that share its slot wait for a later round.
        mul, shift = (np.uint32(0x9E3779B1), np.uint32(32 - _HASH_LOG2)) if small else (np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - _HASH_LOG2))
        where = ((key * mul) >> shift).astype(np.int32)
        table = np.zeros(1 << _HASH_LOG2, key.dtype)
        table[where[inner]] = key[inner]
        same = table[where] == key
        same &= ~closes[:-1]
        hit = np.flatnonzero(same)
        times = np.bincount(where[hit], minlength=1 << _HASH_LOG2)
        slot = np.flatnonzero(times >= LEAST_COUNT)
        slot = slot[np.argsort(-times[slot], kind="stable")][:RULES_PER_ROUND]
        pairs = table[slot]
        if not len(pairs):
            break
        number = np.zeros(1 << _HASH_LOG2, np.uint32)
        number[slot] = base + made + np.arange(len(pairs), dtype=np.uint32)
        hit = hit[number[where[hit]] > 0]
        # Leftmost, not overlapping: every other one of a run of neighbouring hits.
        begin = np.concatenate([[True], hit[1:] != hit[:-1] + 1])
        since = hit - np.maximum.accumulate(np.where(begin, hit, 0))
        hit = hit[since % 2 == 0]
        seq[hit] = number[where[hit]]
        closes[hit] = closes[hit + 1]
        keep = np.ones(len(seq), bool)
        keep[hit + 1] = False
        seq, closes = seq[keep], closes[keep]
        half = np.uint32(16) if small else np.uint64(32)
        two = np.column_stack([pairs >> half, pairs & ((np.ones(1, key.dtype)[0] << half) - np.ones(1, key.dtype)[0])]).astype("<u4")
        rules.append(two)
        size = np.concatenate([size, expansions(two, base, size).sum(axis=1)])
        made += len(pairs)
    wide = int(base + made > 1 << 16)
    ends = np.flatnonzero(closes) + 1
    offsets = np.zeros(len(lengths) + 1, "<u4")
    count = np.zeros(len(lengths), np.int64)
    count[lengths > 0] = np.diff(np.concatenate([[0], ends]))
    offsets[1:] = np.cumsum(count)
    head = b"RPG1" + struct.pack("<4I", base, made, len(seq), len(lengths))
    grammar = np.concatenate(rules) if rules else np.zeros((0, 2), "<u4")
    expansion = size.astype("<u4")
    return head + grammar.tobytes() + expansion.tobytes() + offsets.tobytes() + bytes([wide]) + seq.astype("<u4" if wide else "<u2").tobytes()


class Shard:
    """A shard that is read: documents can be decoded one by one."""

    def __init__(self, raw: bytes) -> None:
        if raw[:4] != b"RPG1":
            raise ValueError("not a token shard")
        self.base, r, s, d = struct.unpack_from("<4I", raw, 4)
        at = 20
        self.rules = np.frombuffer(raw, "<u4", 2 * r, at).reshape(r, 2).astype(np.int64)
        self.size = np.frombuffer(raw, "<u4", r, at + 8 * r).astype(np.int64)
        self.offsets = np.frombuffer(raw, "<u4", d + 1, at + 12 * r).astype(np.int64)
        at += 12 * r + 4 * (d + 1)
        self.seq = np.frombuffer(raw, "<u4" if raw[at] else "<u2", s, at + 1)

    def n_docs(self) -> int:
        return len(self.offsets) - 1

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Rules have only older symbols in them: expand a level at a time."""
        out = symbols.astype(np.int64)
        while len(out) and (rule := out >= self.base).any():
            wide = np.where(rule, 2, 1)
            ends = np.cumsum(wide)
            nxt = np.repeat(out, wide)
            pair = self.rules[out[rule] - self.base]
            nxt[ends[rule] - 2], nxt[ends[rule] - 1] = pair[:, 0], pair[:, 1]
            out = nxt
        return out

    def lengths(self) -> np.ndarray:
        """Ids of each document, from the expansion lengths alone."""
        ends = np.concatenate([[0], np.cumsum(expansions(self.seq.astype(np.int64), self.base, self.size))])
        return np.diff(ends[self.offsets])

    def document(self, i: int) -> np.ndarray:
        return self.expand(self.seq[self.offsets[i] : self.offsets[i + 1]])

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, their lengths)."""
        return self.expand(self.seq), self.lengths()


def write(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Tokenise ``docs`` into shards, written as a table; returns it: part, seq, first_id, n_docs, n_ids,
    doc_ids (binary of 64-bit integers), payload.

    Documents are in ascending id order over (part, seq); null ids come first, as -2^63; rows with one id
    are ordered by text. Null texts count as empty: they have the end id alone. No rows give no shards.
    """
    src = doc_text(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(-(2**63))))
    parts = shuffle_partitions(docs.sparkSession)
    ordered = src.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, seq = tokens(tokenizer_path), 0
        docs_held: list[int] = []
        ids_held: list[np.ndarray] = []
        lens_held: list[int] = []
        total = 0

        def shard() -> pa.RecordBatch:
            payload = compress(np.concatenate(ids_held), np.array(lens_held, np.int64))
            values = [docs_held[0], seq, len(docs_held), total, np.array(docs_held, "<i8").tobytes(), payload]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], ["first_id", "seq", "n_docs", "n_ids", "doc_ids", "payload"])

        for b in batches:
            names = column(b, "doc_id").to_pylist()
            offsets, data = text_bytes(column(b, "text"))
            for i, j in runs(offsets, CHUNK):
                ids, size = tok.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                ends = np.cumsum(size)
                ids = np.insert(ids, ends, end_id).astype(np.int32)
                ends = (ends + np.arange(1, len(ends) + 1)).tolist()
                for name, a, z in zip(names[i:j], [0, *ends[:-1]], ends, strict=True):
                    docs_held.append(name)
                    ids_held.append(ids[a:z])
                    lens_held.append(z - a)
                    total += z - a
                    if total >= shard_ids:
                        yield shard()
                        docs_held, ids_held, lens_held, total, seq = [], [], [], 0, seq + 1
        if docs_held:
            yield shard()

    made = ordered.mapInArrow(cut, "first_id long, seq long, n_docs long, n_ids long, doc_ids binary, payload binary")
    # Ranges are in order of their ids; one id that fills a range stays whole in it.
    made = made.withColumn("part", F.spark_partition_id())
    return stage(made.select("part", "seq", "first_id", "n_docs", "n_ids", "doc_ids", "payload"), "token-shards")


def starts(shards: DataFrame) -> DataFrame:
    """(part, seq, start): ids before each shard. A row for each range is summed in one task, then the
    shards of a range by window."""
    ranges = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = ranges.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return shards.select("part", "seq", "n_ids").join(before, "part").select("part", "seq", (F.col("before") + inside).alias("start"))


def read(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids): each document decoded from its shard; ids are little-endian
    unsigned 32-bit integers in one binary value."""

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, names, raw in zip(*(column(b, c).to_pylist() for c in ("start", "doc_ids", "payload")), strict=True):
                ids, size = Shard(raw).documents()
                doc = np.frombuffer(names, "<i8")
                data, ends = ids.astype("<u4").tobytes(), np.cumsum(size)
                for i in range(0, len(doc), 1024):
                    z = ends[i : i + 1024]
                    a = z - size[i : i + 1024]
                    cols = [pa.array(doc[i : i + 1024], mask=doc[i : i + 1024] == -(2**63)), pa.array(start + a), pa.array(z - a), pa.array([data[4 * x : 4 * y] for x, y in zip(a.tolist(), z.tolist(), strict=True)], pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids"])

    return shards.join(starts(shards), ["part", "seq"]).select("start", "doc_ids", "payload").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def checksums(decoded: DataFrame) -> DataFrame:
    return decoded.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def crc(ids: Iterable[int]) -> int:
    return zlib.crc32(np.array(list(ids), "<u4").tobytes())
