"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Texts are cut into words (a run of spaces stays with the word after it; no piece crosses a word's
start). The distinct words of a batch are encoded together: their symbols lie in one flat array; each
round looks up the rank of every adjacent pair, takes each word's smallest rank (segmented minimum),
merges its leftmost pair of that rank in all words at once, and compacts, until no pair is left.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import column, gather, runs, text_bytes

SPACE = "▁"
#: Words of more symbols go through a heap each, as a round merges one pair of a word.
LONG_WORD = 400
#: Encoded words that a task keeps for its next batches; beyond it, it starts anew.
CACHE_WORDS = 100_000
#: Bytes of text that are encoded and decoded at once.
CHUNK = 1 << 18

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Codec:
    """Vocabulary and merge table of a BPE model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = m.get_piece_size()
        self.bos, self.eos, self.unk = m.bos_id(), m.eos_id(), m.unk_id()
        ids = range(self.size)
        pieces = [m.id_to_piece(i) for i in ids]
        special = np.array([m.is_control(i) or m.is_unknown(i) for i in ids])
        is_byte = np.array([m.is_byte(i) for i in ids])
        normal = {pieces[i]: i for i in ids if not special[i] and not is_byte[i]}
        self.chars = {p: i for p, i in normal.items() if len(p) == 1}
        extra = sorted({c for p in normal for c in p} - set(self.chars))  # parts of pieces, not pieces
        self.symbols = dict(self.chars) | {c: self.size + k for k, c in enumerate(extra)}
        self.extra = extra
        self.byte_ids = np.array([m.piece_to_id(f"<0x{k:02X}>") for k in range(256)], np.int64)
        self.bytes_known = all(is_byte[i] for i in self.byte_ids)
        # Pieces by falling score have rising ranks; equal scores share a rank (the leftmost wins).
        score = np.array([m.get_score(i) for i in ids])
        rank = np.unique(-score, return_inverse=True)[1]
        self.base = self.size + len(extra) + 1
        table = []
        for p, i in normal.items():
            for cut in range(1, len(p)):
                a, b = p[:cut], p[cut:]
                a = normal.get(a, self.symbols.get(a, -1) if len(a) == 1 else -1)
                b = normal.get(b, self.symbols.get(b, -1) if len(b) == 1 else -1)
                if a >= 0 and b >= 0:
                    table.append((a * self.base + b, rank[i], i))
        table.sort()
        self.pair = np.array([t[0] for t in table] + [1 << 62], np.int64)
        self.rank = np.array([t[1] for t in table] + [0], np.int64)
        self.made = np.array([t[2] for t in table] + [0], np.int64)
        inside = any(SPACE in p.lstrip(SPACE) for p in normal)
        newline = "\n" in self.symbols
        self.split = None if inside else re.compile(" *[^ ]+| +" if newline else "\n| *[^ \n]+| +")
        if SPACE in self.symbols:  # words keep plain blanks, which stay in narrow strings
            self.symbols[" "] = self.symbols[SPACE]
        raw = [bytes([k]) for k in range(256)]
        text = [b"" if special[i] else pieces[i].replace(SPACE, " ").encode() for i in ids]
        for k, i in enumerate(self.byte_ids):
            if is_byte[i]:
                text[i] = raw[k]
        some = next(iter(normal.values()))
        text[self.unk] = m.decode([some, self.unk])[len(m.decode([some])) :].encode()
        self.piece_len = np.array([len(t) for t in text], np.int64)
        self.piece_at = np.concatenate([[0], np.cumsum(self.piece_len)[:-1]])
        self.piece_bytes = np.frombuffer(b"".join(text), np.uint8)
        self.is_byte, self.special = is_byte, special
        self.starts_blank = np.array([p.startswith(SPACE) for p in pieces]) & ~special & ~is_byte
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.tokens, self.at, self.len = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        text = " " + text.replace(SPACE, " ")
        return [text] if self.split is None else self.split.findall(text)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index in the merge table, or -1."""
        key = left * self.base + right
        at = np.searchsorted(self.pair, key)
        return np.where((self.pair[at] == key) & (left >= 0) & (right >= 0), at, -1)

    def merge(self, sym: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merged symbols, their words, and the index of each one's first input symbol."""
        first = np.arange(len(sym))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        none = np.int64(1) << 40
        while len(sym):
            same = word[1:] == word[:-1]
            at = np.full(len(sym), -1, np.int64)
            at[:-1][same] = self._lookup(sym[:-1][same], sym[1:][same])
            rank = np.where(at >= 0, self.rank[at], none)
            start = np.flatnonzero(np.concatenate([[True], ~same]))
            size = np.diff(np.append(start, len(sym)))
            best = np.minimum.reduceat(rank, start)
            ended = np.repeat(best == none, size)
            if ended.any():
                done.append((sym[ended], word[ended], first[ended]))
                live = ~ended
                sym, word, first, at, rank = sym[live], word[live], first[live], at[live], rank[live]
                size, best = size[best != none], best[best != none]
                if not len(sym):
                    break
                start = np.cumsum(size) - size
            hit = np.flatnonzero(rank == np.repeat(best, size))
            left = hit[np.searchsorted(hit, start)]  # the leftmost of each word
            sym[left] = self.made[at[left]]
            keep = np.ones(len(sym), bool)
            keep[left + 1] = False
            sym, word, first = sym[keep], word[keep], first[keep]
        s, w, f = (np.concatenate(x) if done else np.zeros(0, np.int64) for x in (zip(*done, strict=True) if done else ([], [], [])))
        order = np.lexsort((f, w))
        return s[order], w[order], f[order]

    def merge_long(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long word, by a heap of (rank, position)."""
        n = len(sym)
        s, nxt, prv = sym.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def push(items: list[tuple[int, int]]) -> None:
            a = np.array([s[i] for i, _ in items], np.int64)
            b = np.array([s[j] for _, j in items], np.int64)
            for (i, j), t in zip(items, self._lookup(a, b).tolist(), strict=True):
                if t >= 0:
                    heapq.heappush(heap, (int(self.rank[t]), i, s[i] * self.base + s[j], t))

        push([(i, i + 1) for i in range(n - 1)])
        alive = [True] * n
        while heap:
            _, i, key, t = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or s[i] * self.base + s[j] != key:
                continue
            s[i], alive[j], nxt[i] = int(self.made[t]), False, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            push([(a, b) for a, b in ((prv[i], i), (i, nxt[i])) if a >= 0 and b < n])
        first = np.flatnonzero(alive)
        return np.array(s, np.int64)[first], first

    def learn(self, new: list[str]) -> None:
        """Encode words not seen yet and keep their ids."""
        text = "".join(new)
        size = np.array([len(w) for w in new], np.int64)
        chars = np.array([self.symbols.get(c, -1) for c in text], np.int64)
        word = np.repeat(np.arange(len(new)), size)
        begin = np.cumsum(size) - size
        long = np.flatnonzero(size > LONG_WORD)
        pick = ~np.isin(word, long) if len(long) else np.ones(len(chars), bool)
        where = np.flatnonzero(pick)
        s, w, f = self.merge(chars[pick], word[pick], len(new))
        f = where[f] if len(where) else f
        for k in long:
            ls, lf = self.merge_long(chars[begin[k] : begin[k] + size[k]])
            s, w, f = np.concatenate([s, ls]), np.concatenate([w, np.full(len(ls), k)]), np.concatenate([f, lf + begin[k]])
        if len(long):
            order = np.argsort(w, kind="stable")
            s, w, f = s[order], w[order], f[order]
        ids: list[np.ndarray] = []
        bad = np.flatnonzero((s < 0) | (s >= self.size))
        if len(bad):  # characters outside the vocabulary: their UTF-8 bytes
            raw = [np.frombuffer(text[f[i]].replace(" ", SPACE).encode(), np.uint8) for i in bad] if self.bytes_known else [np.zeros(0, np.uint8)] * len(bad)
            count = np.ones(len(s), np.int64)
            count[bad] = [max(1, len(r)) for r in raw]
            out = np.repeat(s, count)
            ends = np.cumsum(count)
            for i, r in zip(bad, raw, strict=True):
                out[ends[i] - count[i] : ends[i]] = self.byte_ids[r] if len(r) else self.unk
            s, w = out, np.repeat(w, count)
        per = np.bincount(w, minlength=len(new))
        ids.append(s.astype(np.int32))
        base = len(self.tokens)
        self.at = np.concatenate([self.at, base + np.cumsum(per) - per])
        self.len = np.concatenate([self.len, per])
        self.tokens = np.concatenate([self.tokens, *ids])
        n = len(self.known)
        self.known.update({x: n + i for i, x in enumerate(new)})

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the flat ids of all texts, with begin and end ids."""
        cut = [self.words(t) for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.clear()
        every = list(chain.from_iterable(cut))
        per = np.array([len(c) for c in cut], np.int64)
        word = np.fromiter(map(self.known.get, every, repeat(-1)), np.int64, len(every))
        new = np.flatnonzero(word < 0).tolist()
        if new:
            self.learn(sorted({every[i] for i in new}))
            word[new] = [self.known[every[i]] for i in new]
        size = self.len[word] if len(word) else np.zeros(0, np.int64)
        flat = self.tokens[gather(self.at[word], size)] if len(word) else np.zeros(0, np.int32)
        ends = np.concatenate([[0], np.cumsum(size)])
        row = np.concatenate([[0], np.cumsum(per)])
        offsets = ends[row] + 2 * np.arange(len(texts) + 1)
        out = np.empty(len(flat) + 2 * len(texts), np.int32)
        inner = np.ones(len(out), bool)
        inner[offsets[:-1]] = inner[offsets[1:] - 1] = False
        out[inner] = flat
        out[offsets[:-1]], out[offsets[1:] - 1] = self.bos, self.eos
        return out, offsets

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each run of ids. Control ids are left out, the blank that encoding puts before a
        text is taken off, and each byte of an invalid UTF-8 sequence becomes U+FFFD."""
        size = self.piece_len[ids]
        raw = self.piece_bytes[gather(self.piece_at[ids], size)]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = ends[offsets]
        shown = np.flatnonzero(~(self.special & (self.piece_len == 0))[ids])
        lead = np.searchsorted(shown, offsets[:-1])
        begins = np.array([i < len(shown) and shown[i] < e and self.starts_blank[ids[shown[i]]] for i, e in zip(lead, offsets[1:], strict=True)], bool)
        data = raw.tobytes()
        return [data[a + int(b) : z].decode("utf-8", "each_byte") for a, z, b in zip(at[:-1].tolist(), at[1:].tolist(), begins.tolist(), strict=True)]


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``keep``..., n_tokens, ids, decoded): ids are little-endian unsigned 32-bit integers in one
    binary value, with begin and end ids; ``decoded`` is the text that the ids stand for (null if not asked for).

    A null text is encoded as the empty text: begin and end id only. Rows are independent: repeated
    rows get equal results, an empty table an empty result. ``model_path`` must exist on each executor.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        names = ["doc_id", *keep, "n_tokens", "ids", "decoded"]
        for b in batches:
            texts = column(b, "text")
            for i, j in runs(text_bytes(texts)[0], CHUNK):
                part = [t or "" for t in texts.slice(i, j - i).to_pylist()]
                ids, offsets = c.encode(part)
                data = ids.astype("<u4").tobytes()
                back = c.decode(ids, offsets) if decode else [None] * len(part)
                cols = [column(b, x).slice(i, len(part)) for x in ("doc_id", *keep)]
                edge = (4 * offsets).tolist()
                cols += [pa.array(np.diff(offsets), pa.int64()), pa.array([data[a:z] for a, z in zip(edge[:-1], edge[1:], strict=True)], pa.binary()), pa.array(back, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "text" or "text" in keep)
    return src.mapInArrow(run, f"{fields}, n_tokens long, ids binary, decoded string")
