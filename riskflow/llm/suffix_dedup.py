"""Removal of repeated byte strings by a logarithmic family of suffix arrays.

Equal strings of ``LENGTH`` bytes must meet without every suffix being sent around. Each window of
LENGTH bytes has a key: the smallest hash of its inner SEED-byte strings. Neighbouring windows share
keys, so a text falls into segments (runs of windows with one key), and equal windows have equal keys.

1. Keys of all segments are counted by key range; keys in one document only are out.
2. Segments with the other keys are sent to their key range, equal ones of a batch once.
3. In a range, documents come in ascending order in batches. A batch's windows are sorted to a suffix
   array (by the fingerprint of their first LENGTH bytes, ties by document); it is scanned against the
   levels of the index for windows of smaller documents, whose bytes are then compared, and becomes a
   level itself. Levels of equal size merge, so that there are logarithmically many.
4. The covered bytes go back to the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import words as W
from riskflow.llm.common import gather, mixed, runs, text_bytes

LENGTH, SEED = 50, 16
#: Bytes of text in a batch of documents, keys in a key range, windows in an index batch.
BATCH_BYTES, RANGE_KEYS, INDEX_WINDOWS = 8 << 20, 400_000, 1 << 16
#: Windows of a key range that are indexed at once (more only if they share one key).
INDEX_MOST = 1 << 20
#: Bytes whose hashes are worked on at once.
CHUNK = 1 << 20
_NULL_ID = 2**63 - 1


def _words_at(data: np.ndarray) -> np.ndarray:
    """The 64-bit word that starts at each byte (no copy)."""
    return np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), 0, (1,))


def fingerprint(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of the LENGTH bytes from each start."""
    w = _words_at(data)
    h = np.zeros(len(starts), np.uint64)
    for o in (*range(0, LENGTH - 7, 8), LENGTH - 8):
        h ^= w[starts + o]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return mixed(h)


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        h = np.minimum(h[: len(h) - step], h[step:])
        done += step
    return h


def _window_keys(data: np.ndarray) -> np.ndarray:
    """The smallest hash of the SEED-byte strings in each window of LENGTH bytes."""
    w = _words_at(data)
    h = w[: len(w) - SEED + 8] * np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    h += w[SEED - 8 :]
    h *= np.uint64(0xE7037ED1A0B428DB)
    h ^= h >> np.uint64(29)
    return _smallest(h, LENGTH - SEED + 1)


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, first window, end window) of each segment; windows are numbered by their first byte."""
    none = np.zeros(0, np.int64)
    size = np.diff(offsets)
    if len(data) < LENGTH or size.max() < LENGTH:
        return np.zeros(0, np.uint64), none, none, none
    m = _window_keys(data)
    rows = np.flatnonzero(size >= LENGTH)
    begin, stop = offsets[rows], offsets[rows + 1] - LENGTH + 1
    cut = np.zeros(len(m) + 1, bool)
    cut[1 : len(m)] = m[1:] != m[:-1]
    cut[begin] = True
    inside = np.zeros(len(m) + 1, np.int8)
    inside[begin] += 1
    inside[stop] -= 1
    a = np.flatnonzero(cut[:-1] & (np.cumsum(inside[:-1], dtype=np.int8) > 0))
    row = rows[np.searchsorted(begin, a, side="right") - 1]
    end = np.minimum(np.append(a[1:], len(m)), stop[np.searchsorted(begin, a, side="right") - 1])
    return mixed(m[a].copy()), row, a, end


def _range_of(key: np.ndarray, ranges: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _rows(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(ids, offsets, bytes) of a batch of documents in the order of id, then text."""
    table = table.select(["doc_id", "text"]).combine_chunks().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    col = table.column("text").combine_chunks()
    col = pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) else col
    offsets, data = text_bytes(col)
    return table.column("doc_id").to_pylist(), offsets, data


def _cut(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, tuple]]:
    for i, j in runs(offsets, CHUNK):
        part = data[offsets[i] : offsets[j]]
        yield i, int(offsets[i]), part, segments(part, offsets[i : j + 1] - offsets[i])


def _batch_keys(ids: list[int], offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The batch's distinct keys, sorted, and whether two of its documents have them."""
    doc = np.array(ids, np.int64)
    found = [(key, doc[i + row]) for i, _, _, (key, row, _, _) in _cut(offsets, data)]
    key, own = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = np.argsort(key, kind="stable")
    key, own = key[order], own[order]
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    if not len(edge):
        return key, np.zeros(0, bool)
    return key[edge], np.maximum.reduceat(own, edge) != np.minimum.reduceat(own, edge)


def _table(cols: dict[str, tuple[list, pa.DataType]]) -> pa.Table:
    return pa.table({k: pa.array(v, t) for k, (v, t) in cols.items()})


def _by_range(part: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """(ranges that occur, their borders) of sorted range numbers; the last border is their count."""
    edge = np.searchsorted(part, np.arange(ranges + 1))
    found = np.flatnonzero(np.diff(edge))
    return found, np.append(edge[found], len(part))


def _blobs(data: np.ndarray, borders: np.ndarray) -> pa.Array | pa.ChunkedArray:
    """A binary value for each run of ``data`` between two neighbouring borders; the runs cover it."""
    at = borders * data.itemsize
    if at[-1] >= 2**31:
        return pa.array([data[a:z].tobytes() for a, z in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)], pa.binary())
    buffers = [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, buffers)


def _flat(table: pa.Table, name: str, kind: str = "u1") -> tuple[np.ndarray, np.ndarray]:
    """(borders, items) of the values of a binary column, one after the other."""
    parts = [text_bytes(c) for c in table.column(name).chunks if len(c)]
    width = np.dtype(kind).itemsize
    size = np.concatenate([np.zeros(0, np.int64), *(np.diff(o) for o, _ in parts)])
    data = parts[0][1] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint8), *(d for _, d in parts)])
    data = np.frombuffer(data, kind) if len(data) else np.zeros(0, kind)
    return np.concatenate([[0], np.cumsum(size)]) // width, data


def _packed(bits: np.ndarray, borders: np.ndarray) -> pa.Array | pa.ChunkedArray:
    """The bits between two neighbouring borders as a binary value of whole bytes."""
    n = np.diff(borders)
    at = np.concatenate([[0], np.cumsum(-(-n // 8))])
    wide = np.zeros(8 * int(at[-1]), bool)
    wide[gather(8 * at[:-1], n)] = bits
    return _blobs(np.packbits(wide), at)


def _unpacked(table: pa.Table, name: str, n: np.ndarray) -> np.ndarray:
    """The first ``n`` bits of each value of a binary column, one after the other."""
    at, data = _flat(table, name)
    return np.unpackbits(data)[gather(8 * at[:-1], n)].astype(bool)


def _zipped(data: np.ndarray, at: np.ndarray, size: np.ndarray, borders: np.ndarray) -> pa.Array | pa.ChunkedArray:
    """The ``size`` bytes from each of ``at``, a compressed value for those between two neighbouring borders: short
    pieces in the order of their hashes take two thirds of what Spark's own compression makes of them."""
    codec, view, values = pa.Codec("zstd", compression_level=1), memoryview(data), []
    for x, y in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        pieces = [view[p : p + s] for p, s in zip(at[x:y].tolist(), size[x:y].tolist(), strict=True)]
        values.append(codec.compress(b"".join(pieces), asbytes=True))
    return pa.array(values, pa.binary())


def _unzipped(table: pa.Table, name: str, n: np.ndarray) -> np.ndarray:
    """The bytes of all values of a compressed column, which have ``n`` bytes each."""
    codec = pa.Codec("zstd")
    at, data = _flat(table, name)
    view = memoryview(data)
    return np.frombuffer(b"".join([codec.decompress(view[a:z], m, asbytes=True) for a, z, m in zip(at[:-1].tolist(), at[1:].tolist(), n.tolist(), strict=True)]), np.uint8)


def shared_keys(table: pa.Table) -> pa.Table:
    """(batch, range, mask): which of each batch's keys of a range have another document. All batches' keys are
    sorted once: the work follows the keys, not the batches times the keys. 32 bits of a key suffice to find
    them, as a key that is let through by chance only costs a segment that matches nothing."""
    borders, key = _flat(table, "keys", "<u4")
    n = np.diff(borders)
    on = _unpacked(table, "many", n)
    order = np.argsort(key)
    key, owner = key[order], np.repeat(np.arange(len(n), dtype=np.int32), n)[order]
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    more = (np.minimum.reduceat(owner, edge) != np.maximum.reduceat(owner, edge)) | np.logical_or.reduceat(on[order], edge)
    on[order] = np.repeat(more, np.diff(np.append(edge, len(key))))
    return pa.table({"batch": table.column("batch"), "range": table.column("range"), "mask": _packed(on, borders)})


class Levels:
    """The index family: sorted fingerprints with the smallest document and a place of each."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def scan(self, fp: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(index in the sorted ``fp``, place in the index) of windows that a level has from a smaller document."""
        for keys, docs, places in self.levels:
            at = np.searchsorted(keys, fp)
            at[at == len(keys)] = 0
            hit = np.flatnonzero((keys[at] == fp) & (docs[at] < doc))
            if len(hit):
                yield hit, places[at[hit]]

    def add(self, fp: np.ndarray, doc: np.ndarray, place: np.ndarray) -> None:
        """Sorted windows as a new level; then equal-sized levels merge."""
        first = np.concatenate([[True], fp[1:] != fp[:-1]])
        new = fp[first], doc[first], place[first]
        while self.levels and len(self.levels[-1][0]) < 2 * len(new[0]):
            new = self._merge(self.levels.pop(), new)
        self.levels.append(new)

    @staticmethod
    def _merge(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        fp, doc, place = (np.concatenate(x) for x in zip(a, b, strict=True))
        order = np.argsort(fp, kind="stable")  # the older level, with smaller documents, first
        fp, doc, place = fp[order], doc[order], place[order]
        keep = np.concatenate([[True], fp[1:] != fp[:-1]])
        return fp[keep], doc[keep], place[keep]


def covered(data: np.ndarray, at: np.ndarray, size: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(segment, its windows that a smaller document has), for segments ``at``, ``size`` bytes in ``data``,
    in ascending order of ``doc``."""
    index, w = Levels(), _words_at(data) if len(data) > 7 else None
    windows = size - LENGTH + 1
    i = 0
    while i < len(at):
        total = np.cumsum(windows[i:])
        j = i + max(1, int(np.searchsorted(total, INDEX_WINDOWS)))
        n = windows[i:j]
        begin = np.cumsum(n) - n
        seg = np.repeat(np.arange(i, i + len(n)), n)
        start = np.arange(int(n.sum())) + np.repeat(at[i:j] - begin, n)
        fp, own = fingerprint(data, start), np.repeat(doc[i:j], n)
        order = np.lexsort((own, fp)) if (own[1:] < own[:-1]).any() else np.argsort(fp, kind="stable")
        sfp, sdoc, sstart = fp[order], own[order], start[order]
        group = np.maximum.accumulate(np.where(np.concatenate([[True], sfp[1:] != sfp[:-1]]), np.arange(len(sfp)), 0))
        inner = np.flatnonzero(sdoc[group] < sdoc)
        hits = np.zeros(len(start), bool)
        for hit, place in ((inner, sstart[group[inner]]), *index.scan(sfp, sdoc)):
            same = np.ones(len(hit), bool)
            for o in (*range(0, LENGTH - 7, 8), LENGTH - 8):
                same &= w[sstart[hit] + o] == w[place + o]
            hits[order[hit[same]]] = True
        index.add(sfp, sdoc, sstart)
        got = np.flatnonzero(hits)
        edge = np.flatnonzero(np.diff(seg[got], prepend=-1, append=-1)) if len(got) else got
        for a, z in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            s = int(seg[got[a]])
            yield s, start[got[a:z]] - at[s]
        i = j


def covered_by_keys(data: np.ndarray, at: np.ndarray, size: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``covered`` for segments in any order, each of one key, with an index for some of the keys at a time:
    equal windows have equal keys, so that none is missed. The index holds about INDEX_MOST windows, however
    many the segments have."""
    parts = -(-int((size - LENGTH + 1).sum()) // INDEX_MOST)
    part = np.zeros(len(at), np.int64)
    order = np.argsort(at, kind="stable") if parts > 1 else part[:0]
    ends = at[order] + size[order]
    i = 0
    while i < len(order):
        low = at[order[i]]
        j = max(i + 1, int(np.searchsorted(ends, low + CHUNK, side="right")))
        own = order[i:j]
        key = _window_keys(data[low : int(ends[i:j].max())])[at[own] - low]
        part[own] = (mixed(key) % np.uint64(parts)).astype(np.int64)
        i = j
    order = np.argsort(doc, kind="stable")
    for p in range(parts):
        own = order[part[order] == p]
        for s, windows in covered(data, at[own], size[own], doc[own]):
            yield int(own[s]), windows


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, batch_bytes: int = BATCH_BYTES, range_keys: int = RANGE_KEYS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept, spans]), a row for each row of ``docs``: what is
    left of each text when the bytes covered by a LENGTH-byte string go that also starts in a document
    with a smaller id. Strings are judged on the input; ``kept`` is binary, as a cut may split a character.

    Null texts count as empty; texts shorter than LENGTH lose nothing; rows of one id never remove from
    each other; rows with a null id come after all others and never remove from each other; an empty
    table gives no rows.
    """
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = src.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    batches = max(1, -(-total // batch_bytes))
    ranges = max(1, -(-total // (18 * range_keys)))
    dealt = src.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))

    def keys(table: pa.Table) -> pa.Table:
        ids, offsets, data = _rows(table)
        key, many = _batch_keys(ids, offsets, data)
        b = table.column("batch")[0].as_py()
        found, borders = _by_range(_range_of(key, ranges), ranges)
        if not len(found):
            return _table({"range": ([], pa.int32()), "batch": ([], pa.int32()), "keys": ([], pa.binary()), "many": ([], pa.binary())})
        return pa.table({
            "range": pa.array(found, pa.int32()),
            "batch": pa.array(np.full(len(found), b), pa.int32()),
            "keys": _blobs(key.astype("<u4"), borders),
            "many": _packed(many, borders),
        })

    def cut(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, tuple[list, pa.DataType]] = {"range": ([], pa.int32()), "batch": ([], pa.int32()), "size": ([], pa.binary()), "bytes": ([], pa.binary()), "first": ([], pa.binary()), "row": ([], pa.binary()), "doc": ([], pa.binary()), "at": ([], pa.binary())}
        if not left.num_rows or not right.num_rows:
            return _table(out)
        ids, offsets, data = _rows(left)
        every, _ = _batch_keys(ids, offsets, data)
        part = _range_of(every, ranges)
        on = np.zeros(len(every), bool)
        edge = np.searchsorted(part, np.arange(ranges + 1))
        r = right.column("range").to_numpy()
        n = edge[r + 1] - edge[r]
        on[gather(edge[r], n)] = _unpacked(right, "mask", n)
        live = every[on]
        if not len(live):
            return _table(out)
        found = []
        for i, base, chunk, (k, row, a, z) in _cut(offsets, data):
            at = np.searchsorted(live, k)
            at[at == len(live)] = 0
            pick = np.flatnonzero(live[at] == k)
            k, row, a, size = k[pick], row[pick], a[pick], z[pick] - a[pick] + LENGTH - 1
            up, down = W._pow(len(chunk) + 1)
            acc = np.zeros(len(chunk) + 1, np.uint64)
            np.cumsum((chunk.astype(np.uint64) + np.uint64(1)) * up[: len(chunk)], out=acc[1:])
            content = mixed((acc[a + size] - acc[a]) * down[a] + k) ^ size.astype(np.uint64)
            found.append((k, content, i + row, base + a, size))
        k, content, row, a, size = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((row, content, k))
        k, content, row, a, size = k[order], content[order], row[order], a[order], size[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (content[1:] != content[:-1])])
        doc = np.array(ids, np.int64)
        parts, borders = _by_range(_range_of(k, ranges), ranges)
        heads = np.flatnonzero(new)
        first = np.searchsorted(heads, borders)
        return pa.table({
            "range": pa.array(parts, pa.int32()),
            "batch": pa.array(np.full(len(parts), key[0].as_py()), pa.int32()),
            "size": _blobs(size[heads].astype("<i4"), first),
            "bytes": _zipped(data, a[heads], size[heads], first),
            "first": _packed(new, borders),
            "row": _blobs(row.astype("<i4"), borders),
            "doc": _blobs(doc[row].astype("<i8"), borders),
            "at": _blobs((a - offsets[row]).astype("<i4"), borders),
        })

    def match(table: pa.Table) -> pa.Table:
        segment, size = _flat(table, "size", "<i4")
        size = size.astype(np.int64)
        data = _unzipped(table, "bytes", np.add.reduceat(size, segment[:-1]))
        at = np.cumsum(size) - size
        borders, row = _flat(table, "row", "<i4")
        n = np.diff(borders)
        which = np.cumsum(_unpacked(table, "first", n)) - 1
        doc, pos = (_flat(table, c, kind)[1] for c, kind in (("doc", "<i8"), ("at", "<i4")))
        batch = np.repeat(table.column("batch").to_numpy().astype(np.int64), n)
        # Equal segments of several batches are one; its smallest document stands for it in the index.
        raw = memoryview(data)
        name = np.frombuffer(b"".join([hashlib.blake2b(raw[a : a + s], digest_size=8).digest() for a, s in zip(at.tolist(), size.tolist(), strict=True)]), np.uint64).copy()
        name ^= size.astype(np.uint64)
        uniq, first, back = np.unique(name, return_index=True, return_inverse=True)
        own = back[which]
        least = np.full(len(uniq), np.iinfo(np.int64).max)
        np.minimum.at(least, own, doc)
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        for s, wins in covered_by_keys(data, at[first], size[first], least):
            edge = np.flatnonzero(np.concatenate([[True], wins[1:] > wins[:-1] + LENGTH]))
            stop = np.append(edge[1:], len(wins)) - 1
            found.append((s, wins[edge], wins[stop] + LENGTH))
        found.sort(key=lambda f: f[0])
        some = np.zeros(len(uniq), np.int64)
        some[[s for s, _, _ in found]] = [len(x) for _, x, _ in found]
        begin, end = (np.concatenate([np.zeros(0, np.int64), *(f[c] for f in found)]) for c in (1, 2))
        later = np.flatnonzero(doc > least[own])
        least_of = np.flatnonzero((some[own] > 0) & (doc == least[own]))
        m = some[own[least_of]]
        part = gather((np.cumsum(some) - some)[own[least_of]], m)
        o = np.concatenate([later, np.repeat(least_of, m)])
        x = np.concatenate([np.zeros(len(later), np.int64), begin[part]])
        y = np.concatenate([size[first][own[later]], end[part]])
        order = np.argsort(batch[o], kind="stable")
        o, x, y = o[order], x[order], y[order]
        b = batch[o]
        edge = np.flatnonzero(np.diff(b, prepend=-1))
        if not len(edge):
            return _table({"batch": ([], pa.int32()), "spans": ([], pa.binary())})
        triples = np.column_stack([row[o], pos[o] + x, pos[o] + y]).astype("<i4")
        return pa.table({"batch": pa.array(b[edge], pa.int32()), "spans": _blobs(triples.ravel(), 3 * np.append(edge, len(b)))})

    def apply(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        ids, offsets, data = _rows(left)
        spans = _flat(right, "spans", "<i4")[1].reshape(-1, 3).astype(np.int64)
        depth = np.zeros(len(data) + 1, np.int32)
        np.add.at(depth, offsets[spans[:, 0]] + spans[:, 1], 1)
        np.add.at(depth, offsets[spans[:, 0]] + spans[:, 2], -1)
        gone = np.cumsum(depth, dtype=np.int32, out=depth)[:-1] > 0
        hit = set(np.unique(spans[:, 0]).tolist())
        out: dict[str, list] = {c: [] for c in ("n_removed", "n_spans", "kept_sha256", "kept", "spans")}
        for i, (a, z) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            text, cuts = data[a:z], []
            if i in hit:
                lost = gone[a:z]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], lost.view(np.int8), [0]])))
                cuts = list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
                text = text[~lost]
            raw = text.tobytes()
            out["n_removed"].append(z - a - len(raw))
            out["n_spans"].append(len(cuts))
            out["kept_sha256"].append(hashlib.sha256(raw).hexdigest())
            out["kept"].append(raw if with_text else None)
            out["spans"].append([{"start": x, "stop": y} for x, y in cuts] if with_text else None)
        kinds = {"n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept": pa.binary(), "spans": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))}
        names = [None if i == _NULL_ID else i for i in ids]
        return _table({"doc_id": (names, pa.int64()), "n_bytes": (np.diff(offsets).tolist(), pa.int64()), **{c: (v, kinds[c]) for c, v in out.items()}})

    counted = dealt.groupBy("batch").applyInArrow(keys, "range int, batch int, keys binary, many binary")
    masks = counted.groupBy("range").applyInArrow(shared_keys, "batch int, range int, mask binary")
    pieces = dealt.groupBy("batch").cogroup(masks.groupBy("batch")).applyInArrow(cut, "range int, batch int, size binary, bytes binary, first binary, row binary, doc binary, at binary")
    spans = pieces.groupBy("range").applyInArrow(match, "batch int, spans binary")
    done = dealt.groupBy("batch").cogroup(spans.groupBy("batch")).applyInArrow(apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<start:long,stop:long>>")
    return done if with_text else done.drop("kept", "spans")
