"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's embedding is the mean of the hashed embeddings of itself, its first three, four and five bytes and
its last three. Filters of several widths run over the whole text; each filter's largest responses (k-max
pooling: one odd word is no evidence yet) go through a rectifier and one linear layer. Training is Adagrad in numpy
over all labelled rows, in shards that are trained on side by side and averaged after each epoch; the first embedding
dimension starts from the words' log-odds in all these rows. A fifth of them is kept back to calibrate the scores: one
logistic curve for each language, where enough of its rows are kept back, so that 0.5 is each language's own threshold.
The language is predicted from the text.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm import language_id
from riskflow.llm.byte_words import LOWER, WordHash, tokens
from riskflow.llm.common import column, gather, runs, stage, text_bytes

#: Bytes of labelled texts that are trained on one after another.
SHARD_BYTES = 8 << 20
BUCKETS_LOG2, DIM = 16, 16
WIDTHS, FILTERS, LARGEST = (1, 2, 3), 12, 3
EPOCHS = 3
#: Power of the likelihood of a row's label that scales its gradient, and rows added to each count of the log-odds.
TRUST, SMOOTHING = 0.7, 4
#: Rows of each label that a language needs among those kept back for a curve of its own.
CALIBRATION_ROWS = 10
#: Words scored at once.
BLOCK = 1 << 16
#: Rows of responses whose largest are found together, a power of two.
STRIDE = 32
#: Parts in which the shards' values are added up, binary digits that these keep, and steps of a score for the curves.
PARTS, FRACTION, STEPS = 64, 32, 64
_HASH_SEED = 12
_KINDS = 5


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hasher: WordHash) -> np.ndarray:
    """Embedding rows (words x 5) of words in lower-cased bytes."""
    spans = [(starts, ends), *((starts, np.minimum(starts + k, ends)) for k in (3, 4, 5)), (np.maximum(ends - 3, starts), ends)]
    # One byte array for all words, hashed in one go; the kind of a feature is part of its hash.
    size = ends - starts
    raw = data[gather(starts, size)]
    shift = np.cumsum(size) - size - starts
    out = [hasher(raw, a + shift, b + shift) * np.uint64(2 * k + 1) + np.uint64(k) for k, (a, b) in enumerate(spans)]
    return (np.stack(out, axis=1) >> np.uint64(64 - BUCKETS_LOG2)).astype(np.uint16)


def _batch_words(data: np.ndarray, offsets: np.ndarray, hasher: WordHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-cased texts: the text of each word, which distinct word it is, and their features."""
    starts, ends, doc, ids = tokens(data, offsets, hasher)
    _, first, which = np.unique(ids, return_index=True, return_inverse=True)
    feats = [word_features(data, starts[first[i : i + BLOCK]], ends[first[i : i + BLOCK]], hasher) for i in range(0, len(first), BLOCK)]
    return doc, which, np.concatenate(feats) if feats else np.zeros((0, _KINDS), np.uint16)


def _merged(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    """The ``LARGEST`` largest of two falling lists, element by element."""
    out = []
    for k in range(min(LARGEST, len(a) + len(b))):
        found = [v[k] for v in (a, b) if k < len(v)]
        found += [np.minimum(a[i], b[k - 1 - i]) for i in range(k) if i < len(a) and k - 1 - i < len(b)]
        out.append(functools.reduce(np.maximum, found))
    return out


def _top(r: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The ``LARGEST`` largest values of each column in each run of rows, equal ones as often as they occur."""
    size = np.diff(np.append(first, len(r)))
    whole = size // STRIDE
    if whole.any():
        # Of each full stride of rows only the largest values go on.
        run, nth = np.repeat(np.arange(len(first)), whole), np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
        best = [r[((first[run] + nth * STRIDE)[:, None] + np.arange(STRIDE)).ravel()].reshape(len(run), STRIDE, -1)]
        while best[0].shape[1] > 1:
            half = best[0].shape[1] // 2
            best = _merged([v[:, :half] for v in best], [v[:, half:] for v in best])
        rest = size - whole * STRIDE
        of = np.concatenate([np.tile(run, len(best)), np.repeat(np.arange(len(first)), rest)])
        order = np.argsort(of, kind="stable")
        r = np.concatenate([*(v[:, 0] for v in best), r[gather(first + whole * STRIDE, rest)]])[order]
        size = np.bincount(of, minlength=len(first))
        first = np.cumsum(size) - size
    out = np.full((LARGEST, len(first), r.shape[1]), -np.inf, np.float32)
    filled = np.zeros((len(first), r.shape[1]), np.int64)
    for _ in range(LARGEST):
        m = np.maximum.reduceat(r, first, axis=0)
        equal = r == np.repeat(m, size, axis=0)
        n = np.add.reduceat(equal, first, axis=0, dtype=np.int64)
        for k in range(LARGEST):
            out[k] = np.where((filled <= k) & (k < filled + n), m, out[k])
        filled += n
        r = np.where(equal, -np.inf, r)
    return out


def _placed(filters: list[np.ndarray]) -> np.ndarray:
    """place x DIM x all filters: a filter's weights for the word at each place, 0 past its width."""
    out = np.zeros((max(WIDTHS), DIM, len(filters) * FILTERS))
    for k, f in enumerate(filters):
        out[: len(f), :, k * FILTERS : (k + 1) * FILTERS] = f
    return out


@dataclass
class Model:
    emb: np.ndarray
    filters: list[np.ndarray]  # one array (width x DIM x FILTERS) for each width
    bias: np.ndarray  # by rank of the response, then filter
    out: np.ndarray
    out_bias: float
    languages: language_id.Model | None
    common: tuple[float, float] = (1.0, 0.0)
    curves: dict[str, tuple[float, float]] = field(default_factory=dict)

    def largest(self, doc: np.ndarray, which: np.ndarray, feats: np.ndarray, n: int) -> np.ndarray:
        """The ``LARGEST`` largest responses of each filter in each of ``n`` texts, falling; past a text's end there
        are zero vectors, and a response that a short text does not have is 0."""
        made, most = len(self.filters) * FILTERS, max(WIDTHS) - 1
        # What a word adds to the responses that start at it, one word before it, and so on; 0 where a filter is narrower.
        flat = _placed(self.filters).astype(np.float32)
        each = [np.zeros((len(feats), made), np.float32) for _ in flat]
        for i in range(0, len(feats), BLOCK):
            emb = sum(self.emb.take(feats[i : i + BLOCK, k], axis=0) for k in range(_KINDS)) / np.float32(_KINDS)
            for k, f in enumerate(flat):
                each[k][i : i + BLOCK] = emb @ f
        best = np.full((LARGEST, n, made), -np.inf, np.float32)
        for i in range(0, len(which), BLOCK):
            j = min(len(which), i + BLOCK)
            at, own = which[i : j + most], doc[i : j + most]
            r = each[0].take(at[: j - i], axis=0)
            for k in range(1, most + 1):
                m = min(j - i, len(own) - k)
                other = np.flatnonzero(own[k : k + m] != own[:m])
                kept = r[other]
                r[:m] += each[k].take(at[k : k + m], axis=0)
                r[other] = kept
            first = np.flatnonzero(np.diff(own[: j - i], prepend=-1))
            rows = own[first]
            top = _top(r, first)
            best[:, rows[1:]] = top[:, 1:]  # only the first text of a block may go on from the block before
            best[:, rows[0]] = -np.sort(-np.concatenate([best[:, rows[0]], top[:, 0]]), axis=0)[:LARGEST]
        best[np.isinf(best)] = 0
        return best.transpose(1, 0, 2).reshape(n, -1)

    def raw(self, doc: np.ndarray, which: np.ndarray, feats: np.ndarray, n: int) -> np.ndarray:
        return np.maximum(self.largest(doc, which, feats, n) + self.bias, 0) @ self.out + self.out_bias

    def scores(self, raw: np.ndarray, langs: np.ndarray) -> np.ndarray:
        curve = np.array([self.curves.get(x, self.common) for x in langs], float).reshape(-1, 2)
        return 1 / (1 + np.exp(-np.clip(raw * curve[:, 0] + curve[:, 1], -60, 60)))


def _languages(model: language_id.Model | None, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.full(len(offsets) - 1, "", object)
    if model is not None:
        for i, j in runs(offsets, 1 << 18):
            folded = language_id._FOLD[data[offsets[i] : offsets[j]]]
            out[i:j] = np.array(model.langs, object)[model.logits(folded, offsets[i : j + 1] - offsets[i]).argmax(axis=1)]
    return out


@dataclass
class Shard:
    """Labelled texts that one task trains on at a time: which distinct word each word is, and their features."""

    number: int
    label: np.ndarray
    fold: np.ndarray
    lang: np.ndarray
    cuts: np.ndarray
    which: np.ndarray
    feats: np.ndarray

    def words(self, i: int) -> np.ndarray:
        return self.feats.take(self.which[self.cuts[i] : self.cuts[i + 1]], axis=0)

    def fit(self, short: bool) -> np.ndarray:
        """Rows to train on; a fifth is kept back for the curves, unless there are too few in all."""
        return np.flatnonzero((self.fold != 0) | short)

    def held(self, short: bool) -> np.ndarray:
        return np.flatnonzero((self.fold == 0) | short)


_SHARD = "shard int, label binary, fold binary, lang array<string>, cuts binary, which binary, feats binary, clean long, toxic long, held_clean long, held_toxic long"


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[Shard]:
    for b in batches:
        for r in b.to_pylist():
            ints = [np.frombuffer(r[c], kind) for c, kind in (("label", np.int8), ("fold", np.int8))]
            yield Shard(r["shard"], *ints, np.array(r["lang"], object), np.frombuffer(r["cuts"], np.int64), np.frombuffer(r["which"], np.int32), np.frombuffer(r["feats"], np.uint16).reshape(-1, _KINDS))


def labelled(docs: DataFrame, labels: DataFrame, languages: language_id.Model | None, short: bool = False) -> DataFrame:
    """All labelled texts that have words, whole, in shards of about ``SHARD_BYTES``, dealt by a hash of the id; copies of
    a text count once for each label. Only rows that the curves are fitted on, all if ``short``, have a language."""
    marked = labels.filter("toxic in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("label")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("own"), F.xxhash64("text").alias("pick"), "text").filter("own is not null and length(text) > 0")
    chosen = texts.select("own", "pick", F.octet_length("text").alias("size")).join(marked, F.col("own") == F.col("__id"))
    chosen = stage(chosen.groupBy("label", "pick").agg(F.min("own").alias("own"), F.max("size").alias("size")), "chosen")
    size = chosen.agg(F.sum("size")).first()[0] or 0
    shard = F.pmod(F.xxhash64("own"), F.lit(size // SHARD_BYTES + 1)).cast("int").alias("shard")

    def pack(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.select(["own", "pick"]).to_pandas().drop_duplicates().reset_index(names="at")
        rows = right.to_pandas().merge(rows, on=["own", "pick"]).sort_values(["pick", "label"])
        found: dict[str, list] = {c.split()[0]: [] for c in _SHARD.split(", ")}
        if len(rows):
            texts = left["text"].take(pa.array(rows["at"].to_numpy())).combine_chunks()
            texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
            offsets, data = text_bytes(texts)
            fold = (rows["pick"].to_numpy() % 5).astype(np.int8)
            judged = np.flatnonzero((fold == 0) | short)
            langs, (cut, part) = np.full(len(rows), "", object), text_bytes(texts.take(pa.array(judged)))
            langs[judged] = _languages(languages, part, cut)
            doc, which, feats = _batch_words(LOWER[data], offsets, WordHash(_HASH_SEED))
            cuts = np.searchsorted(doc, np.arange(len(offsets)))
            has = np.flatnonzero(np.diff(cuts))  # texts without words take no place in ``which``
            label, fold = rows["label"].to_numpy(np.int8)[has], fold[has]
            counts = [int(((label == k) & ((fold == 0) == held)).sum()) for held in (False, True) for k in (0, 1)]
            row = [int(right["shard"][0].as_py()), label.tobytes(), fold.tobytes(), langs[has].tolist(), np.append(cuts[has], len(which)).astype(np.int64).tobytes(), which.astype(np.int32).tobytes(), feats.tobytes(), *counts]
            found = {c: [v] for c, v in zip(found, row, strict=True)}
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
        return pa.table([pa.array(v, k) for v, k in zip(found.values(), kinds, strict=True)], names=list(found))

    return texts.select(shard, "own", "pick", "text").groupBy("shard").cogroup(chosen.select(shard, "own", "pick", "label").groupBy("shard")).applyInArrow(pack, _SHARD)


def total(shards: DataFrame, each: Callable[[Shard], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``size`` long values over all shards: added up in each task, then by parts; integers, so that the sum
    does not depend on how the shards lie."""
    edges = np.linspace(0, size, PARTS + 1).astype(np.int64)

    def packed(v: np.ndarray) -> bytes:
        return pa.Codec("zstd", 1).compress(np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8).T), asbytes=True)

    def unpacked(part: int, raw: bytes) -> np.ndarray:
        n = int(edges[part + 1] - edges[part])
        return np.ascontiguousarray(np.frombuffer(pa.Codec("zstd").decompress(raw, 8 * n, asbytes=True), np.uint8).reshape(8, n).T).reshape(-1).view(np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size, np.int64)
        for x in _shards(batches):
            own += each(x)
        if own.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([packed(own[a:z]) for a, z in zip(edges[:-1], edges[1:], strict=True)], pa.binary())], ["part", "data"])

    def add(rows: pa.Table) -> pa.Table:
        part = rows["part"][0].as_py()
        own = sum(unpacked(part, x.as_py()) for x in rows["data"])
        return pa.table([pa.array([part], pa.int32()), pa.array([packed(own)], pa.binary())], ["part", "data"])

    kind = "part int, data binary"
    out = np.zeros(size, np.int64)
    for r in shards.mapInArrow(run, kind).groupBy("part").applyInArrow(add, kind).collect():
        out[edges[r["part"]] : edges[r["part"] + 1]] = unpacked(r["part"], r["data"])
    return out


def _curve(raw: np.ndarray, label: np.ndarray, count: np.ndarray, prior: tuple[float, float] | None = None) -> tuple[float, float]:
    """Slope and shift of the logistic curve of least log loss over ``count`` rows of each score and label, both labels
    weighing the same; a prior curve counts as a few rows more."""
    weight = count * np.where(label == 1, 0.5 / max(count[label == 1].sum(), 1), 0.5 / max(count[label == 0].sum(), 1))
    order = np.argsort(raw, kind="stable")
    below = np.cumsum(count[order])
    centres = np.unique(raw[order][np.searchsorted(below, np.linspace(0, 1, 101) * below[-1]).clip(0, len(raw) - 1)])
    centres = np.concatenate([centres, (centres[1:] + centres[:-1]) / 2, [0.0] if prior is None else [-prior[1] / prior[0]]])
    best = (np.inf, 1.0, 0.0)
    for slope in np.geomspace(0.1, 10, 41):
        z = np.clip(slope * (raw[:, None] - centres), -60, 60)
        loss = weight @ np.logaddexp(0, np.where(label[:, None] == 1, -z, z))
        loss += 0.01 * np.log(slope / (prior[0] if prior else 1.0)) ** 2
        if prior is not None:
            loss += 0.01 * (centres + prior[1] / prior[0]) ** 2
        k = int(loss.argmin())
        best = min(best, (float(loss[k]), float(slope), float(-slope * centres[k])))
    return best[1], best[2]


def start(shards: DataFrame, per: np.ndarray, short: bool, seed: int = 1) -> dict[str, np.ndarray]:
    """Parameters before the first epoch; ``per`` are the rows of each label that are trained on."""

    def seen(x: Shard) -> np.ndarray:
        out = np.zeros((2, 1 << BUCKETS_LOG2), np.int64)
        for i in x.fit(short):
            out[x.label[i], np.unique(x.words(i))] += 1
        return out.ravel()

    draw = np.random.default_rng(seed)
    found = total(shards, seen, 2 << BUCKETS_LOG2).reshape(2, -1)
    share = per[1] / per.sum()
    emb = draw.normal(0, 0.1, (1 << BUCKETS_LOG2, DIM))
    emb[:, 0] = np.log(found[1] + SMOOTHING * share) - np.log(found[0] + SMOOTHING * (1 - share)) - np.log(share / (1 - share))
    filters = [draw.normal(0, 0.1, (w, DIM, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[:, 0, : FILTERS // 2] += 1 / len(f)
    made = len(WIDTHS) * FILTERS
    out = draw.normal(0, 0.05, LARGEST * made)
    out.reshape(-1, FILTERS)[:, : FILTERS // 2] += 0.1
    return {"emb": emb.astype(np.float32), "bias": np.zeros(LARGEST * made), "out": out, "shift": np.array([-1.0])} | {f"f{k}": f for k, f in enumerate(filters)}


def epoch(shard: Shard, params: dict[str, np.ndarray], memory: dict[str, np.ndarray], weight: np.ndarray, rate: float, short: bool, draw: np.random.Generator) -> None:
    """Adagrad over the shard's rows, one at a time, in place."""
    emb, bias, out = params["emb"], params["bias"], params["out"]
    made, wide = len(WIDTHS) * FILTERS, max(WIDTHS)
    # The first filter that reaches to each place; filters and their memory as one array, 0 past a filter's width.
    reach = [FILTERS * sum(w <= j for w in WIDTHS) for j in range(wide)]
    placed, past = (_placed([d[f"f{k}"] for k in range(len(WIDTHS))]) for d in (params, memory))
    past[past == 0] = 1
    every = np.arange(made)
    for i in draw.permutation(shard.fit(short)):
        truth, feats = int(shard.label[i]), shard.words(i)
        n = len(feats)
        x = np.zeros((n + wide - 1, DIM), np.float32)
        for k in range(_KINDS):
            x[:n] += emb.take(feats[:, k], axis=0)
        x /= _KINDS
        flat = placed.reshape(wide * DIM, made).astype(np.float32)
        r = flat.T @ np.concatenate([x[j : n + j] for j in range(wide)], axis=1).T
        top = min(LARGEST, n)
        best, place = np.zeros((LARGEST, made)), np.zeros((LARGEST, made), np.int64)
        for k in range(top):
            place[k] = r.argmax(axis=1)
            best[k] = r[every, place[k]]
            r[every, place[k]] = -np.inf
        hidden = np.maximum(best.ravel() + bias, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ out + params["shift"][0], -30, 30)))
        # A text that the model finds unlike its label moves it less: labels may be wrong.
        g = (p - truth) * weight[truth] * (p if truth else 1 - p) ** TRUST
        back = g * out * (hidden > 0)
        spread = back.reshape(LARGEST, made)[:top]
        steep = np.zeros(placed.shape)
        rows_at, rows_g = [], []
        for j, f in enumerate(reach):
            b, spots = spread[:, f:], place[:top, f:] + j
            steep[j, :, f:] = (x.take(spots, axis=0) * b[:, :, None]).sum(axis=0).T
            ok = (spots < n) & (b != 0)
            rows_at.append(feats.take(spots[ok], axis=0))
            rows_g.append(placed[j].T.take(f + np.nonzero(ok)[1], axis=0) * b[ok][:, None] / _KINDS)
        for now, was, grad in ((placed, past, steep), (out, memory["out"], g * hidden), (bias, memory["bias"], back)):
            was += grad**2
            now -= rate * grad / np.sqrt(was)
        params["shift"] -= rate * g
        # The same for each feature of a word.
        at, grad = np.concatenate(rows_at).ravel(), np.concatenate(rows_g)
        if len(at):
            order = np.argsort(at, kind="stable")
            own = at.take(order)
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            own, moved = own[first], np.add.reduceat(grad.take(order // _KINDS, axis=0), first, axis=0)
            power = memory["emb"].take(own, axis=0) + moved**2
            memory["emb"][own] = power
            emb[own] = emb.take(own, axis=0) - rate * moved / np.sqrt(power)
    for k, w in enumerate(WIDTHS):
        for d, v in ((params, placed), (memory, past)):
            d[f"f{k}"][:] = v[:w, :, k * FILTERS : (k + 1) * FILTERS]


def train(shards: DataFrame, per: np.ndarray, languages: language_id.Model | None, short: bool, seed: int = 1) -> Model:
    """Epochs over all shards: each shard goes on by itself from the same parameters, and what they change is averaged, an
    embedding over the shards that change it; then the curves, from the scores of all rows kept back."""
    params = start(shards, per, short, seed)
    memory = {k: np.full(v.shape, 1e-2, v.dtype) for k, v in params.items()}
    names, shapes = list(params), [v.shape for v in params.values()]
    sizes = [v.size for v in params.values()]
    weight = per.sum() / np.maximum(2 * per, 1)
    for nth in range(EPOCHS):

        def changes(x: Shard, nth: int = nth, params: dict = params, memory: dict = memory) -> np.ndarray:
            p, m = ({k: v.copy() for k, v in d.items()} for d in (params, memory))
            epoch(x, p, m, weight, 0.05 / (1 + nth), short, np.random.default_rng([seed, nth, x.number]))
            changed = [np.concatenate([(d[k] - before[k]).ravel() for k in names]) for d, before in ((p, params), (m, memory))]
            touched = (m["emb"] != memory["emb"]).any(axis=1)
            return np.concatenate([*(np.rint(v * 2.0**FRACTION).astype(np.int64) for v in changed), touched.astype(np.int64), [1]])

        got = total(shards, changes, 2 * sum(sizes) + (1 << BUCKETS_LOG2) + 1)
        touched, n = got[2 * sum(sizes) : -1], got[-1]
        moved = [np.split(v / 2.0**FRACTION, np.cumsum(sizes)[:-1]) for v in (got[: sum(sizes)], got[sum(sizes) : 2 * sum(sizes)])]
        by = {k: np.maximum(touched, 1)[:, None] if k == "emb" else n for k in names}
        params, memory = ({k: (d[k] + v.reshape(s) / by[k]).astype(d[k].dtype) for k, v, s in zip(names, change, shapes, strict=True)} for d, change in zip((params, memory), moved, strict=True))
    model = Model(params["emb"], [params[f"f{k}"] for k in range(len(WIDTHS))], params["bias"], params["out"], float(params["shift"][0]), languages)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _shards(batches):
            rows = x.held(short)
            n = x.cuts[rows + 1] - x.cuts[rows]
            raw = model.raw(np.repeat(np.arange(len(rows)), n), x.which[gather(x.cuts[rows], n)], x.feats, len(rows)) if len(rows) else np.zeros(0)
            step = np.rint(np.clip(raw, -60, 60) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(x.lang[rows], pa.string()), pa.array(x.label[rows].astype(np.int32)), pa.array(step)], ["lang", "label", "step"])

    # At most a row for each language, label and step.
    held = shards.mapInArrow(scored, "lang string, label int, step int").groupBy("lang", "label", "step").count().orderBy("lang", "label", "step").collect()
    raw, label, count, langs = np.array([r["step"] / STEPS for r in held]), np.array([r["label"] for r in held]), np.array([r["count"] for r in held], float), np.array([r["lang"] for r in held], object)
    model.common = _curve(raw, label, count)
    clean = count * (label == 0)
    for lang in sorted(set(langs)):
        own = langs == lang
        n = clean[own].sum()
        if min(n, count[own & (label == 1)].sum()) >= CALIBRATION_ROWS:
            model.curves[lang] = _curve(raw[own], label[own], count[own], model.common)
        elif n:  # the common curve, moved by how far the language's texts with label 0 lie from all such texts
            gap = (raw[own] @ clean[own] / n - raw @ clean / clean.sum()) * n / (n + CALIBRATION_ROWS)
            model.curves[lang] = (model.common[0], model.common[1] - model.common[0] * gap)
    return model


def fit(docs: DataFrame, labels: DataFrame) -> Model | float | None:
    """A model from ``docs`` (doc_id, text, lang) and ``labels`` (doc_id, toxic); the one label that there is, or None.
    All labelled texts are learned from, whole."""
    languages = language_id.fit(docs)
    shards = stage(labelled(docs, labels, languages), "shards")
    kinds = ("clean", "toxic", "held_clean", "held_toxic")
    n = np.array([int(x or 0) for x in shards.agg(*(F.sum(c) for c in kinds)).first()])
    every = n[:2] + n[2:]
    if not every.all():
        return float(every.argmax()) if every.any() else None
    short = bool(every.sum() < 50 or not n.all())
    if short:
        shards = stage(labelled(docs, labels, languages, short), "shards")
    return train(shards, every if short else n[:2], languages, short)


def predict(docs: DataFrame, model: Model | float | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``keep``..., score, predicted), a row for each row of ``docs``, repeated ones too.

    The text alone decides: whole texts are read, null ones as empty. A text without words has the score that the
    calibrated model gives to no response at all. With one label only to learn from every text gets it (0.0 or 1.0); with
    none every score is 0. Predicted is 1 from a score of 0.5 on.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"), *keep)
    out = T.StructType([src.schema["doc_id"], *(src.schema[c] for c in keep), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHash(_HASH_SEED)
        for b in batches:
            offsets, data = text_bytes(column(b, "__text"))
            n = len(offsets) - 1
            score = np.full(n, model if isinstance(model, float) else 0.0)
            if isinstance(model, Model):
                words = _batch_words(LOWER[data], offsets, hasher)
                langs = _languages(model.languages, data, offsets)
                langs[np.bincount(words[0], minlength=n) == 0] = ""  # no words, no language: the common curve
                score = model.scores(model.raw(*words, n), langs)
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), *(column(b, c) for c in keep), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], out.names)

    return src.mapInArrow(run, out)
