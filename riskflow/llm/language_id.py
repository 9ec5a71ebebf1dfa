"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's subwords are its byte n-grams (ASCII lower-cased, other ASCII than letters as a space). Each
is hashed to an embedding; their average goes through one linear layer. Training is stochastic
gradient descent in numpy over a bounded, hash-picked sample of labelled rows (``SAMPLE_PER_LANG``,
``SAMPLE_MAX``); a fifth of the sample is kept back to fit the softmax temperature and the rejection
threshold. As the average is linear, a prediction only sums one row of scores per n-gram.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.common import column, runs, text_bytes

#: Bound of the training sample: rows per language, and in all.
SAMPLE_PER_LANG, SAMPLE_MAX = 250, 4000
ORDERS = (2, 3, 4)
BUCKETS_LOG2 = 15
DIM = 16
EPOCHS = 6
#: No calibrated score at or above this is rejected.
REJECT_AT_MOST = 0.5
UNDETERMINED = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_MUL = {2: np.uint32(0x9E3779B1), 3: np.uint32(0x85EBCA6B), 4: np.uint32(0xC2B2AE35)}
_LETTER = re.compile(r"[^\W\d_]")


def ngrams(data: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each byte (the last n - 1 bytes have none)."""
    if len(data) < n:
        return np.zeros(0, np.uint32)
    code = data[: len(data) - n + 1].astype(np.uint32)
    for j in range(1, n):
        code <<= np.uint32(8)
        code |= data[j : len(data) - n + 1 + j]
    code ^= code >> np.uint32(15)
    code *= _MUL[n]
    return code >> np.uint32(32 - BUCKETS_LOG2)


def counts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = _FOLD[np.frombuffer(raw, np.uint8)]
    return np.unique(np.concatenate([ngrams(data, n) for n in ORDERS]), return_counts=True)


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # bucket x language: embedding times output layer
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean score of each row's n-grams; ``offsets`` are row borders in ``data`` (folded bytes)."""
        n = len(offsets) - 1
        total, size = np.zeros((n, len(self.langs)), np.float64), np.diff(offsets)
        weight = np.zeros(n)
        for k in ORDERS:
            h = ngrams(data, k)
            ok = np.flatnonzero(size >= k)
            if not len(ok):
                continue
            # Row r has the n-grams [start, end - k + 1); the gaps between are those over a border.
            cuts = np.column_stack([offsets[ok], offsets[ok + 1] - k + 1]).ravel()
            cuts = cuts[:-1] if cuts[-1] == len(h) else cuts
            total[ok] += np.add.reduceat(self.scores.take(h, axis=0), cuts, axis=0)[::2]
            weight[ok] += size[ok] - k + 1
        return total / np.maximum(weight, 1)[:, None] + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def sample(labelled: DataFrame) -> list[tuple[str, list[tuple[np.ndarray, np.ndarray]], int]]:
    """(lang, n-gram counts of the whole text and of short windows of it, fold) of a bounded sample,
    picked by a hash of the text, so that it does not depend on the order or the layout of the rows.
    Copies of a text count once, and each language has the same number of texts, or all that it has."""
    rows = labelled.filter("lang is not null and length(text) > 0").select("lang", "text", F.xxhash64("text").alias("pick"))
    sizes = rows.groupBy("lang").agg(F.countDistinct("pick").alias("count")).orderBy(F.desc("count"), "lang").limit(SAMPLE_MAX // 2).collect()
    if not sizes:
        return []
    each = min(SAMPLE_PER_LANG, SAMPLE_MAX // len(sizes))
    keep = F.lit(False)
    for r in sizes:
        # Eight standard deviations more than wanted, so that the cut below finds enough.
        share = min(1.0, (each + 8 * each**0.5 + 32) / r["count"])
        keep = keep | ((F.col("lang") == r["lang"]) & (F.col("pick") <= F.lit(min(2**63 - 1, int(share * 2**64) - 2**63))))

    def featurise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, text, pick in zip(*(column(b, c).to_pylist() for c in ("lang", "text", "pick")), strict=True):
                raw = text.encode()
                draw = np.random.default_rng(pick & (2**63 - 1))
                cut = [raw] + [raw[i : i + 120] for i in draw.integers(0, max(1, len(raw) - 120), 2)]
                got = [counts(x) for x in cut]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([pick], pa.int64()), pa.array([[g.astype(np.int32).tobytes() for g, _ in got]], pa.list_(pa.binary())), pa.array([[c.astype(np.int32).tobytes() for _, c in got]], pa.list_(pa.binary()))],
                    ["lang", "pick", "grams", "counts"],
                )

    nth = F.row_number().over(Window.partitionBy("lang").orderBy("pick"))
    picked = rows.filter(keep).dropDuplicates(["lang", "pick"]).withColumn("nth", nth).filter(F.col("nth") <= each).drop("nth")
    made = picked.mapInArrow(featurise, "lang string, pick long, grams array<binary>, counts array<binary>")
    got = made.orderBy("pick", "lang").collect()
    return [(r["lang"], [(np.frombuffer(g, np.int32), np.frombuffer(c, np.int32)) for g, c in zip(r["grams"], r["counts"], strict=True)], r["pick"] % 5) for r in got]


def train(rows: list[tuple[str, list[tuple[np.ndarray, np.ndarray]], int]], seed: int = 1) -> Model:
    langs = sorted({r[0] for r in rows})
    at = {x: i for i, x in enumerate(langs)}
    draw = np.random.default_rng(seed)
    emb = draw.normal(0, 0.1, (1 << BUCKETS_LOG2, DIM))
    out, bias = draw.normal(0, 0.1, (DIM, len(langs))), np.zeros(len(langs))
    short = len({r[2] for r in rows}) < 2 or len(rows) < 10
    fit = [(at[r[0]], g, c / c.sum()) for r in rows if short or r[2] for g, c in r[1] if len(g)]
    held = [(at[r[0]], g, c / c.sum()) for r in rows if short or not r[2] for g, c in r[1] if len(g)]
    steps = max(1, EPOCHS * len(fit))
    for epoch in range(EPOCHS):
        for k, i in enumerate(draw.permutation(len(fit))):
            lang, g, c = fit[i]
            rate = 2.0 * (1 - (epoch * len(fit) + k) / steps) + 0.01
            x = c @ emb[g]
            z = x @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[lang] -= 1
            back = out @ p
            out -= 0.5 * rate * np.outer(x, p)
            bias -= 0.05 * rate * p
            emb[g] -= rate * 20 * c[:, None] * back
    scores = emb @ out
    logits = np.array([c @ scores[g] + bias for _, g, c in held]).reshape(len(held), len(langs))
    truth = np.array([lang for lang, _, _ in held], np.int64)
    model = Model(langs, scores.astype(np.float32), bias, 1.0, 0.0)
    if len(held):
        loss = {}
        for t in np.geomspace(0.05, 20, 60):
            model.temperature = float(t)
            p = model.probabilities(logits)
            loss[float(t)] = -np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean()
        model.temperature = min(loss, key=loss.get)
        p = model.probabilities(logits)
        right = p[np.arange(len(truth)), truth][p.argmax(axis=1) == truth]
        # Reject below the score that all but one in a thousand of the correct held-back cases reach.
        model.threshold = float(min(REJECT_AT_MOST, np.quantile(right, 0.001))) if len(right) else 0.0
    return model


def fit(labelled: DataFrame) -> Model | None:
    """A model from the columns text and lang, or None if no row has a language and a text."""
    rows = sample(labelled)
    return train(rows) if rows else None


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), prefix: str = "") -> DataFrame:
    """(doc_id, ``keep``..., lang_pred, score, rejected), a row for each row of ``docs``; ``prefix`` goes
    before the last three names, where ``keep`` has columns of these names.

    A null or empty text, or one without a letter, has the language ``und``, score 0 and is rejected;
    so is every text if nothing could be learned. Other texts get the likeliest language, and are
    rejected if its calibrated probability is below the model's threshold. Whole texts are read.
    """
    text = "__text"
    while text.lower() in {c.lower() for c in keep}:
        text += "_"
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias(text), *keep)
    out = T.StructType([src.schema["doc_id"], *(src.schema[c] for c in keep), T.StructField(f"{prefix}lang_pred", T.StringType()), T.StructField(f"{prefix}score", T.DoubleType()), T.StructField(f"{prefix}rejected", T.BooleanType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = column(b, text)
            offsets, data = text_bytes(col)
            known = np.array([x.is_valid and _LETTER.search(x.as_py()) is not None for x in col], bool)
            lang, score = np.full(len(col), UNDETERMINED, object), np.zeros(len(col))
            if model is not None:
                for i, j in runs(offsets, 1 << 18):
                    folded = _FOLD[data[offsets[i] : offsets[j]]]
                    p = model.probabilities(model.logits(folded, offsets[i : j + 1] - offsets[i]))
                    lang[i:j], score[i:j] = np.array(model.langs, object)[p.argmax(axis=1)], p.max(axis=1)
                lang[~known], score[~known] = UNDETERMINED, 0.0
            lost = ~known | (score < (model.threshold if model is not None else 1.0))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), *(column(b, c) for c in keep), pa.array(lang, pa.string()), pa.array(score), pa.array(lost)], out.names)

    return src.mapInArrow(run, out)
