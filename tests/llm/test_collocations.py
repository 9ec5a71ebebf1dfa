"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from riskflow.llm import byte_words
from riskflow.llm import collocations as co

from .conftest import LONG


def _plain(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in cands.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * counts[q]}
        scored = []
        for p, a in cands.items():
            if p not in gone:
                s, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def _rows(seed=1):
    rnd = random.Random(seed)
    vocab = ["the", "of", "New", "york", "é", "日本語", "x1", "A-b", "Iİ", "naïve", "o", "p"]
    rows = [(None, None), ("en", ""), (None, " \t\n.;"), ("xx", LONG), ("fr", "one"), ("und", "new york new york"), ("", "a b c " * 30)]
    for _ in range(300):
        lang = rnd.choice(["en", "en", "en", "fr", None])
        text = "".join(rnd.choice(vocab) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\r\n", "!"]) for _ in range(rnd.randrange(80)))
        rows.append((lang, text + " New York city" * rnd.randrange(3)))
    return rows + rows[-3:]


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, g, 1, "n") for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, word string")


def _got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_equal_to_plain_counting(spark):
    rows = _rows()
    for least, top in ((2, 40), (10, 2000)):
        assert _got(co.collocations(_frame(spark, rows).repartition(3), least, top)) == _plain(rows, least, top)


def test_equal_with_small_tries_and_frequent_words(spark, monkeypatch):
    """Bursts, spills, several prefix partitions, and words frequent enough to be split by the next word."""
    rows = _rows(2)
    for name, value in (("MEMORY", 300), ("BURST", 16), ("PARTITION_WORDS", 500), ("HOT_LEAST", 40), ("HOT_MAX", 20)):
        monkeypatch.setattr(co, name, value)
    monkeypatch.setattr(byte_words, "CHUNK", 64)
    assert _got(co.collocations(_frame(spark, rows).repartition(4), 3, 500)) == _plain(rows, 3, 500)


def test_words_with_one_id_get_another_seed(spark, monkeypatch):
    rows = [("en", "a b c d " * 12), ("en", "b a. c a b " * 5)]
    good = co.WordHash.__call__

    def bad(self, data, starts, ends):
        got = good(self, data, starts, ends)
        return got % 3 if self.clashes else got

    made = co.WordHash.__init__

    def init(self, seed):
        made(self, seed)
        self.clashes = seed == 0

    monkeypatch.setattr(co.WordHash, "__init__", init)
    monkeypatch.setattr(co.WordHash, "__call__", bad)
    assert not list(co._count_words(1)([])) and co.WordHash(0).clashes
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": ["a b c d e f g h"]})
    assert any(None in b.column(2).to_pylist() for b in co._count_words(0)([batch]))
    assert not any(None in b.column(2).to_pylist() for b in co._count_words(1)([batch]))
    monkeypatch.undo()
    assert _got(co.collocations(_frame(spark, rows), 2)) == _plain(rows, 2, 2000)


def test_no_rows_and_products_past_64_bits(spark):
    assert co.collocations(_frame(spark, [])).count() == 0
    assert co.collocations(_frame(spark, [("en", None)])).count() == 0
    big = spark.createDataFrame([(3 * 10**12, 5 * 10**12, 4 * 10**12)], "a long, l long, r long")
    assert big.select(co._score(*(big[c] for c in "alr"))).first()[0] == 10**6 * 9 * 10**24 // (20 * 10**24)
