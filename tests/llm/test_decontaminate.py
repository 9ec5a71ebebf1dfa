"""Tiling against a plain greedy search; contaminated documents; blocks."""

from __future__ import annotations

import random

import numpy as np

from riskflow.llm import decontaminate as dc

from .conftest import LONG


def _plain(doc, item, k):
    used_d, used_i, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for q in range(len(item)):
            for p in range(len(doc)):
                n = 0
                while p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n] and p + n not in used_d and q + n not in used_i:
                    n += 1
                if n > best[0]:
                    best = (n, q, p)
        n, q, p = best
        if n < k:
            return sorted(tiles)
        tiles.append((p, q, n))
        used_d.update(range(p, p + n))
        used_i.update(range(q, q + n))


def test_tiles_equal_a_plain_greedy_search():
    rnd = random.Random(1)
    for _ in range(120):
        item = [rnd.randrange(5) for _ in range(rnd.randrange(3, 22))]
        doc = [rnd.randrange(5) for _ in range(rnd.randrange(3, 30))] + item[rnd.randrange(len(item)) :] + item[: rnd.randrange(len(item))]
        seeds = [(p, q) for p in range(len(doc) - 2) for q in range(len(item) - 2) if doc[p : p + 3] == item[q : q + 3]]
        assert sorted(dc.tile(np.array(doc), np.array(item), seeds, 3)) == _plain(doc, item, 3)


def _rows():
    rnd = random.Random(2)
    vocab = [f"v{i}" for i in range(3000)]
    text = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [text(40) for _ in range(20)]
    whole, parts, half, none = text(200), text(200), text(200), text(300)
    whole[50:50] = items[3]
    parts[30:30], parts[150:150] = items[4][20:], items[4][:20]
    half[10:10] = items[5][:15]
    docs = [(1, " ".join(whole)), (2, " ".join(parts).upper()), (3, " ".join(half)), (4, " ".join(none)), (5, None), (6, ""), (7, "?!"), (8, LONG), (9, " ".join(items[7]) + ", " + " ".join(items[8])), (None, " ".join(items[9])), (1, " ".join(items[3])), (10, "a short one"), (11, "here is a short one. yes it is")]
    bench = [(i, " ".join(t)) for i, t in enumerate(items)] + [(100, None), (101, ""), (102, "..."), (103, "A short one")]
    return docs, bench


def test_planted_items(spark, docs):
    rows, bench = _rows()
    bench = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id long, text string, doc_id string")
    want = {(1, 3), (2, 4), (9, 7), (9, 8), (None, 9), (10, 103), (11, 103)}
    for size in (8 << 20, 700):
        got = dc.contaminated(docs(rows), bench, block_bytes=size).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want
        assert all(r["coverage"] == sum(t["length"] for t in r["tiles"]) / r["item_words"] for r in got)
        two = next(r for r in got if r["doc_id"] == 2)
        assert two["n_tiles"] == 2 and two["coverage"] == 1.0 and two["longest"] == 20
    kept = dc.clean(docs(rows), bench)
    assert kept.columns == ["doc_id", "text", "ids", "part"]
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [3, 4, 5, 6, 7, 8]
    assert dc.contaminated(docs([]), bench).count() == 0
    assert dc.contaminated(docs(rows), bench.limit(0)).count() == 0
