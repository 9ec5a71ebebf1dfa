"""Near duplicates against all pairs; signatures against exact similarities; components."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import common
from riskflow.llm import near_dup as nd
from riskflow.llm.components import components

from .conftest import LONG


def _bag(text):
    h, row, _, _ = nd.W.words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    s, _, _ = nd.W.shingles(h, row, 1, 5)
    return Counter(s.tolist())


def _classes(rows):
    rows = [(i if i is not None else -(2**63), t or "") for i, t in rows]
    bags, root = [_bag(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            both, every = sum((bags[x] & bags[y]).values()), sum((bags[x] | bags[y]).values())
            if rows[x][1] == rows[y][1] or every and both / every >= 0.8:
                root[max(find(x), find(y))] = min(find(x), find(y))
    low = {}
    for x in range(len(rows)):
        low[find(x)] = min(low.get(find(x), rows[x][0]), rows[x][0])
    return sorted((rows[x][0], low[find(x)]) for x in range(len(rows)))


def _corpus(seed, groups=12, copies=9):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = [rnd.choice(vocab) for _ in range(rnd.randrange(60, 200))]
        for c in range(rnd.randrange(1, copies)):
            edited = list(base)
            for _ in range(rnd.randrange(0, 1 + len(base) // 40) if c else 0):
                edited[rnd.randrange(len(edited))] = rnd.choice(vocab)
            rows.append(" ".join(edited))
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_classes_equal_all_pairs(spark, docs):
    rows = _corpus(1) + [(900, None), (901, ""), (902, "one"), (903, "One."), (904, "..."), (905, "..."), (906, "!!!"), (907, LONG), (908, LONG + "end"), (7, "again the same id"), (None, "a b c d e f"), (None, "a b c d e f")]
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -(2**63), r["class_id"] if r["class_id"] is not None else -(2**63)) for r in nd.classes(docs(rows)).collect())
    assert got == _classes(rows)


def test_a_row_without_an_id_never_stands_for_rows_with_one(spark, docs):
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(None, "the dog and the cat"), (4, "the dog and the cat"), (3, "the dog and the cat"), (3, "other words"), (2, "other words")]
    rows += [(None, near), (None, near + " end"), (None, near + " end"), (None, "all alone it is here"), (-(2**63), "smallest id of all")]
    got = nd.members(docs(rows)).collect()
    text = {bytes(r["same"]): t for t in {t for _, t in rows} for r in docs([(0, t)]).select(nd.digest(F.col("text")).alias("same")).collect()}
    seen = sorted(((r["doc_id"], text[bytes(r["same"])], r["class_id"], r["kept"]) for r in got if r["class_id"] is not None), key=str)
    want = [(None, "the dog and the cat", 3, False), (4, "the dog and the cat", 3, False), (3, "the dog and the cat", 3, True), (3, "other words", 2, False), (2, "other words", 2, True), (-(2**63), "smallest id of all", -(2**63), True)]
    assert seen == sorted(want, key=str)
    bare = [r for r in got if r["class_id"] is None]
    groups = {text[bytes(r["same"])]: bytes(r["class_key"]) for r in bare}
    assert len(bare) == 4 and groups[near] == groups[near + " end"] != groups["all alone it is here"]
    assert len({text[bytes(r["same"])] for r in bare if r["kept"]}) == 2


def test_rows_with_a_key_are_all_likely_few_others_are(spark, monkeypatch):
    rows = spark.range(4000).select("id", F.lit("x").alias("__bits"))
    keys = spark.range(0, 4000, 40).select(F.xxhash64("id"))
    for log2, most in ((17, 60), (2, 3900)):  # few words hold too many keys, and still none is lost
        monkeypatch.setattr(common, "FILTER_LOG2", log2)
        likely, others = common.parted(rows, F.xxhash64("id"), keys)
        assert likely.columns == others.columns == rows.columns
        a, b = {r["id"] for r in likely.collect()}, {r["id"] for r in others.collect()}
        assert not a & b and a | b == set(range(4000)) and a >= set(range(0, 4000, 40)) and len(a) <= 100 + most
    likely, others = common.parted(rows, F.xxhash64("id"), keys.limit(0))
    assert likely.isEmpty() and others.count() == 4000


def test_empty_table_and_no_links(spark, docs):
    assert nd.classes(docs([])).count() == 0
    assert sorted(map(tuple, nd.classes(docs([(1, "a b c"), (2, "d e f")])).collect())) == [(1, 1), (2, 2)]


def test_a_large_bucket_in_blocks(spark, docs, monkeypatch):
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(150):
        e = list(base)
        for _ in range(rnd.randrange(4)):
            e[rnd.randrange(150)] = f"n{rnd.randrange(99)}"
        rows.append((i, " ".join(e)))
    monkeypatch.setattr(nd, "BLOCK", 16)
    assert sorted(map(tuple, nd.classes(docs(rows)).collect())) == _classes(rows)


def test_a_pair_is_compared_once(spark):
    """One Python run in the plan; a filter on a column UDF was pushed down and took a second one."""
    bag = lambda *shingles: np.array([x << 16 | 1 for x in shingles], np.uint64).tobytes()
    packed = spark.createDataFrame([(1, bag(1, 2, 3, 4, 5)), (2, bag(1, 2, 3, 4, 6)), (3, bag(1, 2, 3, 4, 5)), (4, bag(2, 3, 4, 5))], "id long, bag binary")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 3), (1, 4), (2, 4)], "a long, b long")
    got = nd.verify(pairs, packed)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert sum(plan.count(x) for x in ("ArrowEvalPython", "MapInArrow")) == 1
    assert sorted(tuple(r) for r in got.collect()) == [(1, 3, 1.0), (1, 4, 0.8)]
    assert nd.verify(pairs.limit(0), packed).count() == 0


def _block(n=60):
    """A bucket's rows that all stand alone, as both base and asking rows but for the first."""
    rnd = random.Random(8)
    base = [f"w{rnd.randrange(300)}" for _ in range(100)]
    texts = [" ".join(f"n{rnd.randrange(99)}" if rnd.random() < 0.03 else w for w in base) for _ in range(n)]
    sets = [nd.multiset(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])) for t in texts]
    low = [(nd.signatures(r, s, c, 1)[0] >> np.uint64(24)).astype(np.uint8).tobytes() for r, s, c in sets]
    bag = [(s & ~np.uint64(0xFFFF) | c.astype(np.uint64)).tobytes() for _, s, c in sets]
    rows = [{"key": 5, "id": i, "root": i, "asks": i > 0, "ask": ask, "n_shingles": int(sets[i][2].sum()), "low": low[i], "keys": np.array([9, 5]) if i % 2 else np.array([3, 5]), "bag": bag[i]} for i in range(n) for ask in ([False, True] if i else [False])]
    near = {(i, j) for i in range(n) for j in range(i) if nd.overlap(*sets[i][1:], *sets[j][1:]) >= 0.8}
    return nd.pd.DataFrame(rows), near


def test_links_between_components_are_whole_and_few():
    frame, near = _block()
    got = [(max(p), min(p)) for p in nd.across(frame, 0.8)]
    # Rows of equal parity share the band with key 9 or 3 first: their pairs belong to that bucket.
    due = {(i, j) for i, j in near if (i - j) % 2}
    assert due and set(got) <= due

    def groups(links):
        root = list(range(60))
        for _ in range(60):
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert groups(got) == groups(due) and len(got) < 60
    assert len(set(groups(due))) > 1
    assert nd.across(frame.assign(root=0), 0.8) == []


@pytest.mark.parametrize("weights", [(1, 1), (3, 2), (40, 33), (1000, 1)])
def test_signatures_estimate_the_weighted_similarity(weights):
    rng = np.random.default_rng(5)
    shared, own_a, own_b = 60, 25, 15
    row = np.repeat([0, 1], [shared + own_a, shared + own_b])
    key = np.concatenate([np.arange(shared + own_a), np.arange(shared), 10_000 + np.arange(own_b)])
    agree, want = [], None
    a = Counter({k: weights[k % 2] for k in range(shared + own_a)})
    b = Counter({k: weights[k % 2] + k % 3 for k in range(shared)}) + Counter({10_000 + k: weights[k % 2] for k in range(own_b)})
    want = sum((a & b).values()) / sum((a | b).values())
    count = np.array([a[k] for k in key[: shared + own_a].tolist()] + [b[k] for k in key[shared + own_a :].tolist()])
    for _ in range(40):
        salt = rng.integers(0, 2**63, dtype=np.uint64)
        sig = nd.signatures(row, nd.mixed(key.astype(np.uint64) + salt), count, 2)
        agree.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(agree) - want) < 0.035


def test_components(spark):
    rnd = random.Random(6)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + rnd.randrange(30), 200 + rnd.randrange(30)) for _ in range(25)] + [(5, 5), (None, 3)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_of_a_batch_take_no_step(spark, monkeypatch):
    """A path in one batch is joined where it lies, without a star step; a scattered one still ends in the same root."""
    from riskflow.llm import components as cc

    steps = []
    monkeypatch.setattr(cc, "_star", lambda *a, star=cc._star: steps.append(1) or star(*a))
    ids = list(range(-40, 160))
    path = list(zip(ids, ids[1:], strict=False))
    random.Random(9).shuffle(path)
    links = spark.createDataFrame(path, "a long, b long")
    want = {i: -40 for i in ids}
    assert {tuple(r) for r in components(links.coalesce(1)).collect()} == set(want.items()) and not steps
    assert dict(tuple(r) for r in components(links.repartition(8)).collect()) == want


def test_open_links_are_seen(spark):
    from riskflow.llm import components as cc

    open_ = lambda links: cc._open(spark.createDataFrame(links, "a long, b long"))
    assert open_([(3, 1), (3, 1), (2, 1), (9, 7)]) == 0
    assert open_([(3, 1), (4, 3)]) == 1 and open_([(3, 1), (3, 2)]) == 1
    a, b = cc.smallest(np.array([5, 9, 2, 7, 7]), np.array([9, 2, 5, 8, 7]))
    assert (a.tolist(), b.tolist()) == ([5, 8, 9], [2, 7, 2])
