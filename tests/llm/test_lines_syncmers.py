"""Line templates and fingerprints against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from riskflow.llm import line_dedup as ld
from riskflow.llm import syncmers as sy

from .conftest import LONG


def _plain_lines(rows, least):
    lines, docs = [], defaultdict(set)
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")):
            toks = tuple(ld.WILD if re.search("[0-9]", w) else w for w in re.split("[ \t]+", line.strip(" \t\r")))
            if i is not None and t is not None and toks[0]:
                lines.append((i, t, n, (len(toks), toks[:3]), toks))
                docs[len(toks), toks[:3], toks].add(i)
    seen = defaultdict(set)
    for (n, lead, toks), own in docs.items():
        for at, tok in enumerate(toks):
            seen[n, lead, at, tok] |= own
    made = {}
    for (n, lead, toks), own in docs.items():
        fixed = [len(seen[n, lead, at, tok]) >= least for at, tok in enumerate(toks)]
        count = sum(f and t != ld.WILD for f, t in zip(fixed, toks, strict=True))
        if count >= ld.MIN_TOKENS and count >= ld.FIXED_SHARE * n:
            made[n, lead, toks] = (n, lead, tuple(t if f else ld.WILD for f, t in zip(fixed, toks, strict=True)))
    templates = defaultdict(list)
    for k, t in made.items():
        templates[t].append(k)
    first = {k: min(own) for k, own in docs.items() if len(own) >= least}
    for t, ks in templates.items():
        if len(set().union(*(docs[k] for k in ks))) >= least:
            low = min(min(docs[k]) for k in ks)
            for k in ks:
                first[k] = min(first.get(k, low), low)
    gone = defaultdict(set)
    for i, t, n, leaf, toks in lines:
        if first.get((*leaf, toks), i) < i:
            gone[i, t].add(n)
    return sorted(((i if i is not None else -1, t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i, t]), len(gone[i, t])) for i, t in rows), key=str)


def test_lines_equal_plain_python(spark, docs):
    rnd = random.Random(1)
    shapes = ["Posted by user {n} on day {n} of May", "Posted by {w} in the open forum today again", "Read the whole story on our site", "one two {w} four", "share share share", "  Read the whole story\ton our site \r", "log {n}: the job of {w} is done now", "all of it is {w} and {w} too, they said", "{w}", "All rights reserved.", "日本語", "{w} {w}"]
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, LONG), (5, "Read the whole story on our site"), (5, "x\nRead the whole story on our site"), (None, "Read the whole story on our site")]
    for i in range(6, 60):
        picked = [rnd.choice(shapes).format(n=rnd.randrange(99), w=rnd.choice("ab cd ef gh ij kl".split())) for _ in range(rnd.randrange(6))]
        rows.append((i, "\n".join(picked)))
    rows.append(rows[-1])
    for least in (2, 5):
        got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["text"], r["__n_dropped"]) for r in ld.dedup(docs(rows), least).collect()), key=str)
        assert got == _plain_lines(rows, least)
    out = ld.dedup(docs(rows))
    assert out.columns == ["doc_id", "text", "ids", "part", "__n_lines", "__n_dropped"]
    assert ld.dedup(docs([])).count() == 0


def test_variants_in_one_document_count_once(docs):
    """Five variants of a line in two documents are no template in five; copies of short lines go."""
    line = "Posted by user {} in the open forum today again"
    rows = [(1, "\n".join(line.format(w) for w in "ab cd ef gh".split())), (2, line.format("ij"))] + [(i, "Les.\nown" + "x" * i) for i in range(3, 9)]
    got = {r["doc_id"]: r["text"] for r in ld.dedup(docs(rows)).collect()}
    assert got[2] == line.format("ij") and got[1] == rows[0][1]
    assert got[3] == rows[2][1] and all(got[i] == "own" + "x" * i for i in range(4, 9))


def _next(rows):
    order = sorted(range(len(rows)), key=lambda x: (rows[x][0] is not None, rows[x][0] or 0, rows[x][1] or ""), reverse=True)
    return [(x, order[(k + 1) % len(order)]) for k, x in enumerate(order)]


def _check(spark, docs, rows):
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -99, r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"], r["fingerprint"], r["edited_fingerprint"]) for r in sy.fingerprints(docs(rows)).collect())
    want = []
    for x, y in _next(rows):
        t, u = rows[x][1] or "", rows[y][1] or ""
        e = len(t) // 3
        want.append((rows[x][0] if rows[x][0] is not None else -99, len(t), hashlib.sha256((t[: len(t) - e] + u[:e]).encode()).hexdigest()))
    assert [g[:3] for g in got] == sorted(want)
    return got


def test_next_documents_and_edits(spark, docs, monkeypatch):
    rnd = random.Random(2)
    rows = [(rnd.randrange(-500, 10**9), "".join(rnd.choice("ab é😀") for _ in range(rnd.randrange(40)))) for _ in range(60)]
    rows += [(rows[0][0], "zz"), (None, "no id"), (None, None), (2**62, LONG), (-(2**62), "low"), (7, ""), (7, "")]
    monkeypatch.setattr(sy, "RANGE_DOCS", 4)
    _check(spark, docs, rows)
    _check(spark, docs, [(i, f"t{i}") for i in range(50)])
    _check(spark, docs, [(3, "only one of them")])
    assert sy.fingerprints(docs([])).count() == 0


def test_fingerprints_follow_the_similarity(spark, docs):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(600)]
    rows = [(9, " ".join(base)), (8, " ".join(base)), (7, " ".join(base[:500] + [word() for _ in range(100)])), (6, " ".join(word() for _ in range(600))), (5, ""), (4, None), (3, "one two"), (2, "one two"), (1, " \n")]
    got = {r["doc_id"]: r for r in sy.fingerprints(docs(rows)).collect()}
    assert got[9]["fingerprint"] == got[8]["fingerprint"] and got[9]["near_next"] == 1.0
    assert abs(got[8]["near_next"] - 500 / 700) < 0.2 and got[7]["near_next"] < 0.05
    assert got[5]["fingerprint"] == "" and got[5]["near_next"] == 1.0 and got[4]["near_next"] == 0.0
    assert got[3]["near_next"] == 1.0 and got[2]["near_next"] == 0.0 and got[1]["fingerprint"] == ""
    assert all(0 <= r["near_edited"] <= 1 for r in got.values())


def test_anchors_are_closed_and_free_of_context(spark, docs):
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(40)}" for _ in range(300)]
    inner = words[100:160]
    a = sy.anchors(docs([(1, " ".join(words)), (2, "other things " + " ".join(inner) + " end of it")]))
    rows = a.collect()
    one = {(r["word"] - 100, r["hash"]) for r in rows if r["doc_id"] == 1 and 100 <= r["word"] <= 155}
    two = {(r["word"] - 2, r["hash"]) for r in rows if r["doc_id"] == 2 and 2 <= r["word"] <= 57}
    assert one == two and len(one) > 5
    # The anchors are the k-mers whose smallest s-mer is at an edge.
    smers = spark.createDataFrame([(" ".join(words),)], "t string").select(sy._smers(sy._word_hashes(F.col("t"))).alias("s")).first()["s"]
    want = {i for i in range(len(smers) - 3) if min(smers[i : i + 4]) in (smers[i], smers[i + 3])}
    assert {r["word"] for r in rows if r["doc_id"] == 1} == want
