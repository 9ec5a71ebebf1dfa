"""Fixed patterns against a plain loop; the field on rows that it was not trained on."""

from __future__ import annotations

import hashlib
import random
import re
import time

from riskflow.llm import pii

from .conftest import LONG


def _plain(text):
    out = []
    for k, (kind, pattern) in enumerate([("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and (not 14 <= len(d) <= 19 or sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10):
                continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_a_plain_loop():
    rnd = random.Random(1)
    bits = ["a@b.c_", "_d@", "e.f", "@x.y.", "1.2.3.4a@", "..", "1.2.", "%", "a@b.c", "x.y@z-1.com.de", "@", ".", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112", "+1 (234) 555-6789", "+12", "٣", "é", "\n", " ", "0" * 30, "+", "-", "7"]
    for _ in range(3000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randrange(7)))
        assert pii.base_spans(t) == _plain(t), t


def test_long_runs_take_linear_time():
    n = 1_000_000
    runs = ["7" * n, "a" * n + "@", "a@" * (n // 2), "1." * (n // 2), "+" + "1-" * (n // 2), "a@" + "b" * n, "a@b." * (n // 4), "1 " * (n // 2), "+1" + "(" * n, "a." * (n // 2) + "@ 1"]
    for text in runs:
        start = time.process_time()
        pii.base_spans(text)
        assert time.process_time() - start < 2, text[:10]


def test_the_field_on_new_rows():
    crf = pii.train()
    rows = pii.labelled_table(3, seed=12345)
    got = pii.crf_spans([t for t, _ in rows], crf)
    want = [sorted(s) for _, s in rows]
    true = sum(len(set(g) & set(w)) for g, w in zip(got, want, strict=True))
    assert true / sum(map(len, want)) > 0.9 and true / sum(map(len, got)) > 0.95


def test_viterbi_equals_all_paths():
    import itertools

    import numpy as np

    crf = pii.train(epochs=2)
    texts = ["call +1 (017) 555-7713 now", "a@b.co 1", "7", "x 4111111111111111 1.2.3.4"]
    keys = [[pii._key(w) for w in t.split()][:4] for t in texts]
    for path, k in zip(crf.decode(keys), keys, strict=True):
        emit = crf.emissions(k)
        score = lambda p, e=emit: crf.start[p[0]] + sum(e[i, x] for i, x in enumerate(p)) + sum(crf.moves[a, b] for a, b in itertools.pairwise(p))
        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(k)), key=score)
        assert np.isclose(score(path), score(best))


def test_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, "mail a@b.com, or 10.0.0.1"), (3, "mail a@b.com, or 10.0.0.1"), (4, LONG + " 1.2.3.4"), (5, "call (017) 555-7713 from nine."), (None, "+1 (234) 555-6789"), (6, "token = 9" + "1" * 5000)]
    got = {}
    for r in pii.find(docs(rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r["base_sha256"], r["spans"]) for i in (1, 2) for r in got[i]] == [(empty, "")] * 2
    assert len(got[3]) == 2 and {(r["spans"], r["n_email"], r["n_ip"]) for r in got[3]} == {("email:5:12,ip:17:25", 1, 1)}
    assert got[4][0]["spans"] == f"ip:{len(LONG) + 1}:{len(LONG) + 8}"
    assert got[5][0]["spans"] == "phone:5:19" and got[5][0]["n_phone"] == 0 and got[5][0]["base_sha256"] == empty
    assert got[None][0]["n_phone"] == 1 and got[6][0]["spans"] == ""
    assert pii.find(docs([])).count() == 0
