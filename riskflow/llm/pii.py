"""Personal data: fixed patterns, and spans added by a linear-chain conditional random field.

The field labels the tokens of a window with B/I labels of the four kinds or O. Its features are the
word shapes, digit counts and check results (Luhn, octets) of a token and its two neighbours. It is
trained from a small labelled table (rows made from ``LABELLED``) by gradient ascent on the
conditional likelihood, and decoded by Viterbi over numpy batches of windows. By definition each
token of a span lies within ``MARGIN`` characters of a digit or an ``@`` in its line, so that text
farther from one is O and is not decoded.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import column

KINDS = ("email", "ip", "card", "phone")
# Each with the characters of its first run. The character after such a run decides for every start in it,
# so that a run is tried at its start, or where the last match ended within it, and never given back.
_PATTERN = {
    "email": (r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]", r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (None, r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": (None, r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_HERE = {kind: re.compile(body) for kind, (_, body) in _PATTERN.items()}
_NEXT = {kind: re.compile(f"(?<!{run}){body}" if run else body) for kind, (run, body) in _PATTERN.items()}
_DIGIT = re.compile(r"[0-9]")
_TRIGGER = re.compile(r"[0-9@]+")
_TOKEN = re.compile(r"\S+")
MARGIN = 48
_EDGE = ".,;:!?\"'<>[]|"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _octets(s: str) -> bool:
    # Long digit runs are compared by length first: no conversion of unbounded numbers.
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def _holds(kind: str, s: str) -> bool:
    if kind == "ip":
        return _octets(s)
    if kind == "email":
        return True
    digits = "".join(_DIGIT.findall(s))
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15


def _matches(kind: str, text: str) -> Iterator[re.Match]:
    """Leftmost non-overlapping matches, in time linear in the text."""
    at = 0
    while m := _HERE[kind].match(text, at) or _NEXT[kind].search(text, at):
        yield m
        at = m.end()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind's place in KINDS, ...) of the fixed patterns, by start, then kind; in code points."""
    found = []
    has_digit = _DIGIT.search(text) is not None
    for k, kind in enumerate(KINDS):
        if not ("@" in text if kind == "email" else has_digit and (kind != "phone" or "+" in text)):
            continue
        found += [(m.start(), k, m.end()) for m in _matches(kind, text) if _holds(kind, m[0])]
    return sorted(found)


#: The labelled table: <kind>...</kind> marks a span; {..} stands for drawn values (see ``_draw``).
LABELLED = """
call <phone>{p3}</phone> or write to <email>{mail}</email> today
Phone: <phone>({a3}) {a3}-{a4}</phone> from nine to five.
Tel. <phone>({a3}) {a3}-{a4}</phone>, ask for the desk
reach me under <phone>{a3}-{a3}-{a4}</phone> in the morning
mobile <phone>{a3}-{a3}-{a4}</phone>.
the number is <phone>+{a1} ({a3}) {a3}-{a4}</phone> and the office closes at {a1}
ring <phone>+{a2} {a3} {a3} {a4}</phone> before noon
fax <phone>+{a2}-{a3}-{a3}-{a4}</phone> or come by
mail <email>{mail}</email>, she answers soon.
write to <email>{mail}</email>
contact: <email>{mail}</email> | <phone>+{a1} ({a3}) {a3}-{a4}</phone> | desk
from <ip>{ip}</ip> a login failed twice
host <ip>{ip}</ip>, port {a4}
the server at <ip>{ip}</ip> was down.
paid with <card>{card}</card> on that day
card <card>{card}</card>.
her card number <card>{card}</card> and a letter
old card <card>{cards}</card> is gone
charged to <card>{cardh}</card> last week
order {a16x} was sent in {a2} boxes
the account {a16x} has no owner
version {a1}.{a1}.{a2} of the tool came out in {y}
see {badip} in the old table
release {a1}.{a1} needs {a3} MB of memory
on {y}-{a2}-{a2} the town had {a4} people
the {a2}th of May {y} was warm
he paid ${a2}.{a2} and {a1},{a3} more
token = "{hex}" was found in the log
commit {hex} broke the build
key {hex}.
between {a3} and {a4} birds were seen
page {a2} of {a3}, line {a1}
room {a3}-{a2} on floor {a1}
chapter {a1}.{a2} has {a2} pages ({a3} in print)
id {a10} in the list, {a2} items
part no. {a3}-{a2}-{a3} is out of stock
isbn {a3}-{a1}-{a2}-{a5}-{a1} on the shelf
score {a1}-{a1} after {a2} minutes
@ the corner of {a1}nd street
follow @name on the site
the word @ alone is not an address
between {y} and {y}, {a2} of {a2}
https://www.example.com/en/{a3}?page={a1} is a page
it grew by {a2}% in {a1} years
Licensed under version {a1}.{a1} of the terms, {y}.
The end. And then it was said that the rest is gone, all of it.
and | so | on | with | {a2} | more | cells
thorea stwhinan, redan. Ingion ouble ther and the with of
""".strip().splitlines()


def _draw(rnd: random.Random, name: str) -> str:
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    if name == "mail":
        return f"{rnd.choice(['ann', 'bo.lee', 'der', 'x-y', 'thorea'])}{rnd.choice(['', '.', '_'])}{digits(rnd.randrange(3))}@{rnd.choice(['mail', 'post', 'mail7.example'])}.{rnd.choice(['com', 'org', 'example'])}"
    if name == "ip":
        return ".".join(str(rnd.randrange(256)) for _ in range(4))
    if name == "badip":
        return ".".join(str(rnd.randrange(256, 999)) for _ in range(4))
    if name == "hex":
        return "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    if name == "y":
        return str(rnd.randrange(1900, 2030))
    if name == "p3":
        return f"+{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)}"
    if name in ("card", "cards", "cardh", "a16x"):
        body = digits(15)
        last = next(c for c in "0123456789" if luhn(body + c) == (name != "a16x"))
        sep = {"cards": " ", "cardh": "-"}.get(name, "")
        return sep.join(re.findall("....", body + last))
    return digits(int(name[1:]))


def labelled_table(copies: int = 8, seed: int = 7) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """(text, [(start, end, kind)]) rows."""
    rnd, rows = random.Random(seed), []
    for line in LABELLED * copies:
        line = re.sub(r"\{(\w+)\}", lambda m: _draw(rnd, m[1]), line)
        text, spans, open_at = "", [], 0
        for piece in re.split(r"(</?(?:email|ip|card|phone)>)", line):
            if piece.startswith("</"):
                spans.append((open_at, len(text), piece[2:-1]))
            elif re.fullmatch(r"<\w+>", piece):
                open_at = len(text)
            else:
                text += piece
        rows.append((text, spans))
    return rows


LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
_CLASS = str.maketrans({**{chr(c): "d" for c in range(48, 58)}, **{chr(c): "X" for c in range(65, 91)}, **{chr(c): "x" for c in range(97, 123)}})
_REPEAT = re.compile(r"(.)\1+")

Key = tuple[str, int, str]


def _key(token: str) -> Key:
    """Word shape (runs collapsed), digits, check result of a token without edge punctuation."""
    core = token[:64].strip(_EDGE)
    digits = "".join(_DIGIT.findall(core)) if len(token) <= 64 else ""
    shape = _REPEAT.sub(r"\1", core.translate(_CLASS)) if len(token) <= 64 else "long"
    shape = "".join("x" if ord(c) > 127 else c for c in shape)[:12]
    check = ""
    if digits and core.replace("-", "").isdigit() and 14 <= len(digits) <= 19:
        check = "luhn" if luhn(digits) else "no"
    elif shape == "d.d.d.d":
        check = "octets" if _octets(core) else "no"
    return shape, min(len(digits), 20), check


def _features(key: Key, role: str) -> list[str]:
    shape, digits, check = key
    return [f"{role}s={shape}", f"{role}d={digits}", f"{role}c={check}", f"{role}sd={shape}|{digits}", f"{role}b"]


@dataclass
class Crf:
    index: dict[str, int]
    weights: np.ndarray  # feature x label
    moves: np.ndarray  # label x label
    start: np.ndarray
    cache: dict[tuple[Key, str], np.ndarray] = field(default_factory=dict)

    def part(self, key: Key, role: str) -> np.ndarray:
        got = self.cache.get((key, role))
        if got is None:
            at = [self.index[f] for f in _features(key, role) if f in self.index]
            got = self.weights[at].sum(axis=0) if at else np.zeros(len(LABELS))
            if len(self.cache) < 100_000:
                self.cache[key, role] = got
        return got

    def emissions(self, keys: list[Key]) -> np.ndarray:
        pad: Key = ("", 0, "")
        around = [pad, *keys, pad]
        return np.array([self.part(around[i], "<") + self.part(around[i + 1], "") + self.part(around[i + 2], ">") for i in range(len(keys))])

    def decode(self, windows: list[list[Key]]) -> list[list[int]]:
        """Viterbi over all windows at once, padded to one length per batch of similar lengths."""
        out: list[list[int]] = [[] for _ in windows]
        order = sorted((i for i in range(len(windows)) if windows[i]), key=lambda i: len(windows[i]))
        for a in range(0, len(order), 256):
            part = order[a : a + 256]
            size = np.array([len(windows[i]) for i in part])
            top = int(size.max())
            emit = np.zeros((len(part), top, len(LABELS)))
            for r, i in enumerate(part):
                emit[r, : size[r]] = self.emissions(windows[i])
            score = self.start + emit[:, 0]
            back = np.zeros((len(part), top, len(LABELS)), np.int8)
            for t in range(1, top):
                every = score[:, :, None] + self.moves[None]
                back[:, t] = every.argmax(axis=1)
                nxt = every.max(axis=1) + emit[:, t]
                live = t < size
                score[live] = nxt[live]
            at = score.argmax(axis=1)
            path = np.zeros((len(part), top), np.int64)
            rows = np.arange(len(part))
            for t in range(top - 1, -1, -1):
                here = t == size - 1
                cur = at.copy() if t == top - 1 else np.where(here, at, cur)
                path[:, t] = cur
                if t:
                    step = back[rows, t, cur]
                    cur = np.where(t <= size - 1, step, cur)
            for r, i in enumerate(part):
                out[i] = path[r, : size[r]].tolist()
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _forbidden() -> tuple[np.ndarray, np.ndarray]:
    """I- labels follow only their own kind."""
    moves, start = np.zeros((len(LABELS), len(LABELS))), np.zeros(len(LABELS))
    for j, b in enumerate(LABELS):
        if b[0] == "I":
            start[j] = -1e4
            for i, a in enumerate(LABELS):
                if a[2:] != b[2:]:
                    moves[i, j] = -1e4
    return moves, start


def _label(text: str, spans: list[tuple[int, int, str]], tokens: list[tuple[int, int]]) -> list[int]:
    out, used = [], set()
    for a, z in tokens:
        hit = next((s for s in spans if a < s[1] and z > s[0]), None)
        out.append(0 if hit is None else LABELS.index(("I-" if hit in used else "B-") + hit[2]))
        used.add(hit)
    return out


def train(rows: list[tuple[str, list[tuple[int, int, str]]]] | None = None, epochs: int = 12, seed: int = 3) -> Crf:
    """Stochastic gradient ascent on the conditional log-likelihood (forward-backward in log space)."""
    rows = labelled_table() if rows is None else rows
    data = []
    for text, spans in rows:
        tokens = [m.span() for m in _TOKEN.finditer(text)]
        data.append(([_key(text[a:z]) for a, z in tokens], _label(text, spans, tokens)))
    pad: Key = ("", 0, "")
    index: dict[str, int] = {}
    cases = []
    for keys, labels in data:
        around = [pad, *keys, pad]
        feats = [[index.setdefault(f, len(index)) for role, k in (("<", around[i]), ("", around[i + 1]), (">", around[i + 2])) for f in _features(k, role)] for i in range(len(keys))]
        cases.append((np.array(feats), np.array(labels)))
    ban, start = _forbidden()
    w, moves = np.zeros((len(index), len(LABELS))), np.zeros_like(ban)
    draw = np.random.default_rng(seed)
    for epoch in range(epochs):
        rate = 0.25 / (1 + epoch / 3)
        w *= 0.999
        for c in draw.permutation(len(cases)):
            feats, y = cases[c]
            emit, m, n = w[feats].sum(axis=1), moves + ban, len(y)
            fwd, bwd = np.zeros_like(emit), np.zeros_like(emit)
            fwd[0] = start + emit[0]
            for t in range(1, n):
                fwd[t] = _logsum(fwd[t - 1][:, None] + m, 0) + emit[t]
            for t in range(n - 2, -1, -1):
                bwd[t] = _logsum(m + (emit[t + 1] + bwd[t + 1])[None], 1)
            z = _logsum(fwd[-1], 0)
            grad = -np.exp(fwd + bwd - z)
            grad[np.arange(n), y] += 1
            np.add.at(w, feats, rate * grad[:, None, :])
            for t in range(1, n):
                moves -= rate * np.exp(fwd[t - 1][:, None] + m + (emit[t] + bwd[t])[None] - z)
                moves[y[t - 1], y[t]] += rate
    return Crf(index, w, moves + ban, start)


def windows(text: str) -> list[list[tuple[int, int]]]:
    """Token spans of each stretch of a line that lies near a digit or an ``@``."""
    out = []
    hits = _TRIGGER.finditer(text)
    edge = None  # (from, to) of the open stretch, whole tokens of one line
    stretches = []
    for m in hits:
        if edge and m.start() < edge[1]:
            continue
        line = text.rfind("\n", 0, m.start()) + 1
        stop = text.find("\n", m.end())
        stop = len(text) if stop < 0 else stop
        a = max(line, m.start() - MARGIN)
        z = min(stop, m.end() + MARGIN)
        # A next trigger before the end of the stretch widens it.
        while (n := _TRIGGER.search(text, max(m.end(), z - MARGIN), z)) and n.end() + MARGIN > z and z < stop:
            z = min(stop, n.end() + MARGIN)
        while a > line and not text[a - 1].isspace():
            a -= 1
        while z < stop and not text[z].isspace():
            z += 1
        if stretches and a < stretches[-1][1]:
            a = stretches.pop()[0]
        edge = (a, z)
        stretches.append(edge)
    for a, z in stretches:
        out.append([t.span() for t in _TOKEN.finditer(text, a, z)])
    return out


def crf_spans(texts: list[str], crf: Crf) -> list[list[tuple[int, int, str]]]:
    """(start, end, kind) that the field finds in each text."""
    cut = [(i, w) for i, t in enumerate(texts) for w in windows(t)]
    paths = crf.decode([[_key(texts[i][a:z]) for a, z in w] for i, w in cut])
    found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for (i, w), path in zip(cut, paths, strict=True):
        open_at: tuple[int, int, str] | None = None
        for (a, z), label in [*zip(w, path, strict=True), ((0, 0), 0)]:
            name = LABELS[label]
            if open_at and name[0] != "I":
                found[i].append(open_at)
                open_at = None
            if name != "O":
                raw = texts[i][a:z]
                end = z - (len(raw) - len(raw.rstrip(_EDGE)))
                open_at = (open_at[0], end, open_at[2]) if open_at else (a + len(raw) - len(raw.lstrip(_EDGE)), end, name[2:])
    return [[s for s in f if s[1] > s[0] and _TRIGGER.search(texts[i], s[0], s[1])] for i, f in enumerate(found)]


def all_spans(base: list[tuple[int, int, int]], extra: list[tuple[int, int, str]]) -> list[tuple[int, int, int]]:
    """Base spans, and those of ``extra`` that touch none of them."""
    out, by_start = list(base), sorted(base)
    longest = max((z - a for a, _, z in base), default=0)
    for a, z, kind in extra:
        near = by_start[bisect_left(by_start, (a - longest, 0, 0)) : bisect_left(by_start, (z, 0, 0))]
        if all(e <= a for _, _, e in near):
            out.append((a, KINDS.index(kind), z))
    return sorted(out)


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


def find(docs: DataFrame, crf: Crf | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added), a row for each row of ``docs``.

    Counts and ``base_sha256`` are of the fixed patterns; ``spans`` has these and the field's spans that
    touch none of them. Null and empty texts have no spans (the hash is that of the empty string);
    repeated rows get equal results; a table without rows gives none. Offsets are code points.
    """
    crf = crf or train()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in column(b, "text").to_pylist()]
            base = [base_spans(t) for t in texts]
            every = [all_spans(s, x) for s, x in zip(base, crf_spans(texts, crf), strict=True)]
            cols = [column(b, "doc_id")]
            cols += [pa.array([sum(s[1] == k for s in one) for one in base], pa.int64()) for k in range(len(KINDS))]
            cols.append(pa.array([hashlib.sha256(_join(s).encode()).hexdigest() for s in base], pa.string()))
            cols.append(pa.array([_join(s) for s in every], pa.string()))
            cols.append(pa.array([len(e) - len(s) for e, s in zip(every, base, strict=True)], pa.int64()))
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
