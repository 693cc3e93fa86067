"""Personal data by stated patterns and a skip-chain conditional random field.

Stated patterns give the base spans. A document's candidate tokens (those with
a digit, `@` or `+`) are the nodes of the field: neighbours form the chain, and
occurrences of the same or a similar token, however far apart, are joined by
skip edges to the one before and to the nearest observed ones. Tokens in base spans are observed; loopy message passing carries
their labels along both kinds of edges to the others, so a number that a
pattern finds once is found wherever it returns. Weights are learnt by
pseudo-likelihood from a bounded sample of the corpus itself, with the base
labels as teacher and the labels of neighbours and of similar tokens as inputs.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole
from .toxicity import train_once, unpack

KINDS = ("email", "ip", "card", "phone")  # the order of equal starts
LABELS = len(KINDS) + 1                   # 0: none
TRAIN_DOCS = 20_000  # documents the weights are learnt from at most
ROUNDS = 200         # of message passing at most, as loops may keep it from standing still
STILL = 1e-3         # largest change of a log message in the last round
CONSISTENT = 8.0     # least log potential of one label on two similar tokens
CONFIDENT = 0.9      # marginal from which a token that no pattern found counts

_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive and anchored at the start of a digit run: the matches of the plain
# pattern without its repeated scans of long runs
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@+]*+[0-9@+]\S*+")
_SOME = re.compile(r"[0-9@+]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield "email", start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive; by start, then kind."""
    if not _SOME.search(text):
        return []
    out = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m.groups()):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


_SHAPES = 24


def _shape(token: str) -> list[int]:
    """Numbers of the token's indicator features."""
    digits = sum("0" <= c <= "9" for c in token)
    groups = (0, 1, 4, 7, 9, 12, 16, 20)
    out = [max(i for i, g in enumerate(groups) if digits >= g)]
    letters = any(c.isalpha() for c in token)
    tests = ("@" in token, "+" in token, token.count(".") >= 3, "." in token, "-" in token, "(" in token or ")" in token,
             letters, token[:1].isdigit(), token[-1:].isdigit(), ":" in token or "/" in token, len(token) > 24,
             not letters and digits > 0, "@" in token and token.rfind(".") > token.find("@"), "=" in token, True)
    return out + [8 + i for i, t in enumerate(tests) if t]


def _keys(token: str):
    """What makes tokens similar: their letters and digits, and the digits
    alone if there are many."""
    plain = "".join(c for c in token.lower() if c.isalnum() or c == "@").strip()
    if len(plain) >= 5:
        yield plain
    digits = "".join(c for c in token if "0" <= c <= "9")
    if len(digits) >= 7 and digits != plain:
        yield digits


class Field:
    """Candidate tokens of a text with their labels, features and edges."""

    def __init__(self, text: str, spans):
        self.start, self.end, self.shape = [], [], []
        tokens = []
        for m in _TOKEN.finditer(text):
            self.start.append(m.start())
            self.end.append(m.end())
            tokens.append(m.group())
        n = len(tokens)
        self.shape = [_shape(t) for t in tokens]
        self.label = np.zeros(n, np.int64)
        whole_key = {}  # a span of several tokens is similar by all its digits
        if n and spans:
            s, e = np.array(self.start), np.array(self.end)
            for kind, a, b in reversed(spans):
                i, j = np.searchsorted(e, a, "right"), np.searchsorted(s, b, "left")
                self.label[i:j] = KINDS.index(kind) + 1
                if j - i > 1 and len(digits := "".join(c for c in text[a:b] if "0" <= c <= "9")) >= 7:
                    whole_key[i] = digits
        edges, alike = [], {}
        for i in range(n):
            if i and text[self.end[i - 1]:self.start[i]].isspace():
                edges.append((i - 1, i, 0))
            for key in dict.fromkeys([*_keys(tokens[i]), *([whole_key[i]] if i in whole_key else [])]):
                alike.setdefault(key, []).append(i)
        label = self.label.tolist()
        for group in alike.values():
            edges += [(a, b, 1) for a, b in zip(group, group[1:])]
            # and to the nearest observed ones, so that no label fades on the way
            before = after = None
            for k, i in enumerate(group):
                if before is not None and before != group[k - 1]:
                    edges.append((before, i, 1))
                before = i if label[i] else before
            for k in range(len(group) - 1, -1, -1):
                i = group[k]
                if label[i]:
                    after = i
                elif after is not None and after != group[k + 1]:
                    edges.append((i, after, 1))
        self.edges = np.array(edges, np.int64).reshape(-1, 3)


def _design(field: Field) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indicators of the shapes, label shares of chain neighbours and of
    similar tokens."""
    n = len(field.label)
    x = np.zeros((n, _SHAPES))
    for i, s in enumerate(field.shape):
        x[i, s] = 1
    one = np.eye(LABELS)[field.label]
    near = [np.zeros((n, LABELS)), np.zeros((n, LABELS))]
    for a, b, kind in field.edges.tolist():
        near[kind][a] += one[b]
        near[kind][b] += one[a]
    return x, *near


def train(fields: list[Field], rounds: int = 200, penalty: float = 1e-3) -> dict[str, np.ndarray]:
    """Weights by pseudo-likelihood: every label given its features and the
    labels around it."""
    if fields:
        parts = [_design(f) for f in fields]
        x = np.concatenate([np.concatenate(p, axis=1) for p in parts])
        y = np.concatenate([f.label for f in fields])
    else:
        x, y = np.zeros((0, _SHAPES + 2 * LABELS)), np.zeros(0, np.int64)
    w, v, t = (np.zeros((x.shape[1], LABELS)) for _ in range(2)), None, 1.0
    w, v = w
    if len(y):
        target = np.eye(LABELS)[y]
        step = 1 / (0.5 * float((x * x).sum(1).mean()) + penalty)
        for _ in range(rounds):
            p = x @ v
            p = np.exp(p - p.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = x.T @ (p - target) / len(y) + penalty * v
            w, before = v - step * g, w
            t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
            v = w + (old - 1) / t * (w - before)
    pair = [w[_SHAPES:_SHAPES + LABELS], w[_SHAPES + LABELS:]]
    # potentials are symmetric; similar tokens share a label of personal data
    # at least as firmly as CONSISTENT says, however few the sample shows
    pair = [(m + m.T) / 2 for m in pair]
    kinds = np.arange(1, LABELS)
    pair[1][kinds, kinds] = np.maximum(pair[1][kinds, kinds], CONSISTENT)
    return {"shape": w[:_SHAPES], "chain": pair[0], "skip": pair[1]}


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def marginals(field: Field, model, rounds: int = ROUNDS) -> np.ndarray:
    """Loopy sum-product messages in logarithms, damped by half, until they
    stand still; observed tokens keep their labels."""
    n = len(field.label)
    local = np.zeros((n, LABELS))
    for i, s in enumerate(field.shape):
        local[i] = model["shape"][s].sum(0)
    observed = field.label > 0
    local[observed] = -50.0
    local[observed, field.label[observed]] = 0.0
    if len(field.edges):
        a, b, kind = field.edges.T
        src, dst = np.r_[a, b], np.r_[b, a]
        back = np.r_[np.arange(len(a)) + len(a), np.arange(len(a))]
        pot = np.stack([model["chain"], model["skip"]])[np.r_[kind, kind]]
        msg = np.zeros((len(src), LABELS))
        for _ in range(rounds):
            total = local.copy()
            np.add.at(total, dst, msg)
            out = _log_sum((total[src] - msg[back])[:, :, None] + pot, 1)
            change = 0.5 * (out - _log_sum(out, 1)[:, None] - msg)
            msg += change
            if np.abs(change).max() < STILL:
                break
        np.add.at(local, dst, msg)
    return np.exp(local - _log_sum(local, 1)[:, None])


_EDGE = " \t\r\n.,;:!?\"'()[]{}<>|"


def find(text: str, model, confident: float = CONFIDENT):
    """Base spans and all spans. The field adds runs of tokens that touch no
    base span, without the punctuation around them."""
    base = base_spans(text)
    if not base:  # nothing observed: no label to carry
        return base, base
    field = Field(text, base)
    p = marginals(field, model)
    linked = np.zeros(len(field.label), bool)
    if len(field.edges):
        skip = field.edges[field.edges[:, 2] == 1]
        linked[skip[:, :2].ravel()] = True
    new = (field.label == 0) & linked & (p.argmax(1) > 0) & (p.max(1) >= confident)
    added, i = [], 0
    order = np.flatnonzero(new).tolist()
    label = p.argmax(1)
    while i < len(order):
        j = i
        while j + 1 < len(order) and order[j + 1] == order[j] + 1 and label[order[j + 1]] == label[order[i]] and \
                text[field.end[order[j]]:field.start[order[j + 1]]].isspace():
            j += 1
        s, e = field.start[order[i]], field.end[order[j]]
        while s < e and text[s] in _EDGE:
            s += 1
        while e > s and text[e - 1] in _EDGE:
            e -= 1
        if e > s:
            added.append((KINDS[label[order[i]] - 1], s, e))
        i = j + 1
    return base, sorted([*base, *added], key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> dict[str, np.ndarray]:
    """Weights from at most ``train_docs`` documents that have candidates,
    chosen by a hash; each lends all its candidate tokens to the sample, with
    the plain words between them left out."""
    def cut(batches):
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                parts, end = [], 0
                for m in _TOKEN.finditer(t):
                    gap = t[end:m.start()]  # plain words only part the tokens
                    parts += [gap if len(gap) <= 3 or gap.isspace() else " x ", m.group()]
                    end = m.end()
                out.append("".join(parts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["h", "text"])

    some = docs.select(whole(F.col("text").cast("string")).alias("text")).where(F.col("text").rlike("[0-9@+]"))
    # a share of the rows and their tokens only, so that what is sorted stays small
    share = some.select(F.xxhash64("text").alias("h"), "text").where(
        F.pmod("h", F.lit(max(1, some.count() // (2 * train_docs)))) == 0)
    few = share.mapInArrow(cut, "h long, text string").orderBy("h", "text").limit(train_docs).select("text")
    blob = train_once(few, lambda t: train(
        [f for x in sorted(t.column("text").to_pylist()) if len((f := Field(x, base_spans(x))).label)]))
    return unpack(blob) if blob else train([])


def _detect_task(model, names, at, add):
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                yield add(part, [find(t or "", model) for t in part.column(at).to_pylist()])

    return run


def detect(docs: DataFrame, model=None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, base), one
    row per input row: counts and hash of the base spans, and all spans as
    kind:start:end in code points. Null texts count as empty (no span); a null
    doc_id keeps its row. Extra columns are ignored."""
    model = model or fit(docs)

    def add(part, found):
        counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
        base = [written(b) for b, _ in found]
        digest = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string())
        return pa.RecordBatch.from_arrays(
            [part.column(0), *counts, digest, pa.array([written(s) for _, s in found], pa.string()), pa.array(base, pa.string())],
            ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "base"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _detect_task(model, None, 1, add),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, base string")


def mask(text: str, spans) -> str:
    """Each span, or run of overlapping spans, becomes <KIND>."""
    out, end = [], 0
    for kind, s, e in spans:
        if s < end:
            if e > end:
                end = e
            continue
        out.append(text[end:s])
        out.append(f"<{kind.upper()}>")
        end = e
    return "".join(out) + text[end:]


def redact(docs: DataFrame, model=None) -> DataFrame:
    """``docs`` with all spans masked in the text; null texts stay null. Other
    columns are as they were."""
    model = model or fit(docs)
    names = docs.columns
    at = names.index("text")

    def add(part, found):
        texts = part.column(at).to_pylist()
        new = pa.array([t if t is None else mask(t, spans) for t, (_, spans) in zip(texts, found)], pa.string())
        cols = list(part.columns)
        cols[at] = new
        return pa.RecordBatch.from_arrays(cols, names)

    return docs.mapInArrow(_detect_task(model, names, at, add), docs.schema)
