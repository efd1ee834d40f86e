"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans around them.

The field scores whole candidate segments of a stretch of words that hold a digit or an @: shape features
of the segment as one piece (digits, groups, dots, Luhn, neighbours). Dynamic programming over stretches, with
segments of at most ``MAX_TOKENS`` tokens, chooses boundaries and kinds together. It is trained here, on stretches
of a bounded sample of documents that the fixed patterns label, by maximum likelihood.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import map_texts, texts_of

KINDS = ("email", "ip", "card", "phone")
# The patterns of the base spans. Digits and dots are matched possessively, which finds the same matches in linear time.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT_OR_AT = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s|[^A-Za-z0-9\s]")

MAX_TOKENS = 24
_ORDER = itemgetter(0, 2)
#: Tokens whose candidate segments are scored together; the programme runs through stretches of any length.
_BLOCK_TOKENS = 400
N_FEATURES = 21


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", max(last, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind), by start and then kind."""
    spans = [(s, e, 0) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            spans.append((*m.span(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = re.sub("[^0-9]", "", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((*m.span(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
                spans.append((*m.span(), 3))
    return sorted(spans, key=_ORDER)


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Runs of blank-separated words that each hold a digit or an @."""
    m, start, end = _DIGIT_OR_AT.search(text), -1, -1
    while m:
        a = m.start()
        while a > max(end, 0) and not text[a - 1].isspace():
            a -= 1
        b = m.end()
        while b < len(text) and not text[b].isspace():
            b += 1
        if start >= 0 and a == end + 1 and text[end] == " ":
            end = b
        else:
            if start >= 0:
                yield start, end
            start, end = a, b
        m = _DIGIT_OR_AT.search(text, b)
    if start >= 0:
        yield start, end


def features(text: str, start: int, end: int) -> np.ndarray:
    """Of the segment as a whole and of its two neighbours."""
    piece = text[start:end]
    digits = re.sub("[^0-9]", "", piece)
    groups = re.findall("[0-9]+", piece)
    n, letters = len(digits), any(c.isalpha() for c in piece)
    before, after = text[start - 1 : start], text[end : end + 1]
    ats, dots = piece.count("@"), piece.count(".")
    dotted = len(groups) == 4 and dots == 3 and len(piece) == n + 3
    return np.array([
        1, ats == 1, ats == 1 and "." in piece.partition("@")[2], ats == 1 and piece[0] != "@" and piece[-1].isalnum(),
        letters, " " in piece, dots == 3, dotted, dotted and all(len(g) <= 3 and int(g) <= 255 for g in groups),
        12 <= n <= 19, 12 <= n <= 19 and luhn(digits), len(piece) == n, piece[0] == "+", 9 <= n <= 15, n > 19,
        n < 9, "(" in piece and ")" in piece, "-" in piece, before.isalnum() or before in "+.@", after.isalnum() or after == "@", not piece[0].isalnum() and piece[0] != "+",
    ], float)


class _Lattice:
    """The candidate segments of one stretch: token bounds and features of those that begin and end with a visible token."""

    def __init__(self, text: str, start: int, end: int):
        found = list(_TOKEN.finditer(text, start, end))
        self.bounds = [(m.start(), m.end()) for m in found]
        seen = [not m[0].isspace() for m in found]
        useful = [m[0].isdigit() or m[0] == "@" for m in found]
        self.segments = [
            (i, j) for i in range(len(found)) if seen[i] for j in range(i, min(i + MAX_TOKENS, len(found))) if seen[j] and any(useful[i : j + 1])
        ]
        self.x = np.array([features(text, self.bounds[i][0], self.bounds[j][1]) for i, j in self.segments]).reshape(-1, N_FEATURES)
        self.ending: list[list[int]] = [[] for _ in found]
        for k, (_, j) in enumerate(self.segments):
            self.ending[j].append(k)

    def gradient(self, scores: np.ndarray) -> tuple[np.ndarray, float]:
        """Expected counts of every segment and kind, and the log partition function."""
        n, total = len(self.bounds), np.logaddexp.reduce(scores, 1)
        ahead, behind = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(n):
            ahead[j + 1] = np.logaddexp.reduce([ahead[j], *(ahead[self.segments[k][0]] + total[k] for k in self.ending[j])])
        starting: list[list[int]] = [[] for _ in range(n)]
        for k, (i, _) in enumerate(self.segments):
            starting[i].append(k)
        for i in range(n - 1, -1, -1):
            behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[self.segments[k][1] + 1] + total[k] for k in starting[i])])
        edge = np.array([ahead[i] + behind[j + 1] for i, j in self.segments]) - ahead[n]
        return np.exp(scores + edge[:, None]), ahead[n]


def best_spans(text: str, start: int, end: int, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """The best segmentation of a stretch as (start, end, kind); a token outside any segment scores 0.

    A state needs the ``MAX_TOKENS`` before it only, so features of a block of tokens are held at a time; what stays of a token is its bounds, score and way back.
    """
    bounds, seen, useful = [], [], [0]
    top, back = [0.0], [None]
    tokens = _TOKEN.finditer(text, start, end)
    while block := list(itertools.islice(tokens, _BLOCK_TOKENS)):
        first = len(bounds)
        for m in block:
            bounds.append(m.span())
            seen.append(not m[0].isspace())
            useful.append(useful[-1] + (m[0].isdigit() or m[0] == "@"))
        segments = [
            (i, j) for j in range(first, len(bounds)) if seen[j] for i in range(max(0, j - MAX_TOKENS + 1), j + 1) if seen[i] and useful[j + 1] > useful[i]
        ]
        x = np.array([features(text, bounds[i][0], bounds[j][1]) for i, j in segments]).reshape(-1, N_FEATURES)
        scores = np.einsum("ij,jk->ik", x, weights)
        kind, high = scores.argmax(1).tolist(), scores.max(1).tolist()
        k = 0
        for j in range(first, len(bounds)):
            score, how = top[j], None
            while k < len(segments) and segments[k][1] == j:
                s = top[segments[k][0]] + high[k]
                if s > score:
                    score, how = s, (segments[k][0], kind[k])
                k += 1
            top.append(score)
            back.append(how)
    out, j = [], len(bounds)
    while j:
        if back[j] is None:
            j -= 1
        else:
            i, kind_of = back[j]
            out.append((bounds[i][0], bounds[j - 1][1], kind_of))
            j = i
    return out[::-1]


def fit(samples: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 60) -> np.ndarray | None:
    """Weights (features by kinds) that maximise the likelihood of labelled stretches, by gradient steps with a square penalty."""
    held = []
    for text, spans in samples:
        lattice = _Lattice(text, 0, len(text))
        at = {(lattice.bounds[i][0], lattice.bounds[j][1]): k for k, (i, j) in enumerate(lattice.segments)}
        gold = np.zeros((len(lattice.segments), len(KINDS)))
        for s, e, kind in spans:
            if (s, e) in at:
                gold[at[s, e], kind] = 1
        if len(lattice.segments):
            held.append((lattice, gold))
    if not held:
        return None
    w, speed = np.zeros((N_FEATURES, len(KINDS))), np.zeros((N_FEATURES, len(KINDS)))
    w[0] = -4
    for _ in range(rounds):
        slope = -1e-3 * w * len(held)
        for lattice, gold in held:
            expected, _ = lattice.gradient(np.einsum("ij,jk->ik", lattice.x, w))
            slope += np.einsum("ij,ik->jk", lattice.x, gold - expected)
        speed += slope**2
        w = w + 0.5 * slope / np.sqrt(speed + 1e-9)
    return w


def train(docs: DataFrame, sample_docs: int = 200, sample_stretches: int = 150) -> np.ndarray | None:
    """Weights from at most ``sample_stretches`` stretches of up to 200 characters, of the ``sample_docs`` documents with an @ or + (then those with any
    digit) and the smallest hash.

    Only the fit is bounded; the patterns and the field then run over every whole text.
    """
    own = texts_of(docs).where("doc_id IS NOT NULL AND text RLIKE '[0-9@]'")
    rich = F.col("text").contains("@") | F.col("text").contains("+")
    # Ids alone are ranked; at most ``sample_docs`` of them are broadcast to fetch the texts.
    ids = own.groupBy("doc_id").agg(F.max(rich).alias("rich")).orderBy(F.desc("rich"), F.xxhash64("doc_id"), "doc_id").limit(sample_docs).select("doc_id")
    picked = own.join(F.broadcast(ids), "doc_id")

    def row(text: str) -> tuple[list[str]]:
        parts = [text[max(a - 1, 0) : b + 1].replace("\n", " ") for a, b in stretches(text) if b - a <= 200]
        return (parts,)

    schema = pa.schema([("doc_id", pa.int64()), ("parts", pa.list_(pa.string()))])
    found = map_texts(picked, row, "doc_id long, parts array<string>", schema).selectExpr("explode(parts) AS part").distinct()
    rows = found.orderBy(F.xxhash64("part"), "part").limit(sample_stretches).collect()
    return fit([(r.part, base_spans(r.part)) for r in rows])


def all_spans(text: str, weights: np.ndarray | None, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The base spans, and the field's that overlap none of them."""
    if weights is None:
        return base
    taken = sorted((s, e) for s, e, _ in base)
    added, first = [], 0
    for a, b in stretches(text):
        while first < len(taken) and taken[first][1] <= a:
            first += 1
        inside = [(s, e) for s, e in itertools.takewhile(lambda x: x[0] < b, itertools.islice(taken, first, None)) if e > a]
        if inside and sum(e - s for s, e in inside) >= b - a - 2:
            continue
        for s, e, kind in best_spans(text, a, b, weights):
            if all(e <= s2 or s >= e2 for s2, e2 in inside):
                added.append((s, e, kind))
    return sorted(base + added, key=_ORDER)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


_FOUND = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, counts of base spans by kind, base_sha256, spans. Null and empty texts have none."""
    weights = train(docs)

    def row(text: str) -> tuple:
        base = base_spans(text)
        counts = [sum(k == kind for *_, k in base) for kind in range(len(KINDS))]
        return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(all_spans(text, weights, base)))

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return map_texts(docs, row, schema, _FOUND)


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns; every span of a text is replaced by its kind in angle brackets. Overlaps are masked as one."""
    weights, at = train(docs), docs.columns.index("text")

    def masked(text: str | None) -> str | None:
        spans = all_spans(text, weights, base_spans(text)) if text else []
        out, last = [], 0
        for s, e, k in spans:
            if s >= last:
                out += [text[last:s], f"<{KINDS[k]}>"]
            last = max(last, e)
        return "".join([*out, text[last:]]) if spans else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = list(b.columns)
            columns[at] = pa.array((masked(t.as_py()) for t in b.column(at)), b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
