"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from strataflow.llm.common import crc_fold

FEATURES = (
    "log_chars", "log_words", "word_length", "long_words", "short_words", "log_distinct", "top_word", "same_as_before",
    "symbols", "digits", "capitals", "stops", "line_length", "repeated_lines", "word_variety", "compressed",
)
_SYMBOLS = re.compile(r"[#*$%&|<>{}\[\]\\/=_~^@]")
_DIGITS = re.compile(r"[0-9]")
_CAPITALS = re.compile(r"[A-ZÀ-Þ]")
_STOPS = re.compile(r"[.!?,;:]")
#: What the compressor sees of a text: all of it, in blocks of this many characters.
_BLOCK = 1 << 16


def statistics(text: str) -> np.ndarray:
    """Transformed statistics of a whole text: logarithms of counts, square roots of shares. Empty text: all counts 0."""
    words = text.split()
    n, c = len(words), len(text)
    lines = [x for x in text.split("\n") if x.strip()]
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    per_word, per_char = max(n, 1), max(c, 1)
    lengths = np.fromiter(map(len, words), np.int64, n)
    same = sum(map(str.__eq__, words, words[1:]))
    packed = sum(len(zlib.compress(text[i : i + _BLOCK].encode(), 1)) for i in range(0, c, _BLOCK))
    root = math.sqrt
    return np.array([
        math.log1p(c), math.log1p(n), math.log1p(lengths.sum() / per_word), root((lengths > 12).sum() / per_word),
        root((lengths <= 3).sum() / per_word), math.log1p(len(counts)), root(max(counts.values(), default=0) / per_word), root(same / per_word),
        root(len(_SYMBOLS.findall(text)) / per_char), root(len(_DIGITS.findall(text)) / per_char), root(len(_CAPITALS.findall(text)) / per_char),
        root(len(_STOPS.findall(text)) / per_char), math.log1p(c / max(len(lines), 1)), root(1 - len(set(lines)) / max(len(lines), 1)),
        len(counts) / per_word, packed / (len(text.encode()) + 64),
    ])


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussian classes. ``inverses`` are the inverted Cholesky factors of their covariances, computed once."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    inverses: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, priors included."""
        z = (x - self.centre) / self.scale
        logs = []
        for k in (0, 1):
            y = np.einsum("ij,kj->ik", z - self.means[k], self.inverses[k])
            logs.append(self.log_priors[k] - 0.5 * self.log_dets[k] - 0.5 * np.einsum("ij,ij->i", y, y))
        return logs[1] - logs[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.offset, -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, shrink: float) -> Discriminant:
    """Class covariances are drawn by ``shrink`` to the pooled one, and that to its diagonal by as much."""
    centre, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - centre) / scale
    groups = [z[y == k] for k in (0, 1)]
    means = np.array([g.mean(0) for g in groups])
    own = [np.cov(g.T, bias=True) for g in groups]
    pooled = sum(len(g) * c for g, c in zip(groups, own, strict=True)) / len(z)
    target = (1 - shrink) * pooled + shrink * np.diag(np.diag(pooled))
    covs = [(1 - shrink) * c + shrink * target + 1e-4 * np.eye(len(centre)) for c in own]
    factors = np.array([np.linalg.cholesky(c) for c in covs])
    log_dets = np.array([2 * np.log(np.diag(f)).sum() for f in factors])
    log_priors = np.log([len(g) / len(z) for g in groups])
    return Discriminant(centre, scale, means, np.array([np.linalg.inv(f) for f in factors]), log_dets, log_priors)


def _calibrated(model: Discriminant, x: np.ndarray, y: np.ndarray) -> tuple[Discriminant, float]:
    """Slope and offset of a logistic curve through the margins (Newton's method), and the loss with them."""
    m = np.clip(model.margin(x), -50, 50)
    design, w = np.column_stack([m, np.ones_like(m)]), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -50, 50)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2), design.T @ (p - y) + 1e-3 * (w - [1, 0]))
        w = w - np.clip(step, -1, 1)
    p = np.clip(1 / (1 + np.exp(-np.clip(design @ w, -50, 50))), 1e-9, 1 - 1e-9)
    loss = -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    return replace(model, slope=max(float(w[0]), 1e-3), offset=float(w[1])), float(loss)


SHRINKS = (0.01, 0.05, 0.1, 0.2, 0.4, 0.7)


def train(docs: DataFrame, labels: DataFrame, train_rows: int = 20_000) -> Discriminant | None:
    """Fit on labelled documents outside the held-out fold.

    Only the fit uses a sample: the ``train_rows`` labels with the smallest hash of
    their doc_id, a bound that makes broadcasting them safe. A fifth of them
    (fold 1) chooses the shrinkage and the calibration. None when a class has fewer than 20 rows.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
        .where("doc_id IS NOT NULL AND y IN (0, 1)")
        .groupBy("doc_id").agg(F.min("y").alias("y"))
        .withColumn("fold", crc_fold(F.col("doc_id")))
        .where("fold <> 0")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_rows)
    )
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id").select("text", "y", "fold")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t.as_py() or "").tolist() for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1), b.column(2)], names=["x", "y", "fold"])

    rows = picked.mapInArrow(run, "x array<double>, y int, fold long").orderBy("y", "x").collect()
    y, fold = np.array([r.y for r in rows]), np.array([r.fold for r in rows])
    if len(rows) == 0 or min((y == 0).sum(), (y == 1).sum()) < 20:
        return None
    x = np.array([r.x for r in rows])
    held = fold == 1
    if min(*(((y == k) & held).sum() for k in (0, 1)), *(((y == k) & ~held).sum() for k in (0, 1))) < 10:
        return fit(x, y, SHRINKS[-2])
    shrink = min(SHRINKS, key=lambda s: _calibrated(fit(x[~held], y[~held], s), x[held], y[held])[1])
    curve = _calibrated(fit(x[~held], y[~held], shrink), x[held], y[held])[0]
    return replace(fit(x, y, shrink), slope=curve.slope, offset=curve.offset)


def score(docs: DataFrame, model: Discriminant | None) -> DataFrame:
    """``docs`` with its columns and a last one, ``_score``: 0 to 1, higher means label 1 is likelier.

    Null text counts as empty. Without a model (no labels to learn from) every score is 0.5.
    Rows that are alike get the same score; nothing but the text enters.
    """
    name = "_score"
    while name in docs.columns:
        name += "_"
    at = docs.columns.index("text")
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            if model is None:
                values = np.full(b.num_rows, 0.5)
            else:
                values = model.score(np.array([statistics(t.as_py() or "") for t in b.column(at)]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(values)], names=[*b.schema.names, name])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, cutoff: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. A null doc_id counts as not held out."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score(own, train(own, labels))
    held = F.coalesce(crc_fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select(
        "doc_id", held.alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= cutoff).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, cutoff: float = 0.3) -> DataFrame:
    """The documents whose score reaches the cutoff, with their own columns."""
    scored = score(docs, train(docs, labels))
    return scored.where(F.col(scored.columns[-1]) >= cutoff).select(*[F.col(f"`{c}`") for c in docs.columns])
