"""How the sources of a language differ in their words, counted through a minimal acyclic transducer.

1. One pass finds the terms of every document and in how many documents of its lang each stands; terms in at least ``min_docs`` stay.
2. They are sorted and built into transducers (``vocabulary``), which number them in UTF-8 order.
3. A second pass streams every text through the transducers; occurrences are counted per (lang, source, ordinal), merged in the task first.
4. Shares are whole numbers by long division, so nothing is rounded. Pairs of sources are compared over blocks of ordinals, and ties between
   terms are settled by ordinals; only the terms that are reported become strings again.

Null text, lang and source are empty text. An empty table gives no rows; a lang without kept terms gives its pairs with value 0; a group of no
other source has no pairs. Repeated rows count each. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import rows_to_batches, stored
from strataflow.llm.vocabulary import Vocabulary, build, joined, stretches

MIN_DOCS, TOP, SMOOTH = 30, 50, 5
#: Distinct terms a task counts before it hands them on.
_HELD_TERMS = 300_000
#: Distinct (source, term) counts a task merges before it hands them on.
_HELD_COUNTS = 1 << 21
#: Entries of a block of ordinals: sources of the lang times ordinals.
_BLOCK_CELLS, _BLOCK_ORDINALS = 1 << 20, 4096

_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
_BREAK = re.compile(rb"[^A-Za-z\x80-\xff]")
_IS_TERM = np.array([bool(_TERM.match(bytes([b]))) for b in range(256)])


def _cut(text: bytes, at: int) -> int:
    found = _BREAK.search(text, at)
    return found.start() if found else len(text)


def _read(docs: DataFrame) -> DataFrame:
    empty = F.lit("")
    return docs.select(*(F.coalesce(F.col(c), empty).alias(c) for c in ("lang", "source", "text")))


_DF = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("n", pa.int64())])


def _document_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        held: dict[str, Counter] = {}

        def drain() -> Iterator[tuple]:
            for lang, counter in held.items():
                yield from ((lang, term, n) for term, n in counter.items())
            held.clear()

        for b in batches:
            for lang, text in zip(b.column(0), b.column(2).cast(pa.binary()), strict=True):
                own: set[bytes] = set()
                for data, _, _ in joined([text.as_py()], b" ", _cut):
                    own.update(_TERM.findall(data.lower()))
                held.setdefault(lang.as_py(), Counter()).update(own)
                if sum(map(len, held.values())) > _HELD_TERMS:
                    yield from drain()
        yield from drain()

    yield from rows_to_batches(rows(), _DF)


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term) pairs in at least ``min_docs`` documents of the lang."""
    seen = _read(docs).mapInArrow(_document_terms, "lang string, term binary, n long")
    return seen.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()), ("n", pa.int64())])


def _recount(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, sources = b.column(0).to_pylist(), b.column(1).to_pylist()
            texts = b.column(2).cast(pa.binary())
            for lang in sorted(set(langs)):
                rows = [i for i, x in enumerate(langs) if x == lang]
                names = sorted({sources[i] for i in rows})
                place = {s: k for k, s in enumerate(names)}
                of_row = np.array([place[sources[i]] for i in rows])
                held: list[tuple[np.ndarray, np.ndarray]] = []
                for data, starts, owners in joined((texts[i].as_py() for i in rows), b" ", _cut):
                    codes = np.frombuffer(data.lower(), np.uint8)
                    first, stop = stretches(_IS_TERM[codes])
                    ordinals = vocabulary.ordinals(lang.encode(), codes, first, stop)
                    known = ordinals >= 0
                    source = of_row[owners[np.searchsorted(starts, first[known], side="right") - 1]]
                    held.append(np.unique(source.astype(np.int64) << 40 | ordinals[known], return_counts=True))
                    if sum(len(k) for k, _ in held) > _HELD_COUNTS:
                        yield from _told(lang, names, held)
                        held = []
                if held:
                    yield from _told(lang, names, held)

    return run


def _told(lang: str, names: list[str], held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, back, np.concatenate([c for _, c in held]))
    sources = pa.array(names, pa.string()).take(pa.array(keys >> 40))
    ordinals, counts = pa.array(keys & ((1 << 40) - 1), pa.int64()), pa.array(sums, pa.int64())
    for at in range(0, len(keys), 50_000):
        own = [x.slice(at, 50_000) for x in (sources, ordinals, counts)]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own[0]), pa.string()), *own], schema=_COUNTS)


def share(count: str, total: str) -> Column:
    """1 + floor(1e9 * (count + SMOOTH) / total) by long division in three steps of a thousand; no product passes 64 bits below 9e15."""
    rest, digits = f"({count} + {SMOOTH}L)", []
    for _ in range(3):
        step = f"({rest} * 1000L)"
        digits.append(f"({step} div {total})")
        rest = f"({step} % {total})"
    return F.expr(f"({digits[0]} * 1000L + {digits[1]}) * 1000L + {digits[2]} + 1L")


def _shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``share`` on arrays."""
    rest, out = counts + SMOOTH, np.zeros(np.broadcast(counts, total).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


_PAIR = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block of a lang's ordinals: for each two of its sources the sum of differences over the block. Every kept term has a count
    in some source, so the ordinals that occur in the block are all its terms."""

    def rows() -> Iterator[tuple]:
        for b in batches:
            for lang, names, totals, cells in zip(*(b.column(k) for k in range(4)), strict=True):
                lang, names = lang.as_py(), names.as_py()
                total = np.array(totals.as_py(), np.int64)[:, None]
                cells = cells.values if cells.is_valid else None
                if cells is None:
                    shares = np.zeros((len(names), 0), np.int64)
                else:
                    which, at, n = (cells.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                    ordinals, column = np.unique(at, return_inverse=True)
                    counts = np.zeros((len(names), len(ordinals)), np.int64)
                    counts[which, column] = n
                    shares = _shares(counts, total)
                for k, name in enumerate(names):
                    for other, value in zip(names, np.abs(shares - shares[k]).sum(1).tolist(), strict=True):
                        if other != name:
                            yield lang, name, other, value

    yield from rows_to_batches(rows(), _PAIR)


def _pairs(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """The sources of a lang as one list, as long as any one row of pairs of the result; blocks of ordinals meet it."""
    member = F.struct("source", "total")
    langs = groups.groupBy("lang").agg(F.array_sort(F.collect_list(member)).alias("m"))
    langs = langs.select("lang", F.col("m.source").alias("names"), F.col("m.total").alias("totals"))
    place = langs.select("lang", F.size("names").alias("many"), F.posexplode("names").alias("which", "source"))
    wide = F.greatest(F.lit(1), F.least(F.lit(_BLOCK_ORDINALS), F.lit(_BLOCK_CELLS) / F.col("many"))).cast("long")
    blocks = (
        counts.join(place, ["lang", "source"])
        .groupBy("lang", F.floor(F.col("ordinal") / wide).alias("block"))
        .agg(F.collect_list(F.struct("which", "ordinal", "n")).alias("cells"))
    )
    meet = langs.join(blocks, "lang", "left").select("lang", "names", "totals", "cells")
    parts = meet.mapInArrow(_compare, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


_TERMS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64()), ("rank", pa.int32())])


def _spelt(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, source, ordinal, value, rank = (b.column(k).to_pylist() for k in range(5))
            terms = {o: vocabulary.pair(o)[1].decode() for o in sorted(set(ordinal))}
            yield from rows_to_batches(zip(lang, source, (terms[o] for o in ordinal), value, rank, strict=True), _TERMS)

    return run


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank, for every occurring (lang, source)."""
    kept = stored(kept_terms(docs, min_docs), "terms")
    vocabulary = build(kept)
    texts = _read(docs)
    seen = texts.mapInArrow(_recount(vocabulary), "lang string, source string, ordinal long, n long")
    counts = stored(seen.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "counts")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    smooth = F.lit(SMOOTH).cast("long") * F.coalesce("v", F.lit(0).cast("long"))
    groups = (
        texts.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(sizes, "lang", "left")
        .select("lang", "source", (F.coalesce("n", F.lit(0).cast("long")) + smooth).alias("total"))
    )
    groups = stored(groups, "groups")
    pairs = _pairs(groups, counts)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))

    langs = counts.groupBy("lang").agg(F.sum("n").alias("n")).join(sizes, "lang").select("lang", (F.col("n") + smooth).alias("lang_total"))
    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n")).join(langs, "lang")
    whole = whole.select("ordinal", share("lang_n", "lang_total").alias("q"))
    over = counts.join(groups, ["lang", "source"]).join(whole, "ordinal")
    over = over.withColumn("value", share("n", "total") - F.col("q")).where("value > 0")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "ordinal"))
    best = over.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "source", "ordinal", "value", "rank")
    terms = best.mapInArrow(_spelt(vocabulary), "lang string, source string, item string, value long, rank int")
    return pairs.unionByName(terms.withColumn("part", F.lit("term")))
