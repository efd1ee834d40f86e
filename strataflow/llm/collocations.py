"""Phrases whose words stand together more often than by chance, from sorted streams of counts.

The layout is that of external-memory language model estimation:

1. Words are counted per lang; those with ``least`` occurrences get ordinals from a transducer vocabulary. A phrase with a rarer word
   can't be a candidate, as no phrase occurs more often than a part of it.
2. Every such word starts a window of up to five ordinals that ends with its piece or before a rarer word. Equal windows are merged in the task,
   then dealt by ranges and sorted: the stream in prefix order. Windows with a common beginning stand together, so each run is the count
   of a phrase. Ranges are cut by a sample of windows, which decides about balance only; a run across a cut is put together afterwards.
3. Frequent counts are read as two streams. Sorted by a phrase's first words the stream meets the candidates' left parts, sorted by its last words
   their right parts; the counts of longer phrases without their last and without their first word give the extensions. All of these are merge joins
   of sorted streams, none builds a hash table.

Null text is empty, null lang is ``und``. Repeated rows count each; an empty table, or one without frequent phrases, gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import rows_to_batches, stored, width_for
from strataflow.llm.vocabulary import Vocabulary, build, joined, stretches

LEAST, TOP, LONGEST = 100, 2000, 5
#: Windows sampled to set the ranges: so many for a range, within these bounds.
PER_RANGE, SAMPLE = 40, (20_000, 400_000)
_HELD_WORDS = 300_000
_LOW = (1 << 32) - 1

_WORD = re.compile(rb"[^\x20\x09.,;:!?\x0A-\x0D]+")
_BREAK = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_IS_WORD = np.array([bool(_WORD.match(bytes([b]))) for b in range(256)])
_ENDS_PIECE = ~_IS_WORD & ~np.isin(np.arange(256), [0x20, 0x09])


def _cut(text: bytes, at: int) -> int:
    found = _BREAK.search(text, at)
    return found.start() if found else len(text)


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


_WORDS = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("n", pa.int64())])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words; a null word has the number of all of them."""

    def rows() -> Iterator[tuple]:
        held: dict[str, Counter] = {}

        def drain() -> Iterator[tuple]:
            for lang, counter in held.items():
                yield lang, None, sum(counter.values())
                yield from ((lang, word, n) for word, n in counter.items())
            held.clear()

        for b in batches:
            for lang, text in zip(b.column(0), b.column(1).cast(pa.binary()), strict=True):
                counter = held.setdefault(lang.as_py(), Counter())
                for data, _, _ in joined([text.as_py()], b" ", _cut):
                    counter.update(_WORD.findall(data.lower()))
                if sum(map(len, held.values())) > _HELD_WORDS:
                    yield from drain()
        yield from drain()

    yield from rows_to_batches(rows(), _WORDS)


def windows(ordinals: np.ndarray, joined_to_next: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct windows, in order, as rows of five numbers (ordinal + 1, 0 for none), and how often each occurs.

    ``joined_to_next`` says whether a word and the next one are in one piece. Pairs get ranks in order, so that a window is one number of 64 bits.
    """
    n = len(ordinals)
    if not n:
        return np.zeros((0, LONGEST), np.int64), np.zeros(0, np.int64)
    ids, ranks = np.unique(ordinals + 1, return_inverse=True)
    known = ids[ranks] > 0
    reach = np.zeros((LONGEST, n + LONGEST), bool)
    reach[0, :n] = known
    for k in range(1, min(LONGEST, n)):
        reach[k, : n - k] = reach[k - 1, : n - k] & joined_to_next[k - 1 : n - 1] & known[k:]
    padded = np.concatenate([ranks + 1, np.zeros(LONGEST, np.int64)]).astype(np.int64)
    word = [np.where(reach[k, :n], padded[k : n + k], 0) for k in range(LONGEST)]
    base = len(ids) + 1
    pair, second = (word[0] * base + word[1], word[2] * base + word[3])
    pairs = np.unique(np.concatenate([pair, second]))
    low = np.searchsorted(pairs, pair) if len(pairs) * len(pairs) * base < 1 << 62 else None
    if low is None:
        rows, counts = np.unique(np.stack(word, 1)[known], axis=0, return_counts=True)
    else:
        code = (low * len(pairs) + np.searchsorted(pairs, second)) * base + word[4]
        code, counts = np.unique(code[known], return_counts=True)
        a, b = pairs[code // base // len(pairs)], pairs[code // base % len(pairs)]
        rows = np.stack([a // base, a % base, b // base, b % base, code % base], 1)
    return np.concatenate([[0], ids])[rows], counts


_WINDOWS = pa.schema([("bucket", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("n", pa.int64())])
_WINDOWS_DDL = "bucket int, a long, b long, c long, n long"


def _emit(vocabulary: Vocabulary, cuts: list[tuple[int, int, int]]):
    """Windows of each buffer of texts, packed two ordinals a number, with the range they belong to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for lang in sorted(set(langs)):
                for data, _, _ in joined((texts[i].as_py() for i, x in enumerate(langs) if x == lang), b"\n", _cut):
                    yield from _of_buffer(lang, data)

    def _of_buffer(lang: str, data: bytes) -> Iterator[pa.RecordBatch]:
        codes = np.frombuffer(data.lower(), np.uint8)
        starts, ends = stretches(_IS_WORD[codes])
        ends_before = np.concatenate([[0], np.cumsum(_ENDS_PIECE[codes], dtype=np.int32)])
        together = ends_before[starts[1:]] == ends_before[ends[:-1]] if len(starts) else np.zeros(0, bool)
        rows, counts = windows(vocabulary.ordinals(lang.encode(), codes, starts, ends), together)
        a, b, c = rows[:, 0] << 32 | rows[:, 1], rows[:, 2] << 32 | rows[:, 3], rows[:, 4]
        edges = [bisect_left(range(len(a)), cut, key=lambda i: (a[i], b[i], c[i])) for cut in cuts]
        bucket = np.repeat(np.arange(len(cuts) + 1), np.diff([0, *edges, len(a)]))
        for at in range(0, len(a), 50_000):
            own = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[own], f.type) for x, f in zip((bucket, a, b, c, counts), _WINDOWS, strict=True)], schema=_WINDOWS
            )

    return run


_GRAMS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("n", pa.int64())])


def _runs(least: int):
    """Counts of the common beginnings of sorted windows. A run inside a batch is whole and goes on if it is frequent; the first and the last
    of a batch may continue elsewhere and go on as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, c, n = (batch.column(k).to_numpy() for k in range(4))
            if not len(a):
                continue
            new = np.zeros(len(a), bool)
            new[0] = True
            out, none = [], np.zeros(len(a), np.int64)
            high = (a & ~_LOW, b & ~_LOW)
            # The beginnings of one to five words, and the last word of each.
            for begin, word in (
                ((high[0], none, none), a >> 32),
                ((a, none, none), a & _LOW),
                ((a, high[1], none), b >> 32),
                ((a, b, none), b & _LOW),
                ((a, b, c), c),
            ):
                for x in begin:
                    new[1:] |= x[1:] != x[:-1]
                first = np.nonzero(new)[0]
                sums = np.add.reduceat(n, first)
                go = sums >= least
                go[[0, -1]] = True
                go &= word[first] > 0
                out.append((*(x[first[go]] for x in begin), sums[go]))
            columns = [np.concatenate(x) for x in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], schema=_GRAMS)

    return run


def _cuts(texts: DataFrame, vocabulary: Vocabulary, words: int, ranges: int) -> list[tuple[int, int, int]]:
    """Where the ranges of windows begin, from some windows at random. They decide which task counts a window, not whether it is counted."""
    wanted = min(max(PER_RANGE * ranges, SAMPLE[0]), SAMPLE[1])
    some = texts.sample(min(1.0, 20 * wanted / max(words, 1)), seed=1).mapInArrow(_emit(vocabulary, []), _WINDOWS_DDL)
    keys = some.sample(0.05, seed=2).select("a", "b", "c").limit(SAMPLE[1]).toPandas().sort_values(["a", "b", "c"])
    at = np.linspace(0, len(keys), ranges, endpoint=False).astype(int)[1:]
    return sorted({tuple(int(x) for x in keys.iloc[i]) for i in at}) if len(keys) else []


def frequent(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, Vocabulary]:
    """All phrases of one to five words with at least ``least`` occurrences as (words array<long>, n); words per lang; the vocabulary that spells them."""
    texts = _read(docs)
    every = texts.mapInArrow(_count_words, "lang string, term binary, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    counted = stored(every.where((F.col("n") >= least) | F.col("term").isNull()), "words")
    sizes = counted.where("term IS NULL").select("lang", "n")
    vocabulary = build(counted.where("term IS NOT NULL").select("lang", "term"))
    words = sizes.agg(F.sum("n")).first()[0] or 0
    ranges = width_for(docs)
    cuts = _cuts(texts, vocabulary, words, ranges)
    dealt = texts.mapInArrow(_emit(vocabulary, cuts), _WINDOWS_DDL).repartitionById(len(cuts) + 1, "bucket")
    runs = dealt.select("a", "b", "c", "n").sortWithinPartitions("a", "b", "c").mapInArrow(_runs(least), "a long, b long, c long, n long")
    grams = runs.groupBy("a", "b", "c").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    low = f"{_LOW}L"
    ids = F.expr(f"filter(array(shiftright(a, 32), a & {low}, shiftright(b, 32), b & {low}, c), x -> x > 0)")
    return stored(grams.select(F.transform(ids, lambda x: x - 1).alias("words"), "n"), "grams"), sizes, vocabulary


_SPELT = pa.schema([("words", pa.list_(pa.int64())), ("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64())])


def _spell(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = b.column(0).to_pylist()
            pairs = {o: vocabulary.pair(o) for o in sorted({o for words in every for o in words})}
            rows = ((w, pairs[w[0]][0], " ".join([pairs[o][1].decode() for o in w]), a) for w, a in zip(every, b.column(1).to_pylist(), strict=True))
            yield from rows_to_batches(rows, _SPELT)

    return run


def score() -> Column:
    """floor(1000 * a * n / (l * r)); products have up to 38 digits."""
    wide = "CAST({} AS DECIMAL(19, 0))"
    return F.expr(f"({wide.format('a * 1000L')} * {wide.format('n')}) div ({wide.format('l')} * {wide.format('r')})")


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's first ``top`` phrases."""
    grams, sizes, vocabulary = frequent(docs, least)
    candidates = grams.where(F.size("words") >= 2)
    # Counts fall as phrases grow, so if any longer candidate is as frequent, one that is longer by a word is too.
    longer = grams.where(F.size("words") >= 3)
    shorn = [longer.select(F.expr(f"slice(words, {first}, size(words) - 1)").alias("words"), "n") for first in (1, 2)]
    extended = shorn[0].unionByName(shorn[1]).groupBy("words").agg(F.max("n").alias("wider"))
    open_ = candidates.join(extended.hint("merge"), "words", "left").where("wider IS NULL OR wider < n").select("words", "n")
    spelt = open_.mapInArrow(_spell(vocabulary), "words array<long>, lang string, phrase string, a long").join(sizes, "lang")
    cuts = spelt.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.expr("slice(words, 1, k)")).withColumn("right", F.expr("slice(words, k + 1, size(words) - k)"))
    by_prefix = grams.select(F.col("words").alias("left"), F.col("n").alias("l")).hint("merge")
    by_suffix = grams.select(F.col("words").alias("right"), F.col("n").alias("r")).hint("merge")
    scored = cuts.join(by_prefix, "left").join(by_suffix, "right")
    lowest = scored.withColumn("score", score()).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    ranked = lowest.select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score").withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
