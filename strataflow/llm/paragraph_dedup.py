"""Substring dedup by paragraphs: MinHash bands, exact Jaccard of the colliding ones, components of removals.

A paragraph is a line, and also each piece of a line that is cut. Lines are cut where the hash of two neighbouring words is least among
those around it, which depends on nothing further away: all cuts of a passage come again wherever else it stands, in a line
of its own or inside a longer one. Short lines are compared like any other.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import rows_to_batches, stored, texts_of, width_for
from strataflow.llm.components import components

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.999
#: Places on either side that a cut is compared with. Pieces have more words than that.
REACH = 4
#: Paragraphs of one bucket that one group compares with as many others.
BLOCK = 128
#: Texts whose paragraphs are named and hashed together: at most so many, and no more once they have so many characters.
_TEXTS_AT_ONCE, _CHARACTERS_AT_ONCE = 512, 1 << 19
#: Paragraphs with their words that are held as lists, if a group hasn't more.
_ROWS_AT_ONCE = 2048
_U = np.uint64


def tuned(similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows) with the fewest hashes, of at least two rows, that find a pair of that similarity with the recall asked for."""
    options = [(b * r, b, r) for r in range(2, 7) for b in range(1, 200) if 1 - (1 - similarity**r) ** b >= recall]
    return min(options)[1:]


def _cuts(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places where lines are cut: least of all within REACH, the first of equal ones, all of them inside the line."""
    n = len(hashes)
    if n < 2 * REACH + 2:
        return np.zeros(0, np.int64)
    mixed = (hashes[:-1] * _U(3) + hashes[1:] * _U(5)) * _U(0x9E3779B97F4A7C15)
    mixed ^= mixed >> _U(29)
    here = mixed[REACH : len(mixed) - REACH]
    least = np.ones(len(here), bool)
    for k in range(1, REACH + 1):
        least &= here < mixed[REACH - k : len(mixed) - REACH - k]
        least &= here <= mixed[REACH + k : len(mixed) - REACH + k]
    at = np.nonzero(least)[0] + REACH + 1
    line = np.searchsorted(starts, at, "right") - 1
    return at[(at - starts[line] > REACH) & (ends[line] - at > REACH)]


class Units:
    """The paragraphs of some texts: words ``starts`` to ``ends`` of each, by place, and how many each text has.

    Each line is one, then its pieces if there are several. A line of fewer words than a shingle is filled up with empty ones.
    """

    def __init__(self, texts: Iterable[str]):
        self.words: list[bytes] = []
        lines, bounds = [], [0]
        for text in texts:
            for line in text.encode().split(b"\n"):
                own = line.split()
                if own:
                    self.words += own
                    if len(own) < SHINGLE:
                        self.words += [b""] * (SHINGLE - len(own))
                    lines.append(len(self.words))
            bounds.append(len(self.words))
        n = len(self.words)
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, n)
        last = np.array(lines, np.int64)
        first = np.concatenate([[0], last[:-1]]).astype(np.int64) if lines else last
        cuts = _cuts(self.hashes, first, last)
        several = np.diff(np.searchsorted(cuts, np.append(first, n))) > 0
        edges = np.sort(np.concatenate([first, cuts]))
        a = np.concatenate([edges, first[several]])
        b = np.concatenate([np.append(edges[1:], n)[: len(edges)], last[several]])
        order = np.lexsort((-b, a))
        self.starts, self.ends = a[order], b[order]
        self.counts = np.diff(np.searchsorted(self.starts, bounds))
        self.pids = _names(self.hashes, self.starts, self.ends)


def _names(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ids (int64) of stretches of words: two polynomials of the words' hashes, from sums up to each word, and the length."""
    x = (ends - starts).astype(np.uint64)
    for base, odd in ((0x9E3779B97F4A7C13, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4B, 0xFF51AFD7ED558CCD)):
        mixed = (hashes ^ (hashes >> _U(29))) * _U(odd)
        powers = np.full(len(hashes) + 1, base, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * powers[:-1], dtype=np.uint64)])
        back = np.full(len(hashes) + 1, pow(base, -1, 1 << 64), np.uint64)
        back[0] = 1
        np.multiply.accumulate(back, out=back)
        x ^= (sums[ends] - sums[starts]) * back[starts]
        x ^= x >> _U(32)
        x *= _U(odd)
        x ^= x >> _U(29)
    return x.view(np.int64)


def _together(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of rows that are taken together."""
    first, held, size = 0, [], 0
    for at, t in enumerate(batch.column(column)):
        held.append(t.as_py())
        size += len(held[-1])
        if len(held) == _TEXTS_AT_ONCE or size > _CHARACTERS_AT_ONCE:
            yield first, held
            first, held, size = at + 1, [], 0
    if held:
        yield first, held


def _pieces(text: str) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(number, words, word hashes) of all paragraphs."""
    u = Units([text])
    for number, (a, b) in enumerate(zip(u.starts.tolist(), u.ends.tolist(), strict=True)):
        yield number, u.words[a:b], u.hashes[a:b]


def _shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of all runs of SHINGLE words; there are that many in every paragraph."""
    n = len(hashes) - SHINGLE + 1
    x = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        x = (x ^ hashes[k : k + n]) * _U(0x9E3779B97F4A7C15)
        x ^= x >> _U(29)
    return x


_OCCURS = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("pids", pa.list_(pa.int64()))])
_BANDS = pa.schema([("pid", pa.int64()), ("key", pa.int64())])
_TEXTS = pa.schema([("pid", pa.int64()), ("words", pa.binary())])


def _pid(words: list[bytes]) -> int:
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return int(_names(hashes, np.array([0]), np.array([len(words)]))[0])


def _occurs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, texts in _together(b, 1):
            u = Units(texts)
            offsets = np.concatenate([[0], np.cumsum(u.counts)]).astype(np.int32)
            pids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(u.pids))
            ids, at = (b.column(k).slice(first, len(texts)) for k in (0, 2))
            yield pa.RecordBatch.from_arrays([ids, at, pids], schema=_OCCURS)


def few(similarity: float) -> int:
    """A paragraph of that many shingles or fewer is alike to those with the same shingles only."""
    return next(n for n in range(1000) if n + 1 >= similarity * (n + 2) - 1e-9)


def _banded(bands: int, width: int, similarity: float):
    rng = np.random.default_rng(11)
    odd = rng.integers(0, 1 << 63, bands * width, dtype=np.uint64) * _U(2) + _U(1)
    same = few(similarity)

    def keyed(texts: list[str], seen: set[int]) -> tuple[np.ndarray, np.ndarray] | None:
        u = Units(texts)
        pids, at = np.unique(u.pids, return_index=True)
        fresh = np.sort(at[np.fromiter((p not in seen for p in pids.tolist()), bool, len(pids))])
        if not len(fresh):
            return None
        pids, starts, ends = u.pids[fresh], u.starts[fresh], u.ends[fresh] - SHINGLE + 1
        seen.update(pids.tolist())
        every, bounds = _shingles(u.hashes), np.stack([starts, ends], 1).reshape(-1)
        low = []
        for a in odd:
            x = every * a
            x ^= x >> _U(31)
            # One value more, as the last paragraph may end with the last shingle.
            low.append(np.minimum.reduceat(np.append(x, x[-1]), bounds)[::2])
        keys = []
        # Where the shingles must be the same, one band finds all.
        wide = np.diff(bounds)[::2] > same
        for k in range(bands):
            x = np.full(len(pids), k + 1, np.uint64)
            for j in range(width):
                x = (x ^ low[k * width + j]) * _U(0xD6E8FEB86659FD93)
                x ^= x >> _U(32)
            keys.append(x[wide] if k else x)
        return np.concatenate([pids, *[pids[wide]] * (bands - 1)]), np.concatenate(keys).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: set[int] = set()
            for _, texts in _together(b, 1):
                found = keyed(texts, seen)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], schema=_BANDS)

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the paragraphs asked for. Another text with the same digest doesn't have them."""

    def rows() -> Iterator[tuple]:
        for b in batches:
            for first, texts in _together(b, 0):
                u = Units(texts)
                asked = b.column(1).slice(first, len(texts))
                fields, sizes = asked.flatten(), np.diff(asked.offsets.to_numpy())
                n, pids = (fields.field(k).to_numpy() for k in range(2))
                text = np.repeat(np.arange(len(texts)), sizes)
                at = n + (np.cumsum(u.counts) - u.counts)[text]
                own = np.nonzero(n < u.counts[text])[0]
                own = own[u.pids[at[own]] == pids[own]]
                at = at[own]
                for pid, x, y in zip(pids[own].tolist(), u.starts[at].tolist(), u.ends[at].tolist(), strict=True):
                    yield pid, b" ".join(u.words[x:y])

    yield from rows_to_batches(rows(), _TEXTS)


def similar(a: set, b: set, similarity: float) -> bool:
    common = len(a & b)
    return common >= similarity * (len(a) + len(b) - common) - 1e-9


def _verify(similarity: float):
    def shingles(words: bytes) -> set:
        w = words.split(b" ")
        return set(zip(*(w[k:] for k in range(SHINGLE)), strict=False))

    def links(pids: list[int], words: list[bytes], mine: list[bool], within: bool) -> Iterator[tuple[int, int]]:
        """A spanning forest of the links of one group, so at most a row for each paragraph. Two blocks are compared with each other only."""
        sets = [shingles(w) for w in words]
        root = list(range(len(pids)))
        for i in range(len(pids)):
            for j in range(i + 1, len(pids)):
                if root[i] == root[j] or not within and mine[i] == mine[j]:
                    continue
                few, many = sorted((len(sets[i]), len(sets[j])))
                if few >= similarity * many - 1e-9 and similar(sets[i], sets[j], similarity):
                    old, new = root[j], root[i]
                    root = [new if r == old else r for r in root]
                    yield pids[i], pids[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                within, edges = b.column(1).to_pylist(), b.column(0).offsets.to_pylist()
                fields, done = b.column(0).values, 0
                while done < len(within):
                    # Groups that are turned into lists together: at most so many rows, or one group.
                    end = max(done + 1, bisect_right(edges, edges[done] + _ROWS_AT_ONCE) - 1)
                    first = edges[done]
                    held = fields.slice(first, edges[end] - first)
                    columns = [held.field(k).to_pylist() for k in range(3)]
                    for k in range(done, end):
                        yield from links(*(c[edges[k] - first : edges[k + 1] - first] for c in columns), within[k])
                    done = end

        yield from rows_to_batches(rows(), pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def _near(docs: DataFrame, similarity: float) -> DataFrame:
    """(``pid``, ``key``) of all buckets that hold different paragraphs."""
    bands, width = tuned(similarity)
    own, n = texts_of(docs), max(width_for(docs), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = own.mapInArrow(_banded(bands, width, similarity), "pid long, key long")
    # A key that can't be null gets no filter from the join, so both readers of this exchange share it.
    rows = rows.select("pid", F.coalesce("key", F.lit(0).cast("long")).alias("key")).repartition(n, "key")
    met = rows.groupBy("key").agg(F.min("pid").alias("least"), F.max("pid").alias("most")).where("least <> most").select("key")
    return stored(rows.join(met, "key").distinct(), "near", release=True)


def _occurrences(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, at (a digest of the text), pids of its paragraphs in order, row (a number)."""
    own = texts_of(docs).withColumn("at", F.xxhash64("text"))
    found = own.mapInArrow(_occurs, "doc_id long, at long, pids array<long>")
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "occurs")


def _each(occurs: DataFrame) -> DataFrame:
    return occurs.select("doc_id", "at", "row", F.posexplode("pids").alias("n", "pid"))


def _buckets(near: DataFrame) -> DataFrame:
    """(``key``, ``blocks``) of the buckets to compare: of those with the same paragraphs, which have the same links, one.

    They are told by the number of paragraphs and three sums of 64 bits over them.
    """
    marks = [F.bit_xor(F.xxhash64("pid", F.lit(k))).alias(f"mark{k}") for k in range(3)]
    every = near.groupBy("key").agg(F.count("*").alias("n"), *marks)
    return every.groupBy("n", "mark0", "mark1", "mark2").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks"))


def _compared(docs: DataFrame, occurs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Links, and the paragraphs that are there twice or share a bucket: ``pid``, ``size``, ``first`` (their first place), ``met`` (share a bucket)."""
    near = _near(docs, similarity)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "n", "at")
    firsts = _each(occurs).groupBy("pid").agg(F.min(place).alias("first"), F.count("*").alias("size"))
    firsts = firsts.join(near.select("pid", F.lit(True).alias("met")).distinct(), "pid", "left").where("met OR size > 1")
    firsts = stored(firsts, "firsts", release=True)
    asked = firsts.where("met").groupBy(F.col("first.doc_id").alias("id"), F.col("first.at").alias("at")).agg(F.collect_list(F.struct("first.n", "pid")).alias("asked"))
    own = texts_of(docs).withColumn("at", F.xxhash64("text"))
    holders = own.join(asked, (own["at"] == asked["at"]) & own["doc_id"].eqNullSafe(asked["id"])).select("text", "asked")
    texts = holders.mapInArrow(_words, "pid long, words binary")
    # Repeated rows of one id give their paragraphs again.
    texts = stored(texts.groupBy("pid").agg(F.first("words").alias("words")), "texts", release=True)
    placed = near.join(_buckets(near), "key").withColumn("own", F.pmod(F.xxhash64("pid"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = placed.select("key", "pid", "own", other.alias("other"))
    pairs = pairs.select("key", "pid", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("mine"))
    groups = pairs.join(texts, "pid").groupBy("key", "i", "j").agg(F.collect_list(F.struct("pid", "words", "mine")).alias("units")).where(F.size("units") > 1)
    found = groups.select("units", (F.col("i") == F.col("j")).alias("within")).mapInArrow(_verify(similarity), "a long, b long")
    return found.distinct(), firsts


def links(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (``a``, ``b``) between ids of different paragraphs of that Jaccard similarity or more; components are those of all links found.

    Only buckets with different paragraphs are compared, and large ones block by block. Words are read again where one of their
    paragraphs stands first.
    """
    return _compared(docs, _occurrences(docs), similarity)[0]


def cut_paragraphs(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_paragraphs, n_removed, n_links, first_ids.

    A line that is cut counts by itself and by its pieces, as ``n_paragraphs``, ``n_removed`` and ``n_links`` do.
    Of each class of alike paragraphs the first (smallest doc_id, then position) stays. ``n_links`` counts a document's
    paragraphs that are alike to another one, ``first_ids`` are the other documents that hold what stays in their place.
    Null and empty texts have no paragraphs; null doc_ids come last. Rows with one doc_id are taken as one document.
    """
    occurs = _occurrences(docs)
    edges, firsts = _compared(docs, occurs, similarity)
    edges = stored(edges, "links", release=True)
    roots = stored(components(edges), "roots")
    named = firsts.join(roots.withColumnRenamed("node", "pid"), "pid", "left").select("pid", "first", "size", F.coalesce("root", "pid").alias("root"))
    classes = named.groupBy("root").agg(F.min("first").alias("first"), F.sum("size").alias("size")).where("size > 1")
    known = named.select("pid", "root").join(classes, "root").select("pid", "first")
    alike = _each(occurs).join(known, "pid").withColumn("stays", (F.col("row") == F.col("first.row")) & (F.col("n") == F.col("first.n")))
    other = F.when(~F.col("first.doc_id").eqNullSafe(F.col("doc_id")), F.col("first.doc_id"))
    sums = alike.groupBy("doc_id").agg(
        F.count("*").alias("n_links"), F.sum((~F.col("stays")).cast("long")).alias("n_removed"), F.array_sort(F.collect_set(other)).alias("first_ids")
    )
    totals = occurs.groupBy("doc_id").agg(F.sum(F.size("pids").cast("long")).alias("n_paragraphs"))
    zero, none = F.lit(0).cast("long"), F.array().cast("array<long>")
    met = totals.alias("t").join(sums.alias("s"), F.col("t.doc_id").eqNullSafe(F.col("s.doc_id")), "left")
    return met.select(
        F.col("t.doc_id").alias("doc_id"), "n_paragraphs", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_links", zero).alias("n_links"), F.coalesce("first_ids", none).alias("first_ids")
    )
