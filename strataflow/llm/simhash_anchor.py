"""SimHash near-duplicates by anchor points: a covering code's words meet every pair of near fingerprints.

A fingerprint's 64 bits are two halves. Two fingerprints at distance 3 or less
differ in at most one bit of one half. On a half of 32 bits the anchors are the
words of the perfect Hamming code of length 31, with the last bit free: every half is
within distance 1 of an anchor (covering radius 1). Each fingerprint has a home anchor
in each half and is replicated to every anchor within 1 + 1: 17 at most. A near
pair therefore meets at the home anchor of either one. The replication does not grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import map_texts, rows_to_batches, stored
from strataflow.llm.components import components

#: Fingerprints of one anchor that one task compares at once with as many others.
BLOCK = 512
_FINGERPRINT = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprint_of(text: str, words: int = 3) -> int:
    """Fingerprint as a signed 64-bit number. Lower-cases A-Z only; no words gives 0."""
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    line, n = b" ".join(tokens), max(len(tokens) - words + 1, 1)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(words, len(tokens)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for i in range(0, n, 4096):
        hashes = np.array([digest(line[a:b], 42) for a, b in zip(starts[i : i + 4096], stops[i : i + 4096], strict=True)], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    return map_texts(docs, lambda text: (fingerprint_of(text),), "doc_id long, fp long", _FINGERPRINT)


def _syndromes(x: np.ndarray) -> np.ndarray:
    """Hamming syndromes of 31-bit words: the XOR of the numbers 1 to 31 of their set bits."""
    s = np.zeros(len(x), np.uint32)
    for bit in range(31):
        s ^= np.where((x >> np.uint32(bit)) & np.uint32(1), np.uint32(bit + 1), np.uint32(0))
    return s


def anchors_of(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 32-bit halves: (home anchor, rows by 17 with every anchor within distance 2; some of a row may repeat).

    With syndrome s, the code words within 2 are those reached by flipping bit s, or two bits whose numbers XOR to s.
    """
    last, word = half & np.uint32(1 << 31), half & np.uint32((1 << 31) - 1)
    s = _syndromes(word)
    flip = lambda k: np.where(k > 0, np.uint32(1) << np.maximum(k, 1).astype(np.uint32) - np.uint32(1), np.uint32(0))
    home = (word ^ flip(s)) | last
    out = [home, home ^ np.uint32(1 << 31)]
    seen = np.zeros((len(half), 32), bool)
    columns = []
    for i in range(1, 32):
        j = np.uint32(i) ^ s
        ok = (s > 0) & (j > i)  # each pair once; j = 0 is the single flip
        columns.append(np.where(ok, (word ^ flip(np.full(len(half), i, np.uint32)) ^ flip(j)) | last, home))
        seen[:, i] = ok
    table = np.stack(columns, 1)
    order = np.argsort(~seen[:, 1:], axis=1, kind="stable")[:, :15]
    return home, np.concatenate([np.stack(out, 1), np.take_along_axis(table, order, 1)], 1)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        every = b.column(0).to_numpy(zero_copy_only=False).astype("<i8")
        for at in range(0, len(every), 8192):
            fp = every[at : at + 8192]
            halves = fp.view("<u4").reshape(-1, 2)
            for h in (0, 1):
                home, near = anchors_of(np.ascontiguousarray(halves[:, h]))
                near = np.sort(near, 1)
                keep = np.concatenate([np.ones((len(fp), 1), bool), near[:, 1:] != near[:, :-1]], 1)
                rows = np.nonzero(keep)
                anchor = near[rows].astype(np.int64) | (h << 32)
                is_home = near[rows] == home[rows[0]]
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[rows[0]]), pa.array(is_home)], names=["anchor", "fp", "home"])


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _compare(distance: int):
    def links(fps: np.ndarray) -> Iterator[tuple[int, int]]:
        """A spanning forest of the links within one block pair: as many rows as it has fingerprints, at most."""
        words = fps.view("<u8")
        root = np.arange(len(fps))
        for i in range(len(fps) - 1):
            near = np.nonzero(np.bitwise_count(words[i + 1 :] ^ words[i]) <= distance)[0] + i + 1
            for r in set(root[near].tolist()) - {root[i]}:
                root[root == r] = root[i]
        for i in np.nonzero(root != np.arange(len(fps)))[0].tolist():
            yield int(fps[root[i]]), int(fps[i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows_to_batches(
            (e for b in batches for fps in b.column(0) for e in links(np.array(fps.as_py(), "<i8"))), _EDGE
        )

    return run


def link_fingerprints(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints of column ``fp``; their components are those of all near pairs.

    An anchor with more than ``BLOCK`` fingerprints is compared block by block, each pair of
    blocks in a group of its own, so no group is larger than two blocks.
    """
    if not 0 <= distance <= 3:
        raise ValueError("two halves with radius 1 serve distances up to 3")
    at = fps.select("fp").mapInArrow(_replicate, "anchor long, fp long, home boolean")
    sizes = at.groupBy("anchor").agg(F.count("*").alias("n"), F.max("home").alias("met")).where("n > 1 AND met")
    # Spark takes a fingerprint's up to 34 rows for one, so by its estimate it would broadcast what the driver can't hold.
    placed = at.join(sizes.hint("merge"), "anchor").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("long"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    paired = placed.select("anchor", "fp", "own", other.alias("other")).select("anchor", "fp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    groups = paired.groupBy("anchor", "i", "j").agg(F.array_sort(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1)
    return groups.select("fps").mapInArrow(_compare(distance), "a long, b long")


def near_duplicates(docs: DataFrame, distance: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links).

    Documents with one fingerprint are one node, so copies cost nothing. Null texts are empty ones, whose
    fingerprint 0 links like any other. A null doc_id never names a component that has another id.
    Rows of these joins grow with the documents and take several times their stored bytes in memory, so none is broadcast.
    """
    prints = stored(fingerprints(docs), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(link_fingerprints(nodes, distance))
    placed = nodes.join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(placed.join(ids.hint("merge"), "root").select("fp", "component_id"), "named")
    return prints.join(named.hint("merge"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, distance: int = 3) -> DataFrame:
    """The documents of ``docs``, one of each near-duplicate group: the one with the smallest doc_id.

    Where several rows carry that same doc_id all of them stay; documents without words are their own group of one text.
    """
    kept = near_duplicates(docs, distance).where("doc_id IS NULL OR doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    own = F.col("doc_id").cast("long")
    return docs.join(kept.hint("merge"), own.eqNullSafe(F.col("_kept")), "left_semi")
