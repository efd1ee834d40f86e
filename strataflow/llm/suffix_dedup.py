"""Substring dedup over suffixes, built block by block with a difference cover.

The rule: a byte goes if a 50-byte string that covers it also starts in a document with a
smaller doc_id. Which suffixes tie in their first 50 bytes is all that has to be known of the suffix array.

1. Cover sample. D is a perfect difference set modulo 21: any two positions have a shift below 21 that
   takes both into D. So two suffixes that tie for 50 bytes have cover samples at the same shift
   that tie for 30 bytes. Sample suffixes are sorted one bucket at a time, and each learns whether it
   shares its rank with another one.
2. Suffix buckets. Only suffixes with a tied cover sample within the next 21 bytes can tie themselves; the
   rest are settled by their sample's rank. The remaining ones are sorted one bucket at a time, and each learns
   whether a smaller document ties with it.

A bucket holds names of its suffixes (hashes of the 30 or 50 bytes), not their bytes: names are equal where the
strings are, and the order of unequal strings has no part in the rule. Names are wide enough that
two unequal strings are expected to share one far less than once in a corpus (``_name_bits``).

Texts travel in compressed chunks. A task holds one chunk or one bucket; both have bounded sizes, whatever the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import BATCH_ROWS, bit_planes, from_bit_planes, from_planes, input_bytes, pack, planes, rows_to_batches, texts_of, unpack, width_for

PERIOD, COVER, LENGTH = 21, (3, 6, 7, 12, 14), 50
SAMPLE = LENGTH - PERIOD + 1
CHUNK_BYTES = 8 << 20
_SLICE = 1 << 19
_LAST = np.iinfo(np.int64).max
_U = np.uint64

_CHUNK = pa.schema([("chunk", pa.int64()), ("body", pa.binary())])
_SENT = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("names", pa.binary())])
_TOLD = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("bits", pa.binary())])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of doc_id, text and whatever columns follow them."""
    first = TaskContext.get().partitionId() << 32

    def made() -> Iterator[tuple]:
        held, slices, size, n = [], [], 0, 0
        for b in batches:
            begin = 0
            for i, (d, t) in enumerate(zip(b.column(0), b.column(1), strict=True)):
                d, raw = d.as_py(), t.as_py().encode()
                held.append((_LAST if d is None else d, d is None, raw))
                size += len(raw)
                if size >= CHUNK_BYTES:
                    yield first + n, _body(held, [*slices, b.slice(begin, i + 1 - begin)])
                    held, slices, size, n, begin = [], [], 0, n + 1, i + 1
            slices.append(b.slice(begin))
        if held:
            yield first + n, _body(held, slices)

    for row in made():
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _CHUNK, strict=True)], schema=_CHUNK)


def _body(held: list[tuple], slices: list[pa.RecordBatch]) -> bytes:
    order = sorted(range(len(held)), key=lambda i: held[i][0])
    rest = pa.Table.from_batches([x.select(x.schema.names[2:]) for x in slices]) if slices[0].num_columns > 2 else None
    sink = pa.BufferOutputStream()
    if rest is not None:
        with pa.ipc.new_stream(sink, rest.schema) as out:
            out.write_table(rest.take(pa.array(order)).combine_chunks())
    held = [held[i] for i in order]
    ids, nulls = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.uint8)
    lengths = np.array([len(h[2]) for h in held], np.int64)
    return pack(ids, nulls, lengths, b"".join(h[2] for h in held), sink.getvalue().to_pybytes(), level=7)


class _Text:
    """A chunk's texts one after the other, with each position's document."""

    def __init__(self, body: bytes):
        self.ids, self.nulls, self.lengths, raw, self.rest = unpack(body, np.int64, np.uint8, np.int64, bytes, bytes)
        self.raw, n = raw, len(raw)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        padded = np.frombuffer(raw + bytes(8), np.uint8)
        self.words = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), shape=(n + 1,), strides=(1,))
        self.digests = [xxhash.xxh128_digest(self.text(i)) for i in range(len(self.ids))]

    def text(self, i: int) -> bytes:
        return self.raw[self.starts[i] : self.starts[i + 1]]

    def document(self, at: np.ndarray) -> np.ndarray:
        """The rank of each position's doc_id among the chunk's; rows with one id share it."""
        rank = np.unique(self.ids, return_inverse=True)[1].astype(np.int32)
        starts, out = self.starts.astype(np.int32), np.empty(len(at), np.int32)
        for i in range(0, len(at), _SLICE):
            out[i : i + _SLICE] = rank[np.searchsorted(starts, at[i : i + _SLICE], side="right") - 1]
        return out

    def names(self, at: np.ndarray, length: int, seed: int) -> np.ndarray:
        """64-bit names of the strings of that length at the positions."""
        out = np.empty(len(at), np.uint64)
        offsets = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
        for i in range(0, len(at), _SLICE):
            p = at[i : i + _SLICE]
            x = np.full(len(p), seed, np.uint64)
            for o in offsets:
                x ^= self.words[p + o]
                x *= _U(0x9E3779B97F4A7C15)
                x ^= x >> _U(32)
            x *= _U(0xD6E8FEB86659FD93)
            out[i : i + _SLICE] = x ^ (x >> _U(32))
        return out

    def samples(self) -> np.ndarray:
        """Positions of the cover within each document whose string of SAMPLE bytes ends in it."""
        found = []
        for start, n in zip(self.starts.tolist(), self.lengths.tolist(), strict=False):
            if n >= LENGTH:
                base = np.arange(0, n - SAMPLE + 1, PERIOD)[:, None] + np.array(COVER)
                found.append(start + base[base <= n - SAMPLE])
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def long_documents(self) -> np.ndarray:
        return np.nonzero(self.lengths >= LENGTH)[0]


class _Sorted:
    """A chunk's cover samples by bucket: in each, the distinct names in order, and where every sample's name is."""

    def __init__(self, text: _Text, buckets: int, width: int):
        self.at = text.samples()
        names = text.names(self.at, SAMPLE, 1)
        self.bucket = ((names >> _U(40)) % _U(buckets)).astype(np.int32)
        low = names & _U((1 << (8 * width)) - 1) if width < 8 else names
        if width <= 5:
            self.order = np.argsort(self.bucket.astype(np.uint64) << _U(8 * width) | low)
        else:
            self.order = np.lexsort((low, self.bucket))
        b, k = self.bucket[self.order], low[self.order]
        new = np.ones(len(k), bool)
        new[1:] = (b[1:] != b[:-1]) | (k[1:] != k[:-1])
        self.group = np.cumsum(new) - 1
        firsts = np.nonzero(new)[0]
        self.several = np.diff(np.append(firsts, len(k))) > 1
        self.keys, self.owners = k[firsts], b[firsts]
        self.edges = np.searchsorted(self.owners, np.arange(buckets + 1))


def _digest_bucket(digest: bytes, buckets: int) -> int:
    return int.from_bytes(digest[:8], "little") % buckets


def _send_samples(buckets: int, width: int):
    def sent(body: bytes) -> Iterator[tuple]:
        text = _Text(body)
        s = _Sorted(text, buckets, width)
        docs: dict[int, list[int]] = {}
        for i in text.long_documents().tolist():
            docs.setdefault(_digest_bucket(text.digests[i], buckets), []).append(i)
        for b in range(buckets):
            keys, own = s.keys[s.edges[b] : s.edges[b + 1]], docs.get(b, [])
            if len(keys) or own:
                steps = np.diff(keys, prepend=_U(0))
                whole = b"".join(text.digests[i] for i in own)
                yield b, pack(planes(steps, width), whole, text.ids[own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((b, c.as_py(), x) for batch in batches for c, body in zip(batch.column(0), batch.column(1), strict=True) for b, x in sent(body.as_py()))
        yield from rows_to_batches(rows, _SENT)

    return run


def _rank_samples(width: int):
    """One bucket: which names occur in several chunks, which whole documents in a smaller one."""

    def told(bucket: int, parts: list[dict]) -> Iterator[tuple]:
        keys, wholes = [], []
        for part in parts:
            low, digests, ids = unpack(part["names"], bytes, bytes, np.int64)
            keys.append(np.cumsum(from_planes(low, width), dtype=np.uint64))
            wholes.append(list(zip((digests[i : i + 16] for i in range(0, len(digests), 16)), ids.tolist(), strict=True)))
        every = np.sort(np.concatenate(keys))
        shared = every[1:][every[1:] == every[:-1]]
        least: dict[bytes, int] = {}
        for part in wholes:
            for digest, i in part:
                least[digest] = min(i, least.get(digest, i))
        for part, own, whole in zip(parts, keys, wholes, strict=True):
            spot = np.searchsorted(shared, own)
            hit = np.zeros(len(own), bool) if not len(shared) else shared[np.minimum(spot, len(shared) - 1)] == own
            copy = np.array([least[digest] < i for digest, i in whole], bool)
            yield part["chunk"], bucket, pack(np.packbits(hit), np.packbits(copy))

    return _by_bucket(told)


def _by_bucket(told):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for b, parts in zip(batch.column(0), batch.column(1), strict=True) for r in told(b.as_py(), parts.as_py()))
        yield from rows_to_batches(rows, _TOLD)

    return run


class _Candidates:
    """A chunk's suffixes that can tie with another: those with a tied cover sample ahead. Copies of whole documents are settled."""

    def __init__(self, text: _Text, told: dict[int, bytes], buckets: int, width: int):
        s = _Sorted(text, buckets, width)
        tied, self.copy, seen = s.several.copy(), np.zeros(len(text.ids), bool), {}
        replies = {b: unpack(x, np.uint8, np.uint8) for b, x in told.items()}
        for b, (hit, _) in replies.items():
            lo, hi = s.edges[b], s.edges[b + 1]
            tied[lo:hi] |= np.unpackbits(hit, count=hi - lo).astype(bool)
        for i in text.long_documents().tolist():
            b = _digest_bucket(text.digests[i], buckets)
            nth = seen[b] = seen.get(b, -1) + 1
            self.copy[i] = bool(replies[b][1][nth >> 3] >> (7 - (nth & 7)) & 1)
        flag = np.zeros(len(text.raw) + PERIOD + 1, np.int8)
        flag[s.at[s.order[tied[s.group]]] + 1] = 1
        del s
        ahead = np.cumsum(flag, dtype=np.int32)
        n = len(text.raw)
        open_ = ahead[PERIOD : PERIOD + n] > ahead[:n]
        for i, (a, e) in enumerate(zip(text.starts[:-1].tolist(), text.starts[1:].tolist(), strict=True)):
            open_[a if self.copy[i] else max(a, e - LENGTH + 1) : e] = False
        self.at = np.nonzero(open_)[0].astype(np.int32)


class _Buckets:
    """Suffixes at the positions, dealt to buckets; within one they keep their order."""

    def __init__(self, text: _Text, at: np.ndarray, buckets: int):
        self.at, self.high = at, text.names(at, LENGTH, 2)
        bucket = (self.high % _U(buckets)).astype(np.int32)
        self.order = np.argsort(bucket, kind="stable").astype(np.int32)
        self.edges = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])


def _settled(text: _Text, at: np.ndarray) -> np.ndarray:
    """Which of the positions tie with one of a smaller document in the chunk: they are decided here and aren't sent.

    Positions are sorted by one name; a second one is made only for those that share it with a neighbour.
    """
    k = text.names(at, LENGTH, 3)
    order = np.argsort(k, kind="stable").astype(np.int32)
    k = k[order]
    new = np.ones(len(at), bool)
    new[1:] = k[1:] != k[:-1]
    del k
    # Runs of two and more; in each, neighbours are told apart by the second name.
    tied = ~new
    tied[:-1] |= ~new[1:]
    spots = np.nonzero(tied)[0]
    high = text.names(at[order[spots]], LENGTH, 2)
    new[spots[1:]] |= high[1:] != high[:-1]
    del high, spots, tied
    doc = text.document(at)[order]
    first = doc[np.nonzero(new)[0]]
    later = doc > np.repeat(first, np.diff(np.append(np.nonzero(new)[0], len(at))))
    out = np.empty(len(at), bool)
    out[order] = later
    return out


def _told(parts) -> dict[int, bytes]:
    return {p["bucket"]: p["bits"] for p in parts or []}


def _send_suffixes(buckets: int, width: int, name_bits: int):
    def sent(chunk: int, body: bytes, told: dict[int, bytes]) -> Iterator[tuple]:
        text = _Text(body)
        c = _Candidates(text, told, buckets, width)
        settled = _settled(text, c.at)
        mine, gone = np.zeros(len(text.raw), bool), np.zeros(len(text.raw), bool)
        mine[c.at[~settled]], gone[c.at[settled]] = True, True
        # The chunk's own state goes round in a bucket of its own: what was sent, what is settled.
        yield -1 - chunk, pack(np.packbits(mine), np.packbits(gone), c.copy)
        s = _Buckets(text, c.at[~settled], buckets)
        del c, mine, gone, settled
        low = text.names(s.at, LENGTH, 3)
        doc, known = text.document(s.at), np.unique(text.ids)
        for b in range(buckets):
            own = s.order[s.edges[b] : s.edges[b + 1]]
            if len(own):
                docs, counts = np.unique(doc[own], return_counts=True)
                more = bit_planes(s.high[own] >> _U(32), name_bits - 64) if name_bits > 64 else b""
                steps = np.diff(known[docs], prepend=0)
                yield b, pack(bit_planes(low[own], min(name_bits, 64)), more, planes(steps, 8), planes(counts, 4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (b, c.as_py(), x)
            for batch in batches
            for c, body, parts in zip(batch.column(0), batch.column(1), batch.column(2), strict=True)
            for b, x in sent(c.as_py(), body.as_py(), _told(parts.as_py()))
        )
        yield from rows_to_batches(rows, _SENT)

    return run


def _rank_suffixes(name_bits: int):
    """One bucket, sorted by name: which suffixes tie with one of a smaller document."""

    def told(bucket: int, parts: list[dict]) -> Iterator[tuple]:
        if bucket < 0:
            yield from ((part["chunk"], -1, part["names"]) for part in parts)
            return
        lows, highs, docs = [], [], []
        for part in parts:
            low, more, steps, counts = unpack(part["names"], bytes, bytes, bytes, bytes)
            counts = from_planes(counts, 4).astype(np.int64)
            n = int(counts.sum())
            lows.append(from_bit_planes(low, min(name_bits, 64), n))
            highs.append(from_bit_planes(more, name_bits - 64, n) if name_bits > 64 else None)
            docs.append(np.repeat(np.cumsum(from_planes(steps, 8).view(np.int64)), counts))
        low, doc = np.concatenate(lows), np.concatenate(docs)
        high = np.concatenate(highs) if name_bits > 64 else None
        order = np.argsort(low, kind="stable") if high is None else np.lexsort((high, low))
        k = low[order]
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        if high is not None:
            new[1:] |= high[order][1:] != high[order][:-1]
        firsts = np.nonzero(new)[0]
        least = np.minimum.reduceat(doc[order], firsts)
        gone = np.empty(len(k), bool)
        gone[order] = np.repeat(least, np.diff(np.append(firsts, len(k)))) < doc[order]
        at = 0
        for part, own in zip(parts, lows, strict=True):
            yield part["chunk"], bucket, pack(np.packbits(gone[at : at + len(own)]))
            at += len(own)

    return _by_bucket(told)


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def _removed(body: bytes, ties: dict[int, bytes], buckets: int) -> tuple[_Text, list[np.ndarray]]:
    """For each document of a chunk, in the chunk's order, which bytes go."""
    text = _Text(body)
    n = len(text.raw)
    mine, settled, copy = unpack(ties.pop(-1), np.uint8, np.uint8, bool)
    s = _Buckets(text, np.nonzero(np.unpackbits(mine, count=n))[0], buckets)
    change = np.zeros(n + LENGTH + 1, np.int32)
    hits = [np.nonzero(np.unpackbits(settled, count=n))[0]]
    for b, bits in ties.items():
        own = s.at[s.order[s.edges[b] : s.edges[b + 1]]]
        hits.append(own[np.unpackbits(unpack(bits, np.uint8)[0], count=len(own)).astype(bool)])
    for hit in hits:
        change[hit] += 1
    change[LENGTH:] -= change[:-LENGTH].copy()
    gone = np.cumsum(change)[:n] > 0
    return text, [np.ones(e - a, bool) if c else gone[a:e] for a, e, c in zip(text.starts[:-1], text.starts[1:], copy, strict=True)]


def _kept(text: _Text, i: int, gone: np.ndarray) -> bytes:
    return np.frombuffer(text.text(i), np.uint8)[~gone].tobytes()


def _removals(buckets: int):
    def rows(body: bytes, ties: dict[int, bytes]) -> Iterator[tuple]:
        text, every = _removed(body, ties, buckets)
        for i, gone in enumerate(every):
            spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=np.int8(0)) == 1))
            yield (None if text.nulls[i] else int(text.ids[i])), len(gone), int(gone.sum()), spans, _kept(text, i, gone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (r for batch in batches for body, ties in zip(batch.column(1), batch.column(2), strict=True) for r in rows(body.as_py(), _told(ties.as_py())))
        yield from rows_to_batches(every, _RESULT)

    return run


def _rewritten(buckets: int, columns: list[str]):
    """The chunks' own rows with what is left of their texts; ``_null`` tells texts that were null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, ties in zip(batch.column(1), batch.column(2), strict=True):
                text, every = _removed(body.as_py(), _told(ties.as_py()), buckets)
                rest = pa.ipc.open_stream(text.rest).read_all()
                left = [_kept(text, i, gone).decode("utf-8", "ignore") if gone.any() else text.text(i).decode() for i, gone in enumerate(every)]
                keep = [i for i, (x, gone) in enumerate(zip(left, every, strict=True)) if x or not len(gone)]
                null = rest.column("_null").to_pylist()
                texts = pa.array([None if null[i] else left[i] for i in keep], pa.string())
                rest = rest.take(pa.array(keep, pa.int64()))
                yield from pa.table({c: texts if c == "text" else rest.column(c) for c in columns}).to_batches(max_chunksize=BATCH_ROWS)

    return run


def _name_bits(total: int, buckets: int) -> int:
    """Width of a name within its bucket. Of ``total`` suffixes a fifth at most is taken to be named; among all
    pairs of them 2**-6 false ties are expected, so one in 64 corpora has a single one."""
    return min(96, max(32, math.ceil(2 * math.log2(max(total, 2) / 5) + 5 - math.log2(buckets))))


def _exchanged(docs: DataFrame, own: DataFrame) -> tuple[DataFrame, int]:
    """Chunks of ``own`` (doc_id, text, more columns) with the answers of all buckets, and the number of buckets."""
    total = max(2 * input_bytes(docs), 1 << 20)  # text is taken to be stored at half its size
    # Both sides of the joins below have as many partitions, so chunks move once.
    n = max(width_for(docs), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    buckets = max(16, 4 * width_for(docs))
    width = min(8, max(4, math.ceil((math.log2(total) + 9 - math.log2(buckets)) / 8)))
    name = _name_bits(total, buckets)
    chunks = own.mapInArrow(_chunks, "chunk long, body binary").repartition(n, "chunk")

    def exchange(sent: DataFrame, rank) -> DataFrame:
        by = sent.groupBy("bucket").agg(F.collect_list(F.struct("chunk", "names")).alias("parts"))
        told = by.mapInArrow(rank, "chunk long, bucket long, bits binary")
        return told.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("told"))

    sent = "bucket long, chunk long, names binary"
    ranks = exchange(chunks.mapInArrow(_send_samples(buckets, width), sent), _rank_samples(width))
    ranked = chunks.join(ranks, "chunk", "left").select("chunk", "body", "told")
    ties = exchange(ranked.mapInArrow(_send_suffixes(buckets, width, name), sent), _rank_suffixes(name))
    return chunks.join(ties, "chunk", "left").select("chunk", "body", "told"), buckets


def cut_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay).

    Null and empty texts have no bytes. A null doc_id counts as larger than any other. Rows with one and
    the same doc_id never cut each other. ``docs`` is read several times in one job, so it should be a
    table or what ``stored`` returns. Kept bytes may end within a character: see ``keep_text``.
    """
    both, buckets = _exchanged(docs, texts_of(docs))
    return both.mapInArrow(_removals(buckets), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    return cut_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def keep_text(docs: DataFrame) -> DataFrame:
    """The documents with their columns, texts without the repeated bytes; pieces of cut characters go too.

    The other columns travel with the texts, so nothing is joined back. Null and empty texts stay; documents that lose everything are dropped.
    """
    plain = texts_of(docs)
    rest = [F.col(f"`{c}`").alias(c) for c in docs.columns if c != "text"]
    own = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"), *rest, F.col("text").isNull().alias("_null"))
    both, buckets = _exchanged(plain, own)
    return both.mapInArrow(_rewritten(buckets, docs.columns), docs.schema)
