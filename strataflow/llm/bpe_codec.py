"""Byte-level BPE encoding and decoding with a global shuffle of distinct words.

Texts are exploded into pre-tokens with their positions, held as one packed array for each chunk of documents. Only
distinct words travel: each chunk sends its own to buckets by hash, a bucket encodes every word once, and the ids are joined
back to the chunk, which puts them in order of position. Decoding joins ids with the table of token bytes, again word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm import bpe_text
from strataflow.llm.common import from_planes, pack, planes, rows_to_batches, texts_of, unpack, width_for

CHUNK_CHARS = 4 << 20
_CHUNK = pa.schema([("chunk", pa.int64()), ("body", pa.binary())])
_SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("words", pa.binary())])
_TOLD = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("ids", pa.binary())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _split(buckets: int, words_only: bool):
    """Chunks of documents in the order of the scan: their words by bucket, or else where each word stands."""

    def made(number: int, held: list[tuple]) -> Iterator[tuple]:
        split = bpe_text.Split([t for _, t in held], by_library=True)
        raw = [w.encode() for w in split.words]
        bucket = np.fromiter((xxhash.xxh64_intdigest(w) % buckets for w in raw), np.int64, len(raw))
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        if words_only:
            for b in np.nonzero(np.diff(edges))[0].tolist():
                own = [raw[i] for i in order[edges[b] : edges[b + 1]].tolist()]
                yield b, number, pack(planes(np.fromiter(map(len, own), np.int64, len(own)), 4), b"".join(own), level=3)
            return
        place = np.empty(len(raw), np.int64)
        place[order] = np.arange(len(raw))
        # Occurrences name words by rank of frequency, whose bytes compress best; ``by_rank`` leads to the order of buckets.
        by_rank = np.argsort(-np.bincount(split.which, minlength=len(raw)), kind="stable")
        rank = np.empty(len(raw), np.int64)
        rank[by_rank] = np.arange(len(raw))
        ids = np.array([0 if d is None else d for d, _ in held], np.int64)
        nulls = np.array([d is None for d, _ in held], np.uint8)
        yield number, pack(ids, nulls, split.counts.astype(np.int64), planes(rank[split.which], 4), planes(place[by_rank], 4), level=3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            number, held, size = TaskContext.get().partitionId() << 32, [], 0
            for b in batches:
                for d, t in zip(b.column(0), b.column(1), strict=True):
                    held.append((d.as_py(), t.as_py()))
                    size += len(held[-1][1])
                    if size >= CHUNK_CHARS:
                        yield from made(number, held)
                        number, held, size = number + 1, [], 0
            if held:
                yield from made(number, held)

        yield from rows_to_batches(rows(), _SENT if words_only else _CHUNK)

    return run


def _encode(ranks_file: str):
    def told(bucket: int, parts: list[dict]) -> Iterator[tuple]:
        index: dict[bytes, int] = {}
        spots = []
        for part in parts:
            lengths, raw = unpack(part["words"], bytes, bytes)
            ends = np.cumsum(from_planes(lengths, 4)).tolist()
            spots.append([index.setdefault(raw[a:b], len(index)) for a, b in zip([0, *ends], ends, strict=False)])
        every = bpe_text.encode_words([w.decode() for w in index], ranks_file)
        for part, own in zip(parts, spots, strict=True):
            sizes = np.fromiter((len(every[k]) for k in own), np.int32, len(own))
            ids = np.fromiter((i for k in own for i in every[k]), np.int64, int(sizes.sum()))
            yield part["chunk"], bucket, pack(planes(sizes, 4), planes(ids, 4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows_to_batches((r for batch in batches for b, parts in zip(*batch.columns, strict=True) for r in told(b.as_py(), parts.as_py())), _TOLD)

    return run


def _reassemble(ranks_file: str):
    def rows(body: bytes, told: list[dict] | None, bytes_of: dict[int, bytes]) -> Iterator[tuple]:
        ids, nulls, counts, which, by_rank = unpack(body, np.int64, np.uint8, np.int64, bytes, bytes)
        numbers, decoded, sizes = [], [], []
        for part in sorted(told or [], key=lambda p: p["bucket"]):
            own, flat = (from_planes(x, 4).astype(np.int64) for x in unpack(part["ids"], bytes, bytes))
            flat, at = flat.tolist(), 0
            for n in own.tolist():
                word = flat[at : at + n]
                at += n
                numbers.append(b",".join([b"%d" % i for i in word]))
                decoded.append(b"".join([bytes_of[i] for i in word]))
            sizes.append(own)
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        if 4 * len(size) != len(by_rank):
            raise RuntimeError("a chunk's words did not come back whole: the table changed while it was read")
        which, at = from_planes(by_rank, 4).astype(np.int64)[from_planes(which, 4).astype(np.int64)], 0
        for d, null, n in zip(ids.tolist(), nulls.tolist(), counts.tolist(), strict=True):
            own = which[at : at + n]
            at += n
            words = own.tolist()
            text_ids = b",".join([numbers[k] for k in words])
            text = b"".join([decoded[k] for k in words])
            yield None if null else d, int(size[own].sum()), hashlib.sha256(text_ids).hexdigest(), hashlib.sha256(text).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {i: b for b, i in bpe_text.ranks(ranks_file).items()}
        yield from rows_to_batches(
            (r for batch in batches for body, told in zip(batch.column(1), batch.column(2), strict=True) for r in rows(body.as_py(), told.as_py(), bytes_of)), _RESULT
        )

    return run


def round_trip(docs: DataFrame, ranks_file: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256.

    Null and empty texts have no ids. ``docs`` is scanned twice in one job, for the words and for their places, so it
    should be a table or what ``stored`` returns. Every row is its own document, whatever its doc_id.
    """
    n, buckets = width_for(docs), max(16, 2 * width_for(docs))
    own = texts_of(docs)
    words = own.mapInArrow(_split(buckets, True), "bucket int, chunk long, words binary")
    sent = words.groupBy("bucket").agg(F.collect_list(F.struct("chunk", "words")).alias("parts"))
    told = sent.mapInArrow(_encode(ranks_file), "chunk long, bucket int, ids binary").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "ids")).alias("told"))
    chunks = own.mapInArrow(_split(buckets, False), "chunk long, body binary").repartition(n, "chunk")
    both = chunks.join(told, "chunk", "left").select("chunk", "body", "told")
    return both.mapInArrow(_reassemble(ranks_file), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
