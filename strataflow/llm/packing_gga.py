"""Best-fit packing by a grouping genetic algorithm, on islands with elite migration.

Documents are cut only where they exceed a sequence; the one piece that may be shorter goes first. Full pieces are sequences. The rest
are dealt into shards of bounded size. For every shard several islands breed packings: a child inherits whole well-filled bins
of one parent, drops the other's bins that hold the same documents, and best-fits what that displaced. Islands swap their best
packings between epochs. Poorly filled bins of all shards are pooled and packed again, shard by shard.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.bpe_text import Encoder
from strataflow.llm.common import rows_to_batches, stored, texts_of

SHARD = 4096
ISLANDS, EPOCHS, CHILDREN, ELITE = 2, 2, 12, 3
_TEXTS = 512
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int) -> DataFrame:
    """The documents' ids with the end id, cut into pieces. Null and empty texts have the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer)

        def rows() -> Iterator[tuple]:
            for b in batches:
                for at in range(0, b.num_rows, _TEXTS):
                    ids, counts = encode(b.column(1).slice(at, _TEXTS).to_pylist())
                    ids, lengths = np.insert(ids, np.cumsum(counts), end_id).astype("<u4"), counts + 1
                    ends = np.cumsum(lengths)
                    for d, n, e in zip(b.column(0).slice(at, _TEXTS).to_pylist(), lengths.tolist(), ends.tolist(), strict=True):
                        cuts = [0, *range((n - 1) % size + 1, n + 1, size)]
                        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
                            yield d, k, lo, hi - lo, zlib.crc32(ids[e - n + lo : e - n + hi].tobytes())

        yield from rows_to_batches(rows(), _PIECES)

    return texts_of(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


Bins = list[list[int]]


def _fill(b: list[int], sizes: list[int]) -> int:
    return sum(map(sizes.__getitem__, b))


def best_fit(order: list[int], sizes: list[int], size: int, bins: Bins) -> Bins:
    """Each item in turn goes into the bin with the least room that takes it. A bit mask of rooms finds it in constant time."""
    rooms: list[Bins] = [[] for _ in range(size + 1)]
    mask = 0
    for b in bins:
        room = size - _fill(b, sizes)
        rooms[room].append(b)
        mask |= 1 << room
    for i in order:
        fits = mask >> sizes[i]
        if fits:
            room = sizes[i] + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            room, b = size, []
        b.append(i)
        rooms[room - sizes[i]].append(b)
        mask |= 1 << (room - sizes[i])
    return [b for at_room in rooms for b in at_room]


def fitness(bins: Bins, sizes: list[int], size: int) -> tuple[int, float]:
    """Smaller is better: bins, then how evenly they are filled."""
    return len(bins), -sum([(_fill(b, sizes) / size) ** 2 for b in bins])


def child(a: Bins, b: Bins, sizes: list[int], size: int, rng: random.Random) -> Bins:
    """Whole bins of ``b``, the fuller the likelier, into ``a``; what they displace is placed by best fit."""
    fills = sorted(b, key=lambda x: -_fill(x, sizes))
    injected = [list(x) for k, x in enumerate(fills) if rng.random() < 0.6 * (1 - k / len(fills))]
    taken = {i for x in injected for i in x}
    kept, loose = [], []
    for x in a:
        if taken.isdisjoint(x):
            kept.append(list(x))
        else:
            loose += [i for i in x if i not in taken]
    kept.sort(key=lambda x: -_fill(x, sizes))
    for x in kept[len(kept) - max(1, len(kept) // 50) :]:  # mutation: the emptiest bins are dissolved
        loose += x
    kept = kept[: len(kept) - max(1, len(kept) // 50)]
    loose.sort(key=lambda i: (-sizes[i], rng.random()))
    return best_fit(loose, sizes, size, kept + injected)


def evolve(sizes: list[int], size: int, seed: int, elite: list[Bins]) -> list[Bins]:
    """One island's epoch: the best packings it ends with, best first. It stops early at the least possible number of bins."""
    rng, least = random.Random(seed), -(-sum(sizes) // size)
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    pool = [*elite, best_fit(order, sizes, size, [])]
    for jitter in (0.03, 0.1, 0.2):
        pool.append(best_fit(sorted(order, key=lambda i: -sizes[i] * (1 + jitter * (rng.random() - 0.5))), sizes, size, []))
    rated = sorted(((fitness(p, sizes, size), k, p) for k, p in enumerate(pool)), key=lambda x: x[:2])
    for k in range(CHILDREN):
        if rated[0][0][0] <= least:
            break
        a, b = rng.sample(rated[: max(2, len(rated) // 2 + 1)], 2)
        made = child(a[2], b[2], sizes, size, rng)
        rated = sorted([*rated, (fitness(made, sizes, size), len(pool) + k, made)], key=lambda x: x[:2])[: len(pool)]
    return [p for _, _, p in rated[:ELITE]]


def _as_labels(bins: Bins, n: int) -> bytes:
    labels = np.zeros(n, np.int32)
    for k, b in enumerate(bins):
        labels[b] = k
    return labels.tobytes()


def _as_bins(labels: bytes) -> Bins:
    out: dict[int, list[int]] = {}
    for i, k in enumerate(np.frombuffer(labels, np.int32).tolist()):
        out.setdefault(k, []).append(i)
    return list(out.values())


_EPOCH = pa.schema([("shard", pa.int64()), ("island", pa.int32()), ("bins", pa.int32()), ("elite", pa.list_(pa.binary()))])


def _epoch(size: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                for shard, island, items, elite in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    sizes = [x["length"] for x in items]
                    best = evolve(sizes, size, shard * 1009 + island * 31 + epoch, [_as_bins(x) for x in elite or []])
                    yield shard, island, len(best[0]), [_as_labels(x, len(sizes)) for x in best]

        yield from rows_to_batches(rows(), _EPOCH)

    return run


_PLACED = pa.schema([("item", pa.int64()), ("length", pa.int64()), ("shard", pa.int64()), ("bin", pa.int32()), ("offset", pa.int64()), ("fill", pa.int64())])


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for b in batches:
            for shard, items, labels in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for k, members in enumerate(_as_bins(labels)):
                    at, fill = 0, sum(items[i]["length"] for i in members)
                    for i in members:
                        yield items[i]["item"], items[i]["length"], shard, k, at, fill
                        at += items[i]["length"]

    yield from rows_to_batches(rows(), _PLACED)


def pack_items(items: DataFrame, size: int) -> DataFrame:
    """``items`` (item, length) into bins: item, length, shard, bin, offset, fill of the bin.

    Shards take eight times their stored bytes in memory, so Spark's estimate is not to decide whether they are broadcast.
    """
    shards = max(1, -(-items.count() // SHARD))
    width = max(shards, items.sparkSession.sparkContext.defaultParallelism)
    shard = F.pmod(F.xxhash64("item"), F.lit(shards)).alias("shard")
    held = items.select(shard, "item", "length").groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("item", "length"))).alias("items"))
    held = stored(held, "shards")
    elite = held.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "items", F.lit(None).cast("array<binary>").alias("elite"))
    for epoch in range(EPOCHS):
        bred = stored(elite.repartition(ISLANDS * width, "shard", "island").mapInArrow(_epoch(size, epoch), "shard long, island int, bins int, elite array<binary>"), "epoch")
        # The best packing of each island moves on to the next one in the ring.
        moved = bred.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"), F.element_at("elite", 1).alias("guest"))
        met = bred.join(moved.hint("merge"), ["shard", "island"]).select("shard", "island", F.array_append("elite", F.col("guest")).alias("elite"))
        elite = held.join(met.hint("merge"), "shard").select("shard", "island", "items", "elite")
    best = bred.groupBy("shard").agg(F.min_by(F.element_at("elite", 1), F.struct("bins", "island")).alias("labels"))
    return held.join(best.hint("merge"), "shard").select("shard", "items", "labels").mapInArrow(_place, "item long, length long, shard long, bin int, offset long, fill long")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every row of ``docs`` is a document, also with a null or repeated doc_id. An empty table gives no rows.
    """
    # Written once, so the numbers are fixed from here on.
    every = stored(pieces(docs, tokenizer, size, end_id).withColumn("item", F.monotonically_increasing_id()), "pieces")
    full = every.where(F.col("length") == size).withColumns({"sequence_id": F.col("item") * 4, "offset": F.lit(0).cast("long")})
    first = stored(pack_items(every.where(F.col("length") < size).select("item", "length"), size), "packed")
    poor = F.col("fill") < int(0.97 * size)
    again = stored(pack_items(first.where(poor).select("item", "length"), size), "repacked")
    number = (F.col("shard") * (1 << 20) + F.col("bin")) * 4
    placed = first.where(~poor).select("item", (number + 1).alias("sequence_id"), "offset").union(again.select("item", (number + 2).alias("sequence_id"), "offset"))
    # A row per piece, several times its stored bytes in memory: not to be broadcast.
    packed = every.where(F.col("length") < size).join(placed.hint("merge"), "item")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return full.select(columns).union(packed.select(columns))
