"""Exact top-k by inner product, without random access.

Vectors are dealt into blocks of bounded size. In a block every dimension is a list sorted by component. For a query
the lists are read from the end that adds most to its score, a step at a time in all of them. A vector's score is
bounded below and above by what has been read of it and by the ends of the lists. Reading stops once no vector outside the k best,
read or unread, can reach them; then the final scores of those that still qualify are resolved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import rows_to_batches, stored

BLOCK, QUERIES = 4096, 512
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def scaled(vectors: DataFrame, factor: int = 1024) -> DataFrame:
    """vec_id and integer components. Rows with a null id or vector, no components, or null or non-finite ones are left out."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").where(fine)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * factor).cast("long")).alias("v"))


class Lists:
    """A block's sorted lists: for each dimension the rows by rising component."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        columns = np.ascontiguousarray(x.T)
        self.order = np.argsort(columns, axis=1, kind="stable")
        self.sorted = np.take_along_axis(columns, self.order, 1)

    def top(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores that hold the block's k best, ties included; the query's own rows are left out."""
        n, dims = self.x.shape
        live = np.nonzero(q)[0]
        own = self.ids == query_id
        if not len(live):
            return np.nonzero(~own)[0], np.zeros(int((~own).sum()), np.int64)
        lists = [(self.order[j], self.sorted[j] * q[j]) if q[j] < 0 else (self.order[j, ::-1], self.sorted[j, ::-1] * q[j]) for j in live]
        worst = np.array([values[-1] for _, values in lists])
        low, high = np.full(n, worst.sum()), np.zeros(n, np.int64)
        step, at = max(64, -(-n // 4)), 0
        unread = np.ones((len(live), n), bool)
        while True:
            for d, (rows, values) in enumerate(lists):
                part = rows[at : at + step]
                low[part] += values[at : at + step] - worst[d]
                unread[d, part] = False
            at = min(at + step, n)
            if at >= n:  # all is read: the lower bounds are the scores
                rows = np.nonzero(~own)[0]
                if len(rows) > k:
                    rows = rows[low[rows] >= np.partition(low[rows], len(rows) - k)[len(rows) - k]]
                return rows, low[rows]
            ends = np.array([values[min(at, n - 1)] for _, values in lists])
            high = low + np.einsum("ji,j->i", unread, ends - worst)
            lows = np.where(own, np.iinfo(np.int64).min, low)
            bar = np.partition(lows, n - k)[n - k] if n > k else np.iinfo(np.int64).min
            alive = (high >= bar) & ~own
            unseen = (unread.all(0) & alive).any()
            if not unseen and alive.sum() <= 4 * k:
                rows = np.nonzero(alive)[0]
                return rows, np.einsum("ij,j->i", self.x[rows], q)


def _search(k: int):
    def found(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, x: np.ndarray) -> Iterator[tuple]:
        lists = Lists(ids, x)
        for query_id, q in zip(query_ids.tolist(), queries, strict=True):
            rows, scores = lists.top(query_id, q, k)
            best = np.lexsort((ids[rows], -scores))
            for i in best[:k].tolist():
                yield query_id, int(ids[rows[i]]), int(scores[i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                for r in range(b.num_rows):
                    block, asked = b.column(0)[r].values, b.column(1)[r].values
                    if block is None or asked is None or not len(block) or not len(asked):
                        continue
                    ids, vectors = block.field(0).to_numpy(), block.field(1)
                    query_ids, queries = asked.field(0).to_numpy(), asked.field(1)
                    sizes, wanted = _sizes(vectors), _sizes(queries)
                    for d in np.unique(wanted).tolist():  # only vectors of one length have an inner product
                        x, q = sizes == d, wanted == d
                        if x.any():
                            yield from found(query_ids[q], _matrix(queries, q, d), ids[x], _matrix(vectors, x, d))

        yield from rows_to_batches(rows(), _FOUND)

    return run


def _sizes(lists: pa.ListArray) -> np.ndarray:
    return np.diff(lists.offsets.to_numpy())


def _matrix(lists: pa.ListArray, pick: np.ndarray, width: int) -> np.ndarray:
    return lists.filter(pa.array(pick)).flatten().to_numpy().reshape(-1, width)


def top_k(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """For each query (vec_id divisible by ``every``) its k best other rows: query_id, rank, vec_id, score.

    Ties go to the smaller vec_id. Repeated rows each count; a query leaves out every row with its own id. Vectors of other lengths than the
    query's aren't compared with it. An empty table gives no rows.
    """
    rows = stored(scaled(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
    n = rows.count()
    blocks, groups = max(1, -(-n // BLOCK)), max(1, -(-n // (every * QUERIES)))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks))  # by row, as one id may have any number of them
    ids = F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))
    held = rows.groupBy(block.alias("block")).agg(F.collect_list(F.struct("vec_id", "v")).alias("rows")).select("block", "rows", F.explode(ids).alias("group"))
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", "v").distinct()
    asked = queries.groupBy(F.pmod(F.xxhash64("vec_id", "v"), F.lit(groups)).alias("group")).agg(F.collect_list(F.struct("vec_id", "v")).alias("asked"))
    met = held.join(asked, "group").select("rows", "asked").repartition(max(blocks * groups, 1))
    found = met.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
