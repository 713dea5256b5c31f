"""Exact top-k search of a query table over a vector table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstrata.operators.skew import lookup_join
from inkstrata.session import materialize

# Largest query matrix that is broadcast, in numbers of eight bytes (64 MB).
BROADCAST_NUMBERS = 8_000_000
# Largest score matrix held at once, and largest hit table of a task, in numbers.
TILE_NUMBERS = 4_000_000
HIT_NUMBERS = 4_000_000
# Rounding error of a matrix product, relative to the lengths of its vectors.
SLACK = 1e-9
# Largest hit table that is broadcast for the text lookup, of some 40 bytes a row.
BROADCAST_HITS = 2_000_000

METRICS = ("cosine", "ip")


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix; every row must have ``dim`` entries."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths())
    wrong = sizes[sizes != dim]
    if len(wrong):
        raise ValueError(f"vector dimension mismatch: expected {dim}, got {wrong[0]}")
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def _unit(m: np.ndarray) -> np.ndarray:
    length = np.sqrt((m * m).sum(axis=1, keepdims=True))
    length[length == 0.0] = 1.0
    return m / length


class _Best:
    """The k best rows per query seen so far: score first, then the larger position."""

    def __init__(self, queries: int, positions: int, k: int) -> None:
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.positions = np.zeros((positions, queries, k), dtype=np.int64)
        # pairs of a query and a block of vectors, and those that bounds have ruled out
        self.offered = self.skipped = 0

    def add(self, first: int, queries: np.ndarray, vectors: np.ndarray, positions: np.ndarray, digits: int | None) -> None:
        """Offer vectors, sorted by position, to the queries from number ``first`` on.

        The matrix product only finds the rows that may count, as its last bits
        depend on where a row stands; those are scored again one row at a time,
        so that equal vectors get equal scores and the tie rule holds.
        """
        kept, sizes = min(self.k, len(vectors)), np.linalg.norm(queries, axis=1)
        slack = SLACK * np.linalg.norm(vectors, axis=1).max() * sizes
        if digits is not None:
            slack = slack + 10.0**-digits
        # no score of the block is above its centre's by more than the radius allows
        centre = vectors.mean(axis=0)
        reach = queries @ centre + sizes * np.linalg.norm(vectors - centre, axis=1).max()
        least = self.scores[first : first + len(queries), -1]
        open_ = np.flatnonzero(reach + 2 * slack >= least)
        self.offered += len(queries)
        self.skipped += len(queries) - len(open_)
        if not len(open_):
            return
        rough = vectors @ queries[open_].T
        # queries that no vector of the block can improve
        better = rough.max(axis=0) + slack[open_] >= least[open_]
        own, rough = open_[better], rough[:, better]
        if not len(own):
            return
        queries, slack, asked = queries[own], slack[own], len(own)
        threshold = np.partition(rough, len(vectors) - kept, axis=0)[len(vectors) - kept]
        offered = np.empty((asked, kept))
        picked = np.empty((asked, kept), dtype=np.int64)
        for q in range(asked):
            near = np.flatnonzero(rough[:, q] >= threshold[q] - slack[q])
            scores = (vectors[near] * queries[q]).sum(axis=1)
            if digits is not None:
                scores = np.round(scores, digits)
            order = np.lexsort((near, scores))[::-1][:kept]
            offered[q], picked[q] = scores[order], near[order]
        part = first + own
        all_scores = np.concatenate([self.scores[part], offered], axis=1)
        all_positions = np.concatenate([self.positions[:, part], positions[:, picked]], axis=2)
        # last key sorts first: score, then the positions in their order
        order = np.lexsort((*all_positions[::-1], all_scores), axis=1)[:, ::-1][:, : self.k]
        self.scores[part] = np.take_along_axis(all_scores, order, axis=1)
        self.positions[:, part] = np.take_along_axis(all_positions, order[None], axis=2)


def _offer(best: _Best, queries: np.ndarray, vectors: np.ndarray, positions: np.ndarray, digits: int | None) -> None:
    order = np.lexsort(positions[::-1])
    vectors, positions = vectors[order], positions[:, order]
    rows = max(1, TILE_NUMBERS // 64)
    for top in range(0, len(vectors), rows):
        block = vectors[top : top + rows]
        width = max(1, TILE_NUMBERS // len(block))
        for left in range(0, len(queries), width):
            best.add(left, queries[left : left + width], block, positions[:, top : top + rows], digits)


def _finite(m: np.ndarray, what: str) -> np.ndarray:
    if not np.isfinite(m).all():
        raise ValueError(f"{what} has values that are not finite")
    return m


def _hits(best: _Best, query_ids: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    found = np.isfinite(best.scores)
    per_query = found.sum(axis=1)
    columns = [np.repeat(query_ids, per_query), best.scores[found]]
    columns += [p[found] for p in best.positions]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)


def top_k(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    dim: int,
    query_id: str = "query_id",
    position: Sequence[str] = ("chunk_id",),
    vector: str = "embedding",
    metric: str = "cosine",
    digits: int | None = None,
    broadcast_numbers: int = BROADCAST_NUMBERS,
) -> DataFrame:
    """The ``k`` best corpus rows per query: ``query_id, *position, score, rank``.

    ``metric`` is ``cosine`` or ``ip`` (inner product of the vectors as they
    are). Equal scores go to the larger ``position``, whole-number columns that
    are unique together. With ``digits`` the scores are rounded before ranking.

    The query matrix is broadcast and the corpus is read in place; a task keeps
    only its best ``k`` per query, and only these are shuffled. A large query
    table is cut into blocks of bounded size that take their turns, each with a
    scan of the corpus (vectors that cost more to compute than to read should be
    written first). A vector with a value that is not finite is an error.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if k <= 0:
        raise ValueError("k must be positive")
    positions = list(position)
    spark = corpus.sparkSession
    asked = queries.select(
        F.col(query_id).cast("bigint").alias("query_id"), F.col(vector).cast("array<double>").alias("v")
    )
    stored = corpus.select(
        *[F.col(p).cast("bigint").alias(p) for p in positions],
        F.col(vector).cast("array<double>").alias("v"),
    )
    fields = [("query_id", pa.int64()), ("score", pa.float64()), *[(p, pa.int64()) for p in positions]]
    schema = pa.schema(fields)
    spark_schema = T.StructType(
        [T.StructField(n, T.DoubleType() if t == pa.float64() else T.LongType()) for n, t in fields]
    )
    scale = _unit if metric == "cosine" else (lambda m: m)

    n_queries = asked.count()
    query_rows = max(1, min(broadcast_numbers // dim, HIT_NUMBERS // k))
    blocks = max(1, -(-n_queries // query_rows))
    if blocks > 1:
        asked = materialize(asked, "queries")

    def scan_for(shared: Broadcast) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, matrix = shared.value
            best = _Best(len(ids), len(positions), k)
            for batch in batches:
                if batch.num_rows and len(ids):
                    place = np.stack([batch.column(p).to_numpy() for p in positions])
                    _offer(best, matrix, scale(_finite(_matrix(batch.column("v"), dim), "a stored vector")), place, digits)
            yield _hits(best, ids, schema)

        return scan

    partial = None
    for number in range(blocks):
        # about query_rows of them: a share of the queries by hash
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == number)
        table = part.toArrow()
        matrix = scale(_finite(_matrix(table.column("v"), dim), "a query vector"))
        shared = spark.sparkContext.broadcast((table.column("query_id").to_numpy(), matrix))
        found = stored.mapInArrow(scan_for(shared), spark_schema)
        if blocks > 1:
            found = materialize(found, "hits")
        partial = found if partial is None else partial.unionByName(found)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), *[F.desc(p) for p in positions])
    return (
        partial.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .withColumnRenamed("query_id", query_id)
        .select(query_id, *positions, "score", "rank")
    )


def named_rows(store: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """The rows of ``store`` that hits name by ``key``."""
    named = hits.select(key).distinct()
    return store.join(F.broadcast(named) if hits.count() <= BROADCAST_HITS else named, key, "left_semi")


def attach_hits(hits: DataFrame, store: DataFrame, position: Sequence[str], query_id: str = "query_id") -> DataFrame:
    """Text and metadata of the hits, looked up by position in the store."""
    keys = list(position)
    if hits.count() <= BROADCAST_HITS:
        return store.join(F.broadcast(hits), keys)
    # many questions may have found the same row
    return lookup_join(hits, store, keys, row_id=[query_id])
