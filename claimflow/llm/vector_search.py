"""Exact top-k search by multi-resolution segment statistics.

A vector is cut into segments, and of each the mean and the deviation are known. With them the distance of two
vectors has a lower bound: in each segment at least (difference of means)^2 + (difference of deviations)^2 times its
length. As q.c = (|q|^2 + |c|^2 - d^2) / 2, that is an upper bound on the inner product: the sum over segments of
length * (mean * mean + deviation * deviation). Bounds are taken coarse to fine; what cannot reach the k-th score
found so far is left out, and the rest gets its exact score.

Queries and candidates are packed into blocks, and blocks of candidates are dealt to slots. Every block of queries goes to
every slot by a shuffle, which no side of is sent to the driver, and meets the slot's blocks one after the other: the
k-th score found so far is a floor for the next block. A slot gives out at most k rows for each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.common import save

K = 20
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 2048
SEGMENTS = (1, 4, 16)  # coarse to fine
SLOTS = 16  # shares of the candidates, at least
BLOCKS = "block long, width int, ids binary, vectors binary"
FOUND = "query long, query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def smallest(vectors: np.ndarray) -> np.ndarray:
    """The vectors in the narrowest whole type that holds them: most quantised components fit a byte."""
    low, high = vectors.min(initial=0), vectors.max(initial=0)
    return vectors.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _pack(limit: int):
    def emit(base: int, width: int, ids: list, vectors: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([base], pa.int64()),
                pa.array([width], pa.int32()),
                pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                pa.array([smallest(np.concatenate(vectors).astype(np.int64)).tobytes()], pa.binary()),
            ],
            names=["block", "width", "ids", "vectors"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            vectors = batch.column(1)
            offsets, values = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
            for k, vec_id in enumerate(batch.column(0).to_pylist()):
                vector = values[offsets[k] : offsets[k + 1]]
                ids, rows = held.setdefault(len(vector), ([], []))
                ids.append(vec_id)
                rows.append(vector)
                if len(ids) == limit:
                    yield emit(block, len(vector), *held.pop(len(vector)))
                    block += 1
        for width, (ids, rows) in held.items():
            yield emit(block, width, ids, rows)
            block += 1

    return pack


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, each times the root of its length, side by side."""
    parts = np.array_split(vectors, min(segments, vectors.shape[1]), axis=1)
    root = [np.sqrt(p.shape[1]) for p in parts]
    means = np.stack([p.mean(axis=1) * r for p, r in zip(parts, root, strict=True)], 1)
    deviations = np.stack([p.std(axis=1) * r for p, r in zip(parts, root, strict=True)], 1)
    return np.concatenate([means, deviations], 1)


def _scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where they hold every sum, else in whole numbers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * queries.shape[1]
    if most < 2**53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


def top_candidates(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, k: int, reached: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, candidate, score) of the k best rows for every query in a block, rows of its own id left out.

    Ties at the k-th score go to the smaller id. `reached` is a score for every query that k other rows are known to
    reach, -inf for none: rows below it are left out.
    """
    own = query_ids[:, None] == ids[None, :]
    alive = ~own
    k = min(k, len(ids))
    q, c = queries.astype(np.float64), candidates.astype(np.float64)
    floor = np.full(len(queries), -np.inf) if reached is None else reached  # a score that k rows are known to reach for the query
    keep = np.arange(len(ids))  # candidates that some query may still want
    for segments in SEGMENTS:
        bound = segment_statistics(q, segments) @ segment_statistics(c[keep], segments).T
        bound += 1e-9 * np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(c[keep], axis=1)[None, :] + 1e-6
        bound[~alive[:, keep]] = -np.inf
        if segments == SEGMENTS[0] and len(ids) > 4 * k and not np.isfinite(floor).all():
            # the most hopeful candidates' exact scores set the first floor
            hopeful = np.argpartition(-bound, k, axis=1)[:, : k + 1]
            exact = np.einsum("qkd,qd->qk", c[keep][hopeful], q)
            exact[~np.take_along_axis(alive[:, keep], hopeful, 1)] = -np.inf
            exact.sort(axis=1)
            slack = 1e-9 * np.abs(exact[:, 1]) + 1e-6
            found = np.where(np.isfinite(exact[:, 1]), exact[:, 1] - np.where(np.isfinite(slack), slack, 0), -np.inf)
            floor = np.maximum(floor, found)
        hope = alive[:, keep] & (bound >= floor[:, None])
        alive[:, keep] = hope
        keep = keep[hope.any(axis=0)]
    queries, candidates = queries.astype(np.int64), candidates[keep].astype(np.int64)
    score = _scores(queries, candidates)
    live = alive[:, keep] & (score >= floor[:, None])
    many = np.flatnonzero(live.sum(axis=1) > k)
    if len(many):
        value = np.where(live[many], score[many], np.iinfo(np.int64).min)
        live[many] &= value >= np.partition(value, len(keep) - k, axis=1)[:, len(keep) - k, None]
    place, at = np.nonzero(live)
    return _ranked(k, place, ids[keep[at]], score[place, at])


def _ranked(k: int, place: np.ndarray, vec_id: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of every place, in order: highest score first, ties by the smaller id."""
    order = np.lexsort((vec_id, -score, place))
    place, vec_id, score = place[order], vec_id[order], score[order]
    kept = np.arange(len(place)) - np.searchsorted(place, place) < k
    return place[kept], vec_id[kept], score[kept]


class _Best:
    """The k best rows found so far for every query of a block."""

    def __init__(self, k: int, block: int, width: int, ids: bytes, vectors: bytes):
        self.k, self.block, self.ids = k, block, np.frombuffer(ids, np.int64)
        self.queries = _vectors(vectors, width, len(self.ids))
        self.place, self.vec_id, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.reached = np.full(len(self.ids), -np.inf)

    def meet(self, ids: np.ndarray, candidates: np.ndarray) -> None:
        found = top_candidates(self.ids, self.queries, ids, candidates, self.k, self.reached)
        held = (np.concatenate(x) for x in zip((self.place, self.vec_id, self.score), found, strict=True))
        self.place, self.vec_id, self.score = _ranked(self.k, *held)
        kth = np.arange(len(self.place)) - np.searchsorted(self.place, self.place) == self.k - 1
        last = self.score[kth].astype(np.float64)  # as a double it may be above the whole number
        self.reached[self.place[kth]] = last - 1e-9 * np.abs(last) - 1e-6

    def rows(self) -> pa.RecordBatch:
        found = (self.block * QUERY_BLOCK + self.place, self.ids[self.place], self.vec_id, self.score)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["query", "query_id", "vec_id", "score"])


def _vectors(packed: bytes, width: int, rows: int) -> np.ndarray:
    """Vectors as `smallest` packed them, whose type is told by their length."""
    kind = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}[len(packed) // (width * rows)]
    return np.frombuffer(packed, kind).reshape(rows, width)


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = at = None
        for batch in batches:
            for row in range(len(batch)):
                slot, width, block = (batch.column(c)[row].as_py() for c in ("slot", "width", "query_block"))
                if (slot, block) != at:
                    if best is not None:
                        yield best.rows()
                    at, best = (slot, block), _Best(k, block, width, *(batch.column(c)[row].as_py() for c in ("query_ids", "queries")))
                ids = np.frombuffer(batch.column("ids")[row].as_py(), np.int64)
                best.meet(ids, _vectors(batch.column("vectors")[row].as_py(), width, len(ids)))
        if best is not None:
            yield best.rows()

    return search


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = K,
    scale: int = 64,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """Each query's k candidates of the highest integer inner products: query_id, rank (from 1), vec_id, score.

    Components become floor(scale * x). Ties go to the smaller vec_id. A candidate of the query's own vec_id takes no
    part. Vectors that are null, empty or hold null or non-finite components, and rows without a vec_id, take no part;
    vectors meet only those of their own length. Rows repeated with one vec_id are ranked each by itself, and as queries
    each has a ranking of its own. An empty side gives no rows. Other columns are not looked at.
    """

    def packed(df: DataFrame, limit: int, name: str) -> DataFrame:
        rows = df.where(F.col(vec_id).isNotNull() & usable(F.col(embedding))).select(
            F.col(vec_id).cast("long"), quantised(F.col(embedding), scale)
        )
        return save(rows.mapInArrow(_pack(limit), BLOCKS), name)

    blocks = packed(candidates, CANDIDATE_BLOCK, "search-candidates")
    asked = packed(queries, QUERY_BLOCK, "search-queries")
    # two slots for a core, not one for a block of candidates: what is shuffled for a query does not grow with the candidates
    slots = max(SLOTS, 2 * queries.sparkSession.sparkContext.defaultParallelism)
    blocks = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)))
    asked = asked.select(
        F.col("block").alias("query_block"),
        F.col("width").alias("query_width"),
        F.col("ids").alias("query_ids"),
        F.col("vectors").alias("queries"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))).alias("query_slot"),
    )
    # Spark takes a side for as small as its compressed files, though the queries stand once for every slot: broadcast, they
    # would all be held by the driver. A merge join holds the blocks of a slot and writes to disk what does not fit.
    met = (F.col("query_slot") == F.col("slot")) & (F.col("query_width") == F.col("width"))
    # a number of partitions that is given is not coalesced: a slot is few bytes and much work
    asked, blocks = asked.repartition(8 * slots, "query_slot", "query_width"), blocks.repartition(8 * slots, "slot", "width")
    pairs = asked.hint("merge").join(blocks.hint("merge"), met)
    found = pairs.select("slot", "width", "query_block", "query_ids", "queries", "ids", "vectors").mapInArrow(_search(k), FOUND)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
