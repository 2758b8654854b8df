"""Hard negatives of anchor vectors: the best rows of another label inside a window below each positive's score.

Vectors are whole numbers in tiles. A block of anchor tiles meets the candidate tiles of a slot one after the other
in a task of its own; the inner products of two tiles are one matrix product by Strassen's recursion in 64-bit whole
numbers. A first pass keeps a heap of the best positives for every anchor. With their scores known, a second one
keeps a heap for every window. Heaps of different slots merge exactly, and there are as many slots at every size, so
what is shuffled after a pass grows with the anchors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.common import save
from claimflow.llm.vector_search import quantised, usable

TILE = 512  # vectors of a tile
BLOCK = 16  # anchor tiles that a task holds, about
SLOTS = 16  # shares of the candidates that a block of anchors meets apart
LEAF = 16  # a side at which the recursion ends
POSITIVES = 5
NEGATIVES = 5
WINDOW = (80, 100)  # percent of the positive's score
SCALE = 256
LEAST = np.iinfo(np.int64).min
TILES = "tile long, width int, rows binary, ids binary, labels binary, vectors binary"
FOUND_POSITIVES = "anchor long, anchor_id long, tile long, place int, positive_score long, positive_id long, positive long"
FOUND_NEGATIVES = "anchor long, positive_rank int, negative_score long, negative_id long, negative long"
LIMITS = "array<struct<place:int,positive_rank:int,positive_score:long>>"


def _halves(matrix: np.ndarray) -> tuple[np.ndarray, ...]:
    """The four quarters of a matrix; odd sides are padded with zeros."""
    rows, columns = matrix.shape
    if rows % 2 or columns % 2:
        matrix = np.pad(matrix, ((0, rows % 2), (0, columns % 2)))
    r, c = matrix.shape[0] // 2, matrix.shape[1] // 2
    return matrix[:r, :c], matrix[:r, c:], matrix[r:, :c], matrix[r:, c:]


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b of 64-bit whole numbers, seven products of halves at a time.

    Sums are taken modulo 2^64: what goes beyond in between comes back, and every product that fits is exact.
    """
    if min(*a.shape, b.shape[1]) <= leaf:
        return a @ b
    a11, a12, a21, a22 = _halves(a)
    b11, b12, b21, b22 = _halves(b)
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    product = np.block([[m1 + m4 - m5 + m7, m3 + m5], [m2 + m4, m1 - m2 + m3 + m6]])
    return product[: a.shape[0], : b.shape[1]]


class Heaps:
    """For each of some rows its k best entries (score, id, row number): higher scores, then smaller ids, go first.

    Entries may be offered in any order and split, and heaps of parts offered to each other give the same.
    """

    def __init__(self, rows: int, k: int):
        self.k, self.floor = k, np.full(rows, LEAST)  # the score that a full heap asks for
        self.at, self.score, self.ids, self.number = (np.zeros(0, np.int64) for _ in range(4))

    def offer(self, scores: np.ndarray, ids: np.ndarray, numbers: np.ndarray, allowed: np.ndarray) -> None:
        """A matrix of scores (rows x candidates), the candidates' ids and numbers, and which entries may count."""
        hopeful = allowed & (scores >= self.floor[:, None])
        if np.count_nonzero(hopeful) > 4 * self.k * len(scores) and scores.shape[1] > self.k:
            masked = np.where(hopeful, scores, LEAST)
            hopeful &= masked >= np.partition(masked, -self.k, axis=1)[:, -self.k][:, None]
        at, column = np.nonzero(hopeful)
        if not len(at):
            return
        at = np.concatenate([self.at, at])
        score = np.concatenate([self.score, scores[hopeful]])
        ids, numbers = np.concatenate([self.ids, ids[column]]), np.concatenate([self.number, numbers[column]])
        order = np.lexsort((numbers, ids, ~score, at))
        at = at[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        kept = place < self.k
        order, at, place = order[kept], at[kept], place[kept]
        self.at, self.score, self.ids, self.number = at, score[order], ids[order], numbers[order]
        full = place == self.k - 1
        self.floor[at[full]] = self.score[full]


class Tile:
    """Vectors of a tile with their row numbers, ids and labels."""

    def __init__(self, width: int, rows: bytes, ids: bytes, labels: bytes, vectors: bytes):
        self.rows, self.ids, self.labels, flat = (np.frombuffer(x, np.int64) for x in (rows, ids, labels, vectors))
        self.vectors = flat.reshape(-1, width)


class Positives:
    """The best rows of the anchors' own labels."""

    schema = FOUND_POSITIVES

    def __init__(self, number: int, tile: Tile, limits: list | None, k: int):
        self.number, self.tile, self.heaps = number, tile, Heaps(len(tile.ids), k)

    def meet(self, scores: np.ndarray, other: Tile) -> None:
        same = (self.tile.labels[:, None] == other.labels[None, :]) & (self.tile.rows[:, None] != other.rows[None, :])
        self.heaps.offer(scores, other.ids, other.rows, same)

    def found(self) -> Iterator[list[np.ndarray]]:
        h = self.heaps
        yield [self.tile.rows[h.at], self.tile.ids[h.at], np.full(len(h.at), self.number), h.at, h.score, h.ids, h.number]


class Negatives:
    """The best rows of other labels in the window of every positive."""

    schema = FOUND_NEGATIVES

    def __init__(self, number: int, tile: Tile, limits: list | None, k: int, window: tuple[int, int]):
        self.tile, self.heaps = tile, {}
        low, high = window
        for x in limits or []:
            rank, score = x["positive_rank"], x["positive_score"]
            if rank not in self.heaps:  # without a positive nothing lies between the bounds
                self.heaps[rank] = (np.full(len(tile.ids), 1), np.zeros(len(tile.ids), np.int64), Heaps(len(tile.ids), k))
            lows, highs, _ = self.heaps[rank]
            lows[x["place"]], highs[x["place"]] = -(-low * score // 100), high * score // 100

    def meet(self, scores: np.ndarray, other: Tile) -> None:
        differs = self.tile.labels[:, None] != other.labels[None, :]
        for lows, highs, heaps in self.heaps.values():
            heaps.offer(scores, other.ids, other.rows, differs & (scores >= lows[:, None]) & (scores <= highs[:, None]))

    def found(self) -> Iterator[list[np.ndarray]]:
        for rank, (_, _, h) in self.heaps.items():
            yield [self.tile.rows[h.at], np.full(len(h.at), rank), h.score, h.ids, h.number]


def _search(kind, leaf: int, options: tuple):
    """Rows sorted by (width, block, slot, side, tile): the anchor tiles of a block, then the candidate tiles they meet."""
    columns = [part.split() for part in kind.schema.split(", ")]
    names, types = [c[0] for c in columns], [pa.int64() if c[1] == "long" else pa.int32() for c in columns]

    def emit(held: list) -> Iterator[pa.RecordBatch]:
        for searching in held:
            for found in searching.found():
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()).cast(t) for x, t in zip(found, types, strict=True)], names=names)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []
        for batch in batches:
            for k in range(len(batch)):
                width, block, slot, side, number = (batch.column(c)[k].as_py() for c in ("width", "block", "slot", "side", "tile"))
                if (width, block, slot) != place:
                    yield from emit(held)
                    place, held = (width, block, slot), []
                tile = Tile(width, *(batch.column(c)[k].as_py() for c in ("rows", "ids", "labels", "vectors")))
                if side == 0:
                    held.append(kind(number, tile, batch.column("limits")[k].as_py(), *options))
                    continue
                turned = np.ascontiguousarray(tile.vectors.T)
                for searching in held:
                    searching.meet(strassen(searching.tile.vectors, turned, leaf), tile)
        yield from emit(held)

    return search


def _tiles(limit: int):
    def emit(number: int, width: int, held: list) -> pa.RecordBatch:
        rows, ids, labels, vectors = zip(*held, strict=True)
        numbers = [np.array(x, np.int64).tobytes() for x in (rows, ids, labels)]
        kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 4)
        values = (number, width, *numbers, np.concatenate(vectors).astype(np.int64).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=[c.split()[0] for c in TILES.split(", ")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, {}
        for batch in batches:
            vectors = batch.column(3)
            offsets, values = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
            for k, row in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
                vector = values[offsets[k] : offsets[k + 1]]
                tile = held.setdefault(len(vector), [])
                tile.append((*row, vector))
                if len(tile) == limit:
                    yield emit(number, len(vector), held.pop(len(vector)))
                    number += 1
        for width, tile in held.items():
            yield emit(number, width, tile)
            number += 1

    return pack


def _best(found: DataFrame, keys: list[str], score: str, other: str, k: int, rank: str) -> DataFrame:
    """The k best entries of each key out of the heaps of all slots, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc(f"{score}_score"), f"{other}_id", other)
    return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
    tile: int = TILE,
    leaf: int = LEAF,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Components become floor(scale * x); a score is the inner product of two rows. `anchors` chooses rows by vec_id. An
    anchor's positives are its first `positives` other rows of its label: higher scores first, then smaller ids. For
    each, the first `negatives` rows of other labels whose score lies within `window`, in percent of the positive's.

    Rows without a vec_id or label, and vectors that are null, empty or hold null or non-finite components, take no
    part; vectors meet only those of their own length. Rows repeated with one vec_id are rows of their own: each is
    an anchor, a positive or a negative by itself. Anchors without positives or negatives give no rows, nor does an
    empty table. Other columns are not looked at.
    """
    used = vectors.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & usable(F.col(embedding)))
    rows = used.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        quantised(F.col(embedding), scale).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    rows = save(rows, "negatives-rows")
    asking = rows.where("anchor")
    asking = asking.repartition(max(1, -(-asking.count() // (tile * BLOCK))), "row").sortWithinPartitions("row")
    columns = ["row", "vec_id", "label", "vector"]
    asked = save(asking.select(*columns).mapInArrow(_tiles(tile), TILES), "negatives-anchors")
    offered = save(rows.select(*columns).mapInArrow(_tiles(tile), TILES), "negatives-candidates")
    blocks = max(1, -(-asked.count() // BLOCK))

    def met(asked: DataFrame, kind, *options) -> DataFrame:
        numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        hashed = lambda n: F.pmod(F.xxhash64("tile"), F.lit(n)).cast("int")
        a = asked.withColumns({"block": hashed(blocks), "slot": numbers(SLOTS), "side": F.lit(0)})
        c = offered.withColumns({"block": numbers(blocks), "slot": hashed(SLOTS), "side": F.lit(1), "limits": F.lit(None).cast(LIMITS)})
        each = a.unionByName(c).repartition("width", "block", "slot").sortWithinPartitions("width", "block", "slot", "side", "tile")
        return each.mapInArrow(_search(kind, leaf, options), kind.schema)

    found = met(asked.withColumn("limits", F.lit(None).cast(LIMITS)), Positives, positives)
    best = save(_best(found, ["anchor"], "positive", "positive", positives, "positive_rank"), "negatives-positives")
    limits = best.groupBy("tile").agg(F.collect_list(F.struct("place", "positive_rank", "positive_score")).alias("limits"))
    found = met(asked.join(limits, "tile"), Negatives, negatives, window)
    chosen = _best(found, ["anchor", "positive_rank"], "negative", "negative", negatives, "rank")
    return chosen.join(best, ["anchor", "positive_rank"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
