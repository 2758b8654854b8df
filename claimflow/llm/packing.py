"""Packing documents into sequences of several permitted lengths.

Documents longer than the longest length are split without loss. Pieces are dealt by a hash of their content into
groups of a bounded number of words, and each group is packed by itself: largest piece first, into the open
sequence with the least room that holds it. Where none does, every permitted length is filled on trial with the pieces
that are left, and the one whose filling costs least per word is opened. This is done with all lengths up to each one that
holds the largest piece, and with the longest alone, and the packing that costs least is kept. In each of them every
sequence shrinks at the end to the least permitted length for what it holds.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import save
from claimflow.llm.words import word_count

CAPACITIES = (1024, 2048, 4096, 8192)
GROUP_WORDS = 1 << 19  # words that a group holds on average
COPIES = 4096  # copies of a row that are numbered at once
PACKED = (
    "doc_id long, copy long, size long, piece long, start long, length long, "
    "bin_id long, bin_capacity long, bin_used long, bin_offset long"
)


def sequence_cost(capacity: int) -> float:
    """What a sequence of this length costs: its positions, and a fixed part that favours fewer sequences."""
    return capacity + 64.0


def _trial(values: list[int], counts: list[int], top: int, room: int) -> int:
    """Words of the pieces left (`counts` of ascending `values`, none above index top) that largest first go into this room."""
    begun = room
    while top >= 0 and room:
        top = bisect.bisect_right(values, room, 0, top + 1) - 1
        if top >= 0:
            room -= min(counts[top], room // values[top]) * values[top]
            top -= 1
    return begun - room


def _fill(lengths: Sequence[int], sizes: list[int], opened: list[int], cost: Callable[[int], float]) -> tuple[list[int], list[int]]:
    """The bin of every piece and what every bin holds, where bins of the lengths `opened` may be opened."""
    values, counts = np.unique(np.array(lengths, np.int64), return_counts=True)
    values, counts = values.tolist(), counts.tolist()
    top = len(values) - 1
    rooms: list[tuple[int, int]] = []  # (room, bin) of open bins, least room first
    bins, used = [], []
    for n in lengths:
        while values[top] > n:
            top -= 1
        at = bisect.bisect_left(rooms, (n, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            best = None
            for c in opened:
                if c >= n:
                    filled = _trial(values, counts, top, c) if len(opened) > 1 else c
                    key = (cost(sizes[bisect.bisect_left(sizes, filled)]) / filled, -c)
                    best = key if best is None else min(best, key)
            room, b = -best[1], len(used)
            used.append(0)
        used[b] += n
        counts[top] -= 1
        bins.append(b)
        if room > n:
            bisect.insort(rooms, (room - n, b))
    return bins, used


def best_fit(
    lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, cost: Callable[[int], float] = sequence_cost
) -> tuple[list[int], list[int]]:
    """The bin of every piece, and the capacity of every bin. Pieces are given largest first, none above the largest."""
    sizes = sorted(capacities)
    if not lengths:
        return [], []
    longest = [k for k, c in enumerate(sizes) if c >= lengths[0]]
    best = None
    for opened in [sizes[-1:], *[sizes[: k + 1] for k in reversed(longest)]]:
        bins, used = _fill(lengths, sizes, opened, cost)
        capacity = [sizes[bisect.bisect_left(sizes, n)] for n in used]
        total = sum(map(cost, capacity))
        if best is None or total < best[0]:
            best = total, bins, capacity
    return best[1:]


def _pack_group(capacities: Sequence[int], cost: Callable[[int], float]):
    longest = max(capacities)

    def pack(table: pa.Table) -> pa.Table:
        group = table["group"][0].as_py()
        sizes = table["size"].to_numpy()
        ids = table["doc_id"]
        known = np.array([x is not None for x in ids.to_pylist()], bool)
        copies = table["copy"].to_numpy()
        pieces = np.maximum(1, -(-sizes // longest))
        row = np.repeat(np.arange(len(sizes)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = piece * longest
        length = np.minimum(sizes[row] - start, longest)
        # largest first; ties by content, so that a rerun packs alike whatever order the rows arrive in
        number = np.where(known, ids.fill_null(0).to_numpy(), -1)
        order = np.lexsort((piece, copies[row], table["digest"].to_numpy()[row], number[row], ~known[row], -length))
        row, piece, start, length = row[order], piece[order], start[order], length[order]
        full = int(np.count_nonzero(length))
        bins, capacity = best_fit(length[:full].tolist(), capacities, cost)
        bins, capacity = np.array(bins, np.int64), np.array(capacity, np.int64)
        used = np.bincount(bins, weights=length[:full], minlength=len(capacity)).astype(np.int64) if full else bins
        by_bin = np.argsort(bins, kind="stable")
        run = np.cumsum(length[:full][by_bin]) - length[:full][by_bin]
        offset = np.empty(full, np.int64)
        first = np.concatenate(([0], np.cumsum(used)))[:-1] if full else run
        offset[by_bin] = run - first[bins[by_bin]] if full else run

        def column(values) -> pa.Array:
            return pa.concat_arrays([pa.array(values, pa.int64()), pa.nulls(len(row) - full, pa.int64())])

        return pa.table(
            {
                "doc_id": ids.combine_chunks().take(pa.array(row)),
                "copy": pa.array(copies[row]),
                "size": pa.array(sizes[row]),
                "piece": pa.array(piece),
                "start": pa.array(start),
                "length": pa.array(length),
                "bin_id": column((np.int64(group) << 32) + bins),
                "bin_capacity": column(capacity[bins] if full else bins),
                "bin_used": column(used[bins] if full else bins),
                "bin_offset": column(offset),
            }
        )

    return pack


def pack_documents(
    docs: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
    group_words: int = GROUP_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece of every document, with the sequence (bin) and the place in it.

    size: words of the text; the piece covers words start to start + length. copy numbers rows repeated with one
    doc_id and text, which are packed one by one. A text without words (null, empty, blank) is one piece of length 0
    in no bin (null). A null doc_id is packed like any other. An empty table gives no rows. Reruns agree.
    """
    sized = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("digest")
    )
    rows = save(sized.groupBy("doc_id", "size", "digest").agg(F.count(F.lit(1)).alias("copies")), "packing-rows")
    # a row counts as 64 words at least, so that rows without words are spread as well
    words = rows.agg(F.sum(F.greatest("size", F.lit(64)) * F.col("copies"))).first()[0] or 0
    groups = max(1, -(-words // group_words))
    last = F.col("copies") - 1
    blocks = rows.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(COPIES).cast("long"))))
    each = blocks.withColumn("copy", F.explode(F.sequence(F.col("at"), F.least(F.col("at") + COPIES - 1, last)))).drop("copies", "at")
    dealt = each.withColumn("group", F.pmod(F.xxhash64("doc_id", "digest", "copy"), F.lit(groups)).cast("long"))
    return dealt.groupBy("group").applyInArrow(_pack_group(capacities, cost), PACKED)
