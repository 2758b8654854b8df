"""Token ids packed into fixed-length sequences and written in binary form.

Every task tokenises its own rows and packs them in buffers of a bounded number of tokens, so tokens are never
shuffled. Documents longer than a sequence are split into pieces without loss. Pieces go largest first into the
sequence with the least room that holds them; a segment tree over the rooms finds it.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import save

SEQUENCE = 2048
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PAD = 50256  # the id after the last rank
BUFFER = 1 << 22  # tokens held by a task before it packs them
# How the public byte-level vocabulary splits a text before merging
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PACKED = (
    "sequence_id long, input_ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<long>, pieces array<int>, starts array<long>"
)


@functools.cache
def tokenizer(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("packed", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class Rooms:
    """Open sequences by the room left in them: a segment tree whose leaves are rooms and whose nodes count sequences."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.held: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.held[room].append(sequence)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, needed: int) -> tuple[int, int] | None:
        """(room, sequence) with the least room of at least `needed`; None if there is none."""
        count, node = self.count, needed + self.leaves
        while not count[node]:
            while node & 1:  # a right child: what is larger lies to the right of an ancestor
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not count[node]:
                node += 1
        room = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.held[room].pop()


def best_fit_decreasing(lengths: list[int], sequence: int) -> list[list[int]]:
    """The pieces of every sequence, in the order they were put. Pieces come largest first, none above `sequence`."""
    rooms, out = Rooms(sequence), []
    for piece, n in enumerate(lengths):
        room, at = rooms.take(n) or (sequence, len(out))
        if at == len(out):
            out.append([])
        out[at].append(piece)
        if room > n:
            rooms.put(room - n, at)
    return out


def _pack(path: str, sequence: int, pad: int, buffer: int):
    kind = np.dtype("<u2") if pad < 1 << 16 else np.dtype("<u4")

    def rows(held: list[tuple[int | None, np.ndarray]], base: int) -> pa.RecordBatch:
        pieces = [(len(ids[at : at + sequence]), k, at) for k, (_, ids) in enumerate(held) for at in range(0, len(ids), sequence)]
        pieces.sort(key=lambda p: (-p[0], p[1], p[2]))
        out: list[tuple] = []
        for members in best_fit_decreasing([p[0] for p in pieces], sequence):
            parts = [pieces[m] for m in members]
            ends = np.cumsum([0, *(p[0] for p in parts)])
            ids = np.full(sequence, pad, kind)
            for (n, k, at), begin in zip(parts, ends, strict=False):
                ids[begin : begin + n] = held[k][1][at : at + n]
            out.append(
                (
                    base + len(out),
                    ids.tobytes(),
                    int(ends[-1]),
                    ends.tolist(),
                    ends[:-1].tolist(),
                    [held[p[1]][0] for p in parts],
                    [p[2] // sequence for p in parts],
                    [p[2] for p in parts],
                )
            )
        empty = [doc for doc, ids in held if not len(ids)]
        if empty:  # documents without tokens lie in no sequence
            out.append((None, b"", 0, [0] * (len(empty) + 1), [0] * len(empty), empty, [0] * len(empty), [0] * len(empty)))
        schema = pa.schema(
            [
                ("sequence_id", pa.int64()),
                ("input_ids", pa.binary()),
                ("n_tokens", pa.int32()),
                ("cu_seqlens", pa.list_(pa.int32())),
                ("position_resets", pa.list_(pa.int32())),
                ("doc_ids", pa.list_(pa.int64())),
                ("pieces", pa.list_(pa.int32())),
                ("starts", pa.list_(pa.int64())),
            ]
        )
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode_to_numpy
        base, held, tokens = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "", disallowed_special=()).astype(kind)
                held.append((doc, ids))
                tokens += max(len(ids), 16)
                if tokens >= buffer:
                    out = rows(held, base)
                    base, held, tokens = base + len(out), [], 0
                    yield out
        if held:
            yield rows(held, base)

    return pack


def pack_tokens(
    docs: DataFrame,
    sequence: int = SEQUENCE,
    vocabulary: str = VOCABULARY,
    pad: int = PAD,
    buffer: int = BUFFER,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Packed sequences, written to the shared folder: one row each with its ids as little-endian numbers.

    input_ids: `sequence` ids of 2 bytes (4 where `pad` needs them), padded with `pad` after n_tokens. cu_seqlens:
    0 and the end of every segment. position_resets: where a position counter goes back to 0. doc_ids, pieces,
    starts: of every segment the document, the number of its piece and the piece's first token in the document.

    Null texts count as empty. Documents without tokens are listed in rows whose sequence_id is null and input_ids
    empty. A null doc_id is kept. Repeated rows are packed each by itself. Special tokens in a text are ordinary
    text. An empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return save(rows.mapInArrow(_pack(vocabulary, sequence, pad, buffer), PACKED), "packed-tokens")


def segments(packed: DataFrame, pad: int = PAD) -> DataFrame:
    """One row per segment: doc_id, piece, start, n_tokens, sequence_id, offset, sequence_tokens, ids_sha256."""
    width = 2 if pad < 1 << 16 else 4
    each = packed.select(
        "sequence_id", "input_ids", F.col("n_tokens").alias("sequence_tokens"), "cu_seqlens", "doc_ids", "pieces", "starts",
        F.posexplode(F.arrays_zip("doc_ids", "pieces", "starts")).alias("k", "segment"),
    ).withColumn("offset", F.col("cu_seqlens")[F.col("k")])
    n = F.col("cu_seqlens")[F.col("k") + 1] - F.col("offset")
    ids = F.expr(f"substring(input_ids, offset * {width} + 1, n_tokens * {width})")
    return each.withColumn("n_tokens", n).select(
        F.col("segment.doc_ids").alias("doc_id"),
        F.col("segment.pieces").alias("piece"),
        F.col("segment.starts").alias("start"),
        "n_tokens",
        "sequence_id",
        F.when(F.col("sequence_id").isNotNull(), F.col("offset")).alias("offset"),
        "sequence_tokens",
        F.sha2(ids, 256).alias("ids_sha256"),
    )


def matrix(rows: list, sequence: int = SEQUENCE, pad: int = PAD) -> tuple[np.ndarray, np.ndarray]:
    """Id and position matrices of some collected rows: positions count from 0 at every reset."""
    kind = np.dtype("<u2") if pad < 1 << 16 else np.dtype("<u4")
    ids = np.stack([np.frombuffer(r["input_ids"], kind) for r in rows])
    positions = np.tile(np.arange(sequence), (len(rows), 1))
    for line, r in zip(positions, rows, strict=True):
        bounds = [*r["position_resets"], r["n_tokens"], sequence]
        for a, b in zip(bounds, bounds[1:], strict=False):
            line[a:b] = np.arange(b - a)
    return ids, positions
