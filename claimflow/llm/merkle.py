"""Merkle manifest of a table: a hash tree for every key value, a tree over their roots, a proof for every row.

A parent is the hash of its children's digests. It retains a copy of its hash state before each child slot, so a
changed child is folded in by resuming the state of its slot: the replacement and the siblings to its right are all
that is hashed again. Rows are numbered within their tree by a range shuffle, and a task holds one subtree of
arity ** LEVELS leaves at most, however many rows a key value has. Subtree roots climb to the next round the same
way; paths come back down, one for each subtree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.common import save

ARITY = 2
LEVELS = 12  # levels of a subtree that a task holds
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "tree string, position long, total long, digest binary"
PATHS = "tree string, position long, subroot binary, root binary, path binary"
FOLDED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


class Slot:
    """A child's place in its parent: the parent's hash state before it, and the digests to its right."""

    __slots__ = ("before", "left", "right")

    def __init__(self, before, left: Sequence[bytes], right: Sequence[bytes]):
        self.before, self.left, self.right = before, left, right

    def fold(self, digest: bytes) -> bytes:
        """The parent's digest with this child replaced."""
        state = self.before.copy()
        state.update(digest)
        for sibling in self.right:
            state.update(sibling)
        return state.hexdigest().encode()


def parent(children: Sequence[bytes]) -> tuple[bytes, list[Slot]]:
    """Digest of a run of children (hex digests) and a slot for each."""
    state, slots = hashlib.sha256(), []
    for k, child in enumerate(children):
        slots.append(Slot(state.copy(), children[:k], children[k + 1 :]))
        state.update(child)
    return state.hexdigest().encode(), slots


def height(total: int, arity: int) -> int:
    """Levels above `total` leaves."""
    levels = 0
    while total > 1:
        total, levels = -(-total // arity), levels + 1
    return levels


def subtree(leaves: Sequence[bytes], levels: int, arity: int) -> tuple[bytes, list[list[Slot]]]:
    """Root of the leaves after so many levels, and the slots of each level's nodes. A run of one is hashed as well."""
    nodes, slots = list(leaves), []
    for _ in range(levels):
        level, above = [], []
        for at in range(0, len(nodes), arity):
            digest, run = parent(nodes[at : at + arity])
            above.append(digest)
            level += run
        slots.append(level)
        nodes = above
    (root,) = nodes
    return root, slots


def write_path(slots: Sequence[Slot]) -> bytes:
    """Slots from the bottom up: for each the numbers of left and right siblings and their digests."""
    steps = ([bytes((len(s.left), len(s.right))), *(bytes.fromhex(d.decode()) for d in (*s.left, *s.right))] for s in slots)
    return b"".join(part for step in steps for part in step)


def read_path(path: bytes) -> list[Slot]:
    """The slots of a written path, each with its state resumed up to the slot."""
    slots, at = [], 0
    while at < len(path):
        left, right = path[at], path[at + 1]
        at += 2
        digests = [path[k : k + 32].hex().encode() for k in range(at, at + 32 * (left + right), 32)]
        at += 32 * (left + right)
        state = hashlib.sha256(b"".join(digests[:left]))
        slots.append(Slot(state, digests[:left], digests[left:]))
    return slots


def leaf_digest(columns: Sequence[str], replaced: Mapping[str, Column] | None = None) -> Column:
    """Hex SHA-256 over the columns: `-` for null, else the value's length in bytes, a colon and the value."""
    replaced = replaced or {}
    parts = []
    for c in columns:
        value = replaced.get(c, F.col(c)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """`rows` with their position and total in their tree, by the order given; which has to tell rows apart.

    Rows are sorted by range over many tasks and counted by (tree, part); only these counts meet in a window.
    """
    keys = ["tree", *order]
    sorted_ = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = save(
        sorted_.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), f"{name}-sorted"
    )
    counts = placed.groupBy("tree", "__part").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = save(
        counts.select(
            "tree",
            "__part",
            (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("__shift"),
            F.sum("n").over(whole).alias("total"),
        ),
        f"{name}-counts",
    )
    met = placed.join(shifts, ["tree", "__part"])
    met = met.withColumn("position", F.col("__at") + F.col("__shift"))
    return save(met.drop("__part", "__at", "__shift"), f"{name}-numbered")


def _chunk(arity: int, levels: int) -> Column:
    return F.expr(f"position div {arity**levels}").alias("chunk")


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by("position")


def _hex(column: pa.ChunkedArray) -> list[bytes]:
    return [d.hex().encode() for d in column.to_pylist()]


def _climb(arity: int, levels: int):
    def up(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        total = table["total"][0].as_py()
        steps = min(levels, height(total, arity))
        root, _ = subtree(_hex(table["digest"]), steps, arity)
        row = (table["tree"][0].as_py(), table["position"][0].as_py() // arity**levels, -(-total // arity**steps), bytes.fromhex(root.decode()))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
        return pa.table([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=["tree", "position", "total", "digest"])

    return up


def _rounds(leaves: DataFrame, arity: int, levels: int, name: str) -> list[DataFrame]:
    """Nodes (tree, position, total, digest) of every round, from the leaves to one root for each tree."""
    most = leaves.agg(F.max("total")).first()[0] or 0
    rounds = [leaves.select("tree", "position", "total", "digest")]
    for _ in range(-(-height(most, arity) // levels)):
        chunks = rounds[-1].groupBy("tree", _chunk(arity, levels))
        rounds.append(save(chunks.applyInArrow(_climb(arity, levels), NODES), f"{name}-nodes"))
    return rounds


def _local(members: pa.Table, arity: int, levels: int) -> tuple[list[bytes], list[list[Slot]]]:
    """Digests of a chunk's members and, for each of them, its slots inside the chunk from the bottom up."""
    leaves = _hex(members["digest"])
    _, slots = subtree(leaves, min(levels, height(members["total"][0].as_py(), arity)), arity)
    return leaves, [[level[k // arity**n] for n, level in enumerate(slots)] for k in range(len(leaves))]


def _descend(arity: int, levels: int):
    def down(members: pa.Table, above: pa.Table) -> pa.Table:
        members = _sorted(members)
        path, subroot, root = (above[c][0].as_py() for c in ("path", "subroot", "root"))
        _, slots = _local(members, arity, levels)
        n = len(slots)
        columns = [members["tree"], members["position"], pa.array([subroot] * n, pa.binary()), pa.array([root] * n, pa.binary())]
        return pa.table([*columns, pa.array([write_path(s) + path for s in slots], pa.binary())], names=["tree", "position", "subroot", "root", "path"])

    return down


def _paths(rounds: list[DataFrame], paths: DataFrame, arity: int, levels: int, name: str) -> DataFrame:
    """Paths from the subtrees of the lowest round to the root, given those of the trees' roots (position 0)."""
    for nodes in reversed(rounds):
        chunks = nodes.groupBy("tree", _chunk(arity, levels))
        met = chunks.cogroup(paths.groupBy("tree", F.col("position").alias("chunk")))
        paths = save(met.applyInArrow(_descend(arity, levels), PATHS), f"{name}-paths")
    return paths


def _fold(arity: int, levels: int):
    def fold(members: pa.Table, above: pa.Table) -> pa.Table:
        members = _sorted(members)
        subroot, root = (above[c][0].as_py().hex() for c in ("subroot", "root"))
        upper = read_path(above["path"][0].as_py())
        over = b"".join(d for s in upper for d in (*s.left, *s.right))
        leaves, slots = _local(members, arity, levels)
        proofs, folded = [], []
        for leaf, changed, own in zip(leaves, members["changed"].to_pylist(), slots, strict=True):
            proof = hashlib.sha256()
            digest = leaf if changed is None else changed.hex().encode()
            for s in own:
                for sibling in (*s.left, *s.right):
                    proof.update(sibling)
                digest = s.fold(digest)
            proof.update(over)
            for s in upper:
                digest = s.fold(digest)
            proofs.append(proof.hexdigest())
            folded.append(digest.decode())
        n = len(leaves)
        columns = [members["doc_id"], [d.decode() for d in leaves], [subroot] * n, [root] * n, proofs, folded]
        return pa.table(columns, names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    return fold


def manifest(
    docs: DataFrame,
    changes: Mapping[str, Column] | None = None,
    where: Column | None = None,
    columns: Sequence[str] = COLUMNS,
    key: str = "lang",
    order: str = "doc_id",
    arity: int = ARITY,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per row of `docs`: its leaf, the roots above it, a digest of its proof, and the root folded anew.

    The leaves of each `key` value ascend by `order` and form a tree; the trees' roots, null first, then by the
    bytes of the value, form the last one. `changes` (column to its changed value) says what the rows that fulfil
    `where` are found to hold now: their leaves are made again, folded along their proofs, and `verified` tells
    whether the root is met. proof_sha256 hashes the siblings level by level, left to right.

    Nulls in a hashed column have a leaf of their own kind; rows with a null `order` come first, and rows that tie
    in it ascend by their leaves. Repeated rows are leaves each by itself; which of them takes which place is told by
    their place in the table. A null or unfulfilled `where` changes nothing. An empty table gives no rows. Other columns are not looked at.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-"))  # orders null first, then by bytes
    changed = F.when(where, leaf_digest(columns, changes)) if changes and where is not None else F.lit(None).cast("string")
    leaves = docs.select(
        tree.alias("tree"),
        F.col(order).cast("long").alias("doc_id"),
        F.unhex(leaf_digest(columns)).alias("digest"),
        F.unhex(changed).alias("changed"),
    )
    leaves = save(leaves.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    numbered = _numbered(leaves, ["doc_id", "digest", "row"], "merkle")
    rounds = _rounds(numbered, arity, levels, "merkle")

    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("member"), "digest")
    tops = _numbered(subroots, ["member"], "merkle-top")
    top_rounds = _rounds(tops, arity, levels, "merkle-top")
    nothing = F.lit(b"").cast("binary")
    start = top_rounds[-1].select("tree", "position", nothing.alias("subroot"), F.col("digest").alias("root"), nothing.alias("path"))
    found = _paths(top_rounds[:-1], start, arity, levels, "merkle-top")
    start = tops.join(found, "position").select(
        F.col("member").alias("tree"), F.lit(0).cast("long").alias("position"), F.col("digest").alias("subroot"), "root", "path"
    )
    paths = _paths(rounds[1:-1], save(start, "merkle-trees"), arity, levels, "merkle")
    folded = numbered.groupBy("tree", _chunk(arity, levels)).cogroup(paths.groupBy("tree", F.col("position").alias("chunk"))).applyInArrow(_fold(arity, levels), FOLDED)
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
