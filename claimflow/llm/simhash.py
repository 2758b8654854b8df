"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

A fingerprint is a path of bits from the root of a trie. Two subtrees are compared by going down both together:
wherever the paths take different bits one more differing bit is spent, and a pair of nodes that has spent more
than the budget is left with all that lies below it. The upper levels of the trie are cut into subtrees that Spark
pairs by a join (a subtree meets those whose prefix differs in no more bits than the budget); below them each task
walks one pair of subtrees, level by level on arrays.

Groups may be large, so a task gives out no more than a spanning forest of the links it finds; components are the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import save
from claimflow.llm.components import connected_components

BITS = 64
SHINGLE_WORDS = 3
BUDGET = 2
SEED = 42
SUBTREE = 1024  # fingerprints of a subtree on average, and at most in one piece
LEAVES = 16  # pairs of nodes with no more pairs of leaves are compared leaf by leaf
FRONT = 1 << 19  # node pairs looked at together


def shingle_hashes(text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle, repeats included; of the whole sequence where it has fewer words, none without words."""
    joined = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())  # bytes: A-Z and the six blanks only
    if not joined:
        return np.zeros(0, np.uint64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(joined)][words - 1 :] or [len(joined)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=False)], np.uint64)


def simhash(text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned fingerprint: a bit is set if it is in over half the hashes of the shingles, repeats included."""
    hashes = shingle_hashes(text, words, seed)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64), pa.int64())


def _fingerprint(text: str, words: int) -> Column:
    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        return _signed([simhash(t.as_py() or "", words) for t in texts])

    return fingerprint(F.col(text))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint as a signed long) per row; null texts count as empty."""
    return docs.select(F.col(doc_id).alias("doc_id"), _fingerprint(text, words).alias("fingerprint"))


def walk_together(
    a: np.ndarray, b: np.ndarray, depth: int, spent: int, budget: int, same: bool, leaves: int = LEAVES
) -> Iterator[tuple]:
    """Index pairs (i, j) of leaves of two subtrees (sorted unsigned arrays, roots at `depth`) within the budget."""
    stack = [(depth, np.array([[0, len(a), 0, len(b), spent]], np.int64))]
    while stack:
        depth, front = stack.pop()
        if len(front) > FRONT:
            stack += [(depth, part) for part in np.array_split(front, -(-len(front) // FRONT))]
            continue
        na, nb = front[:, 1] - front[:, 0], front[:, 3] - front[:, 2]
        few = (na * nb <= leaves) | (depth == BITS)
        if few.any():
            alo, blo, na, nb = front[few, 0], front[few, 2], na[few], nb[few]
            n = na * nb
            of = np.repeat(np.arange(len(n)), n)
            k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            i, j = alo[of] + k // nb[of], blo[of] + k % nb[of]
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if same:
                near &= i < j
            yield i[near], j[near]
            front = front[~few]
        if not len(front):
            continue
        bit = np.uint64(BITS - 1 - depth)
        alo, ahi, blo, bhi, cost = front.T

        def half(values, lo, bit=bit):
            return np.searchsorted(values, ((values[lo] >> bit) | np.uint64(1)) << bit)

        amid, bmid = half(a, alo), half(b, blo)
        twin = same & (alo == blo) & (ahi == bhi)  # a node with itself: one of the two mixed pairs will do
        children = [
            np.stack([alo, amid, blo, bmid, cost], 1),
            np.stack([amid, ahi, bmid, bhi, cost], 1),
            np.stack([alo, amid, bmid, bhi, cost + 1], 1),
            np.stack([amid, ahi, blo, bmid, cost + 1], 1)[~twin],
        ]
        front = np.concatenate(children)
        front = front[(front[:, 0] < front[:, 1]) & (front[:, 2] < front[:, 3]) & (front[:, 4] <= budget)]
        if len(front):
            stack.append((depth + 1, front))


def join_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest labels of the components that the links (i, j) make of those that `label` has."""
    while len(i):
        x, y = label[i], label[j]
        open_ = x != y
        if not open_.any():
            break
        i, j, x, y = i[open_], j[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(nearer := label[label], label):
            label = nearer
    return label


def _pieces(prefix_bits: int):
    """Sorted fingerprints of a partition as pieces of one subtree each, with the bits all members share."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.uint64)

        def emit(values: np.ndarray):
            prefixes = values >> np.uint64(BITS - prefix_bits)
            bounds = np.flatnonzero(np.diff(prefixes)) + 1
            rows = []
            for part in np.split(values, bounds):
                for at in range(0, len(part), SUBTREE):
                    piece = part[at : at + SUBTREE]
                    low, high = int(piece[0]), int(piece[-1])
                    shared = ~((1 << (low ^ high).bit_length()) - 1) & (2**BITS - 1)
                    rows.append((low >> (BITS - prefix_bits), low, shared, piece.tobytes()))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    _signed([r[1] for r in rows]),
                    _signed([r[2] for r in rows]),
                    pa.array([r[3] for r in rows], pa.binary()),
                ],
                names=["prefix", "low", "shared", "members"],
            )

        for batch in batches:
            held = np.concatenate([held, batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)])
            if len(held) > 64 * SUBTREE:
                yield emit(np.sort(held))
                held = np.zeros(0, np.uint64)
        if len(held):
            yield emit(np.sort(held))

    return cut


def _walk(prefix_bits: int, budget: int):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lefts, rights = batch.column("members"), batch.column("other")
            found_a, found_b = [], []
            for k in range(len(batch)):
                a, b = (np.frombuffer(x[k].as_py(), np.uint64) for x in (lefts, rights))
                same = np.array_equal(a, b)
                spent = 0
                if not same:
                    spent = int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(BITS - prefix_bits))) if prefix_bits else 0
                values = a if same else np.concatenate([a, b])
                label, shift = np.arange(len(values)), 0 if same else len(a)
                for i, j in walk_together(a, b, prefix_bits, spent, budget, same):
                    label = join_labels(label, i, j + shift)
                linked = np.flatnonzero(label != np.arange(len(values)))
                found_a.append(values[linked])
                found_b.append(values[label[linked]])
            yield pa.RecordBatch.from_arrays(
                [_signed(np.concatenate(found_a)), _signed(np.concatenate(found_b))], names=["a", "b"]
            )

    return walk


def trie_links(distinct: DataFrame, size: int, budget: int = BUDGET) -> DataFrame:
    """Links (a, b) that span the components of all pairs of `distinct` fingerprints within `budget` bits."""
    prefix_bits = max(1, min(24, (max(size, 1) // SUBTREE).bit_length()))
    pieces = save(
        distinct.select("fingerprint").repartitionByRange("fingerprint").sortWithinPartitions("fingerprint")
        .mapInArrow(_pieces(prefix_bits), "prefix long, low long, shared long, members binary"),
        "simhash-subtrees",
    )
    masks = [sum(1 << bit for bit in bits) for n in range(budget + 1) for bits in combinations(range(prefix_bits), n)]
    left = pieces.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
    left = left.withColumn("partner", F.col("prefix").bitwiseXOR(F.col("mask"))).where(F.col("partner") >= F.col("prefix"))
    right = pieces.select(
        F.col("prefix").alias("partner"),
        F.col("low").alias("other_low"),
        F.col("shared").alias("other_shared"),
        F.col("members").alias("other"),
    )
    agreed = F.col("low").bitwiseXOR(F.col("other_low")).bitwiseAND(F.col("shared")).bitwiseAND(F.col("other_shared"))
    pairs = left.join(right, "partner").where(
        (F.bit_count(agreed) <= budget) & ((F.col("mask") != 0) | (F.col("other_low") >= F.col("low")))
    )
    return pairs.select("members", "other").mapInArrow(_walk(prefix_bits, budget), "a long, b long")


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, budget: int = BUDGET
) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that can be reached over links of `budget` or fewer differing bits, itself
    included. A text without words (null, empty, blank) has fingerprint zero, which is linked like any other. A
    null doc_id never is a component_id beside a known one; a component without any has null. Repeated rows stay
    rows of their own in one component. An empty table gives no rows. Other columns of `docs` are not looked at.
    """
    return _components(docs, doc_id, text, words, budget).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def rooted(distinct: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(fingerprint, first, root) of distinct rows (fingerprint, first): root is the same for all of a component."""
    found = connected_components(trie_links(distinct, distinct.count(), budget))
    joined = distinct.join(found, distinct["fingerprint"] == found["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    return save(joined, "simhash-roots")


def _components(docs: DataFrame, doc_id: str, text: str, words: int, budget: int) -> DataFrame:
    rows = save(fingerprints(docs, doc_id, text, words), "simhash-rows")
    distinct = save(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = rooted(distinct, budget)
    least = save(roots.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-least")
    labels = save(roots.join(least, "root").select("fingerprint", "component_id"), "simhash-labels")
    return rows.join(labels, "fingerprint")


def drop_near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, budget: int = BUDGET
) -> DataFrame:
    """The rows of `docs`, all columns: of every component of `near_groups` the one with the smallest doc_id.

    A null doc_id counts as larger than any; ties go by a hash of the text, and of rows repeated with one doc_id and
    text one stays. Null, empty and blank texts have fingerprint zero and are linked like any other. Texts of any length
    are read whole. An empty table gives no rows. Other columns are carried, whatever they are called.
    """
    digest = F.xxhash64(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), digest.alias("digest"), _fingerprint(text, words).alias("fingerprint"))
    rows = save(rows, "simhash-rows")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "digest")
    roots = rooted(save(rows.groupBy("fingerprint").agg(F.min(place).alias("first")), "simhash-distinct"), budget)
    first = roots.groupBy("root").agg(F.min("first").alias("first"))
    stays = save(first.select(F.col("first.doc_id").alias("__stays"), F.col("first.digest").alias("__digest")), "simhash-stays")
    # rows that stay and have a copy of one doc_id and text
    tied = rows.groupBy("doc_id", "digest").count().where("count > 1")
    tied = save(tied.select(F.col("doc_id").alias("__stays"), F.col("digest").alias("__digest")), "simhash-tied")

    same = F.col(doc_id).eqNullSafe(F.col("__stays")) & (digest == F.col("__digest"))
    # one plan at every size: both sides are shuffled
    kept = docs.join(stays.hint("merge"), same, "left_semi")
    if tied.isEmpty():
        return kept
    one = kept.join(tied.hint("merge"), same).dropDuplicates(["__stays", "__digest"]).select(*docs.columns)
    return kept.join(tied.hint("merge"), same, "left_anti").unionByName(one)
