"""Exact duplicates by counting quotient filters.

Each input partition builds a counting quotient filter over the 64-bit fingerprints of its texts: the high bits
(the quotient) name a block, the low bits (the remainders) lie sorted in the block beside their counts. Filters of
different partitions merge without loss, block by block, as sorted remainders are added up. A group of copies is
one remainder with a count wherever it lies, so no group of any size meets in one task. Only texts whose
fingerprint counts more than one are routed to the comparison of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import ascii_lower, save

FILTER = "block long, remainders binary, counts binary"
REPEATED = "fingerprint long"
BLOCK_ROWS = 1024  # fingerprints that a block holds on average


def filter_of(values: np.ndarray, counts: np.ndarray, remainder_bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks (quotient, sorted remainders, counts) of unsigned fingerprints; equal ones are added up."""
    values, where = np.unique(values, return_inverse=True)
    counts = np.bincount(where, weights=counts, minlength=len(values)).astype(np.int64)
    quotients = values >> np.uint64(remainder_bits) if remainder_bits < 64 else np.zeros(len(values), np.uint64)
    cuts = np.flatnonzero(np.diff(quotients)) + 1
    for at, rest, n in zip(np.split(quotients, cuts), np.split(values, cuts), np.split(counts, cuts), strict=True):
        if len(at):
            low = rest if remainder_bits == 64 else rest & np.uint64((1 << remainder_bits) - 1)
            yield int(at[0]), low, n


def _batch(blocks) -> pa.RecordBatch:
    blocks = list(blocks)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([b for b, _, _ in blocks], pa.int64()),
            pa.array([r.tobytes() for _, r, _ in blocks], pa.binary()),
            pa.array([n.tobytes() for _, _, n in blocks], pa.binary()),
        ],
        names=["block", "remainders", "counts"],
    )


def build_filters(remainder_bits: int, flush: int = 1 << 20):
    """Filter blocks of one partition; emitted whenever `flush` fingerprints are held, so memory is bounded."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            if sum(map(len, held)) >= flush:
                values = np.concatenate(held)
                held = []
                yield _batch(filter_of(values, np.ones(len(values)), remainder_bits))
        if held:
            values = np.concatenate(held)
            yield _batch(filter_of(values, np.ones(len(values)), remainder_bits))

    return build


def merge_filters(remainder_bits: int):
    """Merge the blocks of one quotient and return the fingerprints that count more than one."""

    def merge(table: pa.Table) -> pa.Table:
        values = np.concatenate([np.frombuffer(x, np.uint64) for x in table["remainders"].to_pylist()])
        counts = np.concatenate([np.frombuffer(x, np.int64) for x in table["counts"].to_pylist()])
        quotient = np.uint64(table["block"][0].as_py())
        out = []
        for _, rest, n in filter_of(values, counts, 64):
            out.append(rest[n > 1])
        rest = np.concatenate(out) if out else np.zeros(0, np.uint64)
        full = rest if remainder_bits == 64 else (quotient << np.uint64(remainder_bits)) | rest
        return pa.table({"fingerprint": pa.array(full.view(np.int64), pa.int64())})

    return merge


def repeated_fingerprints(fingerprints: DataFrame, rows: int) -> DataFrame:
    """Fingerprints (one long column) that occur more than once among `rows` rows."""
    quotient_bits = max(1, min(40, (max(rows, 1) // BLOCK_ROWS).bit_length()))
    filters = fingerprints.mapInArrow(build_filters(64 - quotient_bits), FILTER)
    return filters.groupBy("block").applyInArrow(merge_filters(64 - quotient_bits), REPEATED)


def _body(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn("__body", ascii_lower(F.col(text))).withColumn("__sha", F.sha2("__body", 256))


def _groups(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows without their texts (doc_id, sha, row), and one row per group of copies with the row that stays."""
    base = _body(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text")), "__text")
    base = base.select("doc_id", "__body", "__sha", F.xxhash64("__body").alias("fingerprint"))
    rows = save(
        base.select("doc_id", "__sha", "fingerprint", F.monotonically_increasing_id().alias("row")), "dedup-rows"
    )
    repeated = save(repeated_fingerprints(rows.select("fingerprint"), rows.count()), "dedup-repeated")

    routed = base.join(repeated, "fingerprint", "left_semi")
    per_text = routed.groupBy("__body").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    per_digest = (
        per_text.select(F.sha2("__body", 256).alias("__sha"), "keep_id", "group_size")
        .groupBy("__sha")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    )
    clash = F.raise_error(F.lit("two different texts share a SHA-256")).cast("boolean")
    groups = save(
        per_digest.where(F.when(F.col("texts") > 1, clash).otherwise(F.lit(True))).drop("texts"), "dedup-groups"
    )
    stays = rows.join(groups.select("__sha", "keep_id"), "__sha").where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    first = stays.groupBy("__sha").agg(F.min("row").alias("keep_row"), F.count(F.lit(1)).alias("ties"))
    return rows, save(groups.join(first, "__sha"), "dedup-choice")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the largest doc_id
    stays; a null doc_id counts as smaller than any. Of rows repeated with that doc_id and text one is kept. An
    empty table gives no rows. Columns of `docs` other than the two named are not looked at. Two different texts
    of one SHA-256 fail the job.
    """
    rows, groups = _groups(docs, doc_id, text)
    # both sides are read from files, so adaptive execution can split a hot digest
    joined = rows.join(groups, "__sha", "left")
    copied = F.col("keep_row").isNotNull()
    return joined.select(
        "doc_id",
        F.when(copied, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (~copied | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that `exact_groups` keeps."""
    _, groups = _groups(docs, doc_id, text)
    groups = groups.select("__sha", F.col("keep_id").alias("__keep_id"), F.col("ties").alias("__ties"))
    # one plan at every size: both sides are shuffled, and a hot digest is split
    joined = _body(docs, text).join(groups.hint("merge"), "__sha", "left")
    stays = joined.where(F.col("__ties").isNull() | F.col(doc_id).eqNullSafe(F.col("__keep_id")))
    if groups.where(F.col("__ties") > 1).isEmpty():
        return stays.select(*docs.columns)
    repeated = F.coalesce(F.col("__ties") > 1, F.lit(False))
    return (
        stays.where(~repeated)
        .unionByName(stays.where(repeated).dropDuplicates(["__sha"]))
        .select(*docs.columns)
    )
