"""Stages by the hash of their key: checksums, the buckets that are read, and what is found to differ."""

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimflow.operators.checks import reconcile_stages, unequal_rows
from claimflow.sources import hashed

SCHEMA = "k string, v double, s string"


def saved(spark, rows, levels=2, parts=3):
    return hashed.save_hashed(spark.createDataFrame(rows, SCHEMA).repartition(parts), "hashed", ["k"], levels)


def some_rows(rng, n):
    return [(f"K{k}", rng.choice([None, 0.0, 1.5, -2.0]), rng.choice([None, "", "x"])) for k in range(n)]


def brute(a, b):
    a, b = Counter(a), Counter(b)
    return {(*row, a[row], b[row]) for row in a | b if a[row] != b[row]}


def changed(rows, rng):
    out = [r for r in rows if r[0] not in ("K3", "K77")]
    out = [(k, 9.0, s) if k in ("K5", "K80") else (k, v, s) for k, v, s in out]
    return [*out, ("new", 1.0, None), out[0]]


def files(stage, bucket):
    return list(Path(f"{stage.path}/rows/{hashed.BUCKET}={bucket}".removeprefix("file://")).glob("*.parquet"))


def test_rows_and_keys_that_differ(spark):
    rng = random.Random(1)
    rows = some_rows(rng, 300)
    other = changed(rows, rng)
    a, b = saved(spark, rows), saved(spark, other, parts=5)
    got = {tuple(r[c] for c in ("k", "v", "s", "copies_a", "copies_b")) for r in unequal_rows(a, b).collect()}
    assert got == brute(rows, other)
    found = {r["k"]: r["found"] for r in reconcile_stages(a, b).collect()}
    assert found == {"K3": "only a", "K77": "only a", "new": "only b", "K5": "differs", "K80": "differs", rows[0][0]: "differs"}


def test_equal_buckets_are_not_read(spark):
    """The rows of all buckets that agree are made unreadable, and the result is the same."""
    rng = random.Random(2)
    rows = some_rows(rng, 400)
    a, b = saved(spark, rows), saved(spark, changed(rows, rng))
    buckets = hashed.differing(a, b)
    assert 0 < len(buckets) <= 6
    want = sorted(map(str, unequal_rows(a, b).collect()))
    broken = 0
    for stage in (a, b):
        for bucket in set(range(256)) - set(buckets):
            for file in files(stage, bucket):
                file.write_bytes(b"not a table")
                broken += 1
                Path(f"{file.parent}/.{file.name}.crc").unlink(missing_ok=True)
    assert broken > 300 and sorted(map(str, unequal_rows(a, b).collect())) == want
    with pytest.raises(Exception, match="parquet|Parquet|PARQUET"):
        a.rows().collect()


def test_only_branches_that_differ_are_compared(spark):
    rows = some_rows(random.Random(3), 200)
    a, b = saved(spark, rows), saved(spark, [*rows[:-1], (rows[-1][0], 77.0, "y")], parts=1)
    (bucket,) = hashed.differing(a, b)
    expected = spark.createDataFrame([rows[-1]], SCHEMA).select(hashed.bucket_of(["k"], 2)).first()[0]
    assert bucket == expected
    nodes = {(r["level"], r["node"]): (r["n"], r["sum"], r["mix"]) for r in a.tree().collect()}
    leaves = [v for (level, _), v in nodes.items() if level == 2]
    assert nodes[0, 0][0] == 200 == sum(n for n, _, _ in leaves) and nodes[0, 0][1] == sum(s for _, s, _ in leaves)


def test_equal_stages_differ_nowhere(spark):
    rows = [*some_rows(random.Random(4), 100), (None, 1.0, "no key"), (None, 1.0, "no key")]
    a, b = saved(spark, rows), saved(spark, rows[::-1], parts=7)
    assert hashed.differing(a, b) == [] and unequal_rows(a, b).collect() == [] and reconcile_stages(a, b).collect() == []


def test_copies_count(spark):
    """Pairs of copies would cancel in the mix; the count and the sum tell them."""
    a, b = saved(spark, [("K", 1.0, "x")] * 3), saved(spark, [("K", 1.0, "x")])
    assert [tuple(r) for r in unequal_rows(a, b).select("k", "copies_a", "copies_b").collect()] == [("K", 3, 1)]


def test_empty_sides(spark):
    rows = some_rows(random.Random(5), 20)
    empty, full = saved(spark, []), saved(spark, rows)
    assert {r["found"] for r in reconcile_stages(empty, full).collect()} == {"only b"}
    assert reconcile_stages(full, empty).count() == 20 and hashed.differing(empty, empty) == []


def test_a_hot_key_is_written_by_several_tasks(spark, tiny_splits):
    rows = [("hot", float(k), "x" * 50) for k in range(4000)] + some_rows(random.Random(6), 200)
    stage = saved(spark, rows, parts=6)
    bucket = spark.createDataFrame([rows[0]], SCHEMA).select(hashed.bucket_of(["k"], 2)).first()[0]
    assert len(files(stage, bucket)) > 1 and stage.rows([bucket]).where(F.col("k") == "hot").count() == 4000


def test_other_layouts_are_refused(spark):
    a, b = saved(spark, [("K", 1.0, "x")]), saved(spark, [("K", 1.0, "x")], levels=1)
    with pytest.raises(ValueError, match="same keys"):
        hashed.differing(a, b)
