"""Hard negatives against a plain reading of their definition; Strassen and the heaps by themselves."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from claimflow.llm import hard_negatives as hn
from claimflow.llm.queries import NEGATIVES_SQL

SCHEMA = "vec_id long, label int, embedding array<double>, row int, tile string, block int, anchor string"


def brute(rows, every=100, positives=5, negatives=5, window=(80, 100), scale=256):
    used = [
        (i, label, [math.floor(scale * x) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for k, (i, label, v) in enumerate(used):
        if i % every:
            continue
        others = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, n, lab) for n, (j, lab, w) in enumerate(used) if n != k and len(w) == len(v)]
        others.sort()
        for p, positive_id, _, lab in [o for o in others if o[3] == label][:positives]:
            near = [o for o in others if o[3] != label and window[0] * -p <= 100 * -o[0] <= window[1] * -p]
            out += [(i, positive_id, rank, o[1], -p, -o[0]) for rank, o in enumerate(near[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, every=100, parts=3, **options):
    df = spark.createDataFrame([(*r, 1, "t", 2, "a") for r in rows], SCHEMA).repartition(parts)
    found = hn.hard_negatives(df, F.col("vec_id") % every == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def some_rows(rng, n, width=7, labels=3):
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in rng.sample(range(3 * n), n):
        c = rng.choice(centres)
        rows.append((i, rng.randrange(labels), [x + rng.gauss(0, 0.2) for x in c]))
    return rows


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 3, 4), (16, 16, 16), (33, 17, 40), (70, 64, 91), (1, 64, 500)])
def test_strassen(shape):
    rng = np.random.default_rng(sum(shape))
    m, k, n = shape
    a, b = rng.integers(-300, 300, (m, k)), rng.integers(-300, 300, (k, n))
    for leaf in (1, 2, 16):
        assert (hn.strassen(a, b, leaf) == a @ b).all()
    large = rng.integers(-(2**40), 2**40, (m, k)), rng.integers(-(2**12), 2**12, (k, n))
    want = [[sum(int(x) * int(y) for x, y in zip(r, c, strict=True)) for c in large[1].T] for r in large[0]]
    assert hn.strassen(*large, 1).tolist() == want  # sums in between may pass 2^63


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(4)
    scores, ids, allowed = rng.integers(-3, 4, (20, 90)), rng.integers(0, 40, 90), rng.random((20, 90)) < 0.6
    numbers = np.arange(90)
    want = [sorted((-scores[r, c], ids[c], c) for c in range(90) if allowed[r, c])[:6] for r in range(20)]
    for step in (1, 4, 90):
        parts = [rng.permutation(90)[k::step] for k in range(step)] if step > 1 else [rng.permutation(90)]
        order = np.concatenate([np.sort(p) for p in parts]) if step > 1 else parts[0]
        order = order if len(set(order.tolist())) == 90 else np.arange(90)
        heaps = hn.Heaps(20, 6)
        for at in range(0, 90, step):
            c = order[at : at + step]
            heaps.offer(scores[:, c], ids[c], numbers[c], allowed[:, c])
        got = [[] for _ in range(20)]
        for r, s, i, n in zip(heaps.at, heaps.score, heaps.ids, heaps.number, strict=True):
            got[r].append((-s, i, n))
        assert got == want


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"tile": 7, "leaf": 2}), (3, {"tile": 40, "positives": 2, "negatives": 1, "window": (50, 90), "scale": 16})])
def test_equals_the_definition(spark, seed, options):
    rows = some_rows(random.Random(seed), 260)
    plain = {k: v for k, v in options.items() if k in ("positives", "negatives", "window", "scale")}
    got = mined(spark, rows, every=10, **options)
    assert got == brute(rows, 10, **plain) and len(got) > 40


def test_several_blocks_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 1)
    rows = some_rows(random.Random(5), 150)
    assert mined(spark, rows, every=3, tile=6) == brute(rows, 3)


def test_one_vector_holds_a_third_of_the_rows(spark):
    rng = random.Random(6)
    rows = some_rows(rng, 200) + [(1000 + k, k % 2, [0.5] * 7) for k in range(120)]
    assert mined(spark, rows, every=50, tile=30) == brute(rows, 50)


def test_every_case(spark):
    rows = [
        (0, 1, [1.0, 0.5]),
        (0, 1, [0.5, 0.5]),  # a row of its own
        (1, 1, [0.9, 0.5]),
        (1, 1, [0.9, 0.5]),
        (2, 2, [0.9, 0.4]),
        (2, 2, [0.9, 0.4]),
        (3, 2, [0.9, 0.4]),
        (100, 2, [1.0]),
        (101, 2, [1.0]),
        (102, 3, [1.0]),
        (200, None, [1.0, 1.0]),
        (300, 1, None),
        (400, 1, []),
        (500, 1, [float("nan"), 1.0]),
        (600, 1, [None, 1.0]),
        (700, 1, [float("inf"), 1.0]),
        (None, 2, [0.9, 0.45]),
        (800, 9, [-1.0, -1.0]),
        (801, 9, [1.0, 1.0]),  # a positive with a negative score has no window
        (900, 8, [0.0, 0.0]),
        (901, 8, [0.0, 0.0]),
    ]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows[:0]) == [] == mined(spark, rows[2:3])


def test_sql_equals_the_definition():
    rows = some_rows(random.Random(7), 300, width=4, labels=10)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, label INTEGER, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    moved = [(i, (label + 1) % 10 if i % 7 == 0 else label, v) for i, label, v in rows]
    assert sorted(con.execute(NEGATIVES_SQL).fetchall()) == brute(moved) != []
