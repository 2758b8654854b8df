"""Exact top-k search where one vec_id has many rows: each is ranked by itself."""

from collections import Counter

import duckdb
import numpy as np
from test_archives_and_search import brute, searched

from claimflow.llm import vector_search
from claimflow.llm.queries import SEARCH_SQL


def repeated_rows():
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, 16).tolist()) for i in range(300)]
    rows += [(1001, (rng.normal(0, 0.01, 16) + 0.9).tolist()) for _ in range(30)]  # high for many queries
    rows += [(1003, (rng.normal(0, 0.01, 16) - 0.9).tolist()) for _ in range(150)]
    rows += [(40, rng.normal(0, 0.3, 16).tolist()) for _ in range(30)]  # queries as well
    return rows


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    return sorted(con.execute(SEARCH_SQL).fetchall())


def test_an_id_repeated_in_one_block(spark):
    rows = repeated_rows()
    got = searched(spark, rows)
    assert got == brute(rows, 20)
    assert sum(1 for q, *_ in got if q == 40) == 31 * 20
    assert max(Counter((q, c) for q, _, c, _ in got).values()) > 1


def test_sql_ranks_rows_as_well():
    rows = repeated_rows()[:400]
    assert by_sql(rows) == brute(rows, 20)


def test_three_rows_of_the_contract(spark):
    rows = [(1, [0.5, 0.5]), (1, [0.25, 0.5]), (2, [0.1, 0.1]), (20, [1.0, 1.0])]
    assert searched(spark, rows) == by_sql(rows) == [(20, 1, 1, 4096), (20, 2, 1, 3072), (20, 3, 2, 768)]


def test_the_floor_counts_rows():
    rng = np.random.default_rng(5)
    candidates = np.concatenate([np.full((300, 8), 50), rng.integers(1, 40, (200, 8))])
    ids = np.concatenate([np.full(300, 7), np.arange(100, 300)])
    queries = np.full((1, 8), 10)
    place, found, score = vector_search.top_candidates(np.array([1]), queries, ids, candidates, 20)
    assert place.tolist() == [0] * 20 and found.tolist() == [7] * 20 and score.tolist() == [4000] * 20


def test_queries_are_not_broadcast(spark):
    """Queries stand once for every slot, however small their files are: no side of the join goes to the driver."""
    df = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(100)], "vec_id long, embedding array<double>")
    found = vector_search.top_k(df.where("vec_id % 20 = 0"), df)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_rows_shuffled_for_a_query_do_not_grow_with_the_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "SLOTS", 1)
    monkeypatch.setattr(vector_search, "CANDIDATE_BLOCK", 4)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(0, 0.3, 8).tolist()) for i in range(1200)]
    assert searched(spark, rows, 3) == brute(rows, 3)
    best = vector_search._Best(3, 0, 8, np.arange(2).tobytes(), vector_search.smallest(rng.integers(-99, 99, (2, 8))).tobytes())
    for a in range(0, 400, 4):
        best.meet(np.arange(a, a + 4), rng.integers(-300, 300, (4, 8)))
        assert len(best.rows()) <= 6


def test_a_floor_keeps_ties_of_a_smaller_id():
    best = vector_search._Best(2, 0, 1, np.array([99]).tobytes(), np.array([1], np.int8).tobytes())
    for ids, values in (([7, 8], [5, 5]), ([3, 9], [5, 4]), ([99, 4], [9, 6])):
        best.meet(np.array(ids), np.array(values, np.int64)[:, None])
    assert best.vec_id.tolist() == [4, 3] and best.score.tolist() == [6, 5]


def test_vectors_are_packed_in_the_narrowest_type():
    for top in (127, 128, 2**31 - 1, 2**31, 2**62):
        rows = np.array([[top, -5, 0], [1, -top, 3]], np.int64)
        packed = vector_search.smallest(rows).tobytes()
        assert (vector_search._vectors(packed, 3, 2) == rows).all()
    assert len(vector_search.smallest(np.array([[127, -128]])).tobytes()) == 2
