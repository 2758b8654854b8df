"""The final claims and the relabelled rows: what they read, and how often."""

import pytest

from claimflow.operators.lifecycle import relabel_latest
from claimflow.plans.history import beyond_snapshot
from claimflow.plans.queries import lifecycle, snapshot

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_extendedprice double"
ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"


@pytest.fixture
def folder(spark, tmp_path):
    """Orders 1 to 40, every third pending, and the lines of orders 20 to 60: those after 40 and the pending are known to the log alone."""
    lines = [(k, 7 * k + n, 3 * k + 5 * n, n, 1000.5 * n + k) for k in range(20, 61) for n in range(1, 2 if k % 5 == 0 else 6)]
    orders = [(k, k % 24, "FPO"[k % 3], 5000.25 * k) for k in range(1, 41)]
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, ORDERS).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_only_claims_beyond_the_snapshot_are_searched_for_copies(spark, folder, monkeypatch):
    staged, stage = {}, snapshot.stage
    monkeypatch.setattr(snapshot, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    final = [r["claimnumber"] for r in snapshot.final_claims(spark, folder).collect()]
    alone = {f"C{k}" for k in range(20, 61) if k > 40 or k % 3 == 1}
    assert {r["claimnumber"] for r in staged["deduped-log"].select("claimnumber").collect()} == alone
    assert sorted(final) == sorted(alone | {f"{'S' if k % 3 == 1 else 'C'}{k}" for k in range(1, 41)})


def test_beyond_the_snapshot(spark):
    log = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("c", 5)], "claimnumber string, n int")
    known = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("x", 4)], "claimnumber string, m int")
    assert sorted(r["n"] for r in beyond_snapshot(log, known).collect()) == [2, 3, 4, 5]


@pytest.mark.parametrize("name", ["j4_relabel_latest", "j5b_reduce_documents_pending"])
def test_the_log_is_cleaned_once(spark, folder, name):
    """What reads the log without copies twice reads it from a table."""
    read = getattr(lifecycle, name)(spark, folder).inputFiles()
    assert read and not any("lineitem" in f for f in read)


def test_relabelled_rows_are_those_of_the_log(spark, folder):
    columns = ["claimnumber", "row_index", "claim_status", "relabelled"]
    want = relabel_latest(lifecycle.deduped(spark, folder)).select(*columns).collect()
    assert want and sorted(lifecycle.j4_relabel_latest(spark, folder).collect()) == sorted(want)
