"""Every registered query on the smallest data beside its SQL, and the shape of the driver contract."""

import oracle
import pytest

import __spark_entry__ as entry
from claimflow.plans import queries as registered

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = registered.QUERIES, registered.ORACLE


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, text = oracle.compare(QUERIES[name](spark, FOLDER), con, SQL[name])
    assert ok, f"{name}: {text}"


def test_contract(spark):
    assert set(SQL) == set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns == ["calendar_month", "earned_premium", "incurred_losses", "loss_ratio"] and df.count() > 0


@pytest.mark.parametrize("name", ["j5c_reduce_assessment_pending", "j7_consolidate_damage", "k3_rollup_coverage_v2", "g9_at_latest_date"])
def test_split_path_equals_sql(spark, con, tiny_splits, name):
    ok, text = oracle.compare(QUERIES[name](spark, FOLDER), con, SQL[name])
    assert ok, f"{name}: {text}"
