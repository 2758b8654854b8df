"""Bucketed tables: what is read and shuffled; exposure by events against the spread over months and days."""

import random
import uuid
from datetime import date, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimflow.operators import exposure
from claimflow.sources import tables


def bucketed(spark, rows, schema):
    path = tables.new_path(spark, "bucketed")
    return tables.save_bucketed(spark.createDataFrame(rows, schema), f"t_{uuid.uuid4().hex}", ["claim"], 8, ["claim", "day"], path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_a_shuffle(spark):
    log = bucketed(spark, [(f"C{k % 90}", k, "x") for k in range(900)], "claim string, day int, v string")
    facts = bucketed(spark, [(f"C{k}", k, k) for k in range(0, 90, 2)], "claim string, day int, n int").drop("day")
    joined = log.join(facts.hint("merge"), "claim")
    assert "Exchange" not in plan_of(joined) and joined.count() == 450
    grouped = log.groupBy("claim").agg(F.max("day").alias("last"))
    assert "Exchange" not in plan_of(grouped) and grouped.count() == 90


def test_a_filter_on_the_claim_reads_its_bucket_alone(spark):
    log = bucketed(spark, [(f"C{k % 90}", k, "x") for k in range(900)], "claim string, day int, v string")
    some = log.where(F.col("claim") == "C17")
    files = {Path(f.removeprefix("file://").removeprefix("file:")) for f in log.inputFiles()}
    (mine,) = {r["file"].removeprefix("file://") for r in some.select(F.input_file_name().alias("file")).collect()}
    others = {f for f in files if f.name != Path(mine).name}
    assert len(files) == 8 and len(others) == 7
    for f in others:  # the files of all other buckets are made unreadable
        f.write_bytes(b"not a table")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    assert sorted(r["day"] for r in some.collect()) == list(range(17, 900, 90))


def policies_of(rng, n):
    rows = []
    for k in range(n):
        start = date(2020, 1, 1) + timedelta(days=rng.randint(0, 500))
        end = rng.choice([None, start, start + timedelta(days=rng.randint(0, 400)), start - timedelta(days=3)])
        rows.append((f"P{k}", rng.choice([start, start, start, None]), end, rng.choice([None, Decimal(rng.randint(1, 10**6)) / 100])))
    return rows


SCHEMA = "policycode string, start_date date, end_date date, finalprice decimal(15,2)"


def test_days_of_exposure(spark):
    rows = policies_of(random.Random(1), 300)
    grid = exposure.day_grid(spark, "2019-12-30", "2022-01-10", 2)
    got = {r["calendar_day"]: (r["earned_premium"], r["active_policies"]) for r in exposure.earned_premium_daily(spark.createDataFrame(rows, SCHEMA), grid).collect()}
    assert len(got) == (date(2022, 1, 10) - date(2019, 12, 30)).days // 2 + 1
    for day, (premium, active) in got.items():
        held = [(p, (e - s).days + 1) for _, s, e, p in rows if s and e and s <= day <= e]
        assert (active or 0) == len(held)
        assert float(premium or 0) == pytest.approx(sum(float(p or 0) / n for p, n in held), abs=1e-5)


@pytest.mark.parametrize("mode", ["full", "touched"])
def test_events_and_spread_months_agree(spark, mode):
    df = spark.createDataFrame(policies_of(random.Random(2), 400), SCHEMA)
    months = exposure.calendar(spark, "2019-01-01", "2024-12-01")
    by_events = {r[0]: (r[1], r[2]) for r in exposure.earned_premium_by_events(df, months, mode).select("calendar_month", "earned_premium", "active_policies").collect()}
    spread = {r[0]: (r[1] or 0, r[2]) for r in exposure.earned_premium_monthly(df, mode=mode).select("calendar_month", "earned_premium", "active_policies").collect()}
    assert by_events == spread


def test_open_claims_by_day(spark):
    rng, rows = random.Random(3), []
    for k in range(200):
        begin = date(2021, 1, 1) + timedelta(days=rng.randint(0, 60))
        rows.append((f"C{k}", rng.choice([begin, begin, None]), rng.choice([None, begin, begin + timedelta(days=rng.randint(0, 40)), begin - timedelta(days=5)])))
    df = spark.createDataFrame(rows, "claimnumber string, claim_submitted_date date, closed date")
    got = exposure.open_claims_daily(df, F.col("closed"), exposure.day_grid(spark, "2020-12-20", "2021-05-01"))
    for r in got.collect():
        d = r["calendar_day"]
        assert r["open_claims"] == sum(1 for _, s, c in rows if s and s <= d and (c is None or max(c, s) > d))
    empty = exposure.open_claims_daily(df.limit(0), F.col("closed"), exposure.day_grid(spark, "2021-01-01", "2021-01-03"))
    assert [r["open_claims"] for r in empty.collect()] == [0, 0, 0]
