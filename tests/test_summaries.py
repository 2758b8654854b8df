"""Mergeable summaries: the error they state, merging in any order, and bands by cut points from the data."""

import math
import random
from datetime import date
from decimal import Decimal

import pytest
from helpers import as_dicts
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimflow.operators import severity, summaries

SCHEMA = "month date, segment string, amount decimal(15,2)"


def rows_of(rng, n):
    """A hot segment, a rare one, ties, zeros, negative and missing amounts."""
    amounts = lambda: rng.choice([None, 0, 7.25, -3, rng.uniform(-50, 50), rng.lognormvariate(8, 3), 9_999_999_999_999.99])
    rows = []
    for _ in range(n):
        a = amounts()
        rows.append((date(2021, rng.randint(1, 4), 1), rng.choice("aaaab"), None if a is None else Decimal(str(round(a, 2)))))
    return rows


def quantile(values, share):
    values = sorted(values)
    return values[max(math.ceil(round(share * len(values), 6)), 1) - 1]


@pytest.mark.parametrize("bits", [3, 10])
def test_quantiles_within_the_stated_error(spark, bits):
    rows = rows_of(random.Random(bits), 2000)
    df = spark.createDataFrame(rows, SCHEMA)
    kept = summaries.merge(summaries.summarise(df, ["month", "segment"], "amount", bits), ["segment"])
    got = {(r["segment"], r["share"]): r for r in as_dicts(summaries.quantiles(kept, ["segment"], [0.01, 0.3, 0.5, 0.95, 1.0]))}
    for segment in "ab":
        values = [a for _, s, a in rows if s == segment and a is not None]
        for share in (0.01, 0.3, 0.5, 0.95, 1.0):
            r, exact = got[segment, share], quantile(values, share)
            assert r["n"] == len(values)
            assert exact <= r["amount"] <= exact + abs(exact) * Decimal(2.0**-bits)


def test_merging_is_the_same_as_summarising(spark):
    rows = rows_of(random.Random(4), 900)
    whole = summaries.summarise(spark.createDataFrame(rows, SCHEMA), ["segment"], "amount")
    parts = [summaries.summarise(spark.createDataFrame(rows[k::3], SCHEMA), ["month", "segment"], "amount") for k in range(3)]
    merged = summaries.merge(parts[2].unionByName(parts[0]).unionByName(parts[1]), ["segment"])
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.select(*merged.columns).collect()))


def test_trailing_months(spark):
    rows = rows_of(random.Random(5), 600)
    kept = summaries.summarise(spark.createDataFrame(rows, SCHEMA), ["month", "segment"], "amount", 50)
    got = {(r["month"], r["segment"]): r for r in as_dicts(summaries.cut_points(summaries.trailing(kept, "month", ["segment"], 2), ["month", "segment"], [0.5, 0.9]))}
    want = {}
    for m in (2, 3, 4):
        for segment in "ab":
            values = [a for d, s, a in rows if s == segment and a is not None and m - 2 <= d.month < m]
            want[date(2021, m, 1), segment] = (quantile(values, 0.5), quantile(values, 0.9))
    assert {k: (r["cut_1"], r["cut_2"]) for k, r in got.items()} == want


@given(st.lists(st.integers(-(2**49), 2**49), min_size=2, max_size=40))
def test_buckets_are_ordered_as_their_values(values):
    """The rule itself in plain numbers: order, width, and one bucket each for small values."""

    def place(v):
        size = abs(v)
        dropped = max(size.bit_length() - 11, 0)
        return (dropped * 2048 + (size >> dropped)) * (1 if v >= 0 else -1)

    values.sort()
    places = [place(v) for v in values]
    assert places == sorted(places)
    for v, w in zip(values, values[1:], strict=False):
        if place(v) == place(w):
            assert w - v <= abs(v) * 2.0**-10 and (abs(v) >= 2048 or v == w)


def test_buckets_of_the_column(spark):
    values = [0, 1, -1, 2047, 2048, 2049, 4096, 10**9, -(10**12), 2**50 - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", summaries.bucket(F.col("v")).alias("b"))
    for r in df.collect():
        size = abs(r["v"])
        dropped = max(size.bit_length() - 11, 0)
        assert r["b"] == (dropped * 2048 + (size >> dropped)) * (1 if r["v"] >= 0 else -1)


def test_empty_and_missing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert summaries.cut_points(summaries.summarise(empty, ["segment"], "amount"), ["segment"], [0.5]).collect() == []
    missing = spark.createDataFrame([(date(2021, 1, 1), "a", None)], SCHEMA)
    assert summaries.summarise(missing, ["segment"], "amount").collect() == []


def test_bands_by_segment(spark):
    """Cut points of each segment part its own claims; segments without settled claims have no band."""
    rng, rows = random.Random(6), []
    for k in range(400):
        segment = rng.choice("ab")
        rows.append((f"C{k}", rng.choice(["paid out", "approved", "in process"]), date(2021, rng.randint(1, 6), 5), segment, Decimal(rng.randint(1, 2000) * (1 if segment == "a" else 100))))
    claims = spark.createDataFrame(rows, "claimnumber string, claim_status string, claim_submitted_date date, coverage string, compensation_total decimal(15,2)")
    cuts = severity.segment_cuts(severity.amount_summary(claims, ["coverage"], 50), ["coverage"])
    got = {r["claimnumber"]: r["band"] for r in as_dicts(severity.banded(claims, cuts, ["coverage"]))}
    settled = [r for r in rows if r[1] != "in process"]
    assert set(got) == {r[0] for r in settled}
    for segment in "ab":
        values = [r[4] for r in settled if r[3] == segment]
        low, moderate, high = (quantile(values, s) for s in severity.CUT_SHARES)
        for r in settled:
            if r[3] == segment:
                a = r[4]
                assert got[r[0]] == ("low" if a < low else "moderate" if a < moderate else "high" if a < high else "severe")
