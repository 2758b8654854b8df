import random
from datetime import date
from decimal import Decimal

import pytest
from helpers import as_dicts

from claimflow.operators import exposure, severity
from claimflow.plans.metrics import register_metric_views

POLICY = "policycode string, certificate_no string, start_date date, end_date date, finalprice decimal(15,2)"
CLAIM = (
    "claimnumber string, claim_status string, claim_submitted_date date, claim_approved_date date, updateddate date, "
    "compensation_total decimal(15,2)"
)


def policies(spark, *rows):
    return spark.createDataFrame([(f"P{i}", f"G{i}", a, b, Decimal(p)) for i, (a, b, p) in enumerate(rows)], POLICY)


def premium(df, **options):
    rows = exposure.earned_premium_monthly(df, **options).collect()
    return {r["calendar_month"]: (float(r["earned_premium"]), r["active_policies"]) for r in rows}


def test_calendar_bounds(spark):
    months = [r["calendar_month"] for r in exposure.calendar(spark).orderBy("calendar_month").collect()]
    assert len(months) == 226 and months[0] == date(2011, 11, 1) and months[-1] == date(2030, 8, 1)


def test_divisor_can_be_smaller_than_the_months_touched(spark):
    df = policies(spark, (date(2022, 1, 20), date(2022, 3, 10), 60))
    assert premium(df) == {date(2022, m, 1): (30.0, 1) for m in (1, 2, 3)}
    assert premium(df, mode="touched") == {date(2022, m, 1): (20.0, 1) for m in (1, 2, 3)}


def test_premium_of_short_and_broken_policies(spark):
    df = policies(
        spark,
        (date(2022, 5, 3), date(2022, 5, 20), 10),
        (date(2022, 6, 1), date(2022, 5, 1), 99),
        (None, date(2022, 5, 1), 99),
    )
    assert premium(df) == {date(2022, 5, 1): (10.0, 1)}
    assert premium(df, first="2022-06-01") == {}


def test_monthly_premium_adds_up_over_policies(spark):
    rng = random.Random(5)
    rows = [
        (date(2020 + rng.randint(0, 2), rng.randint(1, 12), rng.randint(1, 28)), None, rng.randint(100, 999))
        for _ in range(200)
    ]
    rows = [(a, date(a.year + rng.randint(0, 2), 12, rng.randint(28, 31)), p) for a, _, p in rows]
    expected = {}
    for a, b, p in rows:
        full = (b.year - a.year) * 12 + b.month - a.month - (b.day < a.day)
        y, m = a.year, a.month
        while (y, m) <= (b.year, b.month):
            expected[date(y, m, 1)] = expected.get(date(y, m, 1), 0) + p / (full + 1)
            y, m = (y, m + 1) if m < 12 else (y + 1, 1)
    got = premium(policies(spark, *rows))
    assert got.keys() == expected.keys()
    assert all(abs(got[k][0] - expected[k]) < 1e-4 for k in expected)


def test_two_forms_of_one_months_premium(spark):
    df = policies(
        spark,
        (date(2022, 1, 1), date(2022, 12, 31), 120),
        (date(2022, 8, 1), date(2022, 8, 31), 7),
        (date(2022, 9, 1), date(2022, 10, 31), 20),
    )
    assert float(exposure.earned_premium_month(df, "2022-08-01").first()[0]) == 17.0
    assert float(exposure.earned_premium_month(df, "2022-08-01", "starting").first()[0]) == 10.0
    with pytest.raises(ValueError):
        exposure.earned_premium_month(df, "2022-08-01", "other")


def claims(spark, *rows):
    return spark.createDataFrame([(f"C{i}", s, a, b, u, Decimal(c)) for i, (s, a, b, u, c) in enumerate(rows)], CLAIM)


def test_views_and_empty_months(spark):
    df = policies(spark, (date(2022, 1, 5), date(2022, 2, 5), 40))
    cl = claims(
        spark,
        ("paid out", date(2022, 1, 9), date(2022, 1, 12), date(2022, 1, 20), 10),
        ("approved", date(2022, 1, 9), date(2022, 2, 12), date(2022, 2, 20), 6),
        ("in process", date(2022, 3, 9), None, date(2022, 3, 20), 0),
    )
    register_metric_views(spark, df, cl, "2022-01-01", "2022-03-01")
    ratio = {str(r[0]): (float(r[1]), float(r[2])) for r in spark.sql("select * from v_monthly_loss_ratio").collect()}
    assert ratio == {"2022-01-01": (20.0, 10.0), "2022-02-01": (20.0, 0.0)}
    counts = {str(r[0]): (r[1], r[2]) for r in spark.sql("select * from v_monthly_policy_claim_counts").collect()}
    assert counts == {"2022-01-01": (1, 2), "2022-02-01": (1, 0), "2022-03-01": (0, 1)}
    earned = exposure.earned_premium_monthly(df)
    raw = {str(r["calendar_month"]): r["loss_ratio"] for r in exposure.loss_ratio_monthly(earned, cl).collect()}
    assert raw == {"2022-01-01": 0.5, "2022-02-01": None}
    approved = {str(r["calendar_month"]): r for r in as_dicts(exposure.severity_monthly(earned, cl))}
    assert approved["2022-02-01"]["avg_compensation"] == 6.0 and approved["2022-01-01"]["loss_ratio"] == 0.5


def test_backlog_at_month_ends(spark):
    cl = claims(
        spark,
        ("paid out", date(2022, 1, 9), date(2022, 3, 2), date(2022, 3, 20), 10),
        ("denied", date(2022, 2, 9), None, date(2022, 2, 27), 0),
        ("in process", date(2022, 2, 28), None, date(2022, 3, 20), 0),
    )
    got = {str(r[0]): r[1] for r in severity.open_backlog(cl, "2022-04-01").collect()}
    assert got == {"2022-01-01": 1, "2022-02-01": 2, "2022-03-01": 1, "2022-04-01": 1}


@pytest.mark.parametrize("bits", [1, 4, 10])
def test_concentration_with_ties_equals_a_sort(spark, monkeypatch, bits):
    monkeypatch.setattr(severity, "LEVEL_BITS", bits)
    monkeypatch.setattr(severity, "LEVELS", -(-50 // bits) if bits > 1 else 30)
    rng = random.Random(8)
    amounts = [rng.choice([10, 10, 10, 55, 99, rng.randint(1, 5000)]) for _ in range(731)]
    cl = claims(spark, *[("paid out", date(2022, 1, 1), None, None, a) for a in amounts])
    ranked = sorted(amounts, reverse=True)
    for r in severity.loss_concentration(cl, (0.05, 0.1, 0.9)).collect():
        n = -(-round(r["share"] * len(amounts) * 1_000_000) // 1_000_000)
        assert (r["top_claims"], r["top_amount"]) == (n, float(sum(ranked[:n])))
        assert abs(r["loss_share"] - sum(ranked[:n]) / sum(ranked)) < 1e-9


def test_bands_flags_and_stress(spark):
    cl = claims(spark, *[("paid out", date(2022, 1, 1), date(2022, 1, d), None, a) for d, a in ((2, 5), (3, 15), (4, 25), (11, 35))])
    mix = severity.severity_mix(cl, (10, 20, 30)).first()
    assert (mix["n_low"], mix["n_moderate"], mix["n_high"], mix["n_severe"], mix["severe_high_share"]) == (1, 1, 1, 1, 0.5)
    days = {r["band"]: r["median_days"] for r in severity.settlement_duration(cl, (10, 20, 30)).collect()}
    assert days == {"low": 1.0, "moderate": 2.0, "high": 3.0, "severe": 10.0}
    flagged = severity.large_loss_flag(cl, 25, "compensation_total")
    assert [r["large_loss"] for r in flagged.orderBy("claimnumber").collect()] == [False, False, True, True]
    ratios = spark.sql("select date'2022-01-01' as calendar_month, 0.5d as loss_ratio")
    stressed = {r["stress"]: round(r["stressed_loss_ratio"], 6) for r in severity.stressed_loss_ratio(ratios, (0.05, 0.1)).collect()}
    assert stressed == {0.05: 0.525, 0.1: 0.55}


def test_lead_lag_finds_the_shift(spark):
    values = [3, 8, 1, 9, 4, 7, 2, 6]
    rows = [(date(2022, m, 1), float(values[m - 1]), float(values[m - 2]) if m > 1 else None) for m in range(1, 9)]
    series = spark.createDataFrame(rows, "calendar_month date, intake double, severity double")
    got = {r["lag"]: r["correlation"] for r in severity.lead_lag(series, "intake", "severity", (0, 1)).collect()}
    assert round(got[1], 9) == 1.0 and got[0] < 0.9
