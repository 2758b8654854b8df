from decimal import Decimal

import pytest
from helpers import as_dicts

from claimflow.functions import vocabulary as v
from claimflow.operators import snapshot as snap

SCHEMA = (
    "claimnumber string, coverage string, claim_status string, claim_estimate_first decimal(15,2), "
    "claim_estimate decimal(15,2), claim_estimate_beforetax decimal(15,2), total_claim_estimate decimal(15,2), "
    "compensation_total decimal(15,2), compensation_amount_beforetax decimal(15,2), row_index bigint"
)
A, B = "Auto liability coverage", "Collision coverage"


def snapshot(spark, *rows):
    data = [(c, cov, status, *map(Decimal, amounts), i) for i, (c, cov, status, *amounts) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def by_claim(df):
    out = {}
    for r in as_dicts(df):
        out.setdefault(r["claimnumber"], []).append(r)
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return snapshot(
        spark,
        ("single", B, "paid out", 5, 5, 5, 5, 0, 0),
        ("both", B, "paid out", 10, 20, 18, 30, 40, 36),
        ("both", A, "paid out", 1, 2, 2, 30, 3, 2),
        ("onezero", B, "approved", 10, 20, 18, 30, 40, 36),
        ("onezero", A, "approved", 1, 2, 2, 30, 0, 0),
        ("open", B, "in process", 10, 20, 18, 30, 0, 0),
        ("open", A, "in process", 1, 2, 2, 30, 0, 0),
        ("waiting", B, "assessment pending", 10, 20, 18, 30, 0, 0),
        ("waiting", A, "assessment pending", 1, 2, 2, 30, 0, 0),
        ("gone", B, "cancelled", 7, 0, 0, 0, 0, 0),
        ("gone", A, "cancelled", 3, 0, 0, 0, 0, 0),
        ("tied", B, "denied", 0, 0, 0, 0, 0, 0),
        ("tied", A, "denied", 0, 0, 0, 0, 0, 0),
    )


def test_second_method_sums_and_keeps_one_row_per_claim(rows, tiny_splits):
    got = by_claim(snap.rollup_coverage_v2(rows))
    assert all(len(x) == 1 for x in got.values()) and len(got) == 7
    both = got["both"][0]
    assert (both["coverage"], both["compensation_total"], both["claim_estimate_first"]) == (f"{A}, {B}", 43, 11)
    assert (got["onezero"][0]["coverage"], got["onezero"][0]["compensation_total"]) == (B, 40)
    assert (got["open"][0]["claim_estimate"], got["open"][0]["coverage"]) == (22, f"{A}, {B}")
    assert (got["waiting"][0]["claim_estimate"], got["waiting"][0]["coverage"]) == (20, B)
    assert (got["gone"][0]["claim_estimate_first"], got["gone"][0]["claim_estimate"]) == (10, 0)
    assert got["tied"][0]["coverage"] == A  # all amounts equal: first coverage by name


def test_first_method(rows):
    got = by_claim(snap.rollup_coverage_v1(rows))
    assert len(got["both"]) == 2 and {r["compensation_total"] for r in got["both"]} == {43}
    assert [r["coverage"] for r in got["onezero"]] == [B]
    assert {r["coverage"] for r in got["open"]} == {f"{A} {B}"}
    assert got["single"][0]["compensation_total"] == 0
    assert {r["claim_estimate_first"] for r in got["gone"]} == {10}


def test_multi_row(rows):
    assert {r["claimnumber"] for r in as_dicts(snap.multi_row(rows))} == {
        "both",
        "onezero",
        "open",
        "waiting",
        "gone",
        "tied",
    }


def replay_damage(cause, coverage, injured):
    """The cascade as successive updates of one value, on the raw cause."""
    partial, theft, other = v.PARTIAL_TOTAL, v.THEFT, v.THIRD_PARTY_OTHER
    d = cause
    for group in (partial, theft, other):
        if cause in v.DAMAGE_BY_CAUSE[group]:
            d = group
    if d is not None and d not in (partial, theft, other) and coverage == "Collision coverage":
        d = partial
    if d is not None and d not in (partial, theft, other) and coverage in ("Personal injury coverage", "Comprehensive coverage"):
        d = v.INJURY
    if injured:
        d = v.INJURY
    if coverage == A:
        for group in (v.THIRD_PARTY_VEHICLE, other):
            if d in v.DAMAGE_BY_LIABILITY_CAUSE[group]:
                d = group
    return d if d in (partial, theft, other, v.INJURY, v.THIRD_PARTY_VEHICLE) else v.UNKNOWN


def test_damage_cascade_over_all_causes(spark, tiny_splits):
    every = sorted({m for ms in v.ACCIDENT_TYPES.values() for m in ms}) + ["Khác", "-", "", None, "new cause"]
    data, expected = [], {}
    for cause in every:
        for coverage in v.COVERAGE_BY_CODE.values():
            for text in ("va quệt", "đưa đi Cấp Cứu"):
                key = f"{cause}|{coverage}|{text}"
                data.append((key, cause, coverage, text))
                expected[key] = replay_damage(cause, coverage, text != "va quệt")
    df = spark.createDataFrame(data, "claimnumber string, accident_type string, coverage string, narrative string")
    assert {r["claimnumber"]: r["damage_type"] for r in as_dicts(snap.classify_damage(df))} == expected
    assert {r["claimnumber"]: r["damage_type"] for r in as_dicts(snap.damage_per_claim(df))} == expected


def test_injury_in_one_row_decides_for_the_claim(spark):
    df = spark.createDataFrame(
        [("C1", "Đâm/va xe máy", A, "tử vong"), ("C1", "Mất cắp", B, None)],
        "claimnumber string, accident_type string, coverage string, narrative string",
    )
    assert {r["damage_type"] for r in as_dicts(snap.classify_damage(df))} == {v.INJURY}


def test_accident_and_vehicle_classes(spark):
    df = spark.createDataFrame(
        [("Đâm/va xe máy", "Xe tải"), ("-", "Xe lạ"), (None, None), ("Khác", "Xe bus")], "accident_type string, vehicle_type string"
    )
    got = [tuple(r) for r in snap.classify_vehicle(snap.classify_accident(df)).collect()]
    assert got == [
        ("Bicycle/Motorcycle Accidents", "Commercial Freight Vehicles"),
        ("Unknown", None),
        ("Unknown", None),
        ("Khác", "Government & Emergency Vehicles"),
    ]


def test_vocabularies_are_consistent():
    members = [m for ms in v.ACCIDENT_TYPES.values() for m in ms]
    assert len(members) == len(set(members)) == 32
    vehicles = [m for ms in v.VEHICLE_CLASSES.values() for m in ms]
    assert len(vehicles) == len(set(vehicles)) == 21
    assert set(v.STATUS_PRIORITY) | {"submitted"} == set(v.HISTORY_STATUS.values())
