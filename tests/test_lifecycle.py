from collections import defaultdict
from decimal import Decimal
from itertools import combinations

import pytest
from helpers import COVERAGES, LOG_COLUMNS, LOG_SCHEMA, STATES, as_dicts, key_set, log_rows
from pyspark.sql import functions as F

from claimflow.operators.grouping import spelled
from claimflow.operators import lifecycle as life

ZERO = Decimal("0.00")


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(log_rows(11, 200, hot=120), LOG_SCHEMA).repartition(5).cache()


def replay_status(names):
    """The guarded update chain, one step after the other."""
    status = None
    for step in ("denied", "cancelled", "approved", "paid out", "in process", "documents pending", "assessment pending", "estimate pending"):
        if step in names and (status is None or step in ("denied", "paid out")):
            status = step
    return status


def by_claim(log):
    groups = defaultdict(list)
    for r in as_dicts(log):
        groups[r["claimnumber"]].append(r)
    return groups


def claims_in(log, status):
    return {c: rows for c, rows in by_claim(log).items() if replay_status({r["claim_status_name"] for r in rows}) == status}


def latest(rows):
    day = max(r["updateddate"] for r in rows)
    return [r for r in rows if r["updateddate"] == day]


def joint_zero(rows):
    out = []
    for r in rows:
        if r["claim_estimate"] is None or r["claim_estimate_first"] is None:
            r = {**r, "claim_estimate": ZERO, "claim_estimate_first": ZERO}
        out.append(r)
    return out


def zeroed(rows, columns=life.AMOUNTS):
    return [{**r, **{c: r[c] if r[c] is not None else ZERO for c in columns}} for r in rows]


def drop_zero(rows):
    valued = [r for r in rows if r["claim_estimate"] or r["claim_estimate_first"]]
    return valued or [max(rows, key=lambda r: r["row_index"])]


COMPARED = ("claimnumber", "row_index", "claim_status", *life.AMOUNTS)


def check(df, expected):
    assert key_set(as_dicts(df), *COMPARED) == key_set(expected, *COMPARED)


def test_status_of_every_subset_of_states(spark):
    subsets = [s for n in range(1, len(STATES) + 1) for s in combinations(STATES, n)]
    rows = [(f"C{i}", s) for i, subset in enumerate(subsets) for s in subset]
    resolved = life.resolve_status(spark.createDataFrame(rows, "claimnumber string, claim_status_name string"))
    got = {r["claimnumber"]: r["claim_status"] for r in resolved.collect()}
    assert got == {f"C{i}": replay_status(set(s)) for i, s in enumerate(subsets)}


def test_milestones(log):
    got = {r["claimnumber"]: r for r in as_dicts(life.milestones(log))}
    for claim, rows in by_claim(log).items():
        days = [r["updateddate"] for r in rows if r["claim_status_name"] == "estimate pending"]
        assert got[claim]["estimate_pending_date"] == (min(days) if days else None)


def test_estimate_pending(log):
    expected = []
    for rows in claims_in(log, "estimate pending").values():
        kept = drop_zero(joint_zero(latest(rows)))
        for cov in COVERAGES:
            mine = [r for r in kept if r["coverage"] == cov]
            if mine:
                expected.append({**max(mine, key=lambda r: r["row_index"]), "claim_status": "estimate pending"})
    assert expected
    check(life.reduce_estimate_pending(log), expected)


def test_documents_pending(log, tiny_splits):
    expected = [
        {**r, "claim_status": "documents pending"}
        for rows in claims_in(log, "documents pending").values()
        for r in latest(rows)
    ]
    assert expected
    check(life.reduce_documents_pending(log), expected)


def assessed(log):
    out = []
    for rows in claims_in(log, "assessment pending").values():
        rows = latest(rows)
        own = [r for r in rows if r["claim_status_name"] == "assessment pending"]
        if own and any(sum(r["coverage"] == cov for r in rows) > 1 for cov in COVERAGES):
            rows = own
        rows = joint_zero([{**r, "claim_status": r["claim_status_name"]} for r in rows])
        for stays in (True, False):
            group = [r for r in rows if (r["claim_status"] == "assessment pending") is stays]
            if group:
                out += drop_zero(group)
    return out


def test_assessment_pending(log, tiny_splits):
    expected = assessed(log)
    assert {r["claim_status"] for r in expected} >= {"assessment pending", "estimate pending"}
    check(life.reduce_assessment_pending(log), expected)
    moved = {}
    for r in expected:
        if r["claim_status"] != "assessment pending":
            moved.setdefault(r["claimnumber"], set()).add(r["claim_status"])
    got = {r["claimnumber"]: r["moved_status"] for r in as_dicts(life.moved_status(log))}
    assert got == {c: replay_status(names) or "submitted" for c, names in moved.items()}


def test_in_process(log):
    expected = []
    for rows in claims_in(log, "in process").values():
        mine = [r for r in latest(rows) if r["claim_status_name"] == "in process"]
        mine = zeroed(mine, ("claim_estimate", "claim_estimate_first", "compensation_total"))
        coverages = {r["coverage"] for r in mine}
        for cov in coverages:
            choose = max if len(coverages) == 1 else min
            expected.append({**choose((r for r in mine if r["coverage"] == cov), key=lambda r: r["row_index"]), "claim_status": "in process"})
    assert expected
    check(life.reduce_in_process(log), expected)


def last(rows):
    return max(rows, key=lambda r: (r["updateddate"], r["row_index"])) if rows else None


def test_approved(log):
    expected = []
    for rows in claims_in(log, "approved").values():
        rows = zeroed(rows, ("claim_estimate", "total_claim_estimate", "compensation_total"))
        row = dict(last([r for r in rows if r["claim_status_name"] == "approved"]))
        before = last([r for r in rows if r["claim_status_name"] != "approved"])
        if not row["total_claim_estimate"]:
            if before:
                row["total_claim_estimate"] = before["total_claim_estimate"]
            elif row["compensation_total"]:
                row["total_claim_estimate"] = Decimal(round(float(row["compensation_total"]) * 100 / 92.5926))
        expected.append({**row, "claim_status": "approved"})
    assert expected
    check(life.reduce_approved(log), expected)


def test_paid_out(log):
    expected = []
    for rows in claims_in(log, "paid out").values():
        rows = zeroed(latest(rows))
        for cov in COVERAGES:
            mine = [r for r in rows if r["coverage"] == cov]
            if mine:
                total = sum((r["compensation_total"] for r in mine), ZERO)
                expected.append({**max(mine, key=lambda r: r["row_index"]), "compensation_total": total, "claim_status": "paid out"})
    assert expected
    check(life.reduce_paid_out(log), expected)


def test_cancelled_and_denied(log, tiny_splits):
    cancelled, denied = [], []
    for rows in claims_in(log, "cancelled").values():
        rows = zeroed(rows)
        before = last([r for r in rows if r["claim_status_name"] != "cancelled"])
        for r in rows:
            if r["claim_status_name"] == "cancelled":
                taken = ("total_claim_estimate", "claim_estimate_first", "compensation_total")
                cancelled.append({**r, **({c: before[c] for c in taken} if before else {}), "claim_status": "cancelled"})
    for rows in claims_in(log, "denied").values():
        rows = zeroed(rows)
        before = last([r for r in rows if r["claim_status_name"] != "denied"])
        for r in rows:
            if r["claim_status_name"] == "denied":
                value = r["total_claim_estimate"] or (before or r)["total_claim_estimate"] or r["compensation_total"]
                denied.append({**r, "total_claim_estimate": value, "claim_status": "denied"})
    assert cancelled and denied
    check(life.reduce_cancelled(log), cancelled)
    check(life.reduce_denied(log), denied)


def test_clean_log_is_unique_and_keeps_every_claim(log):
    rows = as_dicts(life.clean_log(log))
    keys = key_set(rows, "claimnumber", "claim_status_name", "coverage")
    assert len(keys) == len(set(keys))
    assert {k[0] for k in keys} == set(by_claim(log))
    assert all(r[c] is not None for r in rows for c in life.AMOUNTS)


def test_damage_is_consolidated(log, tiny_splits):
    got = defaultdict(list)
    named = life.consolidate_damage(log)
    for r in as_dicts(named.withColumn("damage_type_list", spelled(F.col("damage_type_list")))):
        got[r["claimnumber"]].append(r)
    for claim, rows in by_claim(log).items():
        values = sorted(r["damage_type"] for r in rows if r["damage_type"])
        names = set(values)
        for r in got[claim]:
            if not names:
                assert (r["damage_type"], r["damage_type_list"]) == ("Unclassified", "Unclassified")
            elif len(names) == 1:
                assert (r["damage_type"], r["damage_type_list"]) == (values[0], values[0])
            else:
                assert r["damage_type"] in names | {"Multiple"} and r["damage_type_list"] == ",".join(values)
    assert sum(map(len, got.values())) == log.count()


def test_promote_and_payment_date(spark, log, tiny_splits):
    labelled = log.withColumn("claim_status", F.lit("approved"))
    got = {r["claimnumber"]: r["claim_status"] for r in as_dicts(life.promote_paid(labelled))}
    for claim, rows in by_claim(log).items():
        paid = any(r["claim_status_name"] == "paid out" for r in rows)
        assert got[claim] == ("paid out" if paid else "approved")
    dated = log.withColumns({"payment_date": F.lit(None).cast("date"), "claim_approved_date": F.lit(None).cast("date")})
    days = {r["claimnumber"]: r["payment_date"] for r in as_dicts(life.payment_date(dated))}
    for claim, rows in by_claim(log).items():
        paid = [r["updateddate"] for r in rows if r["claim_status_name"] == "paid out"]
        assert days[claim] == (max(paid) if paid else None)


def test_process_days_rules(spark):
    df = spark.sql(
        "select * from values ('paid out', date'2022-01-01', date'2022-01-03', date'2022-01-11', date'2022-01-21', date'2022-02-01', 0), "
        "('cancelled', date'2022-01-01', date'2022-01-03', null, null, date'2022-03-01', 0), "
        "('in process', date'2022-01-01', date'2022-01-03', null, null, date'2022-02-01', null), "
        "('estimate pending', date'2022-01-01', date'2022-01-03', null, null, date'2022-02-01', 0) "
        "as t(claim_status, claim_submitted_date, claim_opened_date, claim_approved_date, payment_date, updateddate, processdays)"
    )

    def days(rule):
        return {r["claim_status"]: r["processdays"] for r in as_dicts(life.process_days(df, rule))}

    assert days("history") == {"paid out": 20, "cancelled": 59, "in process": 31, "estimate pending": None}
    assert days("final") == {"paid out": 10, "cancelled": 59, "in process": None, "estimate pending": None}
    assert days("repair") == {"paid out": 8, "cancelled": 59, "in process": 29, "estimate pending": 0}
    with pytest.raises(ValueError):
        life.process_days(df, "other")


def test_history_only_variants(log):
    groups = by_claim(log)
    got = {r["claimnumber"]: r["row_index"] for r in as_dicts(life.reduce_history_only(log))}
    assert got == {c: last(rows)["row_index"] for c, rows in groups.items()}
    open_ = {r["claimnumber"] for r in as_dicts(life.reduce_history_only(log, "in process"))}
    assert open_ == set(claims_in(log, "in process"))
    sums = {r["claimnumber"]: r["compensation_total"] for r in as_dicts(life.reduce_history_only(log, "distinct amounts"))}
    for claim, rows in claims_in(log, "approved").items():
        amounts = {r["compensation_total"] or ZERO for r in rows if r["claim_status_name"] == "approved"}
        assert sums[claim] == sum(amounts)


def test_distinct_amounts_read_the_log_once(spark):
    """Amounts and states come from one pass over the rows that decide; claims without a number stay out."""
    day = [None] * 3
    rows = [
        ("A", "approved", "5.00"), ("A", "approved", "5.00"), ("A", "approved", "7.00"), ("A", "approved", None),
        ("A", "approved", "0.00"), ("A", "in process", "9.00"), ("A", "submitted", "11.00"), ("A", None, "13.00"),
        ("B", "approved", None), ("C", "approved", "3.00"), ("C", "denied", "3.00"), ("D", "paid out", "4.00"),
        ("D", "approved", "4.00"), ("E", "in process", "6.00"), ("F", "cancelled", None), ("F", "approved", "8.00"),
        ("G", "something else", "2.00"), ("G", "approved", "1.00"), (None, "approved", "2.00"),
    ]
    rows = [
        (claim, i, state, None, *day, None, None, None if paid is None else Decimal(paid))
        for i, (claim, state, paid) in enumerate(rows)
    ]
    spark_rows = spark.createDataFrame(rows, LOG_SCHEMA).repartition(3)
    sums = life.reduce_history_only(spark_rows, "distinct amounts")
    assert sums.columns == ["claimnumber", "compensation_total", "claim_status"]
    assert sorted(map(tuple, sums.collect())) == [
        ("A", Decimal("12.00"), "approved"), ("B", ZERO, "approved"), ("G", Decimal("1.00"), "approved"),
    ]
    assert sums._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1


@pytest.mark.parametrize("status", ["in process", "approved", "documents pending"])
def test_claims_are_resolved_by_the_rows_that_decide(log, status):
    found = life.claims_in(log, status)
    assert {r["claimnumber"] for r in as_dicts(found)} == set(claims_in(log, status))
    weaker = life.STATUS_PRIORITY[life.STATUS_PRIORITY.index(status) + 1 :]
    left = {r["claim_status_name"] for r in as_dicts(life.deciding_rows(log, status))}
    assert status in left and not left & {*weaker, "submitted"}


@pytest.mark.parametrize(
    "reduce",
    [
        life.reduce_estimate_pending,
        life.reduce_assessment_pending,
        life.reduce_in_process,
        life.reduce_approved,
        life.reduce_paid_out,
        life.clean_log,
    ],
)
def test_reductions_do_not_depend_on_partitioning(log, reduce):
    a = key_set(as_dicts(reduce(log)), *COMPARED)
    b = key_set(as_dicts(reduce(log.repartition(7, "updateddate"))), *COMPARED)
    assert a == b


def test_all_states_at_once_are_the_states_one_by_one(log):
    """The rows of `reduce_claims` are those of the eight reductions, each held against its own replay above."""
    each = [
        life.reduce_estimate_pending,
        life.reduce_documents_pending,
        life.reduce_assessment_pending,
        life.reduce_in_process,
        life.reduce_approved,
        life.reduce_paid_out,
        life.reduce_cancelled,
        life.reduce_denied,
    ]
    parts = sorted(str(r) for reduction in each for r in reduction(log).select(*LOG_COLUMNS, "claim_status").collect())
    assert sorted(map(str, life.reduce_claims(log).select(*LOG_COLUMNS, "claim_status").collect())) == parts


def test_whole_rows_meet_no_sort_aggregate(spark, log):
    """The plan has two scans of the log, and what is aggregated or windowed are cells of fixed width."""
    for reduced in (life.reduce_claims(log), life.reduce_assessment_pending(log), life.clean_log(log)):
        plan = reduced._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
        assert reduced._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2
