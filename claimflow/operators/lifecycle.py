"""Claim lifecycle over the status log: states, milestones, per-status reductions, durations.

The log has one row per update: claimnumber, claim_status_name, updateddate, coverage, damage_type,
amounts and row_index (unique within a claim). Amounts are NULL where the source had none.

The reductions first collapse the rows of a claim into day cells, one per (claim, coverage, state,
date), with an aggregate that is combined on the map side. What a window then sees per claim is bounded
by the calendar, nine states and four coverages, however many log rows the claim has. No reduction
needs the resolved state joined to the rows beforehand.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.functions.expressions import map_value
from claimflow.functions.vocabulary import HISTORY_STATUS, STATUS_PRIORITY
from claimflow.operators.cleaning import gross_up
from claimflow.operators.picking import pick
from claimflow.operators.skew import join_facts, with_facts

CLAIM = ["claimnumber"]
AMOUNTS = ("claim_estimate_first", "claim_estimate", "total_claim_estimate", "compensation_total")


def zero() -> Column:
    return F.lit(0).cast("decimal(15,2)")


def normalise_status(log: DataFrame, column: str = "claim_status_name") -> DataFrame:
    """Raw status names to workflow states; unknown names stay as they are."""
    return log.withColumn(column, map_value(column, HISTORY_STATUS, keep=True))


def status_rank(status: str | Column) -> Column:
    """1 for the state that wins over all others; NULL for states that never name a claim."""
    c = F.col(status) if isinstance(status, str) else status
    pairs = [F.lit(x) for i, s in enumerate(STATUS_PRIORITY, start=1) for x in (s, i)]
    return F.element_at(F.create_map(*pairs), c)


def status_of_rank(rank: Column) -> Column:
    return F.get(F.array(*[F.lit(s) for s in STATUS_PRIORITY]), rank - 1)


def first_date_of(status: str, date: str = "updateddate") -> Column:
    return F.min(F.when(F.col("claim_status_name") == status, F.col(date)))


def claim_facts(log: DataFrame, *names: str) -> DataFrame:
    """What the log says about a claim as a whole, one row per claim, in one aggregate.

    claim_status, latest_date, paid_on and the four milestone dates; only the named ones are computed.
    """
    name = F.col("claim_status_name")
    facts = {
        "claim_status": lambda: status_of_rank(F.min(status_rank(name))),
        "latest_date": lambda: F.max("updateddate"),
        "paid_on": lambda: F.max(F.when(name == "paid out", F.col("updateddate"))),
        **{n: functools.partial(first_date_of, state) for n, state in MILESTONE_STATES.items()},
    }
    return log.groupBy("claimnumber").agg(*[facts[n]().alias(n) for n in (names or facts)])


MILESTONE_STATES = {
    "documents_pending_date": "documents pending",
    "estimate_pending_date": "estimate pending",
    "assessment_pending_date": "assessment pending",
    "process_start_date": "in process",
}
MILESTONES = tuple(MILESTONE_STATES)


def resolve_status(log: DataFrame) -> DataFrame:
    """One claim_status per claim from all its rows."""
    return claim_facts(log, "claim_status")


def deciding_rows(log: DataFrame, status: str) -> DataFrame:
    """The rows that decide whether a claim is resolved to `status`: those in it or in a stronger state.

    A claim is resolved to its strongest state, so rows in weaker ones change nothing and need not be shuffled.
    """
    strong = STATUS_PRIORITY[: STATUS_PRIORITY.index(status) + 1]
    return log.where(F.col("claim_status_name").isin(*strong))


def claims_in(log: DataFrame, status: str) -> DataFrame:
    """The claims resolved to `status`, with it in claim_status."""
    return resolve_status(deciding_rows(log, status)).where(F.col("claim_status") == status)


def with_status(log: DataFrame) -> DataFrame:
    """The log with the resolved claim_status on every row."""
    return join_facts(log, resolve_status(log), CLAIM, "inner")


def milestones(log: DataFrame) -> DataFrame:
    """First date of each waiting state per claim."""
    return claim_facts(log, *MILESTONES)


def with_milestones(log: DataFrame) -> DataFrame:
    return join_facts(log, milestones(log), CLAIM, "inner")


def _at_latest_of(log: DataFrame, status: str) -> DataFrame:
    """Rows at the latest date of the claims resolved to `status`: one aggregate and one join."""
    facts = claim_facts(log, "claim_status", "latest_date").where(F.col("claim_status") == status)
    rows = join_facts(log, facts, CLAIM, "inner")
    return rows.where(F.col("updateddate") == F.col("latest_date")).drop("latest_date")


def relabel_latest(log: DataFrame, status: str = "assessment pending") -> DataFrame:
    """Latest rows of the claims resolved to `status`; rows in another state give the claim that state."""
    latest = _at_latest_of(log, status)
    return latest.withColumn("relabelled", F.col("claim_status") != F.col("claim_status_name")).withColumn(
        "claim_status", F.col("claim_status_name")
    )


CELL = ("claimnumber", "coverage", "claim_status_name", "updateddate")
LATEST_STATES = ("estimate pending", "documents pending", "assessment pending", "in process", "paid out")  # read at the latest date
CARRIED = ("total_claim_estimate", "claim_estimate_first", "compensation_total")  # amounts that other rows may take


def _over(*more: str) -> Window:
    return Window.partitionBy("claimnumber", *more)


def _valued() -> Column:
    """A row with an estimate. Both estimates are entered together: if one is missing, both count as 0."""
    first, second = F.col("claim_estimate_first"), F.col("claim_estimate")
    return F.coalesce((second + first).isNotNull() & ((second != 0) | (first != 0)), F.lit(False))


def day_cells(log: DataFrame) -> DataFrame:
    """One row per (claim, coverage, state, date): counts, row indexes, sums and the last row's amounts, all of fixed width.

    It is one hash aggregate, combined on the map side, and cells of parts of a log add up to those of the whole.
    """
    last = lambda c: F.max_by(F.coalesce(F.col(c), zero()), "row_index")
    return log.groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(_valued()).alias("n_valued"),
        F.max(F.when(_valued(), F.col("row_index"))).alias("last_valued"),
        F.min("row_index").alias("first"),
        F.max("row_index").alias("last"),
        F.sum(F.coalesce(F.col("compensation_total"), zero())).cast("decimal(15,2)").alias("paid"),
        *[last(c).alias(f"last_{c}") for c in CARRIED],
    )


def _assessed(cells: DataFrame) -> DataFrame:
    """What the reduction of claims waiting for assessment asks of cells at the latest date.

    Where a claim repeats a coverage, cells in another state give way to cells in the claim's own state. What is left
    in another state takes that state; zero rows go when others remain in the group (claim, stays or moves).
    """
    own, latest = F.col("claim_status_name") == F.col("claim_status"), F.col("at_latest")
    cells = cells.withColumns({"own": own, "n_coverage": F.sum(F.when(latest, F.col("n"))).over(_over("coverage"))})
    repeats, owns = F.max("n_coverage").over(_over()) > 1, F.max(F.when(latest, F.col("own"))).over(_over())
    cells = cells.withColumn("stands", latest & ~(repeats & owns & ~F.col("own")))
    any_valued = F.coalesce(F.sum(F.when(F.col("stands"), F.col("n_valued"))).over(_over("own")), F.lit(0)) > 0
    last = F.max(F.when(F.col("stands"), F.col("last"))).over(_over("own"))
    cells = cells.withColumns({"any_valued": any_valued, "group_last": last})
    survives = F.col("stands") & ((F.col("n_valued") > 0) | (~F.col("any_valued") & (F.col("last") == F.col("group_last"))))
    return cells.withColumn("survives", survives)


def _decided(log: DataFrame, *states: str) -> DataFrame:
    """The cells of a log with everything the reductions know of their claims, in windows over cells alone.

    Given states, only the cells of the claims resolved to them go on.

    claim_status, at_latest, previous (the amounts of the claim's latest row in another state), approved (its last
    approved row) and what `_assessed` adds. How many cells a claim has is bounded by the calendar and the vocabularies.
    """
    cells = day_cells(log)
    rank = F.min(status_rank("claim_status_name")).over(_over())
    latest = F.max("updateddate").over(_over())
    cells = cells.withColumns({"claim_status": status_of_rank(rank), "at_latest": F.coalesce(F.col("updateddate") == latest, F.lit(False))})
    cells = cells.where(F.col("claim_status").isin(*states)) if states else cells
    amounts = [F.col(f"last_{c}").alias(c) for c in CARRIED]
    state, status, row = F.col("claim_status_name"), F.col("claim_status"), F.struct("updateddate", "last", *amounts)
    carried = {
        "previous": F.max(F.when(status.isin("approved", "cancelled", "denied") & (state != status), row)).over(_over()),
        "approved": F.max(F.when((status == "approved") & (state == status), row)).over(_over()),
    }
    return _assessed(cells.withColumns(carried))


def _approved_estimate() -> Column:
    """The estimate of an approved claim: its last approved row's, else that of the row before, else from the compensation."""
    entered, net = F.col("approved.total_claim_estimate"), F.col("approved.compensation_total")
    return (
        F.when(entered != 0, entered)
        .when(F.col("previous").isNotNull(), F.col("previous.total_claim_estimate"))
        .when(net != 0, gross_up(net))
        .otherwise(entered)
    )


def _chosen(log: DataFrame, *states: str) -> DataFrame:
    """Cells that the reductions keep rows of, with the index of the row (`only`; NULL for all rows of the cell).

    `valued_only` asks for rows with an estimate. `rule` is the resolved state, `claim_status` the state that comes out.
    """
    state, status, last = F.col("claim_status_name"), F.col("claim_status"), F.col("last")
    # these states are read at the claim's latest date; the others name their rows by state
    cells = _decided(log, *states).where(~F.col("claim_status").isin(*LATEST_STATES) | F.col("at_latest"))
    by_coverage = _over("coverage")
    cells = cells.withColumns({"cover_valued": F.max("last_valued").over(by_coverage), "cover_last": F.max("last").over(by_coverage)})
    best = F.coalesce("cover_valued", "cover_last")
    mine = state == status
    n_mine = F.count_if(state == "in process").over(_over())
    facts = {
        "best_last": F.max(best).over(_over()),
        "claim_valued": F.max("cover_valued").over(_over()).isNotNull(),
        "n_mine": n_mine,
        "paid_sum": F.sum("paid").over(by_coverage).cast("decimal(15,2)"),
    }
    cells = cells.withColumns(facts)
    is_last_approved = (state == "approved") & F.struct("updateddate", "last").eqNullSafe(F.struct("approved.updateddate", "approved.last"))
    keeps = {
        "estimate pending": F.when(F.col("cover_valued").isNotNull(), F.col("last_valued") == F.col("cover_valued")).otherwise(
            ~F.col("claim_valued") & (last == F.col("cover_last")) & (last == F.col("best_last"))
        ),
        "documents pending": F.lit(True),
        "assessment pending": F.col("survives"),
        "in process": mine,
        "approved": is_last_approved,
        "paid out": last == F.col("cover_last"),
        "cancelled": mine,
        "denied": mine,
    }
    only = {
        "estimate pending": best,
        "assessment pending": F.when(~F.col("any_valued"), F.col("group_last")),
        "in process": F.when(F.col("n_mine") == 1, last).otherwise(F.col("first")),
        "approved": last,
        "paid out": last,
    }

    def by_rule(values: dict[str, Column]) -> Column:
        return reduce(lambda chain, item: chain.when(status == item[0], item[1]), values.items(), F)

    chosen = cells.where(F.coalesce(by_rule(keeps), F.lit(False)))
    assessed = status == "assessment pending"
    return chosen.select(
        *CELL,
        status.alias("rule"),
        F.when(assessed, state).otherwise(status).alias("claim_status"),
        by_rule(only).alias("only"),
        (assessed & F.col("any_valued")).alias("valued_only"),
        "previous",
        "paid_sum",
        _approved_estimate().alias("approved_estimate"),
    )


def _reduced_amounts() -> dict[str, Column]:
    """The amounts of the rows that the reductions keep, by the rule that keeps them."""
    rule, previous = F.col("rule"), F.col("previous")
    waiting, raw = rule.isin("estimate pending", "assessment pending"), rule == "documents pending"
    filled = {c: F.coalesce(F.col(c), zero()) for c in AMOUNTS}
    joint = F.col("claim_estimate").isNull() | F.col("claim_estimate_first").isNull()
    inherited = {c: F.when((rule == "cancelled") & previous.isNotNull(), F.col(f"previous.{c}")) for c in CARRIED}
    denied = F.coalesce(
        F.nullif(F.col("total_claim_estimate"), zero()), F.nullif(F.col("previous.total_claim_estimate"), zero()), filled["compensation_total"]
    )
    first, total, paid = "claim_estimate_first", "total_claim_estimate", "compensation_total"
    return {
        "claim_estimate": F.when(raw, F.col("claim_estimate")).when(waiting & joint, zero()).otherwise(filled["claim_estimate"]),
        first: F.when(raw | (rule == "approved"), F.col(first)).when(waiting & joint, zero()).otherwise(F.coalesce(inherited[first], filled[first])),
        total: F.when(raw | waiting | (rule == "in process"), F.col(total))
        .when(rule == "approved", F.col("approved_estimate"))
        .when(rule == "denied", denied)
        .otherwise(F.coalesce(inherited[total], filled[total])),
        paid: F.when(raw | waiting, F.col(paid)).when(rule == "paid out", F.col("paid_sum")).otherwise(F.coalesce(inherited[paid], filled[paid])),
    }


def reduce_claims(log: DataFrame, *states: str) -> DataFrame:
    """The rows that stand for the claims resolved to the given states (all by default), with claim_status.

    The log is read twice: once for the day cells, whose windows decide which rows stay, and once to fetch these. Whole
    rows meet no aggregate and no window. The states' rules:

    * estimate pending: latest date; zero rows go when the claim has others, a claim of zero rows keeps its last one;
      last row per (claim, coverage); an estimate missing on one side is 0 on both.
    * documents pending: all rows at the latest date.
    * assessment pending: as `_assessed`; what is left in another state takes that state.
    * in process: rows in that state at the latest date, the last one of a single coverage, the first of each of several.
    * approved: the latest approved row, its estimate by `_approved_estimate`.
    * paid out: latest date; compensation summed per (claim, coverage), last row kept.
    * cancelled: cancelled rows with the amounts of the claim's latest other row, where there is one.
    * denied: denied rows; a zero estimate comes from the claim's latest other row, else from the compensation.
    """
    chosen = _chosen(log, *states)
    rows = join_facts(log, chosen, CELL, "inner", null_safe=True)
    kept = rows.where((F.col("only").isNull() | (F.col("row_index") == F.col("only"))) & (~F.col("valued_only") | _valued()))
    return kept.select(*[_reduced_amounts().get(c, F.col(c)).alias(c) for c in log.columns], "claim_status")


# One state alone is reduced in one pass: rows go through the aggregate whole, which costs less than a second scan of the
# log while only one state is asked for. `reduce_claims` is held to these forms by tests.


def _joint_zero(df: DataFrame, a: str, b: str) -> DataFrame:
    """Two amounts entered together: if one is missing, both are 0."""
    broken = F.col(a).isNull() | F.col(b).isNull()
    return df.withColumns({c: F.when(broken, zero()).otherwise(F.col(c)) for c in (a, b)})


def _zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), zero()) for c in columns})


def _row(df: DataFrame, first: Sequence[str] = ("row_index",)) -> Column:
    """The row as a struct ordered by the given columns, to be carried through min and max."""
    return F.struct(*first, *[c for c in df.columns if c not in first and c != "claimnumber"])


def _unrow(df: DataFrame, row: str, columns: Sequence[str], **replaced: Column) -> DataFrame:
    """Back from a carried row to columns, with claim_status added."""
    return df.select(
        "claimnumber",
        *[replaced.get(c, F.col(f"{row}.{c}")).alias(c) for c in columns if c != "claimnumber"],
        "claim_status",
    )


def _day_cells(log: DataFrame, **aggregates: Column) -> DataFrame:
    """One row per (claim, coverage, state, date) with the resolved claim_status and the claim's latest date."""
    cells = log.groupBy(*CELL).agg(*[a.alias(name) for name, a in aggregates.items()])
    rank = F.min(status_rank("claim_status_name")).over(_over())
    latest = F.max("updateddate").over(_over())
    return cells.withColumn("claim_status", status_of_rank(rank)).withColumn("latest_date", latest)


def _latest_cells(log: DataFrame, status: str, **aggregates: Column) -> DataFrame:
    """The cells at the latest date of the claims resolved to `status`."""
    return _day_cells(log, **aggregates).where(
        (F.col("claim_status") == status) & (F.col("updateddate") == F.col("latest_date"))
    )


def reduce_estimate_pending(log: DataFrame) -> DataFrame:
    """Latest date; joint zero fill; zero rows go when the claim has others; last row per (claim, coverage).

    A claim whose rows are all zero keeps its last row.
    """
    r = _joint_zero(log, "claim_estimate", "claim_estimate_first").withColumn("valued", _valued())
    cells = _latest_cells(r, "estimate pending", best=F.max(_row(r, ("valued", "row_index"))))
    best = cells.groupBy("claimnumber", "coverage", "claim_status").agg(F.max("best").alias("best"))
    kept = (
        best.withColumn("any_valued", F.max("best.valued").over(_over()))
        .withColumn("last_index", F.max("best.row_index").over(_over()))
        .where(F.col("best.valued") | (~F.col("any_valued") & (F.col("best.row_index") == F.col("last_index"))))
    )
    return _unrow(kept, "best", log.columns)


def reduce_documents_pending(log: DataFrame) -> DataFrame:
    """Rows at the latest date of the claims waiting for documents."""
    return _at_latest_of(log, "documents pending").select(*log.columns, "claim_status")


def reduce_assessment_pending(log: DataFrame) -> DataFrame:
    """Latest rows of the claims waiting for assessment, with corrected claim_status, by `reduce_claims`."""
    return reduce_claims(log, "assessment pending")


def reduce_in_process(log: DataFrame) -> DataFrame:
    """Rows in process at the claim's latest date: the last one of a single coverage, the first of each of several."""
    r = _zero(log, ("claim_estimate", "claim_estimate_first", "compensation_total"))
    cells = _latest_cells(r, "in process", first=F.min(_row(r)), last=F.max(_row(r)))
    mine = cells.where(F.col("claim_status_name") == "in process")
    coverages = F.count(F.lit(1)).over(_over())
    chosen = mine.withColumn("n", coverages).withColumn(
        "chosen", F.when(F.col("n") == 1, F.col("last")).otherwise(F.col("first"))
    )
    return _unrow(chosen, "chosen", log.columns)


def reduce_approved(log: DataFrame) -> DataFrame:
    """Latest approved row per claim; a zero estimate comes from the latest row in another state, else from the compensation.

    All of it is one aggregate per claim.
    """
    r = _zero(log, ("claim_estimate", "total_claim_estimate", "compensation_total"))
    approved = F.col("claim_status_name") == "approved"
    order = ("updateddate", "row_index")
    claims = r.groupBy("claimnumber").agg(
        status_of_rank(F.min(status_rank("claim_status_name"))).alias("claim_status"),
        F.max(F.when(approved, _row(r, order))).alias("last"),
        F.max(F.when(~approved, F.struct(*order, "total_claim_estimate"))).alias("previous"),
    )
    entered, net = F.col("last.total_claim_estimate"), F.col("last.compensation_total")
    estimate = (
        F.when(entered != 0, entered)
        .when(F.col("previous").isNotNull(), F.col("previous.total_claim_estimate"))
        .when(net != 0, gross_up(net))
        .otherwise(entered)
    )
    return _unrow(claims.where(F.col("claim_status") == "approved"), "last", log.columns, total_claim_estimate=estimate)


def reduce_paid_out(log: DataFrame) -> DataFrame:
    """Rows at the latest date of paid-out claims, compensation summed per (claim, coverage), last row kept."""
    r = _zero(log, AMOUNTS)
    cells = _latest_cells(r, "paid out", last=F.max(_row(r)), total=F.sum("compensation_total"))
    paid = cells.groupBy("claimnumber", "coverage", "claim_status").agg(
        F.max("last").alias("last"), F.sum("total").cast("decimal(15,2)").alias("total")
    )
    return _unrow(paid, "last", log.columns, compensation_total=F.col("total"))


def _closed_with_previous(log: DataFrame, status: str, columns: Sequence[str]) -> DataFrame:
    """Rows in `status` of the claims resolved to it, beside amounts of the claim's latest row in another state."""
    r = _zero(log, AMOUNTS)
    own = F.col("claim_status_name") == status
    previous = F.max(F.when(~own, F.struct("updateddate", "row_index", *columns))).alias("previous")
    claims = r.groupBy("claimnumber").agg(
        status_of_rank(F.min(status_rank("claim_status_name"))).alias("claim_status"), previous
    )
    return join_facts(r.where(own), claims.where(F.col("claim_status") == status), CLAIM, "inner")


def reduce_cancelled(log: DataFrame) -> DataFrame:
    """Cancelled rows with the amounts of the claim's latest other row, where there is one."""
    taken = ["total_claim_estimate", "claim_estimate_first", "compensation_total"]
    rows = _closed_with_previous(log, "cancelled", taken)
    inherited = {
        c: F.when(F.col("previous").isNotNull(), F.col(f"previous.{c}")).otherwise(F.col(c)) for c in taken
    }
    return rows.withColumns(inherited).select(*log.columns, "claim_status")


def reduce_denied(log: DataFrame) -> DataFrame:
    """Denied rows; a zero estimate comes from the claim's latest other row, else from the compensation."""
    rows = _closed_with_previous(log, "denied", ["total_claim_estimate"])
    entered = F.nullif(F.col("total_claim_estimate"), zero())
    previous = F.nullif(F.col("previous.total_claim_estimate"), zero())
    estimate = F.coalesce(entered, previous, F.col("compensation_total"))
    return rows.withColumn("total_claim_estimate", estimate).select(*log.columns, "claim_status")


def _moved_rank() -> Column:
    """Rank of the strongest state that surviving cells of a claim taken for waiting for assessment move to."""
    moved = (F.col("claim_status") == "assessment pending") & ~F.col("own") & F.col("survives")
    return F.when(moved, F.coalesce(status_rank("claim_status_name"), F.lit(len(STATUS_PRIORITY) + 1)))


def _status_moved_to(rank: Column) -> Column:
    return F.when(rank.isNotNull(), F.coalesce(status_of_rank(rank), F.lit("submitted")))


def moved_status(log: DataFrame) -> DataFrame:
    """Claims taken for waiting for assessment whose latest rows say otherwise, with the strongest such state."""
    moved = _decided(log, "assessment pending").groupBy("claimnumber").agg(F.min(_moved_rank()).alias("rank")).where(F.col("rank").isNotNull())
    return moved.select("claimnumber", _status_moved_to(F.col("rank")).alias("moved_status"))


def clean_log(log: DataFrame) -> DataFrame:
    """One row per (claim, state, coverage): earliest date, then highest index; amounts zero-filled.

    Claims relabelled while waiting for assessment take their new state, and approved rows take the approved estimate.
    The rows are chosen among day cells and fetched by a second scan, as in `reduce_claims`.
    """
    cells = _decided(log)
    place = F.struct("updateddate", (-F.col("last")).alias("back"))
    is_first = place.eqNullSafe(F.col("first_place"))
    cells = cells.withColumns({"first_place": F.min(place).over(_over("claim_status_name", "coverage")), "moved": F.min(_moved_rank()).over(_over())})
    is_approved = (F.col("claim_status_name") == "approved") & (F.col("claim_status") == "approved")
    chosen = cells.where(is_first).select(
        *CELL,
        F.coalesce(_status_moved_to(F.col("moved")), "claim_status").alias("claim_status"),
        F.when(is_approved, _approved_estimate()).alias("approved_estimate"),
        F.col("last").alias("only"),
    )
    rows = join_facts(log, chosen, CELL, "inner", null_safe=True).where(F.col("row_index") == F.col("only"))
    filled = {c: F.coalesce(F.col(c), zero()) for c in AMOUNTS}
    filled["total_claim_estimate"] = F.coalesce("approved_estimate", filled["total_claim_estimate"])
    return rows.select(*[filled.get(c, F.col(c)).alias(c) for c in log.columns], "claim_status")


def damage_facts(log: DataFrame, with_status: bool = False, with_milestones: bool = False) -> DataFrame:
    """Per claim: number of different damage types, the first one, and all of them counted.

    `with_status` adds claim_status and paid_on, `with_milestones` the milestone dates, from the same pass over the log.
    """
    value = F.when(F.trim("damage_type") != "", F.col("damage_type"))
    name = F.col("claim_status_name") if with_status else None
    carried = (
        {
            "rank": F.min(status_rank(name)),
            "paid_on": F.max(F.when(name == "paid out", F.col("updateddate"))),
        }
        if with_status
        else {}
    )
    dates = {n: first_date_of(state) for n, state in MILESTONE_STATES.items()} if with_milestones else {}
    per_value = log.groupBy("claimnumber", value.alias("v")).agg(
        F.count(F.lit(1)).alias("copies"), *[c.alias(n) for n, c in {**carried, **dates}.items()]
    )
    named = F.col("v").isNotNull()
    merged = (
        [status_of_rank(F.min("rank")).alias("claim_status"), F.max("paid_on").alias("paid_on")] if with_status else []
    )
    return per_value.groupBy("claimnumber").agg(
        F.count("v").alias("n_damages"),
        F.min("v").alias("only_damage"),
        F.array_sort(F.collect_list(F.when(named, F.struct(F.col("v").alias("value"), "copies")))).alias("damages"),
        *merged,
        *[F.min(n).alias(n) for n in dates],
    )


def damage_labels(rows: DataFrame) -> DataFrame:
    """Rows that carry `damage_facts`: fill blanks and name the values, as an array of (value, copies)."""
    n = F.col("n_damages")
    blank = F.coalesce(F.trim("damage_type") == "", F.lit(True))
    damage = (
        F.when(n == 0, F.lit("Unclassified"))
        .when(~blank, F.col("damage_type"))
        .when(n == 1, F.col("only_damage"))
        .otherwise(F.lit("Multiple"))
    )
    one = F.when(n == 0, F.lit("Unclassified")).when(n == 1, F.col("only_damage"))
    single = F.array(F.struct(one.alias("value"), F.lit(1).cast("long").alias("copies")))
    listed = F.when(n <= 1, single).otherwise(F.col("damages"))
    return rows.withColumns({"damage_type_list": listed, "damage_type": damage}).drop(
        "n_damages", "only_damage", "damages"
    )


def consolidate_damage(log: DataFrame) -> DataFrame:
    """Damage type per claim: blanks take the claim's only value, `Multiple` beside several, `Unclassified` beside none.

    `damage_type_list` holds the claim's value, or all of them sorted and counted when there are several.
    """
    return damage_labels(join_facts(log, damage_facts(log), CLAIM, "inner"))


def promote_paid(rows: DataFrame) -> DataFrame:
    """Approved claims with a paid-out row are paid out."""
    paid = with_facts(rows, CLAIM, __paid=F.max(F.col("claim_status_name") == "paid out"))
    return paid.withColumn(
        "claim_status",
        F.when((F.col("claim_status") == "approved") & F.col("__paid"), F.lit("paid out")).otherwise(F.col("claim_status")),
    ).drop("__paid")


def process_days(df: DataFrame, rule: str = "final", output: str = "processdays") -> DataFrame:
    """Days a claim took. `history`, `final` and `repair` are the three rules in use."""
    status = F.col("claim_status")
    submitted, updated = F.col("claim_submitted_date"), F.col("updateddate")
    approved = F.col("claim_approved_date")
    if rule == "history":
        days = (
            F.when(status == "paid out", F.datediff("payment_date", submitted))
            .when(status.isin("submitted", "cancelled", "in process", "denied"), F.datediff(updated, submitted))
            .when(status == "approved", F.datediff(approved, submitted))
        )
    elif rule == "final":
        days = F.when(status.isin("approved", "paid out"), F.datediff(approved, submitted)).when(
            status.isin("denied", "cancelled"), F.datediff(updated, submitted)
        )
    elif rule == "repair":
        current = F.col(output)
        unset = current.isNull() | (current == 0)
        beyond = ~status.isin("cancelled", "estimate pending", "assessment pending")
        opened = F.datediff(F.coalesce(approved, updated), "claim_opened_date")
        days = (
            F.when(unset & beyond, opened)
            .when((status == "cancelled") & (current == 0), F.datediff(updated, submitted))
            .otherwise(current)
        )
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return df.withColumn(output, days.cast("int"))


def paid_date() -> Column:
    """Payment date of a paid-out claim: the date of its latest paid-out row, else the entered one, else the approval."""
    paid = F.coalesce("paid_on", "payment_date", "claim_approved_date")
    return F.when(F.col("claim_status") == "paid out", paid).otherwise(F.col("payment_date"))


def payment_date(log: DataFrame) -> DataFrame:
    """The log with claim_status and the corrected payment date on every row."""
    facts = claim_facts(log, "claim_status", "paid_on")
    return join_facts(log, facts, CLAIM, "inner").withColumn("payment_date", paid_date()).drop("paid_on")


def reduce_history_only(log: DataFrame, variant: str = "latest") -> DataFrame:
    """One row per claim known only to the log: `latest`, `largest` amounts or latest `in process` row.

    `distinct amounts` sums the different approved amounts per claim instead. Rows are reduced before
    the claim's state is joined, one row per claim on both sides; the amounts bring the states of their claims along.
    """
    latest = [F.desc("updateddate"), F.desc("row_index")]
    name = F.col("claim_status_name")
    if variant == "latest":
        return pick(log, CLAIM, latest).join(resolve_status(log), CLAIM)
    if variant == "largest":
        sizes = [F.desc_nulls_last(c) for c in ("compensation_total", "total_claim_estimate", "claim_estimate_first")]
        return pick(log, CLAIM, [*sizes, *latest]).join(resolve_status(log), CLAIM)
    if variant == "in process":
        return pick(log, CLAIM, latest, name == "in process").join(claims_in(log, "in process"), CLAIM)
    if variant == "distinct amounts":
        return _distinct_amounts(log)
    raise ValueError(f"unknown variant {variant!r}")


def _distinct_amounts(log: DataFrame) -> DataFrame:
    """Claims resolved to approved with the sum of their different approved amounts, from one pass over the log.

    A claim's rows become one per different amount, and one without an amount for all its stronger states; a second
    aggregate makes the claim of them, so a claim with many rows or many amounts does not meet in one task.
    """
    name = F.col("claim_status_name")
    rows = deciding_rows(log, "approved").where(F.col("claimnumber").isNotNull())
    approved = F.when(name == "approved", F.coalesce("compensation_total", zero()))
    amounts = rows.groupBy("claimnumber", approved.alias("amount")).agg(F.min(status_rank(name)).alias("rank"))
    claims = amounts.groupBy("claimnumber").agg(
        F.sum("amount").alias("compensation_total"), status_of_rank(F.min("rank")).alias("claim_status")
    )
    return claims.where(F.col("claim_status") == "approved")
