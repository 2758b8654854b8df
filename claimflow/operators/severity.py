"""Severity and leading-indicator metrics. Thresholds and definitions are parameters of this library."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.functions.expressions import ratio
from claimflow.operators import summaries
from claimflow.operators.grouping import monthly
from claimflow.operators.lifecycle import process_days
from claimflow.operators.relational import expand_months
from claimflow.sources.tables import stage

SETTLED = ("paid out", "approved")
BANDS = ("low", "moderate", "high", "severe")


def _settled(claims: DataFrame) -> DataFrame:
    return claims.where(F.col("claim_status").isin(*SETTLED))


def _double(c: str) -> Column:
    return F.col(c).cast("double")


def frequency_severity(claims: DataFrame) -> DataFrame:
    """Claims and average compensation per submission month with the change against the month before."""
    series = monthly(
        _settled(claims),
        "claim_submitted_date",
        F.count(F.lit(1)).alias("claim_count"),
        F.sum("compensation_total").alias("amount"),
    ).select("calendar_month", "claim_count", ratio(_double("amount"), "claim_count").alias("severity"))
    # the series holds a row a month, so one window over all of them stays small
    last = Window.orderBy(_month_number()).rangeBetween(-1, -1)
    before = series.withColumns({"__count": F.first("claim_count").over(last), "__severity": F.first("severity").over(last)})
    return before.select(
        "calendar_month",
        "claim_count",
        "severity",
        ratio((F.col("claim_count") - F.col("__count")).cast("double"), "__count").alias("count_change"),
        ratio(F.col("severity") - F.col("__severity"), "__severity").alias("severity_change"),
    )


def _month_number() -> Column:
    return F.year("calendar_month") * 12 + F.month("calendar_month")


def severity_band(amount: str | Column, cuts: Sequence[float | Column]) -> Column:
    """Band of an amount by three ascending cut points, numbers or columns."""
    a = F.col(amount) if isinstance(amount, str) else amount
    low, moderate, high = cuts
    return (
        F.when(a < low, BANDS[0]).when(a < moderate, BANDS[1]).when(a < high, BANDS[2]).when(a >= high, BANDS[3])
    )


CUT_SHARES = (0.5, 0.8, 0.95)  # the quantiles that part the bands


def amount_summary(claims: DataFrame, segment: Sequence[str], bits: int = summaries.BITS) -> DataFrame:
    """Mergeable summary of the compensation of settled claims per submission month and segment: a stage to keep."""
    settled = _settled(claims).where(F.col("claim_submitted_date").isNotNull())
    dated = settled.withColumn("calendar_month", F.trunc("claim_submitted_date", "MM"))
    return summaries.summarise(dated, ["calendar_month", *segment], "compensation_total", bits)


def segment_cuts(summary: DataFrame, segment: Sequence[str], shares: Sequence[float] = CUT_SHARES) -> DataFrame:
    """Cut points of every segment over all months of a summary."""
    return summaries.cut_points(summaries.merge(summary, segment), segment, shares)


def trailing_cuts(summary: DataFrame, segment: Sequence[str], months: int = 12, shares: Sequence[float] = CUT_SHARES) -> DataFrame:
    """Cut points of every month and segment from the months before it."""
    before = summaries.trailing(summary, "calendar_month", segment, months)
    return summaries.cut_points(before, ["calendar_month", *segment], shares)


def banded(claims: DataFrame, cuts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Settled claims with the band that the cut points of their keys give them; without cut points there is no band.

    `cuts` holds one row per key: `cut_1` to `cut_3` beside `keys`, of which `calendar_month` is the submission month.
    """
    dated = _settled(claims).withColumn("calendar_month", F.trunc("claim_submitted_date", "MM"))
    met = dated.join(cuts, list(keys), "left")
    return met.withColumn("band", severity_band("compensation_total", [F.col(f"cut_{k}") for k in (1, 2, 3)])).drop("cut_1", "cut_2", "cut_3")


def severity_mix(claims: DataFrame, cuts: Sequence[float]) -> DataFrame:
    """Per submission month: claims of each band and the share of severe and high ones."""
    return band_mix(_settled(claims).withColumn("band", severity_band("compensation_total", cuts)))


def band_mix(banded: DataFrame) -> DataFrame:
    """`severity_mix` of claims that have their band."""
    counts = monthly(
        banded,
        "claim_submitted_date",
        F.count(F.lit(1)).alias("claim_count"),
        *[F.count_if(F.col("band") == b).alias(f"n_{b}") for b in BANDS],
    )
    return counts.withColumn(
        "severe_high_share", ratio((F.col("n_severe") + F.col("n_high")).cast("double"), "claim_count")
    )


def estimation_error(claims: DataFrame) -> DataFrame:
    """Per submission month: total and mean relative distance between estimate and compensation."""
    paid = _settled(claims).where(F.col("compensation_total") != 0)
    gap = F.abs(F.col("total_claim_estimate") - F.col("compensation_total"))
    sums = monthly(
        paid,
        "claim_submitted_date",
        F.sum(gap).alias("gap"),
        F.sum("compensation_total").alias("paid"),
        F.avg(ratio(gap.cast("double"), _double("compensation_total"))).alias("mean_error"),
    )
    return sums.select("calendar_month", ratio(_double("gap"), _double("paid")).alias("total_error"), "mean_error")


def open_backlog(claims: DataFrame, until: str) -> DataFrame:
    """Claims open at each month end up to `until`: submitted by then and not closed by then.

    A settled claim closes on approval, a denied or cancelled one on its last update. Claims are
    collapsed to (first open month, last open month) before they are spread over months.
    """
    closed = F.when(F.col("claim_status").isin(*SETTLED), F.col("claim_approved_date")).when(
        F.col("claim_status").isin("denied", "cancelled"), F.col("updateddate")
    )
    last_open = F.coalesce(F.add_months(F.trunc(closed, "MM"), -1), F.lit(until).cast("date"))
    spans = (
        claims.where(F.col("claim_submitted_date").isNotNull())
        .select(
            F.trunc("claim_submitted_date", "MM").alias("first_month"),
            F.least(last_open, F.lit(until).cast("date")).alias("last_month"),
        )
        .groupBy("first_month", "last_month")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        expand_months(spans, "first_month", "last_month").groupBy("calendar_month").agg(F.sum("n").alias("open_claims"))
    )


def settlement_duration(claims: DataFrame, cuts: Sequence[float]) -> DataFrame:
    """Per severity band: claims, mean, median and 90th percentile of the days to settle.

    Days are whole numbers, so the exact percentiles come from a counted histogram.
    """
    return band_durations(_settled(claims).withColumn("band", severity_band("compensation_total", cuts)))


def band_durations(banded: DataFrame) -> DataFrame:
    """`settlement_duration` of claims that have their band."""
    timed = process_days(banded, "final")
    histogram = timed.where(F.col("processdays").isNotNull()).groupBy("band", "processdays").agg(F.count(F.lit(1)).alias("n"))
    return histogram.groupBy("band").agg(
        F.sum("n").alias("claim_count"),
        ratio(F.sum(F.col("processdays") * F.col("n")).cast("double"), F.sum("n")).alias("mean_days"),
        F.percentile("processdays", 0.5, F.col("n")).alias("median_days"),
        F.percentile("processdays", 0.9, F.col("n")).alias("p90_days"),
    )


LEVEL_BITS = 10  # bits of an amount that one level of buckets tells apart
LEVELS = 5  # amounts are DECIMAL(15,2): below 2^50 cents


def loss_concentration(claims: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Share of losses in the largest `shares` of settled claims, exactly, without sorting the claims.

    The cut of every share is found level by level: a level counts the claims of at most 1,024 buckets inside the
    bucket that the level before ended in, and its last level's buckets are single amounts. Windows see the
    buckets of one share at one level.
    """
    cents = (F.col("compensation_total").cast("decimal(17,2)") * 100).cast("long")
    settled = _settled(claims).where(F.col("compensation_total").isNotNull()).select(cents.alias("cents"))
    # each amount once, with its copies: what the levels read again and again
    amounts = settled.groupBy("cents").agg(F.count(F.lit(1)).alias("n"))
    amounts = amounts.withColumn("amount", (F.col("cents").cast("decimal(20,0)") * F.col("n")).cast("decimal(38,0)"))
    amounts = stage(amounts, "concentration-amounts")
    total = amounts.agg(F.sum("n").alias("total_n"), F.sum("amount").alias("total_amount"))
    cut = total.withColumn("share", F.explode(F.array(*[F.lit(s) for s in shares]))).select(
        "share",
        F.ceil(F.round(F.col("share") * F.col("total_n"), 6)).alias("n_top"),
        "total_amount",
        F.lit(None).cast("long").alias("inside"),
        F.lit(0).cast("long").alias("n_above"),
        F.lit(0).cast("decimal(38,0)").alias("amount_above"),
    )
    for level in reversed(range(LEVELS)):
        bucket = F.shiftright("cents", LEVEL_BITS * level)
        buckets = amounts.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
        # `cut` holds one row per share
        met = F.col("inside").isNull() | (F.shiftright("bucket", LEVEL_BITS) == F.col("inside"))
        met = met if level == LEVELS - 1 else F.shiftright("bucket", LEVEL_BITS) == F.col("inside")
        rows = buckets.join(F.broadcast(cut), met)
        above = Window.partitionBy("share").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
        n_above = F.col("n_above") + F.coalesce(F.sum("n").over(above), F.lit(0))
        amount_above = F.col("amount_above") + F.coalesce(F.sum("amount").over(above), F.lit(0))
        rows = rows.withColumns({"__n": n_above, "__amount": amount_above.cast("decimal(38,0)")})
        cut = rows.where((F.col("__n") < F.col("n_top")) & (F.col("n_top") <= F.col("__n") + F.col("n"))).select(
            "share", "n_top", "total_amount", F.col("bucket").alias("inside"), F.col("__n").alias("n_above"), F.col("__amount").alias("amount_above")
        )
    in_cut = (F.col("n_top") - F.col("n_above")).cast("decimal(18,0)") * F.col("inside")
    top = (F.col("amount_above") + in_cut).cast("double") / 100
    return cut.select(
        "share",
        F.col("n_top").alias("top_claims"),
        top.alias("top_amount"),
        ratio(top, F.col("total_amount").cast("double") / 100).alias("loss_share"),
    )


def large_loss_flag(claims: DataFrame, threshold: float, estimate: str = "claim_estimate_first") -> DataFrame:
    """Flag a claim at first notice when its first estimate reaches the threshold."""
    return claims.withColumn("large_loss", F.coalesce(F.col(estimate) >= F.lit(threshold), F.lit(False)))


def stressed_loss_ratio(loss_ratios: DataFrame, stresses: Sequence[float]) -> DataFrame:
    """The loss ratio of every month under each relative increase of severity."""
    return loss_ratios.withColumn("stress", F.explode(F.array(*[F.lit(s) for s in stresses]))).select(
        "calendar_month", "stress", (F.col("loss_ratio") * (1 + F.col("stress"))).alias("stressed_loss_ratio")
    )


def lead_lag(series: DataFrame, lead: str, follow: str, lags: Sequence[int]) -> DataFrame:
    """Correlation of one monthly series with another some months later, per lag."""
    # the series holds a row a month, so one window over all of them stays small
    ordered = Window.orderBy(_month_number())
    earlier = {f"__lead_{n}": F.first(lead).over(ordered.rangeBetween(-n, -n)) for n in lags}
    each = [F.struct(F.lit(n).alias("lag"), F.col(f"__lead_{n}").alias("__lead")) for n in lags]
    pairs = series.withColumns(earlier).select(F.col(follow).alias("__follow"), F.explode(F.array(*each)).alias("__pair"))
    pairs = pairs.select("__follow", "__pair.lag", "__pair.__lead")
    pairs = pairs.where(F.col("__lead").isNotNull() & F.col("__follow").isNotNull())
    return pairs.groupBy("lag").agg(
        F.count(F.lit(1)).alias("months"), F.corr(_double("__lead"), _double("__follow")).alias("correlation")
    )


def segment_cut(
    claims: DataFrame, columns: Sequence[str] = ("vehicle_type", "coverage", "damage_type"), subtotals: bool = False
) -> DataFrame:
    """Settled claims per segment: number, amount, average; `subtotals` adds every coarser grouping."""
    settled = _settled(claims)
    grouped = settled.cube(*columns) if subtotals else settled.groupBy(*columns)
    return grouped.agg(
        F.count(F.lit(1)).alias("claim_count"), F.sum("compensation_total").alias("amount")
    ).withColumn("severity", ratio(_double("amount"), "claim_count"))
