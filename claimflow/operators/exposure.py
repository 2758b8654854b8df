"""Exposure, premium and loss metrics per calendar month.

Policies are collapsed to one row per (first month, last month) before they are spread over months,
so the spread handles at most months x months rows, whatever the number of policies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimflow.functions.expressions import full_months, month_key, ratio
from claimflow.operators.grouping import duplicated_keys, monthly
from claimflow.operators.relational import expand_months, month_pairs

# First and last month of the reporting calendar.
FIRST_MONTH = "2011-11-01"
LAST_MONTH = "2030-08-01"

PREMIUM = "decimal(28,8)"


def calendar(spark: SparkSession, first: str = FIRST_MONTH, last: str = LAST_MONTH) -> DataFrame:
    """Month starts from `first` to `last`, both included."""
    return spark.range(1).select(
        F.explode(
            F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))
        ).alias("calendar_month")
    )


def monthly_share(mode: str = "full") -> Column:
    """Premium of one policy month.

    `full` divides the price by complete months + 1, `touched` by the number of calendar months the
    term touches.
    """
    if mode == "full":
        months = full_months("start_date", "end_date") + 1
    elif mode == "touched":
        months = full_months(month_key("start_date"), month_key("end_date")) + 1
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.try_divide(F.col("finalprice"), months).cast(PREMIUM)


def earned_premium_month(policies: DataFrame, month: str, mode: str = "overlap") -> DataFrame:
    """Earned premium of one month: policies in force during it, or (`starting`) that start in it or later."""
    first = F.lit(month).cast("date")
    last = F.last_day(first)
    if mode == "overlap":
        chosen = (F.col("start_date") <= last) & (F.col("end_date") >= first)
    elif mode == "starting":
        chosen = (F.col("start_date") >= first) & (F.col("end_date") > last)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return policies.where(chosen).agg(F.sum(monthly_share()).alias("earned_premium"))


def earned_premium_monthly(
    policies: DataFrame, first: str | None = None, last: str | None = None, mode: str = "full"
) -> DataFrame:
    """Earned premium and active policies of every month a policy touches, inside the calendar bounds if given."""
    pairs = month_pairs(
        policies,
        "start_date",
        "end_date",
        F.sum(monthly_share(mode)).alias("share"),
        F.count("policycode").alias("policies"),
    )
    months = expand_months(pairs, "first_month", "last_month", since=first, until=last)
    return months.groupBy("calendar_month").agg(
        F.sum("share").alias("earned_premium"), F.sum("policies").alias("active_policies")
    )


def calendar_premium(calendar_months: DataFrame, premium: DataFrame) -> DataFrame:
    """Every calendar month with its earned premium, NULL where no policy is in force."""
    return calendar_months.join(premium.select("calendar_month", "earned_premium"), "calendar_month", "left")


def claims_monthly(claims: DataFrame) -> DataFrame:
    """Amount and number of claims per month of submission."""
    return monthly(
        claims,
        "claim_submitted_date",
        F.sum("compensation_total").alias("claims_amount"),
        F.count_distinct("claimnumber").alias("claim_count"),
    )


def losses_monthly(claims: DataFrame, date: str, statuses: Sequence[str]) -> DataFrame:
    """Incurred losses and claim rows per month of `date`, for the given claim states."""
    return monthly(
        claims.where(F.col("claim_status").isin(*statuses)),
        date,
        F.sum("compensation_total").alias("incurred_losses"),
        F.count("claimnumber").alias("claim_count"),
    )


def loss_ratio_monthly(premium: DataFrame, claims: DataFrame) -> DataFrame:
    """Paid-out compensation by submission month over earned premium; NULL where a month has no claims."""
    losses = losses_monthly(claims, "claim_submitted_date", ["paid out"]).drop("claim_count")
    joined = premium.select("calendar_month", "earned_premium").join(losses, "calendar_month", "left")
    return joined.withColumn(
        "loss_ratio", ratio(F.col("incurred_losses").cast("double"), F.col("earned_premium").cast("double"))
    )


def monthly_loss_view(premium: DataFrame, claims: DataFrame) -> DataFrame:
    """Month, earned premium and incurred losses, 0 where there are none."""
    return loss_ratio_monthly(premium, claims).select(
        "calendar_month",
        "earned_premium",
        F.coalesce("incurred_losses", F.lit(0).cast("decimal(15,2)")).alias("incurred_losses"),
    )


def policy_claim_counts(calendar_months: DataFrame, premium: DataFrame, claims: DataFrame) -> DataFrame:
    """Active policies and newly submitted claims of every calendar month."""
    new = claims_monthly(claims).select("calendar_month", F.col("claim_count").alias("new_claims"))
    active = premium.select("calendar_month", "active_policies")
    joined = calendar_months.join(active, "calendar_month", "left").join(new, "calendar_month", "left")
    return joined.select(
        "calendar_month",
        F.coalesce("active_policies", F.lit(0)).alias("active_policies"),
        F.coalesce("new_claims", F.lit(0)).alias("new_claims"),
    )


def severity_monthly(premium: DataFrame, claims: DataFrame) -> DataFrame:
    """Loss ratio and average compensation by month of approval, paid-out and approved claims."""
    losses = losses_monthly(claims, "claim_approved_date", ["paid out", "approved"])
    joined = premium.select("calendar_month", "earned_premium").join(losses, "calendar_month", "left")
    incurred = F.col("incurred_losses").cast("double")
    return joined.withColumns(
        {
            "loss_ratio": ratio(incurred, F.col("earned_premium").cast("double")),
            "avg_compensation": ratio(incurred, "claim_count"),
        }
    ).drop("claim_count")


def carried_over(policies: DataFrame, after: str, before: str, beyond: str) -> DataFrame:
    """Premium and number of policies started strictly between two dates that run past a third."""
    chosen = (
        (F.col("start_date") > F.lit(after).cast("date"))
        & (F.col("start_date") < F.lit(before).cast("date"))
        & (F.col("end_date") > F.lit(beyond).cast("date"))
    )
    return policies.where(chosen).agg(
        F.sum("finalprice").alias("premium"), F.count_distinct("policycode").alias("policies")
    )


def renewals(policies: DataFrame) -> DataFrame:
    """Certificates with more than one term."""
    return duplicated_keys(policies, ["certificate_no"], "terms")


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first_date"), F.max(column).alias("last_date"))


def running(events: DataFrame, at: str, deltas: Sequence[str], grid: DataFrame, point: str) -> DataFrame:
    """For every point of `grid` the sums of the deltas of all events up to it.

    Events are first added up by where they lie. The window runs over the points and places of a calendar, which it
    alone bounds: how many events there are does not matter.
    """
    placed = events.where(F.col(at).isNotNull()).groupBy(F.col(at).alias(point)).agg(*[F.sum(d).alias(d) for d in deltas])
    both = placed.withColumn("__asked", F.lit(False)).unionByName(
        grid.select(point).distinct().withColumn("__asked", F.lit(True)), allowMissingColumns=True
    )
    merged = both.groupBy(point).agg(F.max("__asked").alias("__asked"), *[F.sum(d).alias(d) for d in deltas])
    up_to = Window.orderBy(point).rowsBetween(Window.unboundedPreceding, 0)
    sums = merged.select(point, "__asked", *[F.sum(d).over(up_to).alias(d) for d in deltas])
    return sums.where("__asked").select(point, *deltas)


def exposure_events(policies: DataFrame, amount: Column, first: Column, after: Column) -> DataFrame:
    """Two events a policy: its amount and one policy come in force at `first` and go out at `after`."""
    valid = policies.where(first.isNotNull() & after.isNotNull() & (first < after))
    share = F.coalesce(amount, F.lit(0)).cast(PREMIUM)
    each = F.array(
        F.struct(first.alias("day"), share.alias("earned_premium"), F.lit(1).cast("long").alias("active_policies")),
        F.struct(after.alias("day"), (-share).alias("earned_premium"), F.lit(-1).cast("long").alias("active_policies")),
    )
    return valid.select(F.explode(each).alias("event")).select("event.*")


def earned_premium_daily(policies: DataFrame, days: DataFrame, day: str = "calendar_day") -> DataFrame:
    """Premium earned on each day of a grid and the policies in force, the price spread evenly over the days of the term."""
    share = F.try_divide(F.col("finalprice"), F.datediff("end_date", "start_date") + 1)
    events = exposure_events(policies, share, F.col("start_date"), F.date_add("end_date", 1))
    return running(events, "day", ["earned_premium", "active_policies"], days, day)


def earned_premium_by_events(policies: DataFrame, calendar_months: DataFrame, mode: str = "full") -> DataFrame:
    """`earned_premium_monthly` on a calendar without spreading a policy over its months; months in force nowhere are left out."""
    first, after = F.trunc("start_date", "MM"), F.add_months(F.trunc("end_date", "MM"), 1)
    whole = policies.where(F.col("start_date") <= F.col("end_date"))
    events = exposure_events(whole, monthly_share(mode), first, after)
    sums = running(events, "day", ["earned_premium", "active_policies"], calendar_months, "calendar_month")
    return sums.where(F.col("active_policies") > 0)


def day_grid(spark: SparkSession, first: str, last: str, step: int = 1) -> DataFrame:
    """Every `step`-th day from `first` to `last`."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr(f"interval {step} day"))
    return spark.range(1).select(F.explode(days).alias("calendar_day"))


def open_claims_daily(claims: DataFrame, closed: Column, days: DataFrame, day: str = "calendar_day") -> DataFrame:
    """Claims open at the end of each day of a grid: submitted by then and not closed by then."""
    known = claims.where(F.col("claim_submitted_date").isNotNull()).withColumn("__closed", closed)
    comes = known.select(F.col("claim_submitted_date").alias("day"), F.lit(1).cast("long").alias("open_claims"))
    last = F.greatest("__closed", F.col("claim_submitted_date"))
    goes = known.where(F.col("__closed").isNotNull()).select(last.alias("day"), F.lit(-1).cast("long").alias("open_claims"))
    return running(comes.unionByName(goes), "day", ["open_claims"], days, day).select(day, F.coalesce("open_claims", F.lit(0)).alias("open_claims"))
