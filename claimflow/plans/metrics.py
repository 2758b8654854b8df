"""The monthly metric views over policies and final claims."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimflow.operators import exposure
from claimflow.sources.tables import register_views


def register_metric_views(
    spark: SparkSession,
    policies: DataFrame,
    claims: DataFrame,
    first: str = exposure.FIRST_MONTH,
    last: str = exposure.LAST_MONTH,
) -> None:
    """Register `v_monthly_loss_ratio` and `v_monthly_policy_claim_counts` for use from SQL."""
    premium = exposure.earned_premium_monthly(policies, first, last)
    calendar = exposure.calendar(spark, first, last)
    register_views(
        spark,
        {
            "v_monthly_loss_ratio": lambda: exposure.monthly_loss_view(premium, claims),
            "v_monthly_policy_claim_counts": lambda: exposure.policy_claim_counts(calendar, premium, claims),
        },
    )
