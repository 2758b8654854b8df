"""From the raw policy table to typed policies in English."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.functions import vocabulary as v
from claimflow.functions.expressions import map_value
from claimflow.operators.relational import delete_where
from claimflow.operators.shaping import project
from claimflow.sources.contracts import POLICY


def clean_policies(raw: DataFrame) -> DataFrame:
    """Rows without a start date go; the rest is one projection."""
    df = delete_where(project(raw, POLICY), F.col("start_date").isNull())
    return df.withColumns(
        {
            "status_trans": map_value("status_trans", v.POLICY_STATUS),
            "vehicle_usage": map_value("vehicle_usage", v.USAGE),
            "customer_type": map_value("customer_type", v.POLICY_CUSTOMER),
        }
    )
