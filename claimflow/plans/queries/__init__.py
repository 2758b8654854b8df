"""All registered queries. Importing a module registers its queries."""

from claimflow.plans.queries import (
    checks,
    cleaning,
    exposure,
    grouping,
    lifecycle,
    relational,
    severity,
    shaping,
    snapshot,
)
from claimflow.plans.queries.registry import ORACLE, QUERIES

__all__ = [
    "ORACLE",
    "QUERIES",
    "checks",
    "cleaning",
    "exposure",
    "grouping",
    "lifecycle",
    "relational",
    "severity",
    "shaping",
    "snapshot",
]
