"""Small log fixtures and a plain-Python reading of them."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

LOG_SCHEMA = (
    "claimnumber string, row_index bigint, claim_status_name string, coverage string, updateddate date, "
    "damage_type string, claim_estimate_first decimal(15,2), claim_estimate decimal(15,2), "
    "total_claim_estimate decimal(15,2), compensation_total decimal(15,2)"
)
LOG_COLUMNS = [part.strip().split(" ")[0] for part in LOG_SCHEMA.replace("(15,2)", "").split(", ")]
STATES = [
    "submitted",
    "assessment pending",
    "estimate pending",
    "documents pending",
    "in process",
    "approved",
    "paid out",
    "denied",
    "cancelled",
]
COVERAGES = ["Collision coverage", "Auto liability coverage"]


def log_rows(seed: int, claims: int = 150, hot: int = 0) -> list[tuple]:
    """Random log with ties on dates, missing and zero amounts; claim C0 gets `hot` extra rows."""
    rng = random.Random(seed)

    def amount():
        return rng.choice([None, Decimal("0.00"), Decimal(rng.randint(1, 9) * 100)])

    rows = []
    for c in range(claims):
        states = rng.sample(STATES, rng.choice([1, 1, 2, 2, 3]))
        n = rng.randint(1, 6) + (hot if c == 0 else 0)
        for _ in range(n):
            rows.append(
                (
                    f"C{c}",
                    len(rows),
                    rng.choice(states),
                    rng.choice(COVERAGES),
                    date(2022, 1, 1) + timedelta(days=rng.randint(0, 2)),
                    rng.choice(["", "", "Theft", "Partial/Total Loss"]),
                    amount(),
                    amount(),
                    amount(),
                    amount(),
                )
            )
    return rows


def as_dicts(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def key_set(rows, *columns) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns) for r in rows), key=repr)
