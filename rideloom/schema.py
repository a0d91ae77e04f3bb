"""Column names and rule parameters shared by the operators."""

from __future__ import annotations

import re
from dataclasses import dataclass

# One trip line: six text fields, in this order.
RAW_FIELDS = ("s_pickup", "s_dropoff", "s_pu", "s_do", "s_miles", "s_amount")
# The same fields after parsing.
TYPED_FIELDS = ("pickup", "dropoff", "pu", "do_", "miles", "amount")
# The four additive statistics carried by every aggregate.
SUM4 = ("trips", "distance_milli_miles", "seconds", "cents")

# Reject reasons in the order in which the rules are tried.
REASONS = (
    "Malformed",
    "NonFinite",
    "OutsideMonth",
    "UnknownZone",
    "InvalidDuration",
    "InvalidDistance",
    "InvalidAmount",
)


@dataclass(frozen=True)
class Rules:
    """Limits of the data-quality rules; defaults are those of the yellow-taxi data."""

    # Fixed values.
    zone_lo: int = 1
    zone_hi: int = 263
    seconds_lo: int = 60
    seconds_hi: int = 10_800
    miles_hi: float = 100.0
    amount_hi: float = 1_000.0


_MONTH = re.compile(r"20\d{2}-(0[1-9]|1[0-2])")


def month_arg_guard(month: str) -> str:
    """Return ``month`` if it is a YYYY-MM of this century, else raise ValueError."""
    if not isinstance(month, str) or not _MONTH.fullmatch(month):
        raise ValueError(f"month must be YYYY-MM, got {month!r}")
    return month
