"""Run parameters, one frozen dataclass per domain that has any."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(value: date | str) -> Column:
    """A run date as a DATE literal, folded by Catalyst."""
    return F.lit(str(value)).cast("date")


@dataclass(frozen=True)
class LendingParams:
    as_of: str = "2025-06-30"
    par30_days: int = 30
    par90_days: int = 90


@dataclass(frozen=True)
class WorkforceParams:
    as_of: str = "2025-12-31"
    window_start: str = "2025-01-01"


@dataclass(frozen=True)
class RevenueParams:
    base_currency: str = "USD"
    tie_tolerance: str = "1.00"
