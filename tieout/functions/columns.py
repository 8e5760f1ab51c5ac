"""Column expressions shared by every model. All stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
ANY_MONEY = "decimal(38,2)"
DAYS_PER_YEAR = Decimal("365.25")

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_lower(c: ColumnOrName) -> Column:
    return F.lower(F.trim(as_col(c)))


def clean_upper(c: ColumnOrName) -> Column:
    return F.upper(F.trim(as_col(c)))


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` as a double; null (not zero, not an error) when den is 0."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def month_of(c: ColumnOrName) -> Column:
    """First day of the month as a DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(as_col(c), "month")


def days_from(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole calendar days from start to end, negative when end is earlier."""
    return F.datediff(as_col(end), as_col(start))


def years_of(days: ColumnOrName) -> Column:
    """Days as years with two decimals, in decimal arithmetic."""
    exact = as_col(days).cast("decimal(12,0)") / F.lit(DAYS_PER_YEAR)
    return F.round(exact, 2).cast("decimal(10,2)")


def one_of(c: ColumnOrName, values: Iterable[str]) -> Column:
    return as_col(c).isin(*values)


def in_window(c: ColumnOrName, start: Column, end: Column) -> Column:
    """Closed date window; null dates are outside."""
    return as_col(c).between(start, end)


def active_on(start: ColumnOrName, end: ColumnOrName, at: Column) -> Column:
    """Open at a point in time: started by then and not yet ended."""
    return (as_col(start) <= at) & (as_col(end).isNull() | (as_col(end) > at))


def nulls_last(*cols: ColumnOrName) -> Column:
    """A struct that sorts ascending with nulls last in every position.

    Spark's struct ordering puts nulls first, so each value is preceded by its
    null flag. ``min`` over this struct is "first row by (cols)", and since it
    is an ordinary aggregate it is combined on the map side.
    """
    parts = []
    for i, c in enumerate(cols):
        parts.append(as_col(c).isNull().alias(f"n{i}"))
        parts.append(as_col(c).alias(f"v{i}"))
    return F.struct(*parts)
