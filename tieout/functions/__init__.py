from .columns import (
    ANY_MONEY,
    MONEY,
    active_on,
    clean_lower,
    clean_upper,
    days_from,
    in_window,
    month_of,
    nulls_last,
    one_of,
    ratio,
    years_of,
)

__all__ = [
    "ANY_MONEY",
    "MONEY",
    "active_on",
    "clean_lower",
    "clean_upper",
    "days_from",
    "in_window",
    "month_of",
    "nulls_last",
    "one_of",
    "ratio",
    "years_of",
]
