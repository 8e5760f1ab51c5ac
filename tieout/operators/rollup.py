"""Segment tables with a total row, signed walks and totals-last ordering."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL = "ALL"


@dataclass(frozen=True)
class Measure:
    """A figure that can be summed again: a row sum or a conditional count."""

    detail: Column
    zero_when_empty: bool


def total_of(value: Column | str) -> Measure:
    return Measure(F.sum(value), False)


def rows_where(condition: Column | None = None) -> Measure:
    return Measure(F.count(F.lit(1)) if condition is None else F.count(F.when(condition, 1)), True)


def segment_rollup(df: DataFrame, segment: str, measures: dict[str, Measure], total: str = TOTAL) -> DataFrame:
    """One row per segment plus a total row, from a single pass over ``df``.

    The total re-aggregates the segment rows, so the base is scanned and
    shuffled once (the second branch reuses the first one's exchange) and no
    row is expanded as ROLLUP would do. A null segment stays its own row. Over
    an empty input only the total row is left.
    """
    detail = df.groupBy(segment).agg(*[m.detail.alias(name) for name, m in measures.items()])
    again = [
        (F.coalesce(F.sum(name), F.lit(0)) if m.zero_when_empty else F.sum(name)).alias(name)
        for name, m in measures.items()
    ]
    return detail.unionByName(detail.agg(*again).withColumn(segment, F.lit(total)))


def walk(start: str, plus: Sequence[str] = (), minus: Sequence[str] = ()) -> Column:
    """A signed bridge: ``start + plus... - minus...``."""
    up = reduce(add, [F.col(c) for c in plus], F.col(start))
    return reduce(lambda acc, c: acc - F.col(c), minus, up)


def totals_last_order(segment: str, total: str = TOTAL) -> list[Column]:
    return [(F.col(segment) == total).asc_nulls_first(), F.col(segment).asc_nulls_last()]


def totals_last(df: DataFrame, segment: str, total: str = TOTAL) -> DataFrame:
    """Presentation order: segments by name, the total row at the end."""
    return df.orderBy(*totals_last_order(segment, total))


def weighted_mean(value: str, weight: str) -> Column:
    """Mean of per-segment means, weighted; null when the weights sum to zero."""
    weights = F.sum(weight)
    return F.sum(F.col(value) * F.col(weight)) / F.when(weights != 0, weights)
