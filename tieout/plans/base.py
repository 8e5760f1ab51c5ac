"""A project is a set of named models over its raw feeds, composed lazily."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import totals_last_order
from ..sources.raw import Raw


class Project:
    """Subclasses define one ``cached_property`` per model.

    A model that several others read can be pinned to a written copy; whatever
    is derived afterwards reads that copy instead of recomputing the plan.
    """

    name: str
    staging: tuple[str, ...]
    intermediate: tuple[str, ...]
    marts: tuple[str, ...]
    #: Marts that are written in the order of a period, and those in the order of a segment with the total at the end.
    by_period: dict[str, str] = {}
    by_segment: dict[str, str] = {}
    #: Models that are read from a written copy.
    pinned: frozenset[str] = frozenset()

    def __init__(self, raw: Raw) -> None:
        self.raw = raw

    @property
    def models(self) -> tuple[str, ...]:
        return (*self.staging, *self.intermediate, *self.marts)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    def unknown_references(self, relation: str, column: str) -> DataFrame | None:
        """Where a written model holds them: the references of a relation that have no parent, and their ``n_rows``."""
        return None

    def order(self, name: str) -> list[Column]:
        """The order in which a model is written; empty if it has none."""
        if name in self.by_period:
            return [F.col(self.by_period[name]).asc_nulls_last()]
        return totals_last_order(self.by_segment[name]) if name in self.by_segment else []

    def pin(self, name: str, df: DataFrame) -> None:
        self.__dict__[name] = df
        self.pinned |= {name}

    def register_views(self, names: Iterable[str] | None = None) -> None:
        """Expose models to SQL users as temporary views."""
        for name in names or self.models:
            self.model(name).createOrReplaceTempView(name)
