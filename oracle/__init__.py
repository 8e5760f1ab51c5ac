"""Independent SQL for every query, used only to check the Spark results."""

from .build import oracle_queries

__all__ = ["oracle_queries"]
