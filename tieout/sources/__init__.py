from .freshness import source_freshness
from .raw import Feeds, MissingColumns, Raw, checked_feed, raw_tables, read_raw
from .schemas import FRESHNESS, PROJECTS, RAW_COLUMNS, Freshness, raw_schema

__all__ = [
    "FRESHNESS",
    "Feeds",
    "MissingColumns",
    "PROJECTS",
    "RAW_COLUMNS",
    "Freshness",
    "Raw",
    "checked_feed",
    "raw_schema",
    "raw_tables",
    "read_raw",
    "source_freshness",
]
