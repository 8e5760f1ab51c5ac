from .checks import accepted_range, accepted_values, not_null, relationships, unique
from .dedup import (
    distinct_counts,
    first_per_key,
    flag_duplicates,
    latest_by_key,
    latest_record_per_key,
    winning_ids,
)
from .joins import (
    disagree,
    flag_orphans,
    join_one_row_frames,
    left_join_all,
    link_hits,
    lookup,
    validate_links,
)
from .links import Chains, resolve_chains
from .ordered import files_in_order, in_order, read_ordered, with_position, write_ordered
from .rollup import TOTAL, rows_where, segment_rollup, total_of, totals_last, totals_last_order, walk, weighted_mean

__all__ = [
    "TOTAL",
    "Chains",
    "accepted_range",
    "accepted_values",
    "disagree",
    "distinct_counts",
    "files_in_order",
    "in_order",
    "first_per_key",
    "flag_duplicates",
    "flag_orphans",
    "join_one_row_frames",
    "latest_by_key",
    "latest_record_per_key",
    "left_join_all",
    "link_hits",
    "lookup",
    "not_null",
    "read_ordered",
    "relationships",
    "resolve_chains",
    "rows_where",
    "segment_rollup",
    "total_of",
    "totals_last",
    "totals_last_order",
    "unique",
    "validate_links",
    "walk",
    "weighted_mean",
    "winning_ids",
    "with_position",
    "write_ordered",
]
