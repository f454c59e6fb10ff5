"""Relational operators: pivots, merges, joins, grouping."""

from .grouping import count_non_null, gather_lists, means, sorted_registry
from .merging import (
    append_by_name,
    append_by_position,
    full_outer_merge,
    join_on,
    merge_by_key,
    natural_self_map,
    positional_join,
    with_row_position,
)
from .openlabels import (
    frequent_labels,
    label_summary,
    merge_summaries,
    open_vote_counts,
    pivot_open,
    summarised_labels,
)
from .reshape import (
    long_to_wide,
    pivot_any_value,
    pivot_count,
    pivot_flag,
    pivot_mean,
    pivot_presence,
    pivot_sum,
    unknown_labels,
    unpivot,
)
from .rows import keep_arity, keep_parseable, map_batches, ordered, sql_over

__all__ = [
    "append_by_name",
    "append_by_position",
    "count_non_null",
    "full_outer_merge",
    "frequent_labels",
    "gather_lists",
    "join_on",
    "label_summary",
    "keep_arity",
    "keep_parseable",
    "long_to_wide",
    "map_batches",
    "means",
    "merge_by_key",
    "merge_summaries",
    "natural_self_map",
    "open_vote_counts",
    "ordered",
    "pivot_any_value",
    "pivot_count",
    "pivot_flag",
    "pivot_mean",
    "pivot_open",
    "pivot_presence",
    "pivot_sum",
    "positional_join",
    "sorted_registry",
    "sql_over",
    "summarised_labels",
    "unknown_labels",
    "unpivot",
    "with_row_position",
]
