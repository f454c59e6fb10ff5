"""Column expressions: labels, text, and column-name handling."""

from .labels import (
    as_flag,
    flag_if_present,
    map_codes,
    multi_hot,
    null_to,
    one_hot,
    parse_number,
    pair_votes,
    rescale_percent,
    row_mean,
    vote_counts,
)
from .naming import drop_columns, normalize_columns, project, title_case
from .text import (
    collapse_punctuation,
    detokenize,
    drop_inline_tag,
    html_unescape,
    join_middle,
    left_strip_chars,
    split_item,
    strip_text,
    tagged,
)

__all__ = [
    "as_flag",
    "collapse_punctuation",
    "detokenize",
    "drop_columns",
    "drop_inline_tag",
    "flag_if_present",
    "html_unescape",
    "join_middle",
    "left_strip_chars",
    "map_codes",
    "multi_hot",
    "normalize_columns",
    "null_to",
    "one_hot",
    "pair_votes",
    "parse_number",
    "project",
    "rescale_percent",
    "row_mean",
    "split_item",
    "strip_text",
    "tagged",
    "title_case",
    "vote_counts",
]
