"""Readers: delimited files, text lines, JSON lines, saved datasets."""

from .delimited import (
    Dialect,
    count_malformed,
    read_by_header,
    read_delimited,
    read_header_cast,
    read_headerless,
    read_union_by_name,
)
from .quoted import quoted_records
from .records import (
    load_splits,
    read_json_records,
    read_lines,
    redecode_utf7,
    regex_records,
    with_path_parts,
)
from .rejects import (
    kept_rows,
    read_observed,
    read_split,
    rejected_rows,
    scan_with_rejects,
    write_split,
)

__all__ = [
    "Dialect",
    "count_malformed",
    "kept_rows",
    "load_splits",
    "quoted_records",
    "read_by_header",
    "read_delimited",
    "read_header_cast",
    "read_headerless",
    "read_json_records",
    "read_lines",
    "read_observed",
    "read_split",
    "read_union_by_name",
    "redecode_utf7",
    "regex_records",
    "rejected_rows",
    "scan_with_rejects",
    "with_path_parts",
    "write_split",
]
