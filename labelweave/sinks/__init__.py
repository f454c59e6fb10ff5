"""Writing datasets, and the reports about what was written."""

from .dataset import TargetNotEmpty, read_dataset, write_dataset
from .reports import (
    dataset_profile,
    file_stats,
    merge_manifest,
    row_counts,
    sample_one,
    sample_stored,
    store_manifest,
    store_sample,
)

__all__ = [
    "TargetNotEmpty",
    "dataset_profile",
    "file_stats",
    "merge_manifest",
    "read_dataset",
    "row_counts",
    "sample_one",
    "sample_stored",
    "store_manifest",
    "store_sample",
    "write_dataset",
]
