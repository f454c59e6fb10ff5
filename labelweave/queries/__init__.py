"""Every operator and corpus plan as a query over the test tables."""

from . import corpora, reports, scans, transforms  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
