"""Arrays as bytes for shuffles: many small rows become a few dense ones."""

from __future__ import annotations

import numpy as np


def pack(values: np.ndarray) -> bytes:
    """Differences, byte plane by byte plane: runs of near values compress well."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return steps.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unpack(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)
