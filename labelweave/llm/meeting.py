"""Fingerprints of places in texts that meet by partition.

Tasks turn texts into fingerprints of places and send them packed, a row per partition
of fingerprints. Where they meet they are sorted and neighbours compared, so places
whose words occur more than once are found without pairing them. Within a task equal
fingerprints are collapsed first: a passage that a third of all texts share costs one
entry per task that read it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import pack, unpack
from .words import U

# Places gathered by a task before they are sorted and sent, and the fingerprints that
# one partition should hold.
CHUNK = 1 << 19
PER_PART = 1 << 22

PACKED = "part int, once binary, often binary, fp binary, doc binary, place binary, ids_a binary, ids_b binary"
RUNS = "rid_a long, rid_b long, start int, length int"
_ARROW = pa.schema(
    [("part", pa.int32())]
    + [(c, pa.binary()) for c in ("once", "often", "fp", "doc", "place", "ids_a", "ids_b")]
)


def plan_parts(rows: DataFrame, thinned: int = 1) -> tuple[int, int]:
    """(partitions of fingerprints, tasks) for one fingerprint per ``thinned`` words."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(2 * tasks, total // (6 * PER_PART * thinned))
    return parts, max(tasks, parts // 4)


def by_part(packed: DataFrame, tasks: int) -> DataFrame:
    return packed.repartition(tasks, "part").sortWithinPartitions("part")


def gathered(runs: DataFrame, name: str) -> DataFrame:
    """A row per text: its runs. A text's runs are bounded by its length."""
    lists = runs.groupBy("rid_a", "rid_b").agg(F.collect_list(F.struct("start", "length")).alias(name))
    return lists.withColumnsRenamed({"rid_a": "_a", "rid_b": "_b"})


def texts(batches: Iterator[pa.RecordBatch], *more: str):
    """(row id, text as bytes, further columns) of every row; null texts are empty."""
    for batch in batches:
        columns = [batch.column(c) for c in ("rid_a", "rid_b", "text", *more)]
        for i in range(batch.num_rows):
            a, b, text, *rest = (c[i] for c in columns)
            yield (a.as_py(), b.as_py()), (text.as_py() or "").encode(), rest


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return (((h >> U(32)) * U(parts)) >> U(32)).astype(np.int64)


def _slices(parts: np.ndarray):
    """(part, from, to) of each run of equal numbers in a sorted array."""
    edges = np.flatnonzero(np.diff(parts, prepend=-1, append=-1))
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield int(parts[lo]), lo, hi


def _cut(values: np.ndarray, parts: np.ndarray, part: int) -> np.ndarray:
    lo, hi = np.searchsorted(parts, [part, part + 1])
    return values[lo:hi]


def _row(part, once, often, fp, doc, place, ids, used=None) -> dict:
    """``ids`` are of all texts at hand; only those that occur in the row travel:
    ``used``, or the texts of ``doc``."""
    used = np.unique(doc) if used is None else used
    return {
        "part": part,
        "once": pack(once),
        "often": pack(often),
        "fp": pack(fp),
        "doc": pack(np.searchsorted(used, doc).astype(np.uint32)),
        "place": pack(place.astype(np.uint32)),
        "ids_a": pack(ids[used, 0]),
        "ids_b": pack(ids[used, 1]),
    }


def runs_of(doc: np.ndarray, place: np.ndarray):
    """Consecutive places of a text as (doc, start, length)."""
    if not len(doc):
        return doc, place, place
    fresh = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(place, prepend=-2) != 1))
    return doc[fresh], place[fresh], np.diff(np.append(fresh, len(doc)))


def pack_probes(ids, probes, entries, places, parts: int) -> pa.RecordBatch:
    """32-bit fingerprints: ``probes`` are counted, ``entries`` are what may be hit.

    Each is a list of arrays, one per text. With the partition's number a fingerprint has
    32 bits and as many as partitions need, so false hits do not grow with the input.
    """
    h = np.concatenate(probes)
    key, n = np.unique((part_of(h, parts).astype(U) << U(32)) | (h & U(0xFFFFFFFF)), return_counts=True)
    where, fp = (key >> U(32)).astype(np.int64), key.astype(np.uint32)
    entry, place = np.concatenate(entries), np.concatenate(places)
    doc = np.repeat(np.arange(len(entries)), [len(e) for e in entries])
    home = part_of(entry, parts)
    order = np.argsort(home, kind="stable")
    home, entry, doc, place = home[order], entry[order], doc[order], place[order]
    ids = np.array(ids, np.int64).reshape(-1, 2)
    rows = []
    for part, lo, hi in _slices(where):
        single = n[lo:hi] == 1
        cut = [_cut(values, home, part) for values in (entry, doc, place)]
        rows.append(
            _row(part, fp[lo:hi][single], fp[lo:hi][~single], cut[0].astype(np.uint32), *cut[1:], ids)
        )
    return pa.RecordBatch.from_pylist(rows, _ARROW)


def pack_windows(ids, hashes, homes, places) -> pa.RecordBatch:
    """64-bit fingerprints of windows, sent to ``homes``; lists of arrays, one per text.

    Windows that repeat within the task go as one entry for others to meet, and their
    places, known to repeat, go beside in ``once``.
    """
    h, home, place = np.concatenate(hashes), np.concatenate(homes), np.concatenate(places)
    doc = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
    ids = np.array(ids, np.int64).reshape(-1, 2)
    values, back, n = np.unique(h, return_inverse=True, return_counts=True)
    single = n[back] == 1
    value_home = np.zeros(len(values), np.int64)
    value_home[back] = home
    many = np.flatnonzero(n > 1)
    many = many[np.argsort(value_home[many], kind="stable")]
    often, often_home = values[many], value_home[many]
    order = np.argsort(home, kind="stable")
    rows = []
    for part, lo, hi in _slices(home[order]):
        mine = order[lo:hi]
        known, mine = mine[~single[mine]], mine[single[mine]]
        used = np.unique(doc[np.concatenate([mine, known])])
        row = _row(part, h[:0], _cut(often, often_home, part), h[mine], doc[mine], place[mine], ids, used)
        back = np.searchsorted(used, doc[known])
        row["once"] = pack(np.concatenate(runs_of(back, place[known])).astype(np.uint32))
        rows.append(row)
    return pa.RecordBatch.from_pylist(rows, _ARROW)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one part at a time; rows come sorted by part."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and rows[0]["part"] != row["part"]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _repeated(single: np.ndarray, often: list[np.ndarray]) -> np.ndarray:
    """Sorted fingerprints that occur more than once in all."""
    single = np.sort(single)
    return np.unique(np.concatenate([single[1:][single[1:] == single[:-1]], *often]))


def _found(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def _batch(row, doc, start, length) -> pa.RecordBatch:
    a, b = unpack(row["ids_a"], np.int64), unpack(row["ids_b"], np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(a[doc]),
            pa.array(b[doc]),
            pa.array(start.astype(np.int32)),
            pa.array(length.astype(np.int32)),
        ],
        names=["rid_a", "rid_b", "start", "length"],
    )


def _hit_runs(row, repeated, kind) -> pa.RecordBatch:
    hit = _found(repeated, unpack(row["fp"], kind))
    doc, place = (unpack(row[c], np.uint32).astype(np.int64)[hit] for c in ("doc", "place"))
    return _batch(row, *runs_of(doc, place))


def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of entries whose fingerprint was probed more than once."""
    for rows in _parts(batches):
        often = [unpack(r["often"], np.uint32) for r in rows]
        repeated = _repeated(np.concatenate([unpack(r["once"], np.uint32) for r in rows]), often)
        for r in rows:
            yield _hit_runs(r, repeated, np.uint32)


def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of window starts whose words also start elsewhere."""
    for rows in _parts(batches):
        often = [unpack(r["often"], U) for r in rows]
        repeated = _repeated(np.concatenate([unpack(r["fp"], U) for r in rows]), often)
        for r in rows:
            known = unpack(r["once"], np.uint32).astype(np.int64).reshape(3, -1)
            yield _batch(r, *known)
            yield _hit_runs(r, repeated, U)


def lowest(values: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, place) of the least of every ``span`` neighbours, the first of equals."""
    at, width = np.arange(len(values)), 1
    while width < span and len(values):
        step = min(width, span - width)
        ahead = values[step:] < values[: len(values) - step]
        at = np.where(ahead, at[step:], at[: len(at) - step])
        values = np.where(ahead, values[step:], values[: len(values) - step])
        width += step
    return values, at


def expand(runs: list[dict]) -> np.ndarray:
    """Places of runs (start, length)."""
    return np.concatenate([np.arange(r["start"], r["start"] + r["length"]) for r in runs])
