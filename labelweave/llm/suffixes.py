"""Substring dedup with sparse suffix arrays.

Of all suffixes of a text only those are retained that begin at a minimiser: the least
hash of ``HEAD`` words among the places where a window of ``size`` words can hold it.
Content selects them, so a repeated passage selects the same ones wherever it lies, and
every window of ``size`` words holds one. Retained suffixes are sorted by their head and
neighbours compared. Those that match are extended, to the left and to the right: the
windows that hold a matched minimiser are sorted and neighbours compared in turn, and
runs of matching windows are the maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import meeting
from .anchors import covered_sql
from .frames import same_row, scanned, with_row_id
from .words import Hasher, covered

SIZE = 50
HEAD = 12


def minimisers(hasher: Hasher, words: np.ndarray, size: int, head: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every head, minimiser's place of every window)."""
    heads = hasher.windows(words, head, seed=2)
    if len(words) < size:
        return heads, np.zeros(0, np.int64)
    return heads, meeting.lowest(heads, size - head + 1)[1]


def _retain(size: int, head: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        ids, kept, places, held = [], [], [], 0
        for rid, text, _ in meeting.texts(batches):
            heads, at = minimisers(hasher, hasher.words(text), size, head)
            if not len(at):
                continue
            place = np.unique(at)
            ids.append(rid)
            kept.append(heads[place])
            places.append(place)
            held += len(place)
            if held >= meeting.CHUNK:
                yield meeting.pack_probes(ids, kept, kept, places, parts)
                ids, kept, places, held = [], [], [], 0
        if held:
            yield meeting.pack_probes(ids, kept, kept, places, parts)

    return run


def _extend(size: int, head: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        ids, hashes, homes, places, held = [], [], [], [], 0
        for rid, text, (matched,) in meeting.texts(batches, "matched"):
            spans = matched.as_py()
            if not spans:
                continue
            words = hasher.words(text)
            heads, at = minimisers(hasher, words, size, head)
            hot = np.zeros(len(heads), bool)
            hot[meeting.expand(spans)] = True
            place = np.flatnonzero(hot[at])
            if not len(place):
                continue
            ids.append(rid)
            hashes.append(hasher.windows(words, size)[place])
            homes.append(meeting.part_of(heads[at[place]], parts))
            places.append(place)
            held += len(place)
            if held >= meeting.CHUNK:
                yield meeting.pack_windows(ids, hashes, homes, places)
                ids, hashes, homes, places, held = [], [], [], [], 0
        if held:
            yield meeting.pack_windows(ids, hashes, homes, places)

    return run


def _passages(size: int):
    """Maximal repeats of each text: (first word, words), those that touch joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, first, length = [], [], []
            for i, runs in enumerate(batch.column("runs").to_pylist()):
                starts = meeting.expand(runs)
                inside = covered(int(starts.max()) + size, starts, size)
                edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
                at += [i] * (len(edges) // 2)
                first += edges[::2].tolist()
                length += (edges[1::2] - edges[::2]).tolist()
            at = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(at) for c in ("rid_a", "rid_b")],
                    pa.array(first, pa.int64()),
                    pa.array(length, pa.int64()),
                ],
                names=["rid_a", "rid_b", "first_word", "n_words"],
            )

    return run


def repeated_passages(df: DataFrame, text: str = "text", size: int = SIZE, head: int = HEAD) -> DataFrame:
    """``rid_a``, ``rid_b``, ``first_word`` and ``n_words`` of every maximal passage all
    of whose words lie in runs of ``size`` words that also start elsewhere, in another
    row or the same.

    Words are runs of anything but ASCII white space, unchanged. Null, empty and shorter
    texts hold no passage; rows that repeat hold each other's; an empty frame gives an
    empty frame.
    """
    if not 1 <= head <= size:
        raise ValueError("a head is at least one word and at most a passage")
    rows = with_row_id(scanned(df), text=text)
    parts, tasks = meeting.plan_parts(rows, thinned=max(1, (size - head + 2) // 2))
    kept = meeting.by_part(rows.mapInArrow(_retain(size, head, parts), meeting.PACKED), tasks)
    matched = meeting.gathered(kept.mapInArrow(meeting.hits, meeting.RUNS), "matched")
    near = rows.join(matched, same_row()).drop("_a", "_b")
    near = near.sortWithinPartitions("rid_a", "rid_b")
    windows = meeting.by_part(near.mapInArrow(_extend(size, head, parts), meeting.PACKED), tasks)
    found = meeting.gathered(windows.mapInArrow(meeting.confirm, meeting.RUNS), "runs")
    schema = "rid_a long, rid_b long, first_word long, n_words long"
    found = found.withColumnsRenamed({"_a": "rid_a", "_b": "rid_b"})
    return found.mapInArrow(_passages(size), schema)


def op5(df: DataFrame) -> DataFrame:
    """The repeated passages of all documents: doc_id, first_word, n_words."""
    scan = scanned(df)
    ids = with_row_id(scan, doc_id="doc_id").withColumnsRenamed({"rid_a": "_a", "rid_b": "_b"})
    found = repeated_passages(scan).join(ids, same_row())
    return found.select("doc_id", "first_word", "n_words")


OP5_SQL = (
    covered_sql(SIZE)
    + """,
g AS (SELECT r, j, j - row_number() OVER (PARTITION BY r ORDER BY j) AS island FROM c)
SELECT doc_id, first_word, n_words FROM (SELECT r, min(j) - 1 AS first_word, count(*) AS n_words
    FROM g GROUP BY r, island) JOIN d USING (r)"""
)
