"""Periodic runs of words: stretches that repeat with a period, found by recompression.

A run of period ``q`` holds a place of every grid of that period, so places ``i`` of the
grid whose word equals the one ``q`` further on are the candidates. The texts of a batch
are compressed into one grammar, which answers how far each candidate agrees to the left
and to the right. All work is done where a text is read: no shuffle.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import cols
from .recompression import extensions, grammar, mirrored
from .sums import BYTES_SQL, crc32_sql

LEAST, REPEATS = 24, 3
# Words of the texts that share a grammar, unless one text alone has more; candidates
# that are looked at together. Results do not depend on either.
BATCH_WORDS = 1 << 18
CANDIDATES = 1 << 20

RUN = "struct<start:long,length:long,period:long>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Found(NamedTuple):
    """A text's words and its runs: rows of (start, length, period), in that order."""

    words: list[bytes]
    runs: np.ndarray


def _grids(sizes: np.ndarray, offsets: np.ndarray, least: int, repeats: int):
    """(place, period) of all candidates, many at a time: on the grids of all periods,
    every run of ``least`` words and ``repeats`` periods holds one at least."""
    longest = np.where(sizes >= least, sizes // repeats, 0)
    text = np.repeat(np.arange(len(sizes)), longest)
    period = np.arange(len(text)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    step = np.maximum(least, repeats * period) - period
    count = (sizes[text] - period - 1) // step + 1
    # A period with more candidates than are looked at together stays in one piece.
    total = np.cumsum(count)
    cuts = np.searchsorted(total, np.arange(CANDIDATES, int(total[-1]) if len(total) else 0, CANDIDATES))
    for lo, hi in zip([0, *cuts], [*cuts, len(count)], strict=True):
        n = count[lo:hi]
        grid = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        place = grid * np.repeat(step[lo:hi], n) + np.repeat(offsets[text[lo:hi]], n)
        yield place, np.repeat(period[lo:hi], n)


def runs_in(texts: list[list[bytes]], least: int = LEAST, repeats: int = REPEATS) -> list[np.ndarray]:
    """The runs of each text: (start, length, period) by start, then period."""
    names: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    offsets = np.cumsum(sizes + 1) - sizes
    known = np.fromiter(
        (names.setdefault(w, len(names)) for t in texts for w in t), np.int64, int(sizes.sum())
    )
    # Between texts stand symbols that occur once, so nothing agrees across them.
    sequence = len(names) + np.arange(int(sizes.sum()) + len(texts) + 1)
    inside = np.ones(len(sequence), bool)
    inside[np.append(offsets - 1, len(sequence) - 1)] = False
    sequence[inside] = known
    hits = [
        (place[alike], period[alike])
        for place, period in _grids(sizes, offsets, least, repeats)
        for alike in [sequence[place] == sequence[place + period]]
    ]
    empty = np.zeros((0, 3), np.int64)
    if not sum(len(p) for p, _ in hits):
        return [empty] * len(texts)
    levels = grammar(sequence)
    back = mirrored(levels)
    n = len(sequence)
    kept = []
    for place, period in hits:
        right = extensions(levels, place, place + period)
        left = extensions(back, n - place, n - place - period)
        length = left + right + period
        long = length >= np.maximum(least, repeats * period)
        kept.append(np.stack([place - left, length, period])[:, long])
    start, length, period = np.concatenate(kept, axis=1)
    # A stretch has its multiples of the smallest period too: the smallest comes first.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    fresh = (np.diff(start, prepend=-1) != 0) | (np.diff(length, prepend=-1) != 0)
    start, length, period = start[fresh], length[fresh], period[fresh]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = np.searchsorted(offsets, start, side="right") - 1
    rows = np.stack([start - offsets[text], length, period], axis=1)
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    return [rows[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]


def collapsed(found: Found) -> list[bytes]:
    """The words that no run repeats: of each run its first period stays."""
    if not len(found.runs):
        return found.words
    change = np.zeros(len(found.words) + 1, np.int64)
    start, length, period = found.runs.T
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return [found.words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def _emit(
    schema: list[tuple[str, pa.DataType]],
    finish: Callable[[Found], tuple],
    least: int,
    repeats: int,
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None,
):
    """Rows as they come, ``row`` beside what ``finish`` makes of their texts."""
    names = ["row", *[n for n, _ in schema]]

    def out(rows: pa.Array, found: list[tuple]) -> pa.RecordBatch:
        values = list(zip(*found, strict=True))
        made = [pa.array(v, t) for v, (_, t) in zip(values, schema, strict=True)]
        return pa.RecordBatch.from_arrays([rows, *made], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("_text"), batch.column("_id")
            held, words, first = [], 0, 0
            for i in range(batch.num_rows):
                cut = (texts[i].as_py() or "").encode().split()
                held.append(prepare(ids[i].as_py(), cut) if prepare else cut)
                words += len(cut)
                if words >= BATCH_WORDS or i == batch.num_rows - 1:
                    found = zip(held, runs_in(held, least, repeats), strict=True)
                    done = [finish(Found(*f)) for f in found]
                    yield out(batch.column("row").slice(first, len(held)), done)
                    held, words, first = [], 0, i + 1

    return run


def _mapped(df, text, row, id_column, schema, ddl, finish, least, repeats, prepare=None) -> DataFrame:
    given = df.select(row.alias("row"), F.col(text).alias("_text"), id_column.alias("_id"))
    kind = given.schema["row"].dataType.simpleString()
    return given.mapInArrow(_emit(schema, finish, least, repeats, prepare), f"row {kind}, {ddl}")


def with_runs(
    df: DataFrame, text: str = "text", least: int = LEAST, repeats: int = REPEATS
) -> DataFrame:
    """Add ``runs``, an array of (start, length, period), and ``collapsed``, the text with
    one period of each run left and single spaces between words.

    Words are runs of anything but ASCII white space. A run is a stretch of at least
    ``least`` words and ``repeats`` periods that no neighbouring word extends with its
    smallest period. Null and empty texts have no runs and collapse to the empty text;
    very long ones are read whole, one grammar each; equal texts and repeated rows have
    equal results, and ties do not arise. Columns named ``runs`` or ``collapsed`` are
    replaced, whatever their case; all others are kept. Empty frames stay empty. Each
    text is a task's own work: nothing is shuffled.
    """
    if repeats < 2:
        raise ValueError("a run repeats its period at least twice")

    def finish(found: Found) -> tuple:
        runs = [dict(zip(("start", "length", "period"), r, strict=True)) for r in found.runs.tolist()]
        return runs, b" ".join(collapsed(found)).decode()

    kept = [c for c in df.columns if c.lower() not in ("runs", "collapsed")]
    schema = [("runs", pa.list_(_RUN)), ("collapsed", pa.string())]
    row = F.struct(*cols(kept)) if kept else F.struct(F.lit(0).alias("_none"))
    out = _mapped(
        df, text, row, F.lit(None).cast("long"), schema, f"runs array<{RUN}>, collapsed string", finish, least, repeats
    )
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], "runs", "collapsed")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten, from a place on, as repetitions of a period."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    whole, rest = divmod(n - a, p)
    return words[:a] + words[a : a + p] * whole + words[a : a + rest]


def _digest(found: Found) -> tuple:
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found.runs.tolist())
    best: tuple[int | None, ...] = (None, None, None, None)
    for s, n, q in found.runs.tolist():
        # Runs come by start and period, so of equals the first stays.
        if best[0] is None or n * best[2] > best[1] * q:
            best = (s, n, q, 1000 * n // q)
    shas = (hashlib.sha256(x).hexdigest() for x in (lines.encode(), b" ".join(collapsed(found))))
    return len(found.runs), *best, *shas


def op13(df: DataFrame) -> DataFrame:
    """Runs of every document after :func:`planted`: their number, the one of greatest
    exponent, and digests of all runs and of the collapsed words.

    Documents without an id are taken as they are; other cases as in :func:`with_runs`.
    """
    numbers = ["n_runs", "start", "length", "period", "exponent_milli"]
    texts = ["runs_sha256", "collapsed_sha256"]
    schema = [(c, pa.int64()) for c in numbers] + [(c, pa.string()) for c in texts]
    ddl = ", ".join([*[f"{c} long" for c in numbers], *[f"{c} string" for c in texts]])
    doc_id = F.col("doc_id").cast("long")
    out = _mapped(df, "text", F.col("doc_id"), doc_id, schema, ddl, _digest, LEAST, REPEATS, planted)
    return out.withColumnRenamed("row", "doc_id")


# Words equal at a distance make islands; an island and its distance make a run.
OP13_SQL = rf"""
WITH {BYTES_SQL}, d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
h AS (SELECT *, len(w) AS n, {crc32_sql('doc_id::VARCHAR')} AS h FROM d, crc_bytes),
c AS (SELECT r, doc_id, w, n, h, h // 10 AS g FROM h),
a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM c),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
    [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] FOR i IN range(n)] ELSE w END AS w FROM p),
x AS (SELECT r, n, unnest(range(n)) AS i, unnest(w) AS v FROM t),
e AS (SELECT x.r, x.n, x.i, y.i - x.i AS q FROM x JOIN x AS y
    ON x.r = y.r AND x.v = y.v AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
g AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM e),
s AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM g GROUP BY r, q, island),
f AS (SELECT r, start, length, min(q) AS period FROM s WHERE length >= greatest(24, 3 * q)
    GROUP BY r, start, length),
b AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / period DESC, start, period) AS best
    FROM f),
m AS (SELECT r, count(*) AS n_runs, max(CASE WHEN best = 1 THEN start END) AS start,
    max(CASE WHEN best = 1 THEN length END) AS length, max(CASE WHEN best = 1 THEN period END) AS period,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM b GROUP BY r),
o AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM f),
k AS (SELECT x.r, string_agg(v, ' ' ORDER BY x.i) AS kept FROM x ANTI JOIN o USING (r, i) GROUP BY x.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
    1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
    sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN m USING (r) LEFT JOIN k USING (r)
"""
