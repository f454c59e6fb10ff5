"""Substring dedup with fixed-block anchors.

A repeat of ``size`` words, wherever it lies, contains one whole block of
``(size + 1) // 2`` words of each text's own division into blocks. So:

1. index: texts are cut into blocks that do not overlap;
2. probe: every rolling window of a block's length is counted against the index, and
   a block whose words also start elsewhere is an anchor;
3. extend: around each anchor all windows of ``size`` words that contain it are
   compared, and those that occur elsewhere are joined to maximal repeats.

Nothing is paired: windows meet by fingerprint and are counted. Probes carry 32 bits
beside the number of their partition, and step 3 removes false anchors with 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import meeting
from .frames import carried, same_row, scanned, with_row_id
from .words import Hasher, covered

SIZE = 35


def _probe(block: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        ids, windows, held = [], [], 0

        def flush():
            blocks = [w[::block] for w in windows]
            places = [np.arange(len(b)) for b in blocks]
            return meeting.pack_probes(ids, windows, blocks, places, parts)

        for rid, text, _ in meeting.texts(batches):
            rolling = hasher.windows(hasher.words(text), block)
            if not len(rolling):
                continue
            ids.append(rid)
            windows.append(rolling)
            held += len(rolling)
            if held >= meeting.CHUNK:
                yield flush()
                ids, windows, held = [], [], 0
        if held:
            yield flush()

    return run


def _extend(size: int, block: int, parts: int):
    """Windows of ``size`` words around anchors, sent by their least inner fingerprint,
    so that neighbours mostly travel together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        ids, hashes, homes, places, held = [], [], [], [], 0
        for rid, text, (anchors,) in meeting.texts(batches, "anchors"):
            spans = anchors.as_py()
            if not spans:
                continue
            words = hasher.words(text)
            whole = hasher.windows(words, size)
            hot = np.zeros(len(words) // block + 2, bool)
            hot[meeting.expand(spans)] = True
            at = np.arange(len(whole))
            place = at[hot[(at + block - 1) // block]]
            if not len(place):
                continue
            least, _ = meeting.lowest(hasher.windows(words, block), size - block + 1)
            ids.append(rid)
            hashes.append(whole[place])
            homes.append(meeting.part_of(least[place], parts))
            places.append(place)
            held += len(place)
            if held >= meeting.CHUNK:
                yield meeting.pack_windows(ids, hashes, homes, places)
                ids, hashes, homes, places, held = [], [], [], [], 0
        if held:
            yield meeting.pack_windows(ids, hashes, homes, places)

    return run


def repeats(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """``rows`` (rid_a, rid_b, text, ...) with ``repeats``: the runs (start, length) of
    places where a window of ``size`` words starts that also starts elsewhere. Null
    where there is none."""
    if size < 2:
        raise ValueError("a repeat has at least two words")
    block = (size + 1) // 2
    parts, tasks = meeting.plan_parts(rows)
    texts = rows.select("rid_a", "rid_b", "text")
    probes = meeting.by_part(texts.mapInArrow(_probe(block, parts), meeting.PACKED), tasks)
    anchors = meeting.gathered(probes.mapInArrow(meeting.hits, meeting.RUNS), "anchors")
    # All columns go along, so that both joins with the texts share one exchange.
    near = rows.join(anchors, same_row(), "left").drop("_a", "_b")
    near = near.sortWithinPartitions("rid_a", "rid_b")
    windows = meeting.by_part(near.mapInArrow(_extend(size, block, parts), meeting.PACKED), tasks)
    found = meeting.gathered(windows.mapInArrow(meeting.confirm, meeting.RUNS), "repeats")
    return rows.join(found, same_row(), "left").drop("_a", "_b")


def _kept(size: int, digest: bool, name: str, extra: str):
    """Per row: words, words removed, and the kept text or its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, out = [], [], []
            texts, runs = batch.column("text"), batch.column("repeats")
            for i in range(batch.num_rows):
                words = (texts[i].as_py() or "").encode().split()
                spans = runs[i].as_py() or []
                if spans:
                    drop = covered(len(words), meeting.expand(spans), size)
                    kept = b" ".join(w for w, d in zip(words, drop.tolist(), strict=True) if not d)
                    gone.append(int(drop.sum()))
                else:
                    kept = b" ".join(words)
                    gone.append(0)
                total.append(len(words))
                out.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(extra), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(out, pa.string())],
                names=[extra, "n_words", "n_removed", name],
            )

    return run


def dedup(df: DataFrame, text: str = "text", size: int = SIZE) -> DataFrame:
    """``df`` with ``kept_text``, ``n_words`` and ``n_removed``, in front of its columns.

    Every word is removed that lies in a run of ``size`` words which also starts
    anywhere else, judged on the input. A null or empty text has no words and gives an
    empty text. Rows that repeat repeat each other's words, so both lose them. An empty
    frame stays empty. Columns of ``df`` keep their names and may be called anything but
    the three.
    """
    scan = scanned(df)
    rows = carried(scan).withColumn("text", F.col("row").getField(text))
    found = repeats(rows, size)
    schema = T.StructType(
        [
            found.schema["row"],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept_text", T.StringType()),
        ]
    )
    out = found.mapInArrow(_kept(size, False, "kept_text", "row"), schema)
    return out.select("n_words", "n_removed", "kept_text", "row.*")


def op2(df: DataFrame) -> DataFrame:
    """Per document: words, words removed and the digest of the words kept."""
    rows = with_row_id(scanned(df), doc_id="doc_id", text="text")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return repeats(rows).mapInArrow(_kept(SIZE, True, "kept_sha256", "doc_id"), schema)


def covered_sql(size: int) -> str:
    """Common table expressions: ``d`` (r, doc_id, w) and the words ``c`` (r, j, from 1)
    that a repeated window covers."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT r, w, unnest(range(1, len(w) - {size - 2})) AS i FROM d WHERE len(w) >= {size}),
h AS (SELECT r, i, md5(array_to_string(w[i:i + {size - 1}], ' ')) AS h FROM p),
m AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM h) WHERE n > 1),
c AS MATERIALIZED (SELECT DISTINCT r, unnest(range(i, i + {size})) AS j FROM m)"""


OP2_SQL = (
    covered_sql(SIZE)
    + """,
x AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
k AS (SELECT r, string_agg(word, ' ' ORDER BY j) AS kept FROM x ANTI JOIN c USING (r, j) GROUP BY r),
n AS (SELECT r, count(*) AS gone FROM c GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r) LEFT JOIN n USING (r)"""
)
