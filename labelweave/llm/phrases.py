"""Lempel-Ziv phrase fingerprints: likeness of texts as a compressor would see it.

A text is parsed into dictionary phrases: each is the longest phrase met so far and one
byte more. The set of phrases is hashed and its minimum-hash signature kept; the share of
equal minima of two signatures estimates the overlap of the phrase sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..columns import cols
from .frames import frozen, scanned, with_row_id
from .words import U, mix

LANES = 128
# Phrases whose hashes are taken to all lanes together; bytes of text a piece of the
# document order should hold. Results do not depend on either.
TOGETHER = 1 << 12
PIECE_BYTES = 64 << 20


def parse(data: bytes, at: int, stop: int, known: set[bytes]) -> tuple[list[bytes], int]:
    """Phrases from ``at`` on that end by ``stop``, and where the next one begins.

    ``known`` holds all phrases so far and takes the new ones. With a phrase it holds all
    its beginnings, so the longest one is found from the length of the phrase before.
    """
    out, size = [], 1
    while at < stop:
        if data[at : at + size] in known:
            size += 1
            while at + size <= stop and data[at : at + size] in known:
                size += 1
        else:
            while size > 1 and data[at : at + size - 1] not in known:
                size -= 1
        if at + size > stop:
            break
        phrase = data[at : at + size]
        known.add(phrase)
        out.append(phrase)
        at += size
    return out, at


class Lanes:
    """Minimum hashes of phrase sets."""

    def __init__(self, lanes: int) -> None:
        seeds = np.arange(1, 2 * lanes + 1, dtype=U) * U(0x9E3779B97F4A7C15)
        self.factor, self.shift = mix(seeds[:lanes]) | U(1), mix(seeds[lanes:])

    def least(self, phrases: list[bytes]) -> np.ndarray:
        out = np.full(len(self.factor), ~U(0), U)
        for lo in range(0, len(phrases), TOGETHER):
            part = phrases[lo : lo + TOGETHER]
            h = np.fromiter(map(xxhash.xxh64_intdigest, part), U, len(part))
            np.minimum(out, ((h[:, None] ^ self.shift) * self.factor).min(axis=0), out=out)
        return out


def _short(least: np.ndarray) -> bytes:
    """16 bits of each minimum."""
    return (mix(least) >> U(48)).astype(">u2").tobytes()


class Parsed(NamedTuple):
    """What is known of a text before its successor is read."""

    head: bytes  # what an edit leaves
    given_up: int  # the code points that an edit replaces
    phrases: list[bytes]  # those that lie in ``head``
    at: int  # where the phrase after them begins
    least: np.ndarray  # minimum hashes of ``phrases``
    fingerprint: bytes


class Fingerprints:
    """Fingerprints of texts, and of their edits: those with a last part replaced."""

    def __init__(self, lanes: int = LANES) -> None:
        self.lanes = Lanes(lanes)

    def _rest(self, data: bytes, phrases: list[bytes], at: int, least: np.ndarray) -> bytes:
        """The fingerprint of ``data``, of which ``phrases`` are parsed up to ``at``."""
        if not data:
            return b""
        more, end = parse(data, at, len(data), set(phrases))
        # What is left at the end is a phrase met before.
        return _short(np.minimum(least, self.lanes.least(more + [data[end:]] * (end < len(data)))))

    def read(self, text: str, given_up: int = 0) -> Parsed:
        """``given_up``: the last code points, which an edit will replace."""
        head = text[: len(text) - given_up].encode()
        data = head + text[len(text) - given_up :].encode()
        phrases, at = parse(data, 0, len(head), set())
        least = self.lanes.least(phrases)
        return Parsed(head, given_up, phrases, at, least, self._rest(data, phrases, at, least))

    def edited(self, parsed: Parsed, successor: str) -> tuple[bytes, bytes]:
        """The text with its last part replaced by the first of ``successor``, and its
        fingerprint. What both texts share is not parsed again."""
        data = parsed.head + successor[: parsed.given_up].encode()
        return data, self._rest(data, parsed.phrases, parsed.at, parsed.least)


def alike(a: bytes, b: bytes) -> float:
    """Share of equal minima; texts without phrases are like each other alone."""
    if not a or not b:
        return float(a == b)
    return float(np.mean(np.frombuffer(a, ">u2") == np.frombuffer(b, ">u2")))


def likeness(a: Column, b: Column) -> Column:
    """:func:`alike` of two columns of :func:`with_fingerprints`."""
    lanes = F.sequence(F.lit(0), (F.length(a) / 4).cast("int") - 1)
    same = F.filter(lanes, lambda i: F.substr(a, 4 * i + 1, F.lit(4)) == F.substr(b, 4 * i + 1, F.lit(4)))
    both = F.when((a == "") | (b == ""), (a == b).cast("double"))
    return both.otherwise(F.size(same) / (F.length(a) / 4))


def with_fingerprints(df: DataFrame, text: str = "text", lanes: int = LANES) -> DataFrame:
    """Add ``fingerprint``: ``lanes`` minimum hashes of the text's phrases, as hex digits.

    Equal texts have equal fingerprints. Null and empty texts have the empty one; very
    long texts are parsed whole. Rows that repeat are kept. A column of that name, in any
    case, is replaced; others are kept. Empty frames stay empty. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprints(lanes)
        for batch in batches:
            found = [maker.read(t.as_py() or "").fingerprint.hex() for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(found, pa.string())], names=["row", "fingerprint"]
            )

    kept = [c for c in df.columns if c.lower() != "fingerprint"]
    row = F.struct(*cols(kept)) if kept else F.struct(F.lit(0).alias("_none"))
    given = df.select(row.alias("row"), F.col(text).alias("_text"))
    kind = given.schema["row"].dataType.simpleString()
    out = given.mapInArrow(run, f"row {kind}, fingerprint string")
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], "fingerprint")


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)
_RESULT = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
# Of a piece: rows that are done, its first text, and its last row, which waits for the
# first text of the piece after it.
DONE, FIRST, LAST = 0, 1, 2


def _result(maker: Fingerprints, doc_id, text: str, parsed: Parsed, following: str, after: bytes) -> tuple:
    edited, mark = maker.edited(parsed, following)
    own = parsed.fingerprint
    sha = hashlib.sha256(edited).hexdigest()
    return doc_id, len(text), sha, own, mark, alike(own, mark), alike(own, after)


def _table(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [dict(zip((n for n, _ in fields), r, strict=True)) for r in rows], pa.schema(fields)
    )


def _read(maker: Fingerprints, text: str) -> Parsed:
    return maker.read(text, len(text) // 3)


def _pieces(lanes: int):
    fields = [("kind", pa.int32()), ("piece", pa.int32()), ("text", pa.string()), *_RESULT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, piece = Fingerprints(lanes), TaskContext.get().partitionId()
        waiting = None
        for batch in batches:
            done = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                doc_id, text = doc_id.as_py(), text.as_py() or ""
                parsed = _read(maker, text)
                if waiting is None:
                    done.append((FIRST, piece, text, *[None] * len(_RESULT)))
                else:
                    row = _result(maker, *waiting, text, parsed.fingerprint)
                    done.append((DONE, piece, None, *row))
                waiting = doc_id, text, parsed
            if done:
                yield _table(done, fields)
        if waiting is not None:
            row = (waiting[0], *[None] * (len(_RESULT) - 1))
            yield _table([(LAST, piece, waiting[1], *row)], fields)

    return run


def _last_rows(lanes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprints(lanes)
        for batch in batches:
            rows = []
            for doc_id, text, following in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                after = _read(maker, following).fingerprint
                rows.append(_result(maker, doc_id, text, _read(maker, text), following, after))
            if rows:
                yield _table(rows, _RESULT)

    return run


def op12(df: DataFrame, lanes: int = LANES) -> DataFrame:
    """Fingerprints of every document, of its edit, and how like they are.

    The last third of a document's code points gives way to the first of the document
    that follows by descending ``doc_id`` (null ids last, equal ids by a hash of the
    text; the first follows the last, and a single document itself). Texts move once, to
    the piece of that order they belong to, and are parsed as they stream by; only the
    last row of each piece waits for the first text of the next, which are a text or two
    per piece. Null and empty texts have the empty fingerprint; repeated rows follow each
    other; an empty frame gives an empty one.
    """
    scan = scanned(df)
    spark = scan.sparkSession
    size = scan.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PIECE_BYTES)
    rows = with_row_id(scan, doc_id=F.col("doc_id").cast("long"), text="text")
    keys = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "rid_a", "rid_b"]
    ordered = rows.repartitionByRange(pieces, *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    cut = frozen(ordered.mapInArrow(_pieces(lanes), f"kind int, piece int, text string, {RESULT}"), "phrases")
    done = cut.filter(F.col("kind") == DONE).select("doc_id", *[n for n, _ in _RESULT[1:]])
    # One row a piece, so this window holds no more rows than there are pieces.
    everything = Window.orderBy("piece")
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = cut.filter(F.col("kind") == FIRST)
    before = F.coalesce(F.lag("piece").over(everything), F.max("piece").over(whole))
    order = firsts.select("piece").select(F.col("piece").alias("_at"), before.alias("_before"))
    firsts = firsts.select(F.col("piece").alias("_at"), F.col("text").alias("following")).join(order, "_at")
    lasts = cut.filter(F.col("kind") == LAST).select("piece", "doc_id", "text")
    waiting = lasts.join(firsts, F.col("piece") == F.col("_before")).select("doc_id", "text", "following")
    rest = waiting.mapInArrow(_last_rows(lanes), RESULT)
    hexed = [F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")]
    return done.unionByName(rest).select("doc_id", "n_chars", "edited_sha256", *hexed, "near_edited", "near_next")
