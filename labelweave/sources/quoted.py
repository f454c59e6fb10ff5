"""Delimited files whose quoted fields hold line breaks, each read by many tasks.

Whether a line begins inside quotes depends on all lines before it. Each line is a map
of two states, so a block of lines is one too: blocks are read once for their maps, the
maps are composed in file order, and with the state at its start known every block cuts
its records on its own. A record that crosses blocks is put together from their edges.
Records are then parsed by Spark, so rows are those of a multi-line scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..columns import col
from ..functions.labels import parse_number

# What a line does to the states (out of quotes, inside): both leave quotes, both change,
# both stay, both end inside; and both stay on a line without a character, or with a
# carriage return alone.
LEAVES, CHANGES, STAYS, ENTERS, EMPTY, RETURN = range(6)


def _patterns(sep: str, quote: str, escape: str) -> tuple[str, str]:
    """Java patterns of a field at the end of the last one, and of the rest of a quoted
    field that began on an earlier line. All repeats are possessive: no backtracking."""
    q, s, e = (re.escape(x) for x in (quote, sep, escape))
    if escape == quote:
        inside = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
    else:
        inside = f"(?:[^{q}{e}]++|{e}.)*+"
    other = f"[^{s}]" if len(sep) == 1 else f"(?:(?!{s}).)"
    # A quote that closes before other text is text itself, up to the next separator.
    closed = f"{inside}{q}{other}*+"
    field = f"(?s)\\G(?:{q}{closed}|(?!{q}){other}++)?+(?:{s}|\\z)"
    return field, f"(?s)\\A{closed}(?:{s}|\\z)"


def _effect(line: Column, sep: str, quote: str, escape: str) -> Column:
    field, rest = _patterns(sep, quote, escape)
    opened = F.regexp_replace(line, field, "") != ""
    after = F.regexp_replace(F.regexp_replace(line, rest, ""), field, "") != ""
    still = ~line.rlike(rest) | after
    effect = F.when(opened & still, ENTERS).when(opened, CHANGES).when(still, STAYS).otherwise(LEAVES)
    plain = F.when(line == "", EMPTY).when(line == "\r", RETURN).otherwise(STAYS)
    return F.when(F.contains(line, F.lit(quote)), effect).otherwise(plain).cast("byte")


def _after(effects: np.ndarray, state: int) -> np.ndarray:
    """The state behind each line, from the one before the first."""
    fixed = (effects == LEAVES) | (effects == ENTERS)
    turns = np.cumsum(effects == CHANGES) & 1
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(effects)), -1))
    set_to = (effects[last] == ENTERS) ^ turns[last]
    return np.where(last >= 0, set_to, state) ^ turns


def _runs(batch: pa.RecordBatch):
    """(block, from, to) of each stretch of lines of one block."""
    file, start = (batch.column(c).to_numpy() for c in ("file", "start"))
    fresh = (np.diff(file, prepend=0) != 0) | (np.diff(start, prepend=-1) != 0)
    if len(fresh):
        fresh[0] = True
    edges = np.append(np.flatnonzero(fresh), len(file))
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield (int(file[lo]), int(start[lo])), int(lo), int(hi)


BLOCK = (
    "file long, start long, returns boolean, ends_out int, ends_in int, first long, head long, "
    "tail_out long, tail_in long"
)
_BLOCK = [
    ("file", pa.int64()), ("start", pa.int64()), ("returns", pa.bool_()), ("ends_out", pa.int32()),
    ("ends_in", pa.int32()), ("first", pa.int64()), ("head", pa.int64()), ("tail_out", pa.int64()),
    ("tail_in", pa.int64()),
]


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block: whether its first line ends in a carriage return; its map; its first
    line with a character; the line that ends the record it begins in; the line at which
    the record begins that it ends in."""
    block, held = None, {}

    def told() -> pa.RecordBatch:
        row = {"file": block[0], "start": block[1], **held}
        return pa.RecordBatch.from_pylist([row], pa.schema(_BLOCK))

    for batch in batches:
        lines, effects = (batch.column(c).to_numpy() for c in ("line", "effect"))
        returns = batch.column("returns")
        for key, lo, hi in _runs(batch):
            if key != block:
                if block is not None:
                    yield told()
                block = key
                held = {"returns": returns[lo].as_py(), "ends_out": 0, "ends_in": 1}
                held |= dict.fromkeys(("first", "head", "tail_out", "tail_in"))
            line, effect = lines[lo:hi], effects[lo:hi]
            full = (effect != EMPTY) & ((effect != RETURN) | (not held["returns"]))
            if held["first"] is None and full.any():
                held["first"] = int(line[np.argmax(full)])
            for name, tail in (("ends_out", "tail_out"), ("ends_in", "tail_in")):
                after = _after(effect, held[name])
                before = np.append(held[name], after[:-1])
                closes = np.flatnonzero((before == 1) & (after == 0))
                if name == "ends_in" and held["head"] is None and len(closes):
                    held["head"] = int(line[closes[0]])
                opens = np.flatnonzero((before == 0) & (after == 1))
                if len(opens):
                    held[tail] = int(line[opens[-1]])
                held[name] = int(after[-1])
    if block is not None:
        yield told()


RECORD = "record string, first boolean"


def _cut(line_sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records that lie in one block, and whether they are the first of their file."""
        block, state, top, head, pending = None, 0, False, False, []
        for batch in batches:
            effects, inside = (batch.column(c).to_numpy() for c in ("effect", "inside"))
            returns = batch.column("returns").to_numpy(zero_copy_only=False)
            # Where lines end in a carriage return too, it is part of no text.
            empty = (effects == EMPTY) | ((effects == RETURN) & returns)
            values = batch.column("value").to_pylist()
            records, firsts = [], []
            for key, lo, hi in _runs(batch):
                if key != block:
                    # What is pending is the edge of a record that another block ends.
                    block, state, pending = key, int(inside[lo]), []
                    top, head = key[1] == 0, state == 1
                after = _after(effects[lo:hi], state)
                begin = lo
                for end in (np.flatnonzero(after == 0) + lo).tolist():
                    if head:
                        head = False
                    elif begin < end or pending or not empty[end]:
                        pending.extend(values[begin : end + 1])
                        records.append(pending[0] if len(pending) == 1 else line_sep.join(pending))
                        firsts.append(top)
                        top, pending = False, []
                    begin = end + 1
                if not head:
                    pending.extend(values[begin:hi])
                state = int(after[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(records, pa.string()), pa.array(firsts, pa.bool_())], names=["record", "first"]
            )

    return run


def quoted_records(
    spark: SparkSession,
    paths: str | Iterable[str],
    sep: str = ",",
    quote: str = '"',
    escape: str = '"',
    line_sep: str | None = None,
) -> DataFrame:
    """``record``, the text of each record as it stands in its file, and ``first``,
    whether it is the first of its file. Empty lines between records are left out. Where a
    file breaks its own dialect (quotes inside values that are not quoted) and has another
    escape than the quote, or carriage returns, a multi-line scan may cut otherwise.

    Lines end at ``line_sep``, or at a line feed; in files whose first line ends in a
    carriage return and a line feed, at both, and there both are a line feed in texts. Every
    file that Spark can split is read by many tasks; no rows are shuffled but the edges of
    blocks. Of the blocks whose edges lie in quotes a few numbers are broadcast: some
    hundred bytes for each block of ``spark.sql.files.maxPartitionBytes``.
    """
    cut_at = line_sep or "\n"
    lines = spark.read.option("lineSep", cut_at).text(paths if isinstance(paths, str) else list(paths))
    lines = lines.select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        _effect(F.col("value"), sep, quote, escape).alias("effect"),
        (F.lit(line_sep is None) & F.col("value").endswith("\r")).alias("returns"),
    )
    maps = lines.select("file", "start", "line", "effect", "returns").mapInArrow(_maps, BLOCK)
    # States at the start of blocks: where a map last left no choice, and changes since.
    order = Window.partitionBy("file").orderBy("start")
    changes = F.sum(F.when((F.col("ends_out") == 1) & (F.col("ends_in") == 0), 1).otherwise(0)).over(order)
    fixed = F.when(F.col("ends_out") == F.col("ends_in"), F.struct("ends_out", "_changes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(fixed, ignorenulls=True).over(before)
    changed = F.coalesce(F.lag("_changes").over(order), F.lit(0))
    state = F.when(F.col("_last").isNull(), F.col("_changed") % 2).otherwise(
        F.pmod(F.col("_last.ends_out") + F.col("_changed") - F.col("_last._changes"), F.lit(2))
    )
    inside = F.col("inside") == 1
    tail = F.when(inside, F.col("tail_in")).otherwise(F.col("tail_out"))
    open_end = F.when(inside, F.col("ends_in")).otherwise(F.col("ends_out")) == 1
    blocks = (
        maps.withColumn("_changes", changes)
        .withColumns({"_last": last, "_changed": changed})
        .withColumn("inside", state)
        .withColumn("tail", F.when(open_end, tail))
        .withColumn("begun", F.when(inside, F.last("tail", ignorenulls=True).over(before)))
        .withColumn("returns", F.first("returns").over(order))
        .select(
            F.col("file").alias("_file"), F.col("start").alias("_start"),
            "inside", "head", "tail", "begun", "first", "returns",
        )
    )
    odd = (F.col("inside") == 1) | F.col("tail").isNotNull() | F.col("returns")
    edges = F.broadcast(blocks.filter(odd))
    same = (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start"))
    lines = lines.drop("returns")
    known = lines.join(edges.select("_file", "_start", "inside", "returns"), same, "left").withColumns(
        {"inside": F.coalesce("inside", F.lit(0)), "returns": F.coalesce("returns", F.lit(False))}
    )
    text = F.when(F.col("returns"), F.regexp_replace("value", "\r\\z", "")).otherwise(F.col("value"))
    stripped = known.select("file", "start", "effect", "inside", "returns", text.alias("value"))
    whole = stripped.mapInArrow(_cut(cut_at), RECORD)
    at_head = (F.col("inside") == 1) & (F.col("head").isNull() | (F.col("line") <= F.col("head")))
    record = F.when(at_head, F.col("begun")).when(F.col("line") >= F.col("tail"), F.col("line_of"))
    pieces = (
        lines.join(edges.withColumn("line_of", F.col("tail")), same)
        .withColumn("record", record)
        .filter(F.col("record").isNotNull())
        .withColumn("first", (F.col("start") == 0) & (F.col("record") == F.col("first")))
        .groupBy("file", F.col("record").alias("_record"))
        .agg(
            F.sort_array(F.collect_list(F.struct("start", "line", text.alias("value")))).alias("_lines"),
            F.bool_or("first").alias("first"),
        )
    )
    joined = F.array_join(F.transform("_lines", lambda x: x["value"]), cut_at)
    return whole.unionByName(pieces.select(joined.alias("record"), "first"))


def parsed_records(records: DataFrame, schema: T.StructType, options: dict[str, str], bad_rows: str) -> DataFrame:
    """Rows of records; ``bad_rows`` as in ``read_delimited``. With a header in
    ``options``, the first record of each file must name the columns in order."""
    kept = ("sep", "quote", "escape", "nullValue")
    settings = {**{k: v for k, v in options.items() if k in kept}, "multiLine": "true"}
    names = [f.name for f in schema.fields]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    bad = "_bad_record"
    while bad in names:
        bad = "_" + bad

    def read(kind: T.StructType, mode: str) -> Column:
        more = {**settings, "mode": mode, "columnNameOfCorruptRecord": bad}
        ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kind.fields)
        return F.from_csv(F.col("record"), ddl, more)

    if options.get("header") == "true":
        found = read(text, "PERMISSIVE")
        same = [F.lower(found.getField(n)).eqNullSafe(F.lit(n.lower())) for n in names]
        wrong = F.raise_error(F.concat(F.lit(f"header is not {names}: "), F.col("record"))).cast("boolean")
        agrees = same[0]
        for one in same[1:]:
            agrees = agrees & one
        records = records.filter(F.when(~F.col("first"), True).when(agrees, False).otherwise(wrong))
    if bad_rows != "drop":
        row = read(schema, "FAILFAST" if bad_rows == "raise" else "PERMISSIVE")
        return records.select(row.alias("_row")).select(*[F.col("_row").getField(n).alias(n) for n in names])
    marked = T.StructType([*text.fields, T.StructField(bad, T.StringType())])
    rows = records.select(read(marked, "PERMISSIVE").alias("_row")).filter(F.col("_row").getField(bad).isNull())
    rows = rows.select(*[F.col("_row").getField(n).alias(n) for n in names])
    typed = [f for f in schema.fields if f.dataType != T.StringType()]
    for f in typed:
        parsed = parse_number(col(f.name), f.dataType.simpleString())
        rows = rows.filter(col(f.name).isNull() | parsed.isNotNull())
    return rows.select(
        *[
            parse_number(col(f.name), f.dataType.simpleString()).alias(f.name) if f in typed else col(f.name)
            for f in schema.fields
        ]
    )
