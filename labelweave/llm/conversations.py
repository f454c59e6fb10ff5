"""Conversation repair: faults of turns, and the cheapest edits that mend them.

Turns are moved once, to a range of the order by conversation and turn, and conversations
are mended as they stream by. Those that lie across ranges, or are very long, are cut
into blocks of about a square root of the longest one's turns. Blocks give the costs from
each state to each, vectors at the cuts are the checkpoints, and every block then walks
on its own, so a conversation that holds most turns is the work of many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import turns as T
from .frames import frozen, scanned, with_row_id
from .sums import BYTES_SQL, crc32_sql

# Turns of a conversation, or bytes of their texts, above which it is mended in blocks;
# the least size of a block, as a power of two; bytes of text per range. Results do not
# depend on any of them.
LONG_TURNS, LONG_BYTES = 1 << 14, 16 << 20
BLOCK_BITS = 12
RANGE_BYTES = 64 << 20
SPACES = " \t\n\x0b\x0c\r"
# How a text ends.
BLANK, OPEN, CLOSED = 0, 1, 2

REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPORT = [*[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())]
MENDED = "place long, step int, edit string, turn long, role string, text string"
_MENDED = [
    ("place", pa.int64()), ("step", pa.int32()), ("edit", pa.string()), ("turn", pa.int64()),
    ("role", pa.string()), ("text", pa.string()),
]
_LEFT = [("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("ending", pa.int32())]
LEFT = "place long, turn long, role string, text string, ending int"


def _turns(df: DataFrame) -> DataFrame:
    """The columns of turns and the rows they are; null roles and texts are one space."""
    text = {c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")}
    numbers = {c: F.col(c).cast("long") for c in ("conv_id", "turn")}
    return with_row_id(scanned(df), **numbers, **text)


def _ordered(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ending, in order within ranges, ranges in order.

    Turns of equal number are ordered by the beginnings of role and text, then by a hash
    of both; equal ones spread over ranges by the rows they are.
    """
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(tasks, size // RANGE_BYTES)
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    ending = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), CLOSED).otherwise(OPEN)
    heads = [F.left(c, F.lit(64)) for c in ("role", "text")]
    both = F.md5(F.concat("role", F.lit(":"), "text"))
    keys = ["conv_id", "turn", *heads, both, "rid_a", "rid_b"]
    placed = rows.withColumn("ending", ending).repartitionByRange(ranges, *keys)
    return placed.sortWithinPartitions(*keys).select("conv_id", "turn", "role", "text", "ending")


def _codes(rows: list[tuple]) -> tuple[list[int], dict[str, int]]:
    """Codes of all turns of a conversation, and counts of its faults."""
    seen: set[tuple[str, str]] = set()
    codes, blank, duplicate, truncated, illegal = [], 0, 0, 0, 0
    previous = None
    for _, role, text, ending in rows:
        initial = T.initial_of(role)
        illegal += previous is not None and (previous, initial) not in T.LEGAL
        previous = initial
        again = (role, text) in seen
        seen.add((role, text))
        if ending == BLANK or again:
            blank += ending == BLANK
            duplicate += ending != BLANK
            codes.append(T.GOES)
        else:
            truncated += ending == OPEN
            codes.append(initial + 4 * (ending == OPEN))
    counts = {"blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal}
    return codes, counts


def _mended(rows: list[tuple], letters: list[str], state: int) -> Iterator[list[tuple]]:
    """What stands for each turn, and then what follows the last."""
    editor = T.Editor()
    for (turn, role, text, _), letter in zip(rows, letters, strict=True):
        yield list(editor.edited(letter, turn, role, text))
    yield list(editor.inserted(T.last_letters(state)))


def _gaps(numbers: list[int | None]) -> int:
    known = {n for n in numbers if n is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def _whole(rows: list[tuple], report: bool, place: int) -> list[tuple]:
    """All of a conversation's result."""
    codes, counts = _codes(rows)
    letters, state = T.walk(codes, T.END)
    parts = _mended(rows, letters, state)
    if not report:
        return [(place + i, k, *x) for i, part in enumerate(parts) for k, x in enumerate(part)]
    lines = [f"{role}:{text}" for part in parts for _, _, role, text in part]
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    cost = T.cost_before(codes, T.END)[T.START]
    audit = "".join(letters) + T.last_letters(state)
    return [(_gaps([r[0] for r in rows]), *counts.values(), cost, audit, sha)]


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def _streamed(report: bool):
    """Results of conversations that lie in the range and are short, turns of others."""
    own = _REPORT if report else _MENDED
    left = [(f"left_{n}", t) for n, t in _LEFT]
    fields = [("conv_id", pa.int64()), ("done", pa.bool_()), *own, *left]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        out: list[tuple] = []
        current, size, first, spilling = None, 0, True, False

        def spill() -> None:
            nonlocal place, size
            for turn, role, text, ending in held:
                out.append((current, False, *[None] * len(own), place, turn, role, text, ending))
                place += 1
            held.clear()
            size = 0

        def finish(last: bool) -> None:
            nonlocal place
            if first or last or spilling:
                spill()
            else:
                for row in _whole(held, report, place):
                    out.append((current, True, *row, *[None] * len(left)))
                place += len(held) + 1
                held.clear()

        started = False
        for batch in batches:
            for conv, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if started and conv != current:
                    finish(False)
                    first, spilling, size = False, False, 0
                current, started = conv, True
                held.append(tuple(row))
                size += len(row[2])
                if len(held) > LONG_TURNS or size > LONG_BYTES:
                    spilling = True
                    spill()
            if out:
                yield _batch(out, fields)
                out.clear()
        if started:
            finish(True)
            yield _batch(out, fields)

    return run


def _segment(frame: pd.DataFrame) -> pd.DataFrame:
    """Costs across a block of a conversation, and its counts."""
    frame = frame.sort_values("place")
    initials = frame["initial"].tolist()
    pairs = zip(initials[:-1], initials[1:], strict=True)
    return pd.DataFrame(
        {
            "key": frame["key"].iloc[:1].tolist(),
            "block": frame["block"].iloc[:1].tolist(),
            "costs": [[c for row in T.transfer(frame["code"].tolist()) for c in row]],
            "blank": [int((frame["fault"] == 1).sum())],
            "duplicate": [int((frame["fault"] == 2).sum())],
            "truncated": [int((frame["fault"] == 3).sum())],
            "illegal": [sum(p not in T.LEGAL for p in pairs)],
            "head": initials[:1],
            "tail": initials[-1:],
        }
    )


def _checkpoints(frame: pd.DataFrame) -> pd.DataFrame:
    """The vector behind each block of a conversation, and the sums of its counts."""
    frame = frame.sort_values("block")
    v, ends = list(T.END), []
    for costs in reversed(frame["costs"].tolist()):
        ends.append(list(T.relative(v)))
        v = T.through([list(costs[4 * s : 4 * s + 4]) for s in range(4)], v)
    joints = zip(frame["tail"].tolist()[:-1], frame["head"].tolist()[1:], strict=True)
    out = frame[["key", "block"]].copy()
    out["behind"] = ends[::-1]
    out["cost"] = v[T.START]
    for c in ("blank", "duplicate", "truncated"):
        out[c] = int(frame[c].sum())
    out["illegal"] = int(frame["illegal"].sum()) + sum(j not in T.LEGAL for j in joints)
    return out


def _walks(turns: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
    """The letters of a block's turns, and the state behind it, from every state."""
    codes = turns.sort_values("place")["code"].tolist()
    end = tuple(int(c) for c in ends["behind"].iloc[0])
    walks = [T.walk(codes, end, state) for state in range(4)]
    return pd.DataFrame(
        {
            "key": ends["key"].tolist(),
            "block": ends["block"].tolist(),
            "letters": [["".join(letters) for letters, _ in walks]],
            "states": [[state for _, state in walks]],
        }
    )


def _entries(frame: pd.DataFrame) -> pd.DataFrame:
    """The state in which each block of a conversation begins, and what ends it."""
    frame = frame.sort_values("block")
    state, entry = T.START, []
    for states in frame["states"].tolist():
        entry.append(state)
        state = int(states[state])
    out = frame[["key", "block"]].copy()
    out["entry"] = entry
    out["more"] = [""] * (len(entry) - 1) + [T.last_letters(state)]
    return out


_LETTERS = ("letters", "entry")


def _blocks(batches: Iterator[pa.RecordBatch]):
    """(key, block, editor, letters per turn and those behind, row) of rows whose blocks
    begin with a row that holds their letters."""
    editor, letters, at, ahead = T.Editor(), "", 0, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["letters"] is not None:
                if ahead is not None:
                    yield ahead, editor, letters[at:], None
                editor, letters, at, ahead = T.Editor(row["entry"]), row["letters"], 0, row
                continue
            end = at
            while letters[end] == "I":
                end += 1
            yield ahead, editor, letters[at : end + 1], row
            at = end + 1
    if ahead is not None:
        yield ahead, editor, letters[at:], None


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each conversation, as its turns stream by."""
    fields = [("key", pa.string()), ("repaired_sha256", pa.string())]
    key, sha, empty = None, hashlib.sha256(), True
    for ahead, editor, letters, row in _blocks(batches):
        if key is not None and ahead["key"] != key:
            yield _batch([(key, sha.hexdigest())], fields)
            sha, empty = hashlib.sha256(), True
        key = ahead["key"]
        if row is None:
            part = editor.inserted(letters)
        else:
            part = editor.edited(letters, row["turn"], row["role"], row["text"])
        for _, _, role, text in part:
            sha.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
            empty = False
    if key is not None:
        yield _batch([(key, sha.hexdigest())], fields)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mended turns of blocks."""
    fields = [("conv_id", pa.int64()), *_MENDED]
    out, place = [], 0
    for ahead, editor, letters, row in _blocks(batches):
        if row is None:
            part = editor.inserted(letters)
            place += 1
        else:
            part = editor.edited(letters, row["turn"], row["role"], row["text"])
            place = row["place"]
        conv = int(ahead["key"]) if ahead["key"] else None
        out += [(conv, place, k, *x) for k, x in enumerate(part)]
        if len(out) >= 4096:
            yield _batch(out, fields)
            out = []
    yield _batch(out, fields)


def _in_blocks(left: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Turns with their block, blocks with their letters, conversations with their sums."""
    named = {f"left_{n}": n for n, _ in _LEFT}
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key")
    left = left.select(key, *[F.col(a).alias(b) for a, b in named.items()])
    initial = F.lit(3)
    for i, letter in enumerate(T.INITIALS):
        initial = F.when(F.col("role").startswith(letter), i).otherwise(initial)
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    light = left.select("key", "place", "turn", "ending", initial.alias("initial"), same.alias("same"))
    # A turn stands alone or first of its equals if its place is the least of theirs.
    firsts = light.groupBy("key", "same").agg(F.min("place").alias("place"))
    coded = light.drop("same").join(firsts.select("place", F.lit(True).alias("first")), "place", "left")
    fault = F.when(F.col("ending") == BLANK, 1).when(F.col("first").isNull(), 2)
    fault = fault.when(F.col("ending") == OPEN, 3).otherwise(0)
    code = F.when(F.col("fault").isin(1, 2), T.GOES)
    code = code.otherwise(F.col("initial") + F.when(F.col("fault") == 3, 4).otherwise(0))
    longest = light.groupBy("key").count().agg(F.max("count")).first()[0] or 0
    bits = max(BLOCK_BITS, (longest.bit_length() + 1) // 2)
    block = F.shiftright("place", bits).alias("block")
    coded = coded.withColumn("fault", fault).select(
        "key", block, "place", "turn", "initial", "fault", code.cast("int").alias("code")
    )
    coded = frozen(coded, "turns")
    counts = "blank long, duplicate long, truncated long, illegal long"
    segments = coded.groupBy("key", "block").applyInPandas(
        _segment, f"key string, block long, costs array<long>, {counts}, head int, tail int"
    )
    ends = frozen(
        segments.groupBy("key").applyInPandas(
            _checkpoints, f"key string, block long, behind array<long>, cost long, {counts}"
        ),
        "checkpoints",
    )
    walks = coded.groupBy("key", "block").cogroup(ends.groupBy("key", "block")).applyInPandas(
        _walks, "key string, block long, letters array<string>, states array<int>"
    )
    walks = frozen(walks, "walks")
    entries = walks.select("key", "block", "states").groupBy("key").applyInPandas(
        _entries, "key string, block long, entry int, more string"
    )
    letters = F.concat(F.element_at("letters", F.col("entry") + 1), "more")
    edits = walks.join(entries, ["key", "block"]).select("key", "block", "entry", letters.alias("letters"))
    numbers = coded.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    sums = ends.groupBy("key").agg(*[F.max(c).alias(c) for c in _COUNTS[1:]]).join(numbers, "key")
    return left.withColumn("block", block), edits, sums


def _with_letters(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """Rows of turns, and before those of each block one that holds its letters."""
    texts = turns.select("key", "block", "place", "turn", "role", "text").withColumns(
        {"letters": F.lit(None).cast("string"), "entry": F.lit(None).cast("int")}
    )
    return texts.unionByName(edits.withColumn("place", F.lit(-1).cast("long")), allowMissingColumns=True)


def _conv_id() -> Column:
    return F.when(F.col("key") != "", F.col("key").cast("long")).alias("conv_id")


def _left_ddl() -> str:
    return ", ".join(f"left_{part}" for part in LEFT.split(", "))


def _made(rows: DataFrame, report: bool) -> DataFrame:
    ddl = f"conv_id long, done boolean, {REPORT if report else MENDED}, {_left_ddl()}"
    return frozen(_ordered(rows).mapInArrow(_streamed(report), ddl), "mended")


def _reported(rows: DataFrame) -> DataFrame:
    made = _made(rows, True)
    names = [n for n, _ in _REPORT]
    turns, edits, sums = _in_blocks(made.filter("NOT done"))
    streams = _with_letters(turns, edits).repartition("key").sortWithinPartitions("key", "block", "place")
    hashes = streams.mapInArrow(_hashes, "key string, repaired_sha256 string")
    parts = F.sort_array(F.collect_list(F.struct("block", "letters")))
    audit = F.array_join(F.transform(parts, lambda p: p["letters"]), "")
    audits = edits.groupBy("key").agg(audit.alias("audit"))
    rest = sums.join(audits, "key").join(hashes, "key").select(_conv_id(), *names)
    return made.filter("done").select("conv_id", *names).unionByName(rest)


def report(df: DataFrame) -> DataFrame:
    """Faults of each conversation, the cost and letters of its edits, and the digest of
    the repaired one: a row per ``conv_id``.

    Null roles and texts are read as one space. Turns are taken by number, nulls first,
    ties by beginnings of role and text and a hash; null ids are one conversation; whole
    rows that repeat are duplicates. Very long texts and conversations are taken whole:
    edits of long ones are found in blocks by many tasks; only the digest of one, which
    can be computed in order alone, streams through a single task. Further columns are
    ignored, whatever their names. An empty frame gives an empty one.
    """
    return _reported(_turns(df))


def repair(df: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: ``conv_id``, ``place`` and ``step`` that
    order them, ``edit`` (K kept, R given another role, I inserted), ``turn`` (null if
    inserted), ``role`` and ``text``. All else as in :func:`report`."""
    made = _made(_turns(df), False)
    names = [n for n, _ in _MENDED]
    turns, edits, _ = _in_blocks(made.filter("NOT done"))
    streams = _with_letters(turns, edits).repartition("key", "block")
    rest = streams.sortWithinPartitions("key", "block", "place").mapInArrow(_rows, f"conv_id long, {MENDED}")
    return made.filter("done").select("conv_id", *names).unionByName(rest)


def damaged(rows: DataFrame) -> DataFrame:
    """Turns damaged by a sum of ``conv_id:turn``, nulls one space: left out, emptied,
    robbed of marks that end sentences, repeated, or given to the user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key) % 20
    once, twice = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
    times = F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, twice).otherwise(once)
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    return rows.withColumns({"role": role, "text": text, "_copy": F.explode(times)}).drop("_copy")


def op11(df: DataFrame) -> DataFrame:
    """Every conversation's faults and repair after :func:`damaged`; those that lose all
    of their turns have nothing to repair."""
    rows = _turns(df)
    found = _reported(damaged(rows)).withColumnRenamed("conv_id", "_conv")
    ids = df.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    nothing = {**dict.fromkeys(_COUNTS, 0), "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(v)).cast(type_).alias(c) for (c, v), type_ in zip(
            nothing.items(), ["long"] * len(_COUNTS) + ["string"] * 2, strict=True)]
    )


# Costs from the front, a turn at a time; of each state the cheapest way, ties by letters.
OP11_SQL = rf"""
WITH RECURSIVE {BYTES_SQL}, z AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
y AS (SELECT *, {crc32_sql("name")} % 20 AS kind FROM z, crc_bytes),
x AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN ''
    WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM y WHERE kind <> 0),
w AS (SELECT *, coalesce(conv_id::VARCHAR, '') AS c, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, left(role, 64), left(text, 64), md5(role || ':' || text)) AS i,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS mark FROM x),
v AS (SELECT *, left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS previous,
    CASE WHEN mark = '' THEN 1 WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 2
    WHEN mark NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM w),
ins(s, t, dear, letters, lines) AS (VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []),
    (3, 3, 0, '', []), (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (3, 2, 2, 'I', ['user:']),
    (2, 3, 2, 'I', ['assistant:']), (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])),
m AS (SELECT c, i, t, t AS u, 3 AS dear, 'D' AS letter, []::VARCHAR[] AS line FROM v, range(4) r(t)
  UNION ALL SELECT c, i, t, CASE ini WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, (fault = 3)::INT, 'K', [role || ':' || text]
    FROM v, range(4) r(t) WHERE fault NOT IN (1, 2) AND (ini = 's' AND t = 0 OR ini = 'u' AND t <> 2 OR ini = 'a' AND t = 2)
  UNION ALL SELECT c, i, t, CASE t WHEN 2 THEN 3 ELSE 2 END, 2 + (fault = 3)::INT, 'R',
    [CASE t WHEN 2 THEN 'assistant:' ELSE 'user:' END || text] FROM v, range(4) r(t) WHERE fault NOT IN (1, 2)),
dp AS (SELECT DISTINCT c, 0::BIGINT AS i, 0 AS s, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS best FROM v
  UNION ALL SELECT dp.c, m.i, m.u, min({{'cost': best.cost + ins.dear + m.dear, 'audit': best.audit || letters || letter,
    'lines': list_concat(list_concat(best.lines, ins.lines), m.line)}})
    FROM dp JOIN ins USING (s) JOIN m ON m.c = dp.c AND m.i = dp.i + 1 AND m.t = ins.t GROUP BY dp.c, m.i, m.u),
g AS (SELECT c, conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (previous IS NOT NULL AND previous || ini NOT IN ('su', 'ua', 'au')) AS illegal,
    max(i) AS n FROM v GROUP BY c, conv_id),
e AS (SELECT g.c, min({{'cost': best.cost + ins.dear, 'audit': best.audit || letters,
    'lines': list_concat(best.lines, ins.lines)}}) AS best
    FROM g JOIN dp ON dp.c = g.c AND dp.i = g.n JOIN ins USING (s) WHERE t IN (0, 3) GROUP BY g.c)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
    coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN e ON e.c = g.c
"""
