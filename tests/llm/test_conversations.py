"""Edits against brute force, long conversations against short ones, edge cases."""

import hashlib
import heapq
import random
import zlib
from collections import Counter

import duckdb
import pytest
from oracle import arrow, differences
from pyspark.sql import functions as F

from labelweave.llm import conversations
from labelweave.llm import turns as T

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def cheapest(codes):
    """(cost, letters) by a search over all edits, cheapest and least first."""
    heap, done = [(0, "", 0, T.START)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if i == len(codes) and state in (T.START, T.ASSISTANT):
            return cost, audit
        if (i, state) in done:
            continue
        done.add((i, state))
        following = T.USER if state != T.USER else T.ASSISTANT
        heapq.heappush(heap, (cost + 2, audit + "I", i, following))
        if i == len(codes):
            continue
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state))
        if codes[i] == T.GOES:
            continue
        initial, extra = codes[i] % 4, codes[i] // 4
        heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, following))
        fits = {0: state == T.START, 1: state != T.USER, 2: state == T.USER, 3: False}
        if fits[initial]:
            heapq.heappush(heap, (cost + extra, audit + "K", i + 1, initial + 1))


@pytest.mark.parametrize("seed", range(200))
def test_edits(seed):
    rng = random.Random(seed)
    codes = [rng.randrange(9) for _ in range(rng.randint(0, 14))]
    letters, state = T.walk(codes, T.END)
    cost = T.cost_before(codes, T.END)
    assert (cost[T.START], "".join(letters) + T.last_letters(state)) == cheapest(codes)
    cut = rng.randint(0, len(codes))
    behind = T.through(T.transfer(codes[cut:]), list(T.END))
    assert T.through(T.transfer(codes[:cut]), behind) == cost


def test_what_is_looked_up_does_not_grow_with_the_turns():
    codes = [random.Random(1).randrange(9) for _ in range(10_000)]
    letters, _ = T.walk(codes, T.END)
    assert len(letters) == len(codes) and len(T._BEFORE) + len(T._CHOICE) < 2000


def result(df, sql_rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if sql_rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", sql_rows)
    return differences(arrow(df), con.sql(conversations.OP11_SQL).to_arrow_table())


def odd_rows():
    rng = random.Random(7)
    texts = [None, "", " \n", "Yes.", "Why?", "cut sho", "So!\t", " ", "Ends. \x0b", "said: a"]
    roles = [None, "", "user", "assistant", "system", "tool", "User", "assistant:", "s"]
    rows = []
    for conv in [None, *range(40)]:
        for _ in range(rng.randint(1, 14)):
            turn = rng.choice([None, *range(-2, 9)])
            rows.append((conv, turn, rng.choice(roles + ["user", "assistant"] * 4), rng.choice(texts)))
    return rows + rows[:20]


@pytest.mark.parametrize("long_turns,bits", [(1 << 14, 12), (2, 1), (2, 12)])
def test_odd_rows_against_sql(spark, monkeypatch, long_turns, bits):
    """Null and repeated turns, roles and texts; short conversations, and all in blocks."""
    monkeypatch.setattr(conversations, "LONG_TURNS", long_turns)
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"role_": F.lit(1), "place": F.lit(2), "done": F.lit(3)})
    assert result(conversations.op11(df.repartition(3)), rows) == []


def test_one_conversation_holds_most_turns(spark, monkeypatch):
    monkeypatch.setattr(conversations, "LONG_TURNS", 50)
    monkeypatch.setattr(conversations, "BLOCK_BITS", 4)
    rng = random.Random(3)
    texts = [f"Turn {i}{rng.choice(['.', '!', ' and'])}" for i in range(300)]
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice(texts)) for i in range(700)]
    rows += [(i, k, "user", "Hi.") for i in range(2, 30) for k in range(3)]
    rows += [(99, 5, "user", "The same.")] * 300
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(conversations.op11(df), rows) == []
    blocks = conversations._made(conversations._turns(df), True).filter("NOT done AND conv_id = 1")
    assert blocks.select(F.shiftright("left_place", 33)).distinct().count() > 1


@pytest.mark.parametrize("long_turns", [1 << 14, 2])
def test_repaired_turns(spark, monkeypatch, long_turns):
    monkeypatch.setattr(conversations, "LONG_TURNS", long_turns)
    monkeypatch.setattr(conversations, "BLOCK_BITS", 2)
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    told = {r.conv_id: r for r in conversations.report(df).collect()}
    lines, edits = {}, Counter()
    for r in conversations.repair(df).orderBy("conv_id", "place", "step").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        edits[r.conv_id, r.edit] += 1
        assert (r.turn is None) or r.edit != "I"
    for conv, r in told.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == r.repaired_sha256
        assert all(edits[conv, e] == r.audit.count(e) for e in "KRI")
        initials = "".join(x[0] for x in lines.get(conv, []))
        assert not initials.replace("ua", "").replace("s", "", 1 if initials.startswith("s") else 0)


def test_nothing_left_and_nothing_given(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(lost, 0, "user", "Hello.")], SCHEMA)
    assert [tuple(r) for r in conversations.op11(df).collect()] == [(lost, 0, 0, 0, 0, 0, 0, "", EMPTY)]
    none = df.limit(0)
    for made in (conversations.op11, conversations.report, conversations.repair):
        assert made(none).count() == 0
