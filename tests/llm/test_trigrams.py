"""Queries derived from expressions never ask for more than matches hold."""

import random
import re
from re import _constants as C
from re import _parser

import pytest

from labelweave.llm.secrets import RULES, Rule, scan
from labelweave.llm.trigrams import repeated_class, required

PATTERNS = [
    *[r.pattern for r in RULES],
    "abc|defg", "(abc|de)fgh", "a{2}b{3}c*def", "(?i:HeLLo)[0-9]wor(ld)?", "x?y?z?", "[ab][cd][ef]gh", "(foo|ba.)qux+end",
    "^start.*end$", "(?:ab){2,3}c", "abc(?=d)de", "(one|two|three) (red|blue) [a-z]+ fish", "[^a]bcd", "\\d{3}-code", "é+abc",
    "(abcd)+", "(a|b|c|d)(e|f|g|h)(i|j|k|l)(m|n|o|p)qrstu", "((abc|abd)x|y)z", "",
]


def sample(parts, rng):
    out = ""
    for op, value in parts:
        if op is C.LITERAL:
            out += chr(value)
        elif op is C.NOT_LITERAL:
            out += rng.choice([c for c in "xyz" if ord(c) != value])
        elif op is C.ANY:
            out += rng.choice("abz 9")
        elif op is C.IN:
            kind, item = rng.choice([v for v in value if v[0] is not C.NEGATE])
            if value[0][0] is C.NEGATE:
                out += "~"
            elif kind is C.LITERAL:
                out += chr(item)
            elif kind is C.RANGE:
                out += chr(rng.randint(*item))
            else:
                out += rng.choice("0123456789")
        elif op is C.SUBPATTERN:
            out += sample(value[3], rng)
        elif op is C.BRANCH:
            out += sample(rng.choice(value[1]), rng)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            for _ in range(rng.randint(value[0], min(value[1], value[0] + 4))):
                out += sample(value[2], rng)
    return out


@pytest.mark.parametrize("pattern", PATTERNS)
def test_matches_satisfy_their_query(pattern):
    rng, query = random.Random(pattern), required(pattern)
    tried = 0
    for _ in range(300):
        text = sample(_parser.parse(pattern), rng)
        text = "".join(rng.choice([c, c.upper()]) for c in text) if "?i" in pattern else text
        found = re.search(pattern, text)
        if found and query:
            tried += 1
            low = found[0].lower()
            assert any(all(t in low for t in alternative) for alternative in query), (text, query)
    assert tried or not query


def test_what_queries_ask_for():
    assert required("abc|defg") == [["abc"], ["def", "efg"]]
    assert required("AKIA[A-Z0-9]+") == [["aki", "kia"]]
    assert required("api_?key") == [["_ke", "api", "i_k", "key", "pi_"], ["api", "ike", "key", "pik"]]
    assert required("(foo|ba.)qux+end") == [["end"]]
    # An alternative that asks for all of another's, and more, is not needed.
    assert required("(secret|secrets)=") == [["cre", "ecr", "et=", "ret", "sec"], ["cre", "ecr", "ets", "ret", "sec", "ts="]]
    assert required("(key|keyword)[0-9]+") == [["key"]]
    # Nothing is mandatory in these, or it is too short.
    assert required("[0-9a-f]+") == required("x?y?z?") == required("ab") == required("(") == []
    assert repeated_class("[0-9a-f]+", 32) == "[0-9a-f]{32}"
    assert repeated_class("[0-9]+x", 3) is repeated_class("(ab)+", 3) is None


def test_rules_of_a_users_own(spark):
    rules = (Rule("pin", "pin(code)?[:=][0-9]{4}"), Rule("shout", "[A-Z]+", least=6), Rule("any", "k.y"))
    texts = ["pincode:1234 and pin=9999", "PIN=1234", "WHISPERING loud", "key kay ky", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in scan(df, rules).collect()}
    assert got == {
        0: [("pin", 0, 12), ("pin", 17, 25)], 1: [], 2: [("shout", 0, 10)], 3: [("any", 0, 3), ("any", 4, 7)], 4: [], 5: [],
    }
