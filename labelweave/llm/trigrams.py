"""Boolean trigram queries derived from regular expressions.

An expression is read as a tree. Parts that match few strings are kept as those strings
and put together with their neighbours; where a part matches too many, the strings so far
become a condition: one of them is there, with all of its trigrams. Alternatives are
joined by or, neighbours by and, and what may be missing asks for nothing. A query never
asks for more than every match holds.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser

# Characters of a class that are spelt out, strings that are kept of a part, and
# alternatives of a query; what has more asks for less.
CLASS, STRINGS, ALTERNATIVES = 8, 64, 64

# A query: alternatives, each a set of trigrams. The one without trigrams is always met.
Query = frozenset[frozenset[str]]
ALWAYS: Query = frozenset([frozenset()])


def _least(query: set[frozenset[str]]) -> Query:
    """Without alternatives that ask for all that another asks for, and more."""
    kept = frozenset(a for a in query if not any(b < a for b in query))
    return kept if len(kept) <= ALTERNATIVES else ALWAYS


def _either(a: Query, b: Query) -> Query:
    return _least({*a, *b})


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > ALTERNATIVES * ALTERNATIVES:
        return a
    joined = _least({x | y for x in a for y in b})
    return a if joined == ALWAYS and a != ALWAYS else joined


def _holds(strings: set[str]) -> Query:
    """One of the strings, by its trigrams."""
    return _least({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _class(items) -> set[str] | None:
    found: set[str] = set()
    for op, value in items:
        if op is C.LITERAL:
            found.add(chr(value))
        elif op is C.RANGE and value[1] - value[0] < 64:
            found |= {chr(c) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return _plain(found)


def _plain(strings: set[str]) -> set[str] | None:
    """Lower-cased; nothing outside ASCII, where cases differ between libraries."""
    if not all(s.isascii() for s in strings):
        return None
    low = {s.lower() for s in strings}
    return low if len(low) <= CLASS else None


def _part(op, value) -> tuple[set[str] | None, Query]:
    """(all strings that a part matches, if they are few; what its matches hold)."""
    if op is C.LITERAL:
        return _plain({chr(value)}), ALWAYS
    if op is C.IN:
        return _class(value), ALWAYS
    if op is C.AT or op is C.ASSERT or op is C.ASSERT_NOT:
        return {""}, ALWAYS
    if op is C.SUBPATTERN:
        return _sequence(value[3])
    if op is C.ATOMIC_GROUP:
        return _sequence(value)
    if op is C.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        if all(strings is not None for strings, _ in parts):
            strings = set().union(*[s for s, _ in parts])
            if len(strings) <= STRINGS:
                return strings, ALWAYS
        query: Query = frozenset()
        for strings, asked in parts:
            query = _either(query, asked if strings is None else _holds(strings))
        return None, query
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        least, most, inner = value
        strings, query = _sequence(inner)
        if strings is None:
            return None, query if least else ALWAYS
        if most == 1:
            return strings | {""} if not least else strings, ALWAYS
        if least == most and len(strings) ** least <= STRINGS:
            whole = {""}
            for _ in range(least):
                whole = {a + b for a in whole for b in strings}
            return whole, ALWAYS
        return None, _holds(strings) if least else ALWAYS
    return None, ALWAYS


def _sequence(parts) -> tuple[set[str] | None, Query]:
    run, query, whole = {""}, ALWAYS, True
    for op, value in parts:
        strings, asked = _part(op, value)
        if strings is not None and len(run) * len(strings) <= STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        query, whole = _both(query, _holds(run)), False
        run = {""} if strings is None else strings
        query = _both(query, asked)
    if whole:
        return run, ALWAYS
    return None, _both(query, _holds(run))


def required(pattern: str) -> list[list[str]]:
    """Alternatives of trigrams, lower case: a match of ``pattern``, in any case, holds
    all trigrams of one of them. None if matches need not have any, or if the expression
    has parts that only other libraries know."""
    try:
        parts = _parser.parse(pattern)
    except re.error:
        return []
    strings, query = _sequence(parts)
    query = query if strings is None else _holds(strings)
    return [] if frozenset() in query else sorted(sorted(a) for a in query)


def repeated_class(pattern: str, least: int) -> str | None:
    """For an expression that is one repeated character: the same, ``least`` times."""
    try:
        parts = _parser.parse(pattern)
    except re.error:
        return None
    if len(parts) != 1 or parts[0][0] is not C.MAX_REPEAT or not pattern.endswith("+"):
        return None
    low, high, inner = parts[0][1]
    single = len(inner) == 1 and inner[0][0] in (C.IN, C.LITERAL)
    return f"{pattern[:-1]}{{{least}}}" if single and high is C.MAXREPEAT and low <= 1 else None
