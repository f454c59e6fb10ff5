"""The cheapest edits of a sequence of turns, by dynamic programming with checkpoints.

A repaired conversation has role initials ``(s?(ua)+)?``. Four states say what may come
next; a vector holds the cost that is left from each of them. Vectors are computed from
the end. Only those at every square root of the length are stored; the walk from the
start computes the others again, block by block, and takes the least letter among the
edits that are as cheap as can be. Vectors differ by little, so what happens at a turn
is looked up once it is known.
"""

from __future__ import annotations

from math import isqrt

# States: at the start, after ``s``, after ``u``, after ``a``; what an insertion or a new
# role gives there, and where it leads.
START, SYSTEM, USER, ASSISTANT = range(4)
GIVES = ("user", "user", "assistant", "user")
LEADS = (USER, USER, ASSISTANT, USER)
# Costs of the edits, and of a truncated turn that stays.
DELETE, INSERT, REROLE, CUT_SHORT = 3, 2, 2, 1
BEYOND = 1 << 60

INITIALS = "sua"
LEGAL = {(0, 1), (1, 2), (2, 1)}
# Codes of turns: initial (3: any other), and 4 more if truncated; those that must go.
GOES = 8



def initial_of(role: str) -> int:
    return INITIALS.find(role[:1]) & 3 if role else 3


Vector = tuple[int, int, int, int]
# Beyond the last turn: what is left to insert.
END: Vector = (0, 4, 2, 0)


def _keeps(code: int, state: int) -> int | None:
    """Where a turn that stays as it is leads."""
    initial = code & 3
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def _moves(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use the turn up."""
    out = [("D", DELETE, state)]
    if code != GOES:
        extra = CUT_SHORT * (code >= 4)
        if (to := _keeps(code, state)) is not None:
            out.append(("K", extra, to))
        out.append(("R", REROLE + extra, LEADS[state]))
    return out


MOVES = [[_moves(code, state) for state in range(4)] for code in range(GOES + 1)]


def _inserting(v: list[int]) -> list[int]:
    user, assistant = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
    return [min(v[START], INSERT + user), min(v[SYSTEM], INSERT + user), user, assistant]


# What the two functions below have answered, by their arguments.
_BEFORE: dict[tuple, tuple[Vector, int]] = {}
_CHOICE: dict[tuple, tuple[str, int]] = {}


def before(code: int, after: Vector) -> tuple[Vector, int]:
    """The vector before a turn, less its smallest cost, and that cost."""
    known = _BEFORE.get((code, after))
    if known is None:
        known = _BEFORE[code, after] = _before(code, after)
    return known


def choice(code: int, state: int, after: Vector) -> tuple[str, int]:
    """The letters up to and with the turn's own, and the state behind it."""
    known = _CHOICE.get((code, state, after))
    if known is None:
        known = _CHOICE[code, state, after] = _choice(code, state, after)
    return known


def _before(code: int, after: Vector) -> tuple[Vector, int]:
    v = _inserting([min(c + after[to] for _, c, to in MOVES[code][s]) for s in range(4)])
    least = min(v)
    return tuple(c - least if c < BEYOND else BEYOND for c in v), least  # type: ignore[return-value]


def _choice(code: int, state: int, after: Vector) -> tuple[str, int]:
    v, least = before(code, after)
    letters = ""
    while True:
        left = v[state] + least
        moves = {letter: to for letter, c, to in MOVES[code][state] if c + after[to] == left}
        if "D" not in moves and INSERT + v[LEADS[state]] == v[state]:
            letters += "I"
            state = LEADS[state]
            continue
        letter = min(moves)
        return letters + letter, moves[letter]


def last_letters(state: int) -> str:
    """What is inserted behind the last turn."""
    return "I" * (END[state] // INSERT)


def cost_before(codes: list[int], end: Vector) -> list[int]:
    """The vector before all of the turns."""
    total = 0
    for code in reversed(codes):
        end, least = before(code, end)
        total += least
    return [c + total if c < BEYOND else BEYOND for c in end]


def transfer(codes: list[int]) -> list[list[int]]:
    """Costs from each state before the turns to each one behind them. Stretches of a
    conversation are joined by these."""
    ends = [tuple(0 if s == t else BEYOND for s in range(4)) for t in range(4)]
    columns = [cost_before(codes, e) for e in ends]  # type: ignore[arg-type]
    return [list(row) for row in zip(*columns, strict=True)]


def through(matrix: list[list[int]], end: list[int]) -> list[int]:
    """The vector before a stretch from the one behind it."""
    return [min(min(a + b for a, b in zip(row, end, strict=True)), BEYOND) for row in matrix]


def relative(v: list[int]) -> Vector:
    least = min(v)
    return tuple(c - least for c in v)  # type: ignore[return-value]


def walk(codes: list[int], end: Vector, state: int = START) -> tuple[list[str], int]:
    """The letters of each turn, those of insertions before it first, and the last state.

    Of the vectors only every square root of the length is kept, and one block of them.
    """
    gap = isqrt(len(codes)) + 1
    checkpoints = [end]
    v = end
    for i in range(len(codes) - 1, -1, -1):
        v = before(codes[i], v)[0]
        if i % gap == 0:
            checkpoints.append(v)
    checkpoints.pop()  # before the first turn
    letters = []
    for first in range(0, len(codes), gap):
        block = codes[first : first + gap]
        v = checkpoints.pop()
        behind = [v]
        for code in reversed(block[1:]):
            v = before(code, v)[0]
            behind.append(v)
        for code in block:
            letter, state = choice(code, state, behind.pop())
            letters.append(letter)
    return letters, state


class Editor:
    """Applies letters to turns, in order."""

    def __init__(self, state: int = START) -> None:
        self.state = state

    def _given(self) -> str:
        role = GIVES[self.state]
        self.state = LEADS[self.state]
        return role

    def inserted(self, letters: str):
        for _ in letters:
            yield "I", None, self._given(), ""

    def edited(self, letters: str, turn: int | None, role: str, text: str):
        """(edit, turn, role, text) of the turns that stand in the turn's place."""
        yield from self.inserted(letters[:-1])
        if letters[-1] == "K":
            self.state = _keeps(initial_of(role), self.state)
            yield "K", turn, role, text
        elif letters[-1] == "R":
            yield "R", turn, self._given(), text
