"""Approximate nearest neighbours: NN-descent and greedy graph search.

NN-descent keeps some near neighbours per vector, more among more vectors, and improves them by a principle: a
neighbour of a neighbour is likely a neighbour. Each round is a join: every vector's
group, its neighbours and those that have it as one, meets with its members' vectors,
and each member learns of better ones. Rounds end when few lists change. A query walks
the graph: it keeps the nearest vectors seen, expands those it has not expanded, and
ends when all are.

Equal vectors are one node. Vectors travel whole, as bytes of double precision, or of
single precision where that changes no component. Ties are broken by a hash of both nodes,
so that equally far nodes do not all list the same few. The beam of the walks is widened
until a sample of the queries, compared with all vectors, reaches the recall asked for.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import shared_folder
from .frames import frozen
from .words import MIX_B, U, mix

GIVEN = 1 << 14  # members whose vectors a task lays out at once
K = 24  # neighbours kept per vector, of few vectors
ROOMY, MORE = 10_000, 6  # vectors past which each doubling adds so many to that
HELD = 1 << 19  # offers that a task cuts to each member's best before it goes on
SETTLED = 0.005  # share of list entries that change, below which rounds end
FIRST_ORDERS, FIRST_BLOCK = 3, 4096  # random cuts into blocks, taken together for first lists
MEETINGS, SPLIT = 1.0, 0.585  # blocks that near pairs share; a cut parts 1 in 3 near pairs
ROWS = 256  # of a block, compared with all of it at once
MANY = 8  # a share of pairs, 1 in so many, past which all are taken in double precision at once
BEAM = 96  # vectors a walk keeps at first
RECALL, SAMPLE = 0.95, 100  # least recall, and queries that it is measured on
PART_BYTES = 1 << 27  # of vectors at most that the groups of a part meet with
CLOSE = 1e-6  # squared distance, against the norms, below which it is taken anew
PART_ITEMS = 1024  # nodes at least that a part keeps, of many
FEW_WALKS, WALKS = 16, 64  # queries whose walks a part keeps, at least and at most, of many
LOAD = 1 << 25  # bytes of letters that a task deals out together
ENTRIES = 8  # random vectors a walk starts from, beside its own neighbours

_GRAPH = "node long, code binary, near array<long>, dist array<double>"
# Rows between tasks are letters: many nodes, pairs or vectors in one, as bytes, to a part.
_LETTER = "part long, kind int, n long, a binary, b binary, c binary, d binary, e binary"
_NAMES = ["part", "kind", "n", "a", "b", "c", "d", "e"]
LISTS, EDGES, GROUPS, WANTED = range(4)  # kinds of letters; those first that others need
I, D, B = np.int64, np.float64, np.bool_


def listed(n: int) -> int:
    """How many neighbours a list holds among ``n`` vectors. Lists of one length hold ever
    fewer of the true neighbours as vectors grow in number, and walks pay for that."""
    return K + int(MORE * max(0.0, np.log2(max(n, 1) / ROOMY)))


def _times(n: int) -> int:
    """How often first lists are improved by cuts, so that near pairs share ``MEETINGS`` blocks
    of all cuts: a block holds fewer near pairs among more vectors."""
    return max(1, int(np.ceil(MEETINGS * max(1.0, n / FIRST_BLOCK) ** SPLIT / FIRST_ORDERS)))


def usable(vector):
    """Not null, not zero, all components finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return vector.isNotNull() & good & F.exists(vector, lambda x: x != 0)


def _encode(kind: str):
    """Vectors as bytes of a numpy type."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            v = flat.reshape(batch.num_rows, -1).astype(kind)
            code = pa.array([x.tobytes() for x in v], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), code], names=["node", "code"])

    return run


def _raw(codes: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long bytes as a matrix, without a copy per row."""
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    _, ends, data = codes.buffers()
    ends = np.frombuffer(ends, np.int32)[codes.offset : codes.offset + len(codes) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].reshape(len(codes), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    """A matrix of bytes as a column."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _decode(codes: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    return _raw(codes).view(kind).astype(D)


def _kind(nodes: DataFrame) -> str:
    """Single precision if every component fits it, else double."""
    whole = F.forall("vector", lambda x: x == x.cast("float").cast("double"))
    return "f8" if nodes.filter(~whole).limit(1).count() else "f4"


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of every row of a to every row of b."""
    centre = b.mean(axis=0)
    a, b = a - centre, b - centre
    norms = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    out = np.maximum(norms - 2.0 * (a @ b.T), 0.0)
    # Products lose the digits of near copies.
    x, y = np.nonzero(out <= CLOSE * norms)
    for lo in range(0, len(x), 1 << 14):
        p, q = x[lo : lo + (1 << 14)], y[lo : lo + (1 << 14)]
        out[p, q] = ((a[p] - b[q]) ** 2).sum(axis=1)
    return out


def _rough(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Centred vectors in single precision, half their squared lengths, less what products may
    be wrong by, and that error against the lengths. Two vectors may be as near as ``w`` if
    their product reaches the sum of those halves less ``w / 2``."""
    v = v - v.mean(axis=0)
    error = (v.shape[1] + 16) * 2.0**-23
    half = (v * v).sum(axis=1) / 2
    if not half.max(initial=0.0) < 1e30:  # too large: all may be near
        return np.zeros(v.shape, np.float32), np.full(len(v), -np.inf, np.float32), error
    return v.astype(np.float32), (half * (1 - error) - 1e-37).astype(np.float32), error


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows to rows beside them."""
    step = a - b
    return np.einsum("ij,ij->i", step, step)


def _lot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What decides between equally far pairs."""
    return mix(mix(x.astype(U)) ^ (y.astype(U) * MIX_B))


def _whole(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups; rows come sorted by group."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        marks = table.column(key).to_numpy()
        ended = np.flatnonzero(marks != marks[-1])
        last = int(ended[-1]) + 1 if len(ended) else 0
        if last:
            yield table.slice(0, last)
        rest = table.slice(last)
    if rest is not None:
        yield rest


def _offers(x, y, d) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(d, pa.float64())],
        names=["node", "other", "d"],
    )


def _ranked(x, y, d) -> tuple[np.ndarray, np.ndarray]:
    """Some distinct pairs in order of their first node, then of how near; and each one's place."""
    order = np.lexsort((_lot(x, y), d, x))
    first = np.flatnonzero(np.diff(x[order], prepend=-1))
    return order, np.arange(len(x)) - np.repeat(first, np.diff(first, append=len(x)))


def _best(x, y, d, most: int) -> np.ndarray:
    """Which of some distinct pairs are among the ``most`` nearest of their first node."""
    order, place = _ranked(x, y, d)
    return order[place < most]


def _once(x, y) -> np.ndarray:
    """The first of every distinct pair."""
    order = np.lexsort((y, x))
    return order[(np.diff(x[order], prepend=-1) != 0) | (np.diff(y[order], prepend=-1) != 0)]


def _nearest(own, nodes, d, worst, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The finite pairs of every row that its list can take: no more of one group than its
    ``most`` best, and as near. Equally far ones may still win by lot."""
    inside = d <= np.minimum(worst, np.finfo(D).max)[:, None]
    full = np.flatnonzero(inside.sum(axis=1) > most)
    if len(full):
        inside[full] &= d[full] <= np.partition(d[full], most - 1, axis=1)[:, most - 1 : most]
    row, column = np.nonzero(inside)
    return own[row], nodes[column], d[row, column]


def _offered(found, most: int) -> Iterator[pa.RecordBatch]:
    """Offers of a task's groups, cut to each member's best as they pile up."""
    held, size = [], 0

    def cut():
        x, y, d = (np.concatenate(c) for c in zip(*held, strict=True))
        at = _once(x, y)
        x, y, d = x[at], y[at], d[at]
        at = _best(x, y, d, most)
        return x[at], y[at], d[at]

    for part in found:
        held.append(part)
        size += len(part[0])
        if size >= HELD:
            held = [cut()]
            size = len(held[0][0])
            if size > HELD // 2:
                yield _offers(*held[0])
                held, size = [], 0
    if held:
        yield _offers(*cut())


def _meet(kind: str, most: int = K):
    """A group's members learn of one another; at least one of a pair is fresh."""

    def found(batches):
        for table in _whole(batches, "hub"):
            hub, member, worst = (table.column(c).to_numpy() for c in ("hub", "member", "worst"))
            order = np.lexsort((member, hub))
            h, m = hub[order], member[order]
            firsts = np.flatnonzero((np.diff(h, prepend=-1) != 0) | (np.diff(m, prepend=-1) != 0))
            fresh = table.column("fresh").to_numpy(zero_copy_only=False)[order]
            fresh, at = np.logical_or.reduceat(fresh, firsts), order[firsts]
            hub, member, worst = hub[at], member[at], worst[at]
            v = _decode(table.column("code"), kind)[at]
            rough, half, _ = _rough(v)
            bound = (half - worst / 2).astype(np.float32)
            cuts = [*np.flatnonzero(np.diff(hub, prepend=-1)).tolist(), len(hub)]
            left, right = [], []
            for lo, hi in pairwise(cuts):
                new = np.flatnonzero(fresh[lo:hi]) + lo
                if hi - lo < 2 or not len(new):
                    continue
                # A pair stays if either list may take the other.
                least = np.minimum(bound[new, None] + half[lo:hi], half[new, None] + bound[lo:hi])
                may = rough[new] @ rough[lo:hi].T >= least
                if np.count_nonzero(may) <= may.size // MANY:
                    row, column = np.nonzero(may)
                    left.append(new[row])
                    right.append(column + lo)
                    continue
                nodes, most_far, x, new = member[lo:hi], worst[lo:hi], v[lo:hi], new - lo
                d = _distances(x[new], x)
                d[np.arange(len(new)), new] = np.inf
                yield _nearest(nodes[new], nodes, d, most_far[new], most)
                old = np.flatnonzero(~fresh[lo:hi])
                if len(old):
                    yield _nearest(nodes[old], nodes[new], d[:, old].T, most_far[old], most)
            if left:
                i, j = np.concatenate(left), np.concatenate(right)
                i, j = i[i != j], j[i != j]
                for lo in range(0, len(i), GIVEN):
                    x, y = i[lo : lo + GIVEN], j[lo : lo + GIVEN]
                    d = _apart(v[x], v[y])
                    fine, back = d <= worst[x], (d <= worst[y]) & ~fresh[y]
                    yield member[x[fine]], member[y[fine]], d[fine]
                    yield member[y[back]], member[x[back]], d[back]

    return lambda batches: _offered(found(batches), most)


def _part(nodes: np.ndarray, parts: int) -> np.ndarray:
    """Where a node's list and vector are kept."""
    return (mix(nodes.astype(U)) % U(parts)).astype(I)


def _split(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key and where it is."""
    order = np.argsort(keys, kind="stable")
    cuts = [*np.flatnonzero(np.diff(keys[order], prepend=-1)).tolist(), len(keys)]
    for lo, hi in pairwise(cuts):
        yield int(keys[order[lo]]), order[lo:hi]


def _letters(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Letters (part, kind, n, arrays) as batches of bounded size."""

    def batch():
        part, kind, n, *data = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array(kind, pa.int32()), pa.array(n, pa.int64()),
             *(pa.array(c, pa.binary()) for c in data)],
            names=_NAMES,
        )

    held, size = [], 0
    for part, kind, n, *arrays in rows:
        data = [x.tobytes() for x in arrays]
        held.append((part, kind, n, *data, *[None] * (5 - len(data))))
        size += 64 + sum(map(len, data))
        if size > 1 << 22:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _opened(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _by_part(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    return groupby(_opened(batches), key=lambda r: r[0])


def _loads(letters: Iterable[tuple]) -> Iterator[list[tuple]]:
    """Letters that are dealt out together, so that they make few."""
    held, size = [], 0
    for letter in letters:
        held.append(letter)
        size += sum(map(len, filter(None, letter[3:])))
        if size >= LOAD:
            yield held
            held, size = [], 0
    if held:
        yield held


def _read(data: bytes, kind, width: int = 0) -> np.ndarray:
    """What a letter holds; rows of ``width`` where given."""
    out = np.frombuffer(data, kind)
    return out.reshape(-1, width) if width else out


def _joined(rows: list[tuple], *kinds) -> list[np.ndarray]:
    """The first arrays of all letters, end to end."""
    return [np.concatenate([np.empty(0, k), *(_read(r[3 + i], k) for r in rows)]) for i, k in enumerate(kinds)]


def _vectors(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of some letters, in order, and their vectors as rows of bytes."""
    nodes = np.concatenate([_read(r[3], I) for r in rows])
    codes = np.frombuffer(b"".join(r[4] for r in rows), np.uint8).reshape(len(nodes), -1)
    return nodes, codes


def _crowded(x, y, d, most: int) -> np.ndarray:
    """Which pairs stay where no node keeps more than its ``most`` nearest."""
    _, back, count = np.unique(x, return_inverse=True, return_counts=True)
    crowd = count[back] > most
    if not crowd.any():
        return np.arange(len(x))
    at = np.flatnonzero(crowd)
    return np.concatenate([np.flatnonzero(~crowd), at[_best(x[at], y[at], d[at], most)]])


def _posted(flat, parts: int):
    """Offers as letters to the nodes that they are made to."""

    def rows(batches):
        for batch in flat(batches):
            x, y, d = (c.to_numpy() for c in batch.columns)
            for part, at in _split(_part(x, parts)):
                yield part, EDGES, 0, x[at], y[at], d[at]

    return lambda batches: _letters(rows(batches))


def _placed(parts: int):
    """Vectors as letters to the parts that keep them."""

    def rows(batches):
        for batch in batches:
            if batch.num_rows:
                nodes, codes = batch.column("node").to_numpy(), _raw(batch.column("code"))
                for part, at in _split(_part(nodes, parts)):
                    yield part, LISTS, 0, nodes[at], codes[at]

    return lambda batches: _letters(rows(batches))


def _begun(most: int):
    """Parts with empty lists."""

    def rows(batches):
        for part, letters in _by_part(batches):
            nodes, codes = _vectors(list(letters))
            order, shape = np.argsort(nodes), (len(nodes), most)
            yield (
                part, LISTS, 0, nodes[order], codes[order],
                np.full(shape, -1, I), np.full(shape, np.inf, D), np.zeros(shape, B),
            )

    return lambda batches: _letters(rows(batches))


def _cells(v: np.ndarray, orders: int, bits: int, seed: int) -> np.ndarray:
    """A vector's cell in each of some random cuts: the signs of random projections."""
    planes = np.random.default_rng([v.shape[1], seed]).normal(size=(v.shape[1], orders * bits))
    sides = (v @ planes > 0).reshape(len(v), orders, bits)
    return (sides * (1 << np.arange(bits))).sum(axis=2) + (np.arange(orders) << bits)


def _counted(orders: int, bits: int, kind: str, seed: int):
    """How many vectors of a task are in each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(orders << bits, I)
        for _, _, _, nodes, codes, *_ in _opened(batches):
            v = _read(codes, kind).reshape(len(nodes) // 8, -1).astype(D)
            total += np.bincount(_cells(v, orders, bits, seed).ravel(), minlength=len(total))
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

    return run


def _dealt_cells(orders: int, bits: int, kind: str, seed: int, full: dict[int, tuple[int, int]]):
    """Vectors as letters to their blocks: a cell, or the blocks that a full one is dealt out to."""

    def rows(batches):
        for load in _loads(_opened(batches)):
            nodes, codes = _vectors(load)
            worst = np.concatenate([_read(r[6], D, len(r[6]) // len(r[3]))[:, -1] for r in load])
            v = codes.view(kind).astype(D)
            for cell, at in _split(_cells(v, orders, bits, seed).ravel()):
                at = at // orders
                first, blocks = full.get(cell, (cell, 1))
                lot = _lot(nodes[at], np.full(len(at), cell * 64 + seed, I)) % U(blocks)
                for block, some in _split(lot.astype(I)):
                    some = at[some]
                    yield first + block, EDGES, 0, nodes[some], codes[some], worst[some]

    return lambda batches: _letters(rows(batches))


def _first(kind: str, most: int):
    """Nearest neighbours within a block."""

    def found(batches):
        for _, letters in _by_part(batches):
            rows = list(letters)
            nodes, codes = _vectors(rows)
            worst = np.concatenate([_read(r[5], D) for r in rows])
            v = codes.view(kind).astype(D)
            rough, half, error = _rough(v)
            for lo in range(0, len(v) if len(v) > 1 else 0, ROWS):
                far, own = worst[lo : lo + ROWS], nodes[lo : lo + ROWS]
                some = np.arange(len(own))
                score = rough[lo : lo + ROWS] @ rough.T - half
                score[some, lo + some] = -np.inf
                least = half[lo : lo + ROWS] - far / 2
                short = np.flatnonzero(np.isinf(far))
                if len(short) and len(v) > most:
                    # The nearest of the block, and as near as products may be wrong by.
                    last = np.partition(score[short], len(v) - most, axis=1)[:, len(v) - most]
                    least[short] = last - 4 * error * (half[lo + short] + half.max())
                may = score >= least.astype(np.float32)[:, None]
                if np.count_nonzero(may) <= may.size // MANY:
                    row, column = np.nonzero(may)
                    d = _apart(v[lo + row], v[column])
                    fine = d <= far[row]
                    yield own[row[fine]], nodes[column[fine]], d[fine]
                    continue
                d = _distances(v[lo : lo + ROWS], v)
                d[some, lo + some] = np.inf
                yield _nearest(own, nodes, d, far, most)

    return lambda batches: _offered(found(batches), most)


def _merged(most: int):
    """Parts with the nearest of each list and what was offered to it."""

    def rows(batches):
        for part, letters in _by_part(batches):
            a, codes, near, dist, _ = next(letters)[3:]
            nodes, near, dist = _read(a, I), _read(near, I, most), _read(dist, D, most)
            held, size = [], 0

            def cut(held):
                x, y, d, new = (np.concatenate(c) for c in zip(*held, strict=True))
                at = _once(x, y)  # of a list's entry and an offer, the entry
                x, y, d, new = x[at], y[at], d[at], new[at]
                order, place = _ranked(x, y, d)
                top, place = order[place < most], place[place < most]
                return (x[top], y[top], d[top], new[top]), place

            row, column = np.nonzero(near >= 0)
            held = [(nodes[row], near[row, column], dist[row, column], np.zeros(len(row), B))]
            for letter in letters:
                x, y, d = _read(letter[3], I), _read(letter[4], I), _read(letter[5], D)
                held.append((x, y, d, np.ones(len(x), B)))
                size += len(x)
                if size > 4 * HELD:
                    held, size = [cut(held)[0]], 0
            (x, y, d, new), place = cut(held)
            near, dist = np.full(near.shape, -1, I), np.full(dist.shape, np.inf, D)
            fresh, row = np.zeros(near.shape, B), np.searchsorted(nodes, x)
            near[row, place], dist[row, place], fresh[row, place] = y, d, new
            yield part, LISTS, int(new.sum()), nodes, _read(codes, np.uint8), near, dist, fresh

    return lambda batches: _letters(rows(batches))


def _edges(parts: int, most: int, every: bool):
    """A part's lists to itself, and their entries to the parts of those they name. ``every``
    entry counts as fresh after the cuts: lists have met in blocks only."""

    def rows(batches):
        for load in _loads(_opened(batches)):
            found = []
            for part, _, _, a, _, near, dist, fresh in load:
                nodes, near, dist = _read(a, I), _read(near, I, most), _read(dist, D, most)
                fresh = near >= 0 if every else _read(fresh, B, most)
                yield part, LISTS, 0, nodes, near, fresh
                row, column = np.nonzero(near >= 0)
                found.append((near[row, column], nodes[row], dist[row, column], fresh[row, column]))
            y, x, d, new = (np.concatenate(c) for c in zip(*found, strict=True))
            at = _crowded(y, x, d, 2 * most)
            y, x, d, new = y[at], x[at], d[at], new[at]
            for owner, at in _split(_part(y, parts)):
                yield owner, EDGES, 0, y[at], x[at], d[at], new[at]

    return lambda batches: _letters(rows(batches))


def _gathered(parts: int, most: int):
    """The groups of a part's nodes, and what vectors are wanted for them from where. A hub
    has the ``2 * most`` nearest of those that have it on their lists; where nobody is new,
    all have met before."""

    def rows(batches):
        for part, letters in _by_part(batches):
            _, _, _, a, near, fresh, *_ = next(letters)
            nodes, near, fresh = _read(a, I), _read(near, I, most), _read(fresh, B, most)
            row, column = np.nonzero(near >= 0)
            y, x, d, new = _joined(list(letters), I, I, D, B)
            at = _crowded(y, x, d, 2 * most)
            hub = np.concatenate([nodes[row], y[at]])
            member = np.concatenate([near[row, column], x[at]])
            new = np.concatenate([fresh[row, column], new[at]])
            at = np.flatnonzero(np.isin(hub, np.unique(hub[new])))
            if not len(at):
                continue
            at = at[np.argsort(hub[at], kind="stable")]
            yield part, GROUPS, 0, hub[at], member[at], new[at]
            wanted = np.unique(member[at])
            for owner, some in _split(_part(wanted, parts)):
                yield owner, WANTED, part, wanted[some]

    return lambda batches: _letters(rows(batches))


def _sent(most: int):
    """Vectors to the parts that want them, and how far offers to them may be."""

    def rows(batches):
        for _, letters in _by_part(batches):
            _, _, _, a, codes, _, dist, _ = next(letters)
            nodes, worst = _read(a, I), _read(dist, D, most)[:, -1]
            codes = _read(codes, np.uint8).reshape(len(nodes), -1)
            for letter in letters:
                wanted = _read(letter[3], I)
                at = np.searchsorted(nodes, wanted)
                yield letter[2], LISTS, 0, wanted, codes[at], worst[at]

    return lambda batches: _letters(rows(batches))


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The groups of a part with their members' vectors, some at a time."""
    for _, letters in _by_part(batches):
        rows = list(letters)
        given = [r for r in rows if r[1] == LISTS]
        nodes, codes = _vectors(given)
        worst, order = np.concatenate([_read(r[5], D) for r in given]), np.argsort(nodes)
        nodes = nodes[order]
        for _, _, _, hub, member, new, *_ in (r for r in rows if r[1] == GROUPS):
            hub, member, new = _read(hub, I), _read(member, I), _read(new, B)
            for lo in range(0, len(hub), GIVEN):
                some = slice(lo, lo + GIVEN)
                at = order[np.searchsorted(nodes, member[some])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hub[some]), pa.array(member[some]), pa.array(new[some]), _binary(codes[at]),
                     pa.array(worst[at])],
                    names=["hub", "member", "fresh", "code", "worst"],
                )


def _listing(most: int):
    """Parts as a row per node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, a, codes, near, dist, _ in _opened(batches):
            nodes, near, dist = _read(a, I), _read(near, I, most), _read(dist, D, most)
            there = near >= 0
            ends = np.concatenate([[0], np.cumsum(there.sum(axis=1))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes),
                    _binary(_read(codes, np.uint8).reshape(len(nodes), -1)),
                    pa.ListArray.from_arrays(ends, pa.array(near[there])),
                    pa.ListArray.from_arrays(ends, pa.array(dist[there])),
                ],
                names=["node", "code", "near", "dist"],
            )

    return run


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _parts(df: DataFrame, items: int, size: int) -> int:
    """In how many parts items are kept: none so large that a task cannot hold what it meets
    with, ``size`` bytes an item; else one per task, but of many items, as parts write to parts."""
    least = -(-items * size // PART_BYTES)
    return max(1, least, min(_tasks(df), -(-items // PART_ITEMS)))


def _dealt(parts: int, *letters: DataFrame) -> DataFrame:
    """Letters at their parts, each part in one task."""
    df = letters[0]
    for more in letters[1:]:
        df = df.union(more)
    tasks = min(parts, _tasks(df))
    df = df.repartitionById(tasks, F.pmod("part", F.lit(tasks)).cast("int"))
    return df.sortWithinPartitions("part", "kind")


def _take(graph: DataFrame, offers: DataFrame, most: int, parts: int) -> DataFrame:
    """Lists with what was offered; those before are not needed any more."""
    taken = frozen(_dealt(parts, graph, offers).mapInArrow(_merged(most), _LETTER), "graph")
    _forget(graph)
    return taken


def _forget(df: DataFrame) -> None:
    """Remove the files of a frozen frame that nothing reads any more."""
    jvm, spark = df.sparkSession._jvm, df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def build_graph(nodes: DataFrame) -> DataFrame:
    """``nodes`` (node long, vector array<double> of one length) to lists of neighbours.

    Returns ``node``, ``code``, ``near`` and ``dist`` (squared, nearest first). Node ids
    are unique. A round only makes lists better, so rounds end. Lists and vectors are kept in
    parts by a hash of the node; a part is sent each vector that its groups meet with once.
    """
    kind = _kind(nodes)
    codes = frozen(nodes.mapInArrow(_encode(kind), "node long, code binary"), "codes")
    n = codes.count()
    most = listed(n)
    size = codes.select(F.length("code")).first()[0] if n else 1
    parts = _parts(nodes, n, 3 * most * size)
    graph = frozen(_dealt(parts, codes.mapInArrow(_placed(parts), _LETTER)).mapInArrow(_begun(most), _LETTER), "graph")
    bits = max(0, int(np.ceil(np.log2(max(n, 1) / FIRST_BLOCK)))) if n else 0
    for seed in range(_times(n)):
        graph = _take(graph, _cut(graph, bits, kind, most, parts, seed), most, parts)
    first = True
    while n:
        changed = graph.agg(F.sum("n")).first()[0] or 0
        if not first and changed <= SETTLED * n * most:
            break
        graph = _take(graph, _round(graph, kind, most, parts, first), most, parts)
        first = False
    rows = frozen(graph.mapInArrow(_listing(most), _GRAPH), "lists")
    _forget(graph)
    return rows


def _cut(graph: DataFrame, bits: int, kind: str, most: int, parts: int, seed: int) -> DataFrame:
    """Offers within the blocks of some random cuts."""
    counts = graph.mapInArrow(_counted(FIRST_ORDERS, bits, kind, seed), "cell long, n long")
    counts = counts.groupBy("cell").agg(F.sum("n").alias("n")).filter(F.col("n") > 2 * FIRST_BLOCK)
    # A cell that holds very many vectors is dealt out at random into blocks.
    full, blocks = {}, FIRST_ORDERS << bits
    for row in counts.orderBy("cell").collect():
        full[row.cell] = (blocks, -(-row.n // (2 * FIRST_BLOCK)))
        blocks += full[row.cell][1]
    cells = graph.mapInArrow(_dealt_cells(FIRST_ORDERS, bits, kind, seed, full), _LETTER)
    return _dealt(blocks, cells).mapInArrow(_posted(_first(kind, most), parts), _LETTER)


def _round(graph: DataFrame, kind: str, most: int, parts: int, first: bool) -> DataFrame:
    """Offers within the groups of all nodes that have a fresh member; ``first``: all have."""
    edges = graph.mapInArrow(_edges(parts, most, first), _LETTER)
    met = frozen(_dealt(parts, edges).mapInArrow(_gathered(parts, most), _LETTER), "groups")
    wanted = met.filter(F.col("kind") == WANTED)
    vectors = _dealt(parts, graph, wanted).mapInArrow(_sent(most), _LETTER)
    meet = _meet(kind, most)
    offers = _dealt(parts, vectors, met.filter(F.col("kind") == GROUPS))
    return offers.mapInArrow(_posted(lambda batches: meet(_groups(batches)), parts), _LETTER)


def _step(kind: str):
    """How far each query is from the node beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own, other = (_decode(batch.column(c), kind) for c in ("own", "code"))
                d = ((other - own) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query"), batch.column("node"), pa.array(d, pa.float64()),
                     pa.array(np.zeros(len(d), bool))],
                    names=["query", "node", "d", "done"],
                )

    return run


def _nearest_of_all(graph: DataFrame, sample: list, kind: str, top: int) -> dict[int, list[float]]:
    """How far the ``top`` nearest of each sampled node reach, all nodes compared."""
    asked, own = np.array([r.query for r in sample], np.int64), _decode(pa.array([r.code for r in sample], pa.binary()), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(asked), top), np.inf)
        for batch in batches:
            if batch.num_rows:
                d = _distances(own, _decode(batch.column("code"), kind))
                d[asked[:, None] == batch.column("node").to_numpy()[None, :]] = np.inf
                best = np.sort(np.concatenate([best, d], axis=1), axis=1)[:, :top]
        q, d = np.repeat(asked, top), best.ravel()
        fine = np.isfinite(d)
        yield pa.RecordBatch.from_arrays([pa.array(q[fine]), pa.array(d[fine])], names=["query", "d"])

    found = graph.select("node", "code").mapInArrow(run, "query long, d double")
    place = F.row_number().over(Window.partitionBy("query").orderBy("d"))
    found = found.withColumn("place", place).filter(F.col("place") <= top)
    return {r.query: sorted(r.d) for r in found.groupBy("query").agg(F.collect_list("d").alias("d")).collect()}


def _shelved(parts: int, most: int):
    """Nodes with their vectors and lists as letters to the parts that keep them, and the
    lists' entries to the parts of those they name."""

    def rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes, codes = batch.column("node").to_numpy(), _raw(batch.column("code"))
            near, dist = (batch.column(c).flatten().to_numpy() for c in ("near", "dist"))
            ends = batch.column("near").value_lengths().to_numpy().astype(I)
            for part, at in _split(_part(nodes, parts)):
                yield part, LISTS, 0, nodes[at], codes[at], ends[at], near[_ranges(ends, at)]
            named = np.repeat(nodes, ends)
            at = _crowded(near, named, dist, 2 * most)
            x, y, d = near[at], named[at], dist[at]
            for part, at in _split(_part(x, parts)):
                yield part, EDGES, 0, x[at], y[at], d[at]

    return lambda batches: _letters(rows(batches))


def _ranges(lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the items of the lists ``at`` are, of lists of such lengths end to end."""
    starts, long = (np.cumsum(lengths) - lengths)[at], lengths[at]
    return np.repeat(starts - (np.cumsum(long) - long), long) + np.arange(int(long.sum()))


def _shelf(most: int):
    """One letter per part: nodes in order, and those next to them: a node's own list and the
    ``2 * most`` nearest of those that have it on theirs."""

    def rows(batches):
        for part, letters in _by_part(batches):
            given, named = [], []
            for letter in letters:
                (given if letter[1] == LISTS else named).append(letter)
            nodes, codes = _vectors(given)
            lengths, near = (np.concatenate([_read(r[i], I) for r in given]) for i in (5, 6))
            x, y, d = _joined(named, I, I, D)
            at = _crowded(x, y, d, 2 * most)
            x, y = np.concatenate([np.repeat(nodes, lengths), x[at]]), np.concatenate([near, y[at]])
            at = _once(x, y)
            order = np.argsort(nodes)
            nodes = nodes[order]
            lengths = np.bincount(np.searchsorted(nodes, x[at]), minlength=len(nodes))
            yield part, LISTS, 0, nodes, codes[order], lengths.astype(I), y[at]

    return lambda batches: _letters(rows(batches))


def _seated(parts: int):
    """Queries as letters to the parts that keep their walks; each starts at its own node."""

    def rows(batches):
        for batch in batches:
            if batch.num_rows:
                query, codes = batch.column("query").to_numpy(), _raw(batch.column("code"))
                for part, at in _split(_part(query, parts)):
                    yield part, LISTS, 0, query[at], codes[at]
                    yield part, EDGES, 0, query[at], query[at], np.zeros(len(at), D), np.zeros(len(at), B)

    return lambda batches: _letters(rows(batches))


def _doors(parts: int):
    """Nodes to start from as letters to the queries' parts."""

    def rows(batches):
        for batch in batches:
            if batch.num_rows:
                query, node = batch.column("query").to_numpy(), batch.column("node").to_numpy()
                for part, at in _split(_part(query, parts)):
                    yield part, GROUPS, 0, query[at], node[at]

    return lambda batches: _letters(rows(batches))


def _walked(most: int, parts: int):
    """A step of a part's walks: what they met, and letters to the nodes' parts that ask for
    the distances of nodes not met, and for the lists of nodes to expand."""

    def rows(batches):
        for part, letters in _by_part(batches):
            got = [[] for _ in range(4)]
            for letter in letters:
                got[letter[1]].append(letter)
            query, codes = _vectors(got[LISTS])
            order = np.argsort(query)
            query, codes = query[order], codes[order]
            q, node, d = _joined(got[EDGES], I, I, D)
            # Letters of answers say nothing of what is done.
            done = np.concatenate([np.zeros(len(r[3]) // 8, B) if r[6] is None else _read(r[6], B) for r in got[EDGES]])
            order, place = _ranked(q, node, d)
            q, node, d, done = q[order], node[order], d[order], done[order]
            reach = np.full(len(query), np.inf)
            last = place == most - 1
            reach[np.searchsorted(query, q[last])] = d[last]
            todo = np.flatnonzero((place < most) & ~done)
            named, lengths, beside = _joined(got[WANTED], I, I, I)
            first = np.unique(named, return_index=True)[1]
            here = np.isin(node[todo], named)
            now, later = todo[here], np.unique(node[todo[~here]])
            at = first[np.searchsorted(named[first], node[now])]
            new_q, new_node = np.repeat(q[now], lengths[at]), beside[_ranges(lengths, at)]
            done[now] = True
            doors = _joined(got[GROUPS], I, I)
            every_q, every_node = np.concatenate([q, doors[0], new_q]), np.concatenate([node, doors[1], new_node])
            fresh = _once(every_q, every_node)
            fresh = fresh[fresh >= len(q)]
            new_q, new_node = every_q[fresh], every_node[fresh]
            yield part, LISTS, len(fresh) + len(later), query, codes
            yield part, EDGES, 0, q, node, d, done
            for owner, at in _split(_part(new_node, parts)):
                asks = np.unique(new_q[at])
                own = np.searchsorted(query, asks)
                yield owner, GROUPS, part, new_q[at], new_node[at], asks, codes[own], reach[own]
            for owner, at in _split(_part(later, parts)):
                yield owner, WANTED, part, later[at]

    return lambda batches: _letters(rows(batches))


def _answered(step):
    """How far queries are from nodes of a part, and the lists of nodes near enough for a beam."""

    def rows(batches):
        for _, letters in _by_part(batches):
            shelf = next(letters)
            nodes, lengths, beside = (_read(shelf[i], I) for i in (3, 5, 6))
            codes = _read(shelf[4], np.uint8).reshape(len(nodes), -1)

            def lists(at):
                return nodes[at], lengths[at], beside[_ranges(lengths, at)]

            for _, kind, asker, a, b, c, own, reach in letters:
                if kind == WANTED:
                    yield asker, WANTED, 0, *lists(np.searchsorted(nodes, _read(a, I)))
                    continue
                query, node, asks = _read(a, I), _read(b, I), _read(c, I)
                own, reach = _read(own, np.uint8).reshape(len(asks), -1), _read(reach, D)
                at, whose = np.searchsorted(nodes, node), np.searchsorted(asks, query)
                pieces = (slice(lo, lo + GIVEN) for lo in range(0, len(node), GIVEN))
                flat = (
                    pa.RecordBatch.from_arrays(
                        [pa.array(query[s]), pa.array(node[s]), _binary(own[whose[s]]), _binary(codes[at[s]])],
                        names=["query", "node", "own", "code"],
                    )
                    for s in pieces
                )
                d = np.concatenate([out.column("d").to_numpy() for out in step(flat)])
                yield asker, EDGES, 0, query, node, d
                near = np.unique(at[d <= reach[whose]])
                if len(near):
                    yield asker, WANTED, 0, *lists(near)

    return lambda batches: _letters(rows(batches))


def _beams(most: int, only: list[int] | None = None):
    """The walks' ``most`` nearest nodes as rows; ``only`` of some queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for letter in _opened(batches):
            q, node, d = _joined([letter], I, I, D)
            at = np.arange(len(q)) if only is None else np.flatnonzero(np.isin(q, only))
            at = at[_best(q[at], node[at], d[at], most)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(q[at]), pa.array(node[at]), pa.array(d[at])], names=["query", "node", "d"]
            )

    return run


def walk(graph: DataFrame, queries: DataFrame, kind: str, top: int = 10) -> DataFrame:
    """Greedy search: ``query``, ``node``, ``d`` of the nearest nodes seen.

    ``queries`` are nodes of the graph (column ``query``). A walk starts at its own node
    and at some random ones, and keeps ``BEAM`` nodes, more where that finds less than
    ``RECALL`` of the ``top`` nearest of ``SAMPLE`` queries: the walks then go on with
    half as much again. A beam as large as the graph ends this too. What falls out of a beam is
    kept with its distance, so no query meets a node's vector twice. Vectors and lists of
    nodes stay in their parts; a query's vector goes to each part where it has not met some.
    """
    n = graph.count()
    own = frozen(queries.join(graph.select(F.col("node").alias("query"), "code"), "query"), "queries")
    # Random entries: each query takes the next few nodes in the order of a hash ring cut
    # into as many cells as there are queries.
    count = own.count()
    cells = max(1, count)
    ring = F.pmod(F.xxhash64("node"), F.lit(cells))
    place = F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("node")))
    doors = graph.select("node", ring.alias("cell")).withColumn("place", place)
    doors = doors.filter(F.col("place") <= ENTRIES).select("node", "cell")
    seats = own.select("query", F.pmod(F.xxhash64("query"), F.lit(cells)).alias("cell"))
    doors = seats.join(doors, "cell").filter("query != node").select("query", "node")
    sample = own.orderBy(F.xxhash64("query"), "query").limit(SAMPLE).collect()
    truth = _nearest_of_all(graph, sample, kind, top) if sample else {}
    size = len(sample[0].code) if sample else 1
    shelves = _parts(graph, n, size + 24 * listed(n))
    halls = max(1, -(-count // WALKS), min(_tasks(graph), -(-count // FEW_WALKS)))
    shelf = _dealt(shelves, graph.mapInArrow(_shelved(shelves, listed(n)), _LETTER))
    shelf = frozen(shelf.mapInArrow(_shelf(listed(n)), _LETTER), "shelf")
    most = BEAM
    walks = _dealt(halls, own.mapInArrow(_seated(halls), _LETTER), doors.mapInArrow(_doors(halls), _LETTER))
    walks = frozen(walks.mapInArrow(_walked(most, shelves), _LETTER), "walks")
    while True:
        before, kept = walks, walks.filter(F.col("kind") <= EDGES)
        if kept.agg(F.sum("n")).first()[0]:
            asked = _dealt(shelves, shelf, walks.filter(F.col("kind") > EDGES))
            walks = _dealt(halls, kept, asked.mapInArrow(_answered(_step(kind)), _LETTER))
        else:
            met = walks.filter(F.col("kind") == EDGES)
            got = met.mapInArrow(_beams(top + 1, list(truth)), "query long, node long, d double")
            near: dict[int, list[float]] = {q: [] for q in truth}
            for r in got.filter("query != node").collect():
                near[r.query].append(r.d)
            hits = sum(sum(d <= x[-1] * (1 + 1e-9) for d in sorted(near[q])[:top]) for q, x in truth.items())
            if most >= n or hits >= RECALL * sum(map(len, truth.values())):
                return met.mapInArrow(_beams(most), "query long, node long, d double")
            # What the narrow beam dropped comes back, expanded or not.
            most += (most + 1) // 2
            walks = _dealt(halls, kept)
        walks = frozen(walks.mapInArrow(_walked(most, shelves), _LETTER), "walks")
        _forget(before)


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (
            batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for c in ("a", "b")
        )
        step = a.astype(np.float64) - b.astype(np.float64)
        score = pa.array(np.sqrt((step * step).sum(axis=1)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("query", "node")] + [score], names=["query", "node", "score"]
        )


def search(df: DataFrame, is_query, top: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``top`` nearest rows found for every row of ``df`` that ``is_query`` marks.

    ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, the Euclidean distance in
    double precision; nearest first, ties to the smaller id. Vectors that are null, zero
    or hold null or non-finite components take no part, nor do null ids, nor vectors
    whose length is not the most common one (of equally common ones the longest). Rows
    with the same id are never each other's neighbours; rows that repeat count once.
    With fewer rows than ``top`` all are returned; an empty frame gives an empty frame.
    """
    ids = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    ids = ids.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    ids = ids.withColumn("length", F.size("vector"))
    length = ids.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    ids = frozen(ids.filter(F.col("length") == (length[0] if length else 0)).drop("length"), "vectors")

    # A node per distinct vector, and its smallest ids: enough to fill any list.
    rows = ids.select("id", "vector")
    distinct = rows.select("vector").distinct().sortWithinPartitions("vector")
    nodes = frozen(distinct.select(F.monotonically_increasing_id().alias("node"), "vector"), "nodes")
    named = frozen(rows.distinct().join(nodes, "vector").select("node", "id"), "named")
    few = named.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(64)))
    for keys in (("node", "slot"), ("node",)):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
        few = few.withColumn("place", place).filter(F.col("place") <= top + 1)
    few = few.groupBy("node").agg(F.collect_list("id").alias("ids"))

    graph = build_graph(nodes)
    asked = frozen(
        named.filter(is_query(F.col("id"))).select(F.col("id").alias("query_id"), F.col("node").alias("query")),
        "asked",
    )
    found = walk(graph, asked.select("query").distinct(), _kind(nodes), top)
    ends_a = nodes.select(F.col("node").alias("query"), F.col("vector").alias("a"))
    ends_b = nodes.select("node", F.col("vector").alias("b"))
    scored = (
        found.select("query", "node")
        .join(ends_a, "query")
        .join(ends_b, "node")
        .mapInArrow(_exact, "query long, node long, score double")
    )
    # Only nodes that can reach the top are opened into ids.
    near = F.rank().over(Window.partitionBy("query").orderBy("score"))
    scored = scored.withColumn("place", near).filter(F.col("place") <= top + 1)
    opened = (
        asked.join(scored, "query")
        .join(few, "node")
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .filter("vec_id != query_id")
    )
    best = opened.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )


def op6(df: DataFrame) -> DataFrame:
    """The ten nearest of every vector whose id is divisible by 100."""
    return search(df, lambda i: i % 100 == 0)
