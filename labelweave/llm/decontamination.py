"""Benchmark decontamination by latent semantic retrieval.

Texts are hashed once, word by word; every step below reads the hashes.

1. Statistics: the document frequency of every (hashed) word, over all documents.
2. Latent space: a randomised SVD of the TF-IDF matrix of the benchmark's passages and of
   all passages of all documents, over the benchmark's words. Its rank is far below
   the number of passages, so words that go together fall together. Each task multiplies
   its rows with the sketch; only sums of fixed size meet.
3. Candidates: every passage of every document, in windows that overlap by half, against
   every item, by cosine in the latent space. Beside it stands an exact rule, as a space
   of low rank loses parts of items: who holds the share of an item's words asked for
   holds some of its rarest ones, whichever words are missing. A window with so many of
   those is a candidate at any cosine. By the same rule for an item's last words, which
   the checks ask of a candidate by cosine, most windows need no cosine.
4. Checks: around a candidate, the longest common subsequence of words with the item, and
   the same for the item's last words, its answer. Less in common is enough where the
   latent space brought the two together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import col
from .frames import carried, frozen, row_keys, same_row, scanned, with_row_id
from .words import U, Hasher

BITS = 18
FEATURES = 1 << BITS  # hashed words
RANK = 64  # latent dimensions
PASSAGE = 64  # words of a passage that shapes the space
SKETCH = 16  # further columns of the random sketch
POWER = 2  # passes that sharpen the sketch
FEATURE_BLOCK = 64  # features whose sums travel as one row
COSINE = 0.5  # latent cosine that makes a candidate
RARE = 3  # of an item's rarest words that a match holds at least
RARE_LAST = 2  # and of the rarest of its last words
COMMON = 0.8  # least share of an item's words in a common subsequence
LOOSE, ANSWER = 0.6, 8  # with the item's last words there too, this share is enough
PARAPHRASE = 0.4  # and this one if the latent cosine makes the candidate
ANSWER_SHARE = 0.85
SHORTEST = 4  # items of fewer words have no passage to find
BLOCK_ITEMS = 2048  # items that a task holds at once; more take further passes
PIECE = 1 << 15  # words searched at once
GIVEN = 1 << 17  # hashed words given out at once
ROWS = 1 << 12  # words of passages multiplied at once, with the part of the vocabulary they hold

# ASCII punctuation becomes white space.
_FOLD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def _words(hasher: Hasher, text: str | None) -> np.ndarray:
    return hasher.words((text or "").lower().encode().translate(_FOLD))


def _features(words: np.ndarray) -> np.ndarray:
    return (words >> U(64 - BITS)).astype(np.int64)


def hashed(rows: DataFrame) -> DataFrame:
    """``words``, the hashes of each text's words as bytes, and their number ``n``, for
    ``text``."""

    def given(batch: pa.RecordBatch, words: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                *[batch.column(c) for c in ("rid_a", "rid_b", "doc_id")],
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([w.tobytes() for w in words], pa.binary()),
            ],
            names=["rid_a", "rid_b", "doc_id", "n", "words"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            # Hashes take more room than texts, so few rows at a time are given out.
            words, held, done = [], 0, 0
            for row, text in enumerate(batch.column("text"), 1):
                words.append(_words(hasher, text.as_py()))
                held += len(words[-1])
                if held >= GIVEN or row == batch.num_rows:
                    yield given(batch.slice(done, len(words)), words)
                    words, held, done = [], 0, row

    return rows.mapInArrow(run, "rid_a long, rid_b long, doc_id long, n long, words binary")


def _hashes(column) -> Iterator[np.ndarray]:
    return (np.frombuffer(words.as_buffer(), U) for words in column)


def document_frequency(rows: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts hold each hashed word, and how many texts there are.

    Each task adds up its texts; what moves is one count per word and task, what
    reaches the driver is ``FEATURES`` counts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, last = np.zeros(FEATURES, np.int64), np.zeros(FEATURES, np.int64)
        texts = 0
        for batch in batches:
            for words in _hashes(batch.column("words")):
                features = _features(words)
                place = np.arange(len(features))
                last[features] = place
                # One place of each feature counts.
                seen[features[last[features] == place]] += 1
                texts += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(seen[at], texts))],
            names=["feature", "n"],
        )

    counts = rows.select("words").mapInArrow(count, "feature int, n long")
    total = counts.groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(FEATURES, np.int64)
    feature, n = (total.column(c).to_numpy() for c in ("feature", "n"))
    out[feature[feature >= 0]] = n[feature >= 0]
    return out, int(n[feature < 0].sum())


def _tfidf(features: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and unit-length weights."""
    at, tf = np.unique(features, return_counts=True)
    w = tf * idf[at]
    return at, w / max(np.sqrt((w * w).sum()), 1e-12)


_MATRIX = "n int, at binary, row binary, col binary, w binary"


def _matrix(vocab: np.ndarray, idf: np.ndarray):
    """The TF-IDF rows of passages of ``PASSAGE`` words, over ``vocab``: a block of ``n``
    passages, the places in ``vocab`` that it holds, and its cells by row and place."""
    place = np.full(FEATURES, -1, np.int64)
    place[vocab] = np.arange(len(vocab))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = np.zeros(len(vocab), np.int64)
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            for texts, words in _pieces(_hashes(batch.column("words")), 0, ROWS):
                sizes = np.array([len(w) for w in words])
                within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                passage = np.cumsum(within % PASSAGE == 0) - 1
                at = place[_features(np.concatenate(words))]
                inside = at >= 0
                cell, tf = np.unique(passage[inside] * len(vocab) + at[inside], return_counts=True)
                if not len(cell):
                    continue
                row, at = np.divmod(cell, len(vocab))
                w = tf * idf[vocab[at]]
                scale = np.repeat(weights[[t[0] for t in texts]], -(-sizes // PASSAGE))
                w *= (scale / np.sqrt(np.maximum(np.bincount(row, w * w, len(scale)), 1e-24)))[row]
                known = np.flatnonzero(np.bincount(at))
                local[known] = np.arange(len(known))
                column = local[at]
                binary = [pa.array([c.astype(np.int32).tobytes()], pa.binary()) for c in (known, row, column)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(scale)], pa.int32()), *binary, pa.array([w.astype(np.float32).tobytes()], pa.binary())],
                    names=["n", "at", "row", "col", "w"],
                )

    return run


def latent_space(passages: DataFrame, vocab: np.ndarray, idf: np.ndarray, rank: int) -> np.ndarray:
    """Latent vectors of the words in ``vocab``, sorted, of ``passages`` (words, weight).

    Subspace iteration: ``Z = A' (A Q)`` is summed over tasks, a row per block of
    features and task, and orthonormalised on the driver, where it has the size of the
    vocabulary times the rank.
    """
    width = min(rank + SKETCH, max(len(vocab), 1))
    q = np.random.default_rng(7).normal(size=(len(vocab), width))

    def product(q):
        q = q.astype(np.float32)

        def run(batches):
            out = np.zeros(q.shape, np.float32)
            for batch in batches:
                blocks = zip(*(batch.column(c) for c in ("n", "at", "row", "col", "w")), strict=True)
                for n, *cells, w in blocks:
                    at, row, column = (np.frombuffer(c.as_buffer(), np.int32) for c in cells)
                    a = np.zeros((n.as_py(), len(at)), np.float32)
                    a[row, column] = np.frombuffer(w.as_buffer(), np.float32)
                    out[at] += a.T @ (a @ q[at])
            blocks = range(0, len(out), FEATURE_BLOCK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(blocks), pa.int64()),
                    pa.array([out[b : b + FEATURE_BLOCK].tobytes() for b in blocks], pa.binary()),
                ],
                names=["block", "z"],
            )

        return run

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, z in zip(batch.column("block").to_pylist(), batch.column("z"), strict=True):
                part = np.frombuffer(z.as_py(), np.float32)
                sums[block] = sums[block] + part if block in sums else part.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([z.tobytes() for z in sums.values()], pa.binary())],
            names=["block", "z"],
        )

    if len(vocab):
        matrix = frozen(passages.mapInArrow(_matrix(vocab, idf), _MATRIX), "matrix")
    for _ in range(POWER + 1 if len(vocab) else 0):
        parts = matrix.mapInArrow(product(q), "block long, z binary")
        total = parts.repartition("block").mapInArrow(add, "block long, z binary").collect()
        z = np.concatenate([np.frombuffer(r.z) for r in sorted(total, key=lambda r: r.block)])
        u, s, _ = np.linalg.svd(z.reshape(q.shape), full_matrices=False)
        q = u[:, s > 1e-9 * max(s.max(), 1e-300)]  # the rest is noise
    return q[:, :rank].astype(np.float32)


def common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence: a bit per place of ``b``."""
    places: dict[int, int] = {}
    for i, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << i
    full = row = (1 << len(b)) - 1
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(b) - row.bit_count()


def _rarest(features: np.ndarray, idf: np.ndarray, share: float, most: int) -> tuple[np.ndarray, int]:
    """Some of a list's rarest words, and how many of them, ``most`` if there are as many,
    whoever holds ``share`` of the list holds."""
    holds = int(np.ceil(share * len(features) - 1e-9))
    most = min(most, holds)
    order = np.argsort(-idf[features], kind="stable")
    return np.unique(features[order[: len(features) - holds + most]]), most


def _present(h, lo, hi, lists, which, share: float) -> np.ndarray:
    """Whether each window ``h[lo:hi]`` has ``share`` of the words of its list, in any order."""
    out = np.zeros(len(lo), bool)
    h = h.view(np.int64)
    for some in range(0, len(lo), 1 << 9):
        part = slice(some, some + (1 << 9))
        span = np.arange((hi[part] - lo[part]).max())
        window = h[np.minimum(lo[part, None] + span, hi[part, None] - 1)]
        wanted = [lists[n] for n in which[part].tolist()]
        size = np.array([len(w) for w in wanted])
        grid = np.zeros((len(wanted), size.max()), np.int64)
        grid[np.arange(size.max()) < size[:, None]] = np.concatenate(wanted)
        there = np.zeros(len(wanted), np.int64)
        for j in range(grid.shape[1]):
            there += (window == grid[:, j, None]).any(axis=1) & (j < size)
        out[part] = there >= share * size
    return out


class _Matcher:
    """Finds the items that a run of words holds."""

    def __init__(self, items, vocab, space, idf):
        self.hasher, self.idf = Hasher(), idf.astype(np.float32)
        # Words outside the vocabulary have no latent part.
        self.space = np.concatenate([space, np.zeros((1, space.shape[1]), np.float32)])
        self.place = np.full(FEATURES, len(vocab), np.int64)
        self.place[vocab] = np.arange(len(vocab))
        self.ids = [_words(self.hasher, text).view(np.int64) for _, text in items]
        self.lists = [w.tolist() for w in self.ids]
        self.lengths = np.array([len(w) for w in self.ids])
        self.latent = np.zeros((len(items), space.shape[1]), np.float32)
        rare, last, need = [], [], []
        for n, words in enumerate(self.ids):
            features = _features(words.view(U))
            at, w = _tfidf(features, idf)
            self.latent[n] = w.astype(np.float32) @ space[self.place[at]]
            some, least = _rarest(features, idf, LOOSE, RARE)
            ends, least_ends = _rarest(features[-ANSWER:], idf, ANSWER_SHARE, RARE_LAST)
            rare.append(some)
            last.append(ends)
            need.append((least, least_ends))
        need = np.array(need).reshape(-1, 2)
        self.latent /= np.maximum(np.linalg.norm(self.latent, axis=1, keepdims=True), 1e-12)
        # Windows of twice the longest item of a class overlap by half, so a passage lies
        # whole in one, and items of like length fill a like share of it.
        classes: dict[int, list[int]] = {}
        for n, length in enumerate(self.lengths):
            if length >= SHORTEST:
                classes.setdefault(int(np.ceil(2 * np.log2(length))), []).append(n)
        # The words that some list holds, by their places among these.
        used = [words for n, length in enumerate(self.lengths) if length >= SHORTEST for words in (rare[n], last[n])]
        used = np.unique(np.concatenate([np.zeros(0, np.int64), *used]))
        self.listed = np.full(FEATURES, -1, np.int64)
        self.listed[used] = np.arange(len(used))
        self.classes = []
        for members in map(np.array, classes.values()):
            # The members among whose rarest words a word is, then those among whose last.
            lists = [rare[n] for n in members] + [last[n] for n in members]
            words = self.listed[np.concatenate(lists)]
            order = np.argsort(words, kind="stable")
            first = np.searchsorted(words[order], np.arange(len(used) + 1))
            owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])[order]
            self.classes.append((members, (first, owner, need[members].T.ravel()), int(self.lengths[members].max())))
        self.overlap = 2 * max((size for *_, size in self.classes), default=0)

    def cosines(self, features, lo, hi, items) -> np.ndarray:
        """Latent cosines of windows with an item each."""
        out = np.zeros(len(lo), np.float32)
        for some in range(0, len(lo), 1 << 10):
            part = slice(some, some + (1 << 10))
            size = hi[part] - lo[part]
            first = np.cumsum(size) - size
            word = features[np.arange(size.sum()) + np.repeat(lo[part] - first, size)]
            weight = self.idf[word]
            vectors = np.add.reduceat(self.space[self.place[word]] * weight[:, None], first, axis=0)
            # A word that repeats weighs more than this length says, so the cosine is
            # never taken too low.
            length = np.sqrt(np.maximum(np.add.reduceat(weight * weight, first), 1e-12))
            out[part] = (vectors * self.latent[items[part]]).sum(axis=1) / length
        return out

    def match(self, rows, words):
        """(row, item) to the share of the item found, for a list of runs of words."""
        sizes = np.array([len(w) for w in words])
        h = np.concatenate(words)
        offset = np.cumsum(sizes) - sizes
        features = _features(h)
        listed = self.listed[features]
        word = np.flatnonzero(listed >= 0)
        listed = listed[word]
        run = np.repeat(np.arange(len(sizes)), sizes)[word]
        best: dict[tuple[int, int], float] = {}
        for members, (first, owner, need), size in self.classes:
            count = np.maximum(1, -(-(sizes - size) // size))
            start = np.cumsum(count) - count
            # A word lies in the window of its turn and in the one before.
            held = first[listed + 1] - first[listed]
            some = np.flatnonzero(held)
            held, begin = held[some], first[listed[some]]
            last = np.minimum((word[some] - offset[run[some]]) // size, count[run[some]])
            entry = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held - begin, held)
            cell = start[run[some]] + last
            cell = np.stack([np.repeat(cell, held), np.repeat(cell - 1, held)])
            there = np.stack([np.repeat(last < count[run[some]], held), np.repeat(last > 0, held)])
            pair, times = np.unique((cell * (2 * len(members)) + owner[entry])[there], return_counts=True)
            cell, column = np.divmod(pair[times >= need[pair % (2 * len(members))]], 2 * len(members))
            # Only who holds an item's last words can make a match of a cosine.
            ends, column = column >= len(members), column % len(members)
            item = members[column]
            piece = np.searchsorted(start, cell, side="right") - 1
            lo = offset[piece] + (cell - start[piece]) * size
            hi = np.minimum(lo + 2 * size, offset[piece] + sizes[piece])
            tails = [words[-ANSWER:] for words in self.ids]
            fine = ~ends
            fine[ends] = _present(h, lo[ends], hi[ends], tails, item[ends], ANSWER_SHARE)
            for latent, enough in ((False, LOOSE), (True, PARAPHRASE)):
                at = np.flatnonzero(fine & (ends == latent))
                at = at[_present(h, lo[at], hi[at], self.ids, item[at], enough)]
                if latent:
                    at = at[self.cosines(features, lo[at], hi[at], item[at]) >= COSINE]
                for w in at.tolist():
                    row, n = int(rows[piece[w]][0]), int(item[w])
                    share = self.share(n, h[lo[w] : hi[w]].view(np.int64), enough)
                    if share > best.get((row, n), 0.0):
                        best[row, n] = share
        return best

    def share(self, n: int, near: np.ndarray, enough: float) -> float:
        """Share of an item's words in common, 0 if that makes no match."""
        item = self.ids[n]
        near = near.tolist()
        share = common(self.lists[n], near) / len(item)
        if share >= COMMON:
            return share
        tail = item[-ANSWER:]
        fine = share >= enough and common(tail.tolist(), near) >= ANSWER_SHARE * len(tail)
        return share if fine else 0.0


def _pieces(texts, overlap: int, size: int):
    """(row of each word, words): whole texts together, long ones with overlaps."""
    rows, words, held = [], [], 0
    for i, h in enumerate(texts):
        for lo in range(0, max(len(h) - overlap, 1), size):
            part = h[lo : lo + size + overlap]
            if not len(part):
                continue
            rows.append(np.full(len(part), i))
            words.append(part)
            held += len(part)
            if held >= size:
                yield rows, words
                rows, words, held = [], [], 0
    if held:
        yield rows, words


def _scan(items, vocab, space, idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _Matcher(items, vocab, space, idf)
        for batch in batches:
            best: dict[tuple[int, int], float] = {}
            texts = _hashes(batch.column("words"))
            for rows, words in _pieces(texts, matcher.overlap, PIECE) if matcher.classes else ():
                for pair, share in matcher.match(rows, words).items():
                    best[pair] = max(share, best.get(pair, 0.0))
            at = pa.array([row for row, _ in best], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(at) for c in ("rid_a", "rid_b", "doc_id")],
                    pa.array([items[n][0] for _, n in best], pa.int64()),
                    pa.array(list(best.values()), pa.float64()),
                ],
                names=["rid_a", "rid_b", "doc_id", "item_id", "overlap"],
            )

    return run


def leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every (document, item) where the document holds the item or a paraphrase of it.

    ``rid_a``, ``rid_b``, the key as ``doc_id``, ``item_id`` and ``overlap``, the share
    of the item's words that occur in the document in its order. A document holds an
    item if that share is at least 0.8, or at least 0.6 and the item's last eight words
    are there too, each within a window of about twice the item's length: no window that
    holds so many of its words is left out. A share of 0.4 with those last words is
    enough in windows whose latent cosine with the item is at least ``COSINE``. Case and
    ASCII punctuation do not count.
    Null and empty texts hold nothing and items of fewer than four words are not looked
    for. Repeated items and rows are reported one by one. With an empty frame or
    benchmark the result is empty. Tasks hold ``BLOCK_ITEMS`` items at once; a larger
    benchmark takes a pass over the documents per block.
    """
    rows = with_row_id(scanned(df), doc_id=col(key).cast("long"), text=text)
    rows = frozen(hashed(rows.select("rid_a", "rid_b", "doc_id", "text")), "words")
    seen, texts = document_frequency(rows)
    idf = np.log((1.0 + texts) / (1.0 + seen)) + 1.0
    passages = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    blocks = max(1, -(-passages.count() // BLOCK_ITEMS))
    schema = "rid_a long, rid_b long, doc_id long, item_id long, overlap double"
    out = None
    total = rows.agg(F.sum(F.ceil(F.col("n") / PASSAGE))).first()[0] or 0
    hasher = Hasher()
    for block in range(blocks):
        part = passages.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = [(r.item_id, r.text) for r in part.collect()]
        held = {text: _words(hasher, text) for _, text in items}
        vocab = np.unique(np.concatenate([np.zeros(0, np.int64), *map(_features, held.values())]))
        known = df.sparkSession.createDataFrame(
            [(held[text].tobytes(), 1.0) for text in sorted(held)], "words binary, weight double"
        )
        # All passages of documents weigh as much as all items.
        weight = float(np.sqrt(len(held) / max(1, total)))
        space = latent_space(known.union(rows.select("words", F.lit(weight))), vocab, idf, RANK)
        found = rows.mapInArrow(_scan(items, vocab, space, idf), schema)
        out = found if out is None else out.union(found)
    return out


def without_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that hold no item, with the columns of ``df``."""
    scan = scanned(df)
    found = leaks(scan, benchmark, text, key).select(*row_keys())
    return carried(scan).join(found, same_row(), "left_anti").select("row.*")


def op8(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold benchmark items: doc_id, item_id, overlap."""
    return leaks(df, benchmark).select("doc_id", "item_id", "overlap")
