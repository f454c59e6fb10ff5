"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word goes in as a vector of its own (hashed), the mean of its characters' vectors
(hashed triples of bytes), and how much more often than by chance the word and its
characters stood in toxic training texts. Words longer than ``LONGEST`` bytes, such as text
without spaces, go in as pieces, each a step of its own. Two gated recurrent passes, one each way, read a window of
words; attention weighs their states into one vector, and a logit follows. Every window
of every text is scored, and windows overlap. A text's score is a logistic function of
its highest and mean logit and its number of windows.

The network is trained on the driver from a sample of labelled windows whose size is
bounded by the parameters below. Scoring is a map over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col, cols
from .frames import hidden
from .words import MIX_A, MIX_B, U, mix, powers

WINDOW, STRIDE = 64, 48
WORD_BITS, CHAR_BITS, ODDS_BITS = 14, 12, 20
LEAST_TEXTS = 3  # texts that a word must stand in for its odds to count
FOLDS = 4  # training texts see odds counted on the other folds
WORD_DIM, CHAR_DIM, STATE, ATTENTION = 8, 8, 8, 8
# The sample that the network is fitted on: texts per class and windows per text.
MOST_TOXIC, MOST_CLEAN, MOST_WINDOWS = 2000, 3000, 4
EPOCHS, BATCH, RATE = 6, 64, 0.01
WORDLESS = 0.4  # share of words that are known by their characters alone in a step
DECAY = 0.02  # pull of the embeddings towards zero
SCORED = 2048  # windows scored at once

# ASCII punctuation becomes white space.
_FOLD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
LONGEST = 64  # bytes of a step; longer words are cut into pieces


class Vocabulary:
    """The distinct words of some texts as network input."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
        ink = raw != 32
        edges = np.flatnonzero(np.diff(ink, prepend=False, append=False))
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        offsets = np.cumsum(lengths) - lengths
        if len(starts):
            # In place: a reused worker keeps the room that these take.
            place = np.arange(int(lengths.sum()))
            place -= np.repeat(offsets, lengths)
            terms = powers(MIX_A, int(lengths.max()))[place]
            terms *= raw[ink]
            sums = np.add.reduceat(terms, offsets)
            del place, terms
            names = mix(sums + lengths.astype(U) * MIX_B)
        else:
            names = np.zeros(0, U)
        unique, first, self.index = np.unique(names, return_index=True, return_inverse=True)
        self.words = (unique >> U(64 - WORD_BITS)).astype(np.int64)
        self.wide = (unique >> U(64 - ODDS_BITS)).astype(np.int64)
        self.sizes = lengths[first]
        self.starts = np.cumsum(self.sizes) - self.sizes
        inner = np.arange(int(self.sizes.sum())) - np.repeat(self.starts, self.sizes)
        p = np.repeat(starts[first], self.sizes) + inner
        triple = (
            raw[p - 1].astype(U) * U(65536) + raw[p].astype(U) * U(256) + raw[p + 1].astype(U)
        )
        self.chars = (mix(triple * MIX_A) >> U(64 - CHAR_BITS)).astype(np.int64)
        self.counts = [len(t.split()) for t in texts]
        self.seen = np.ones((len(self.words), 1), np.float32)


def fold(text: str | None) -> bytes:
    """Lower-cased words without ASCII punctuation, one space between; long ones in pieces."""
    words = (text or "").lower().encode().translate(_FOLD).split()
    if max(map(len, words), default=0) > LONGEST:
        words = [piece for word in words for piece in _cut(word)]
    return b" ".join(words)


def _cut(word: bytes) -> Iterator[bytes]:
    """Consecutive pieces of at most ``LONGEST`` bytes, cut between characters. The next
    starts with the last character or two (at least two bytes) of the one before, so
    that every triple of the word lies in a piece."""
    lo = 0
    while len(word) - lo > LONGEST:
        hi = lo + LONGEST
        while word[hi] & 0xC0 == 0x80:
            hi -= 1
        yield word[lo:hi]
        lo = hi - 2
        while word[lo] & 0xC0 == 0x80:
            lo -= 1
    yield word[lo:]


def windows_of(n: int) -> np.ndarray:
    """Where windows of a text of ``n`` words start; the last ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)


@dataclass
class Network:
    p: dict[str, np.ndarray] = field(default_factory=dict)
    # Not trained: odds of words and of characters.
    word_odds: np.ndarray = field(default_factory=lambda: np.zeros(1 << ODDS_BITS, np.float32))
    char_odds: np.ndarray = field(default_factory=lambda: np.zeros(1 << CHAR_BITS, np.float32))
    # The same without the texts of each fold.
    without: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def __getstate__(self) -> tuple:
        """Most units have no odds: only the others travel to tasks."""
        odds = [(self.word_odds, self.char_odds), *self.without]
        return self.p, [[(at.astype(np.int32), x[at]) for x in pair for at in [np.flatnonzero(x)]] for pair in odds]

    def __setstate__(self, state: tuple) -> None:
        self.p, sparse = state
        odds = []
        for pair in sparse:
            dense = [np.zeros(1 << bits, np.float32) for bits in (ODDS_BITS, CHAR_BITS)]
            for x, (at, values) in zip(dense, pair, strict=True):
                x[at] = values
            odds.append(tuple(dense))
        (self.word_odds, self.char_odds), *self.without = odds

    def for_fold(self, fold: int) -> Network:
        """The network as texts of a fold may see it."""
        return Network(self.p, *self.without[fold])

    def trained(self) -> Network:
        return Network(self.p, self.word_odds, self.char_odds)

    @classmethod
    def fresh(cls, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape, scale=None):
            scale = scale or 1.0 / np.sqrt(shape[0])
            return (rng.normal(size=shape) * scale).astype(np.float32)

        size = WORD_DIM + CHAR_DIM + 2
        p = {
            "word": normal(1 << WORD_BITS, WORD_DIM, scale=0.1),
            "char": normal(1 << CHAR_BITS, CHAR_DIM, scale=0.3),
            "attend": normal(2 * STATE, ATTENTION),
            "shift": np.zeros(ATTENTION, np.float32),
            "query": normal(ATTENTION, 1)[:, 0],
            "out": normal(2 * STATE, 1)[:, 0],
            "bias": np.zeros(1, np.float32),
        }
        for way in "fb":
            p[way + "_in"] = normal(size, 3 * STATE)
            p[way + "_add"] = np.zeros(3 * STATE, np.float32)
            p[way + "_rec"] = normal(STATE, 3 * STATE)
        return cls(p)

    def inputs(self, vocabulary: Vocabulary) -> np.ndarray:
        chars = np.zeros((len(vocabulary.words), CHAR_DIM), np.float32)
        if len(vocabulary.words):
            sums = np.add.reduceat(self.p["char"][vocabulary.chars], vocabulary.starts, axis=0)
            chars = sums / vocabulary.sizes[:, None].astype(np.float32)
        words = self.p["word"][vocabulary.words] * vocabulary.seen
        odds = np.zeros((len(vocabulary.words), 2), np.float32)
        odds[:, 0] = self.word_odds[vocabulary.wide]
        if len(vocabulary.words):
            sums = np.add.reduceat(self.char_odds[vocabulary.chars], vocabulary.starts)
            odds[:, 1] = sums / vocabulary.sizes
        return np.concatenate([words, chars, odds], axis=1)

    def read(self, way: str, projected, index, lengths, trace=None) -> np.ndarray:
        """States (step, window, state) of one direction. ``index`` is (window, step)."""
        n, steps = index.shape
        rec = self.p[way + "_rec"]
        h = np.zeros((n, STATE), np.float32)
        out = np.zeros((steps, n, STATE), np.float32)
        order = range(steps) if way == "f" else range(steps - 1, -1, -1)
        full = int(lengths.min()) if n else 0
        for t in order:
            a = projected[index[:, t]]
            u = h @ rec
            gates = np.tanh(0.5 * (a[:, : 2 * STATE] + u[:, : 2 * STATE]))
            gates = 0.5 * gates + 0.5
            r, z = gates[:, :STATE], gates[:, STATE:]
            new = np.tanh(a[:, 2 * STATE :] + r * u[:, 2 * STATE :])
            if trace is not None:
                trace.append((t, h, r, z, new, u[:, 2 * STATE :]))
            stepped = new + z * (h - new)
            h = stepped if t < full else np.where((t < lengths)[:, None], stepped, h)
            out[t] = h
        return out

    def forward(self, vocabulary, index, lengths, keep=False):
        """Logits of windows; with ``keep`` also what the way back needs."""
        x = self.inputs(vocabulary)
        if not len(x):
            x = np.zeros((1, WORD_DIM + CHAR_DIM + 2), np.float32)
        traces = {"f": [] if keep else None, "b": [] if keep else None}
        states = []
        for way in "fb":
            projected = x @ self.p[way + "_in"] + self.p[way + "_add"]
            states.append(self.read(way, projected, index, lengths, traces[way]))
        h = np.concatenate(states, axis=2)
        s = np.tanh(h @ self.p["attend"] + self.p["shift"])
        e = s @ self.p["query"]
        inside = np.arange(len(h))[:, None] < lengths[None, :]
        e = np.where(inside, e, -1e9)
        w = np.exp(e - e.max(axis=0)) * inside
        alpha = w / np.maximum(w.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnk->nk", alpha, h)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, (x, traces, h, s, alpha, pooled)) if keep else logit

    def gradients(self, vocabulary, index, lengths, target, weight) -> dict[str, np.ndarray]:
        logit, (x, traces, h, s, alpha, pooled) = self.forward(vocabulary, index, lengths, True)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d = ((1.0 / (1.0 + np.exp(-logit)) - target) * weight / len(target)).astype(np.float32)
        g["out"], g["bias"][0] = pooled.T @ d, d.sum()
        d_pooled = d[:, None] * self.p["out"][None, :]
        d_alpha = np.einsum("nk,tnk->tn", d_pooled, h)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
        d_s = d_e[:, :, None] * self.p["query"] * (1.0 - s * s)
        g["query"] = np.einsum("tn,tnk->k", d_e, s)
        g["attend"], g["shift"] = np.einsum("tni,tnj->ij", h, d_s), d_s.sum(axis=(0, 1))
        d_h = alpha[:, :, None] * d_pooled[None] + d_s @ self.p["attend"].T
        d_x = np.zeros_like(x)
        for way, part in (("f", slice(0, STATE)), ("b", slice(STATE, 2 * STATE))):
            rec = self.p[way + "_rec"]
            back = np.zeros((len(target), STATE), np.float32)
            d_projected = np.zeros((len(x), 3 * STATE), np.float32)
            for t, before, r, z, new, u in reversed(traces[way]):
                live = (t < lengths)[:, None]
                dh = d_h[t][:, part] + back
                step = dh * live
                d_new = step * (1.0 - z) * (1.0 - new * new)
                d_r = d_new * u * r * (1.0 - r)
                d_z = step * (before - new) * z * (1.0 - z)
                d_u = np.concatenate([d_r, d_z, d_new * r], axis=1)
                back = np.where(live, step * z + d_u @ rec.T, dh)
                g[way + "_rec"] += before.T @ d_u
                np.add.at(d_projected, index[:, t], np.concatenate([d_r, d_z, d_new], axis=1))
            g[way + "_add"] = d_projected.sum(axis=0)
            g[way + "_in"] = x.T @ d_projected
            d_x += d_projected @ self.p[way + "_in"].T
        if len(vocabulary.words):
            np.add.at(g["word"], vocabulary.words, d_x[:, :WORD_DIM] * vocabulary.seen)
            share = d_x[:, WORD_DIM:-2] / vocabulary.sizes[:, None]
            np.add.at(g["char"], vocabulary.chars, np.repeat(share, vocabulary.sizes, axis=0))
        return g


def _batch(texts: list[bytes]) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """Windows, one per text, as (vocabulary, word index per window and step, lengths)."""
    vocabulary = Vocabulary(texts)
    lengths = np.array(vocabulary.counts)
    index = np.zeros((len(texts), max(1, int(lengths.max(initial=1)))), np.int64)
    index[np.arange(index.shape[1])[None, :] < lengths[:, None]] = vocabulary.index
    return vocabulary, index, lengths


def _split(items: list, firsts: np.ndarray) -> Iterator[list]:
    for lo, hi in zip(firsts, [*firsts[1:], len(items)], strict=True):
        yield items[lo:hi]


def surplus(found: list[np.ndarray], labels: np.ndarray, bits: int) -> np.ndarray:
    """Per hashed unit, between -1 and 1: toxic texts that hold it, beyond what chance
    gives, in standard deviations. Units of few texts say nothing and get 0."""
    every, toxic = np.zeros(1 << bits), np.zeros(1 << bits)
    for units, label in zip(found, labels, strict=True):
        every[units] += 1
        toxic[units] += label
    share = labels.mean()
    z = (toxic - share * every) / np.sqrt(np.maximum(every, 1) * share * (1 - share) + 1e-9)
    return np.where(every >= LEAST_TEXTS, np.tanh(z / 6.0), 0.0).astype(np.float32)


def train(texts: list[bytes], labels: np.ndarray, owners: list[int], seed: int = 5) -> Network:
    """Fit the network to windows; both classes weigh the same. Adam steps. ``owners``
    says which text a window is of; the windows of a text come together."""
    net, rng = Network.fresh(), np.random.default_rng(seed)
    firsts = np.flatnonzero(np.diff(owners, prepend=-1))
    # One text's vocabulary at a time: what stays of it are the units it holds.
    wide, chars = [], []
    for part in _split(texts, firsts):
        vocabulary = Vocabulary([b" ".join(part)])
        wide.append(np.unique(vocabulary.wide).astype(np.int32))
        chars.append(np.unique(vocabulary.chars).astype(np.int16))
    toxic, fold = labels[firsts], np.arange(len(firsts)) % FOLDS

    def odds(rows):
        return tuple(
            surplus([units[i] for i in rows], toxic[rows], bits)
            for units, bits in ((wide, ODDS_BITS), (chars, CHAR_BITS))
        )

    net.word_odds, net.char_odds = odds(np.arange(len(firsts)))
    net.without = [odds(np.flatnonzero(fold != f)) for f in range(FOLDS)]
    del wide, chars
    window_fold = np.asarray(owners) % FOLDS
    share = max(labels.mean(), 1e-9), max(1 - labels.mean(), 1e-9)
    weights = np.where(labels == 1, 0.5 / share[0], 0.5 / share[1]).astype(np.float32)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    # Small samples get more rounds, so that the steps taken do not vanish.
    steps = max(EPOCHS * len(texts) // BATCH, 250)
    pools = [np.flatnonzero(window_fold == f) for f in range(FOLDS)]
    pools = [(f, p) for f, p in enumerate(pools) if len(p)]
    for step in range(1, steps + 1):
        # A batch is of one fold, so that one set of odds holds for it.
        f, pool = pools[rng.choice(len(pools), p=[len(p) / len(texts) for _, p in pools])]
        pick = rng.choice(pool, min(BATCH, len(pool)), replace=False)
        seen = net.for_fold(f)
        vocabulary, index, lengths = _batch([texts[i] for i in pick])
        vocabulary.seen[rng.random(len(vocabulary.words)) < WORDLESS] = 0.0
        g = seen.gradients(vocabulary, index, lengths, labels[pick], weights[pick])
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        rate = RATE * (1.0 - 0.9 * step / steps) * min(1.0, 5.0 / max(norm, 1e-9))
        for k in net.p:
            first[k] = 0.9 * first[k] + 0.1 * g[k]
            second[k] = 0.999 * second[k] + 0.001 * g[k] * g[k]
            fixed = first[k] / (1 - 0.9**step)
            if k in ("word", "char"):
                net.p[k] *= 1.0 - DECAY * rate
            net.p[k] -= (rate * fixed / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def logits(net: Network, texts: list[bytes]) -> Iterator[tuple[float, float, int]]:
    """(highest logit, mean logit, windows) of whole texts."""
    vocabulary = Vocabulary(texts)
    counts = np.array(vocabulary.counts, np.int64)
    offset = np.cumsum(counts) - counts
    starts = [windows_of(int(n)) for n in counts]
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    lengths = np.minimum(counts[owner] - start, WINDOW)
    words = np.append(vocabulary.index, 0)
    out = np.zeros(len(owner), np.float64)
    # Full windows first: short ones need a mask at every step.
    order = np.argsort(-lengths, kind="stable")
    for lo in range(0, len(order), SCORED):
        part = order[lo : lo + SCORED]
        place = (offset[owner[part]] + start[part])[:, None] + np.arange(max(1, lengths[part].max()))
        index = words[np.minimum(place, len(words) - 1)]
        out[part] = net.forward(vocabulary, index, lengths[part])
    ends = np.cumsum([len(s) for s in starts]) if starts else []
    for lo, hi in zip([0, *ends[:-1]], ends, strict=True) if len(starts) else ():
        yield float(out[lo:hi].max()), float(out[lo:hi].mean()), int(hi - lo)


def _facts(rows: list[tuple[float, float, int]]) -> np.ndarray:
    a = np.array(rows, np.float64).reshape(-1, 3)
    return np.stack([a[:, 0], a[:, 1], np.log(a[:, 2]), np.ones(len(a))], axis=1)


def calibrate(facts: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a little shrinkage."""
    spread = np.array([*np.maximum(facts[:, :-1].std(axis=0), 1e-6), 1.0])
    x, w = facts / spread, np.zeros(facts.shape[1])
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weights * (p - labels)) + 0.1 * np.append(w[:-1], 0.0)
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag([0.1] * (len(w) - 1) + [1e-6])
        w -= np.linalg.solve(curve, slope)
    return w / spread


@dataclass
class Model:
    net: Network | None
    weights: np.ndarray
    prior: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.prior)
        logit = _facts(list(logits(self.net, texts))) @ self.weights
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))


def chunked(texts, most_bytes: int = 1 << 21):
    """Lists of folded texts of bounded size together; one long text may be alone."""
    held, size = [], 0
    for text in texts:
        folded = fold(text)
        held.append(folded)
        size += len(folded)
        if size >= most_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def held_out(key: Column) -> Column:
    """The fifth of all keys that no label is learned from."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled(labels: DataFrame) -> DataFrame:
    """One label per id outside the held-out fifth; toxic wins over clean."""
    known = labels.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def fit(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> Model:
    """Train on at most ``MOST_TOXIC`` and ``MOST_CLEAN`` labelled texts, drawn by a hash
    of their id, and ``MOST_WINDOWS`` windows of each. Labels that are null or neither 0
    nor 1 count for nothing; of several labels of an id the toxic one counts. Without both
    classes the model is the share of toxic labels."""
    known = labelled(labels)
    counts = {r.toxic: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    if len(counts) < 2:
        return Model(None, np.zeros(4), prior)
    sample = None
    for value, most in ((1, MOST_TOXIC), (0, MOST_CLEAN)):
        part = known.filter(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        sample = part if sample is None else sample.union(part)
    sample = sample.withColumnRenamed("doc_id", "_id")
    rows = df.select(col(key).cast("long").alias("doc_id"), col(text).alias("text"))
    # The sample has at most MOST_TOXIC + MOST_CLEAN rows.
    texts = rows.join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("doc_id", "toxic", "text")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, toxic, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = fold(body).split()
                starts = windows_of(len(words))
                if len(starts) > MOST_WINDOWS:
                    starts = np.random.default_rng(doc % (1 << 32)).permutation(starts)[:MOST_WINDOWS]
                joined = [b" ".join(words[s : s + WINDOW]).decode() for s in starts]
                out.append((doc, toxic, joined))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                 pa.array([o[2] for o in out], pa.list_(pa.string()))],
                names=["doc_id", "toxic", "windows"],
            )

    drawn = texts.mapInArrow(draw, "doc_id long, toxic int, windows array<string>")
    # Repeated ids give one row, so the sample stays bounded.
    drawn = drawn.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("windows").alias("windows"))
    got = sorted(drawn.collect(), key=lambda r: r.doc_id)
    train_texts = [w.encode() for r in got for w in r.windows]
    train_labels = np.array([r.toxic for r in got for _ in r.windows], np.float32)
    if len(set(train_labels.tolist())) < 2:
        return Model(None, np.zeros(4), prior)
    fold_of = {r.doc_id: i % FOLDS for i, r in enumerate(got)}
    owners = [i for i, r in enumerate(got) for _ in r.windows]
    del got, drawn
    net = train(train_texts, train_labels, owners)
    del train_texts, owners

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds = np.array([fold_of[d] for d in batch.column("doc_id").to_pylist()], np.int64)
            found = [(0.0, 0.0, 1)] * batch.num_rows
            for f in range(FOLDS):
                at = np.flatnonzero(folds == f)
                bodies = (batch.column("text")[i].as_py() for i in at.tolist())
                seen = (x for part in chunked(bodies) for x in logits(net.for_fold(f), part))
                for i, x in zip(at, seen, strict=True):
                    found[i] = x
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"),
                 *[pa.array([f[i] for f in found], pa.float64()) for i in range(3)]],
                names=["doc_id", "toxic", "top", "mean", "n"],
            )

    measured = texts.mapInArrow(measure, "doc_id long, toxic int, top double, mean double, n double")
    facts = measured.groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), *[F.max(c).alias(c) for c in ("top", "mean", "n")]
    )
    rows = sorted(facts.collect(), key=lambda r: r.doc_id)
    y = np.array([r.toxic for r in rows], np.float64)
    # The classes weigh as among all labels.
    drawn_share = max(y.mean(), 1e-9)
    weight = np.where(y == 1, prior / drawn_share, (1 - prior) / max(1 - drawn_share, 1e-9))
    return Model(net.trained(), calibrate(_facts([(r.top, r.mean, r["n"]) for r in rows]), y, weight), prior)


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the toxicity of each text, 0 to 1, as a last column ``name``.

    Null and empty texts are one empty window. Rows that repeat get equal scores; an
    empty frame stays empty; other columns are untouched whatever their names, and one
    called ``name`` is replaced.
    """
    keep = [c for c in df.columns if c != name]
    # The text travels once: as the column that stays, or beside the columns that stay.
    place = keep.index(text) if text in keep else len(keep)
    whole = df.select(*cols(keep), *([] if text in keep else [col(text).alias(hidden(df, "_body"))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = (t.as_py() for t in batch.column(place))
            done = 0
            for part in chunked(bodies):
                # A row per text, given out chunk by chunk.
                rows = batch.slice(done, len(part))
                done += len(part)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[: len(keep)], pa.array(model.scores(part), pa.float64())], names=[*keep, name]
                )

    schema = T.StructType([*df.select(*cols(keep)).schema, T.StructField(name, T.DoubleType())])
    return whole.mapInArrow(run, schema)


def without_toxic(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that score below one half, with the columns of ``df``."""
    model = fit(df, labels, text, key)
    name = hidden(df, "_toxicity")
    return score(df, model, text, name).filter(F.col(name) < 0.5).drop(name)


def op3(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's score, decision, and whether labels of it were held out."""
    model = fit(df, labels)
    scored = score(df.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
