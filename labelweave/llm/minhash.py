"""MinHash near-duplicates: one-permutation hashing with optimal densification.

A text's set is hashed once; the hash's leading part names one of ``BINS`` bins and the
least value of each bin is kept. An empty bin borrows from a bin drawn at random, again
until that one is not empty. Bins are banded; texts that agree in a band meet in a
bucket. A bucket yields a star: one hub against each member, so pairs grow with members
and not with their square. The hub is the member whose buckets are fullest, which in a
group of edited copies is the one they were made from.

Texts with equal sets are one node throughout, and links are confirmed on full sets.
Members of a bucket that the stars leave in different components are compared with one
another in blocks of bounded size, inside tasks that give out only links that join
components. So no link is lost but to banding: bands are as long as keeps the chance
that a pair at the threshold agrees in none below ``MISS``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from ..columns import col
from .frames import carried, frozen, row_keys, same_row, scanned, with_row_id
from .words import MIX_A, MIX_B, U, Hasher, mix

BINS = 252
# Most chance that banding misses a pair at the threshold.
MISS = 1e-6
# Bins that agree, below which a pair cannot plausibly reach the threshold: five
# standard deviations of the estimate.
SLACK = 5.0
# A block's most members and shingles.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000
AT_ONCE = 256  # rows of a batch made Python objects at once

_DRAWS = mix(
    (np.arange(BINS, dtype=U)[:, None] * MIX_A) ^ (np.arange(1, 257, dtype=U)[None, :] * MIX_B)
) % U(BINS)
_DRAWS = _DRAWS.astype(np.int64)


def shingles(hasher: Hasher, text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's runs of ``size`` words, A-Z lower-cased; of
    all its words as one run if there are fewer, of nothing if there are none."""
    words = hasher.words((text or "").encode(), lower=True)
    if not len(words):
        return words
    return np.unique(hasher.windows(words, min(size, len(words)), seed=1))


def signature(values: np.ndarray) -> np.ndarray:
    """One value per bin of a set that is not empty."""
    high = (values >> U(32)) * U(BINS) >> U(32)
    out = np.full(BINS, np.iinfo(np.uint64).max, U)
    order = np.argsort(high, kind="stable")
    bins, first = np.unique(high[order], return_index=True)
    scrambled = mix(values[order] ^ MIX_B)
    filled = np.zeros(BINS, bool)
    filled[bins.astype(np.int64)] = True
    out[bins.astype(np.int64)] = np.minimum.reduceat(scrambled, first)
    empty = np.flatnonzero(~filled)
    given = out.copy()
    turn = 0
    while len(empty):
        if turn < _DRAWS.shape[1]:
            donor = _DRAWS[empty, turn]
        else:
            seed = U((turn + 1) * int(MIX_B) % (1 << 64))
            donor = (mix(empty.astype(U) * MIX_A ^ seed) % U(BINS)).astype(np.int64)
        found = filled[donor]
        out[empty[found]] = given[donor[found]]
        empty = empty[~found]
        turn += 1
    return out


def band_rows(percent: int) -> int:
    """Bins per band for a threshold."""
    share = percent / 100
    fine = [r for r in range(1, 17) if (1 - share**r) ** (BINS // r) <= MISS]
    return max(fine, default=1)


def bands_of(sig: np.ndarray, rows: int) -> np.ndarray:
    return sig[: BINS // rows * rows].reshape(-1, rows)


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    weights = mix(np.arange(1, rows + 1, dtype=U) * MIX_A)
    sums = (bands_of(sig, rows) * weights).sum(axis=1, dtype=U)
    return mix(sums + np.arange(len(sums), dtype=U) * MIX_B)


_SIGNED = "rid_a long, rid_b long, doc_id long, n_shingles long, node binary, bands array<long>"


def _sign(size: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            count, nodes, bands = [], [], []
            for text in batch.column("text"):
                values = shingles(hasher, text.as_py(), size)
                count.append(len(values))
                if len(values):
                    nodes.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(signature(values), rows).view(np.int64))
                else:
                    nodes.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid_a"), batch.column("rid_b"), batch.column("doc_id"),
                    pa.array(count, pa.int64()), pa.array(nodes, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["rid_a", "rid_b", "doc_id", "n_shingles", "node", "bands"],
            )

    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    least, most = sorted((len(a), len(b)))
    if 100 * least < percent * most:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(size: int, percent: int):
    """Pairs (u, v) whose full sets are similar enough; equal ``u`` come together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        last, held = None, None
        for batch in batches:
            u, v = batch.column("u").to_pylist(), batch.column("v").to_pylist()
            texts_u, texts_v = batch.column("text_u"), batch.column("text_v")
            keep = []
            for i in range(batch.num_rows):
                if u[i] != last:
                    last, held = u[i], shingles(hasher, texts_u[i].as_py(), size)
                if _similar(held, shingles(hasher, texts_v[i].as_py(), size), percent):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([u[i] for i in keep], pa.binary()),
                    pa.array([v[i] for i in keep], pa.binary()),
                ],
                names=["u", "v"],
            )

    return run


def _groups(batches: Iterator[pa.RecordBatch]):
    """Rows of one (bucket, i, j) at a time; they come sorted."""
    held, last = [], None
    for batch in batches:
        for lo in range(0, batch.num_rows, AT_ONCE):
            for row in batch.slice(lo, AT_ONCE).to_pylist():
                now = (row["bucket"], row["i"], row["j"])
                if held and now != last:
                    yield held
                    held = []
                last = now
                held.append(row)
    if held:
        yield held


def _compare(size: int, percent: int):
    """Links between members of a block pair that join components not yet joined."""
    share, per_band = percent / 100, band_rows(percent)
    floor = BINS * share - SLACK * np.sqrt(BINS * share * (1 - share))

    def links(rows, hasher):
        sets = [shingles(hasher, r["text"], size) for r in rows]
        full = np.stack([signature(s) for s in sets])
        sigs = full.astype(np.uint8)
        counts = np.array([len(s) for s in sets])
        block = np.array([r["block"] for r in rows])
        cross = rows[0]["i"] != rows[0]["j"]
        names, group = np.unique([r["comp"] for r in rows], return_inverse=True)
        group = group.astype(np.int64)
        mine = rows[0]["bucket"]
        for a in range(len(rows) - 1):
            others = np.arange(a + 1, len(rows))
            fits = (group[others] != group[a]) & (
                100 * np.minimum(counts[others], counts[a])
                >= percent * np.maximum(counts[others], counts[a])
            )
            if cross:
                fits &= block[others] != block[a]
            others = others[fits]
            if not len(others):
                continue
            agree = (sigs[others] == sigs[a]).sum(axis=1)
            for b in others[agree >= floor]:
                if group[b] == group[a]:
                    continue
                # A pair that meets in several buckets is compared in the first.
                same = bands_of(full[a] == full[b], per_band).all(axis=1)
                if band_keys(full[a], per_band).view(np.int64)[int(np.argmax(same))] != mine:
                    continue
                if _similar(sets[a], sets[b], percent):
                    group[group == group[b]] = group[a]
                    yield rows[a]["node"], rows[b]["node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for rows in _groups(batches):
            found = list(links(rows, hasher))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x for x, _ in found], pa.binary()),
                    pa.array([y for _, y in found], pa.binary()),
                ],
                names=["u", "v"],
            )

    return run


def near_duplicates(
    df: DataFrame, text: str = "text", key: str = "doc_id", size: int = 5, percent: int = 80
) -> DataFrame:
    """``rid_a``, ``rid_b``, the key as ``doc_id``, ``n_shingles``, ``component_id`` and
    ``node`` (null without words) and ``comp``, the component's name, of every row.

    Two rows are linked if ``100 * |A & B| >= percent * |A | B|`` for their sets of
    distinct word runs. ``component_id`` is the smallest key that links reach, the own
    key included; null keys come into it only if all are null. Null and empty texts have
    no set, ``n_shingles`` 0, and are linked with nothing. Rows that repeat are linked
    with each other. An empty frame gives an empty frame.
    """
    rows = with_row_id(scanned(df), doc_id=col(key).cast("long"), text=text)
    signed = frozen(rows.mapInArrow(_sign(size, band_rows(percent)), _SIGNED), "signed")
    nodes = frozen(
        signed.filter("node is not null")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("rid_a", "rid_b")).alias("rid"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        ),
        "nodes",
    )
    cells = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = cells.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = frozen(cells.join(sizes, "bucket"), "members")

    # The fullest member of each bucket is its hub.
    fill = members.groupBy("node").agg(F.sum("members").alias("fill"))
    filled = members.join(fill, "node")
    hubs = filled.groupBy("bucket").agg(F.max(F.struct("fill", "node"))["node"].alias("hub"))
    starred = frozen(members.join(hubs, "bucket"), "starred")
    pairs = starred.filter("node != hub").select(F.col("hub").alias("u"), F.col("node").alias("v"))

    # One text per node that shares a bucket.
    wanted = (
        members.select("node").distinct().join(nodes.select("node", "rid", "n_shingles"), "node")
        .select("node", "n_shingles", F.col("rid.rid_a").alias("_a"), F.col("rid.rid_b").alias("_b"))
    )
    texts = frozen(
        rows.join(wanted, same_row()).select(
            "node", "n_shingles", "text"
        ),
        "texts",
    )
    ends_v = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    ends_u = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    checked = pairs.distinct().join(ends_v, "v").join(ends_u, "u")
    links = frozen(checked.mapInArrow(_verify(size, percent), "u binary, v binary"), "links")
    comps = frozen(components(links), "comps")

    more = frozen(_leftovers(starred, comps, texts, size, percent), "more")
    if more.limit(1).count():
        comps = frozen(components(links.union(more)), "comps")
    return _labelled(signed, nodes, comps)


def _leftovers(starred, comps, texts, size, percent):
    """Links inside buckets whose members, hub aside, lie in several components."""
    placed = (
        starred.filter("node != hub")
        .join(comps, "node", "left")
        .select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
    )
    open_ = (
        placed.groupBy("bucket")
        .agg(F.min("comp").alias("a"), F.max("comp").alias("b"))
        .filter("a != b")
        .select("bucket")
    )
    rest = frozen(placed.join(open_, "bucket").join(texts.select("node", "n_shingles"), "node"), "rest")
    blocks = rest.groupBy("bucket").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
        ).cast("int").alias("blocks")
    )
    cut = rest.join(blocks, "bucket").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    # A block meets every block, itself included.
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "node",
        "comp",
    )
    tasks = int(starred.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        met.join(texts.select("node", "text"), "node")
        .repartition(tasks, "bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j")
        .mapInArrow(_compare(size, percent), "u binary, v binary")
    )


def _labelled(signed: DataFrame, nodes: DataFrame, comps: DataFrame) -> DataFrame:
    grouped = nodes.select("node", "least_id", "copies").join(comps, "node", "left")
    grouped = grouped.filter("copies > 1 or comp is not null").select(
        "node", F.coalesce("comp", "node").alias("comp"), "least_id"
    )
    least = grouped.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    named = grouped.select("node", "comp").join(least, "comp")
    out = signed.select("rid_a", "rid_b", "doc_id", "n_shingles", "node")
    return out.join(named, "node", "left").select(
        "rid_a",
        "rid_b",
        "doc_id",
        "n_shingles",
        # A null means that nothing but the row itself is in its component.
        F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "node",
        F.coalesce("comp", "node").alias("comp"),
    )


def keep_one(df: DataFrame, text: str = "text", key: str = "doc_id", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df``, one of each component: the one with the smallest key, of
    several the first by row id. Rows without words all stay. Columns are those of ``df``."""
    scan = scanned(df)
    found = near_duplicates(scan, text, key, size, percent)
    first = (
        found.filter("comp is not null")
        .groupBy("comp")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid_a", "rid_b")).alias("pick"))
        .select(F.col("pick.rid_a").alias("_a"), F.col("pick.rid_b").alias("_b"))
    )
    alone = found.filter("comp is null").select(*row_keys())
    return carried(scan).join(first.union(alone), same_row(), "left_semi").select("row.*")


def op9(df: DataFrame) -> DataFrame:
    """Per document: set size, smallest id of its component, whether it is that one."""
    found = near_duplicates(df, size=3, percent=85)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


OP9_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 3
        THEN [array_to_string(w, ' ')] ELSE [w[i] || ' ' || w[i+1] || ' ' || w[i+2]
        FOR i IN range(1, len(w) - 1)] END) AS x FROM d),
n AS (SELECT doc_id, len(x) AS n FROM s),
e AS MATERIALIZED (SELECT doc_id, unnest(x) AS g FROM s),
p AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
      FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT u, v FROM p JOIN n a ON u = a.doc_id JOIN n b ON v = b.doc_id
      WHERE 100 * shared >= 85 * (a.n + b.n - shared)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.v FROM r JOIN l ON r.y = l.u)
SELECT doc_id, n::BIGINT AS n_shingles, c AS component_id, doc_id = c AS kept
FROM n JOIN (SELECT x, min(y) AS c FROM r GROUP BY x) ON x = doc_id
"""
