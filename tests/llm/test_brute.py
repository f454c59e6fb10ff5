"""Queries without SQL against brute force, known answers or held-out labels."""

import html
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from labelweave.llm import minhash, mixing, sharding, toxicity
from labelweave.llm.frames import documents, frozen, table
from labelweave.llm.pages import block_texts, parse, together, trained
from labelweave.llm.registry import QUERIES
from labelweave.llm.words import Hasher

SF, LARGER, LARGEST = (f"/root/testdata/sf{x}" for x in ("0.001", "0.01", "0.1"))


def read(sf, columns, name):
    return duckdb.connect().execute(f"SELECT {columns} FROM '{sf}/{name}.parquet'").fetchall()


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in words]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def groups(rows, size, percent):
    """Smallest id of each id's component, all pairs compared."""
    sets = {d: shingles(t, size) for d, t in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(d for d in sets if sets[d])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in sets}


def test_mixing_reaches_its_targets(spark):
    rows = mixing.op1(documents(spark, LARGER)).collect()
    again = mixing.op1(documents(spark, LARGER)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    source = dict(read(LARGER, "doc_id, source", "documents"))
    taken, target, largest, size = defaultdict(int), {}, defaultdict(int), {}
    for r in rows:
        s = source[r.doc_id]
        taken[s] += r.taken
        target[s], size[s] = r.target, r.source_size
        largest[s] = max(largest[s], r.size)
        assert r.taken in (0, r.size, 2 * r.size)
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    for s in target:
        assert target[s] <= 2 * size[s]
        assert abs(taken[s] - target[s]) <= max(largest[s] / 2, 0.01 * target[s])


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, size, percent):
    rows = read(SF, "doc_id, text", "documents")
    found = minhash.near_duplicates(documents(spark, SF), size=size, percent=percent).collect()
    want = groups(rows, size, percent)
    assert {r.doc_id: r.component_id for r in found} == want
    assert len(set(want.values())) < len(rows)


def test_near_copies_that_only_meet_each_other(spark):
    # A chain: each text is near the next, its ends are far apart, and all share bands.
    words = [f"w{i}" for i in range(400)]
    chain = [" ".join([*words[5 * k :], *(f"x{i}" for i in range(5 * k))]) for k in range(12)]
    rows = list(enumerate(chain * 2))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.op9(df).collect()
    assert {r.doc_id: r.component_id for r in got} == groups(rows, 3, 85)


def test_word_hashes():
    hasher = Hasher()
    text = "a bb\tccc  a\nbb " + "long" * 500 + " é é"
    words = text.encode().split()
    hashes = hasher.words(text.encode())
    assert len(hashes) == len(words)
    assert [words.index(w) for w in words] == [hashes.tolist().index(h) for h in hashes.tolist()]
    pairs = hasher.windows(hashes, 2)
    assert pairs[0] == pairs[3] and len(set(pairs.tolist())) == len(words) - 2
    assert hasher.windows(hashes, len(words) + 1).size == 0


def scalar_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    keys = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    for shards in (1, 8, 9, 1000):
        assert sharding.jump(keys, shards).tolist() == [scalar_jump(int(k), shards) for k in keys]
    rows = QUERIES["op10_jump_sharding"](spark, LARGER).collect()
    texts = dict(read(LARGER, "doc_id, text", "documents"))
    assert len(rows) == len(texts)
    sizes = Counter(r.shard for r in rows)
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    assert max(sizes.values()) < 1.4 * min(sizes.values()) and len(sizes) == 8
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        assert r.grown_shard in (r.shard, 8)
    assert 0 < sum(r.grown_shard == 8 for r in rows) < len(rows) / 5


def test_toxicity_on_held_out_labels(spark):
    toxic = dict(read(LARGEST, "doc_id, toxic", "labels"))
    rows = QUERIES["op3_gated_toxicity"](spark, LARGEST).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    known = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    bad = [s for s, t in known if t]
    good = [s for s, t in known if not t]
    ranked = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert ranked > 0.94
    assert np.mean([(s >= 0.5) == bool(t) for s, t in known]) > 0.96


def test_long_words_are_read_whole():
    long = "\u3042\u4e00b" * 400
    ends = [long + end for end in ("\u6bd2\u6bd2\u6bd2", "\u826f\u3044\u65e5", "abc", "abd")]
    net = toxicity.Network.fresh()
    top = [x[1] for x in toxicity.logits(net, [toxicity.fold(t) for t in ends])]
    assert len({round(x, 6) for x in top}) == len(ends)
    for text in [*ends, "x" * 65, "\U0001f600" * 50]:
        pieces = toxicity.fold(text).split()
        body, whole = text.encode(), b" ".join(pieces)
        assert max(map(len, pieces)) <= 64 and whole.decode()
        assert all(any(body[i : i + 3] in p for p in pieces) for i in range(len(body) - 2))


def test_gradients_are_right():
    texts = [b"some words here", b"other words", b"one", b"words and more words to read"]
    net = toxicity.Network.fresh()
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    vocabulary, index, lengths = toxicity._batch(texts)
    y, w = np.array([1.0, 0.0, 1.0, 0.0]), np.ones(4)

    def loss():
        z = net.forward(vocabulary, index, lengths).astype(np.float64)
        return float(np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y)))

    g = net.gradients(vocabulary, index, lengths, y, w)
    rng = np.random.default_rng(0)
    for name, value in net.p.items():
        flat, slope = value.reshape(-1), g[name].reshape(-1)
        for i in rng.choice(np.flatnonzero(slope), min(3, np.count_nonzero(slope)), replace=False):
            before, step = flat[i], 1e-2
            flat[i] = before + step
            up = loss()
            flat[i] = before - step
            down = loss()
            flat[i] = before
            assert slope[i] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-4), name


def test_page_text(spark):
    got = {r.page_id: r for r in QUERIES["op4_tree_extraction"](spark, LARGER).collect()}
    pages = read(LARGER, "page_id, html", "pages")
    assert len(got) == len(pages)
    for i, page in pages:
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = [
            " ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split())
            for b in re.split("</?(?:p|h1)>", article)
        ]
        want = " ".join(b for b in blocks if b)
        assert got[i].text == want and got[i].n_chars == len(want)


def test_features_see_whole_blocks():
    from labelweave.llm.pages import _OWN, features

    spans = "".join(f"<span>word{i} </span>" for i in range(60))
    ends, open_ = (features(parse(f"<body><p>{spans}and{mark}</p></body>"))[0][-1] for mark in (".", ""))
    assert ends[_OWN + 4] == 1 and open_[_OWN + 4] == 0
    late = features(parse(f"<body><p>{'long ' * 200}© us</p></body>"))[0][-1]
    assert late[_OWN + 5] == 1


def test_messages_give_exact_marginals():
    model = trained()
    nodes = parse("<body><nav><a href=/>x</a></nav><article><h1>A b</h1><p>Some text, here.</p></article>")
    x, pairs, parents, depth, _ = together([nodes])
    p, joint, log_z = model.marginals(x, pairs, parents, depth)
    unary, edge = x @ model.node, pairs @ model.pair
    total, ones = 0.0, np.zeros(len(nodes))
    for state in range(1 << len(nodes)):
        y = [(state >> i) & 1 for i in range(len(nodes))]
        score = sum(unary[i] for i in range(len(nodes)) if y[i])
        for i in range(1, len(nodes)):
            score += (0.0, *edge[i])[2 * y[parents[i]] + y[i]]
        total += np.exp(score)
        ones += np.exp(score) * np.array(y)
    assert p == pytest.approx(ones / total)
    assert log_z == pytest.approx(np.log(total))
    assert block_texts(nodes, p >= 0.5) == "A b Some text, here."


def test_neighbours_recall(spark):
    rows = read(LARGER, "vec_id, embedding", "embeddings")
    ids, v = np.array([i for i, _ in rows]), np.array([e for _, e in rows], float)
    got = defaultdict(list)
    for r in QUERIES["op6_neighbour_descent"](spark, LARGER).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == {int(i) for i in ids if i % 100 == 0}
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((v - v[ids == q]) ** 2).sum(axis=1))
        assert [s for _, _, s in sorted(found)] == pytest.approx([d[ids == i][0] for _, i, _ in sorted(found)])
        best = [int(ids[k]) for k in np.lexsort((ids, d)) if ids[k] != q][:10]
        hits += len(set(best) & {i for _, i, _ in found})
        assert [n for n, _, _ in sorted(found)] == list(range(1, 11))
    assert hits >= 0.95 * 10 * len(got)


def test_no_query_meets_a_vector_twice(spark, monkeypatch):
    """Narrow beams drop much, and are widened."""
    from labelweave.llm import neighbours
    from labelweave.session import shared_folder

    monkeypatch.setattr(neighbours, "BEAM", 12)
    monkeypatch.setattr(neighbours, "RECALL", 1.0)
    met = []
    rng = np.random.default_rng(11)
    df = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1500, 24)))], "node long, vector array<double>"
    )
    nodes = frozen(df, "nodes")
    graph = frozen(neighbours.build_graph(nodes), "graph")
    step = neighbours._step

    def spy(kind):
        run = step(kind)
        folder = shared_folder(spark, "met")
        met.append(folder)

        def noted(batches):
            import os
            import uuid

            os.makedirs(folder, exist_ok=True)
            for batch in run(batches):
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                    out.writelines(f"{q} {n}\n" for q, n in zip(*(batch.column(c).to_pylist() for c in ("query", "node"))))
                yield batch

        return noted

    monkeypatch.setattr(neighbours, "_step", spy)
    queries = nodes.filter("node % 100 = 0").selectExpr("node AS query")
    found = neighbours.walk(graph, queries, "f8", 10)
    pairs = spark.read.text(met).select("value")
    assert pairs.count() == pairs.distinct().count() > 0
    assert found.groupBy("query").count().filter("count >= 11").count() == 15


@pytest.mark.parametrize("noise", [None, 1e-4])
def test_neighbours_of_near_copies(spark, noise):
    """Thousands of near copies of one vector, and vectors without any structure."""
    from labelweave.llm.neighbours import search

    rng = np.random.default_rng(5)
    v = rng.normal(size=(4000, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    if noise:
        v[:3000] = v[0] + rng.normal(size=(3000, 64)) * noise * np.abs(v[0]).max()
    rows = [(n, x.tolist()) for n, x in enumerate(v)]
    df = frozen(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "copies")
    got = defaultdict(set)
    for r in search(df, lambda i: i % 50 == 0).collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, 4000, 50):
        d = ((v - v[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10].tolist()) & got[q])
    assert hits >= 0.95 * 10 * 80


def test_a_group_offers_all_that_a_list_can_take():
    import pyarrow as pa

    from labelweave.llm import neighbours

    n = 30
    v = np.random.default_rng(1).normal(size=(n, 8))
    group = pa.RecordBatch.from_pydict({
        "hub": np.zeros(n, np.int64), "member": np.arange(n), "fresh": np.ones(n, bool),
        "code": [x.tobytes() for x in v], "worst": np.full(n, np.inf),
    })
    offers = [b.to_pydict() for b in neighbours._meet("f8")([group])]
    got = {pair for o in offers for pair in zip(o["node"], o["other"], strict=True)}
    d = ((v[:, None] - v[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    assert got == {(i, int(j)) for i in range(n) for j in np.argsort(d[i])[: neighbours.K]}


def _parts_of(neighbours, v, near, dist, fresh, parts):
    """Lists as letters of their parts."""
    nodes = np.arange(len(v))
    rows = []
    for part, at in neighbours._split(neighbours._part(nodes, parts)):
        rows.append((part, neighbours.LISTS, 0, nodes[at], v[at], near[at], dist[at], fresh[at]))
    return list(neighbours._letters(rows))


def _delivered(batches):
    import pyarrow as pa

    table = pa.Table.from_batches(batches).sort_by([("part", "ascending"), ("kind", "ascending")])
    return table.to_batches(max_chunksize=7)


def test_a_round_sends_a_vector_to_a_part_once():
    """All pairs that a round compares by brute force are offered, and no part is sent a
    member's vector for each of its groups."""
    from labelweave.llm import neighbours

    n, most, parts = 400, 6, 3
    rng = np.random.default_rng(8)
    v = rng.normal(size=(n, 16))
    near = np.array([rng.choice(np.delete(np.arange(n), i), most, replace=False) for i in range(n)])
    dist = ((v[:, None] - v[near]) ** 2).sum(axis=2)
    order = np.argsort(dist, axis=1)
    near, dist = np.take_along_axis(near, order, 1), np.take_along_axis(dist, order, 1)
    fresh = rng.random((n, most)) < 0.2
    graph = _parts_of(neighbours, v, near, dist, fresh, parts)
    met = list(neighbours._gathered(parts, most)(_delivered(neighbours._edges(parts, most, False)(graph))))
    kinds = [np.array(b.column("kind")) for b in met]
    wanted = [b.filter(k == neighbours.WANTED) for b, k in zip(met, kinds, strict=True)]
    groups = [b.filter(k == neighbours.GROUPS) for b, k in zip(met, kinds, strict=True)]
    vectors = list(neighbours._sent(most)(_delivered([*graph, *wanted])))
    sent = [(r[0], int(x)) for r in neighbours._opened(vectors) for x in np.frombuffer(r[3], np.int64)]
    assert len(sent) == len(set(sent)) <= parts * n
    flat = neighbours._meet("f8", most)(neighbours._groups(_delivered([*vectors, *groups])))
    got = defaultdict(dict)
    for batch in flat:
        for x, y, d in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got[x][y] = d
    hubs = defaultdict(dict)
    for x in range(n):
        for y, new in zip(near[x].tolist(), fresh[x].tolist(), strict=True):
            hubs[x][y] = hubs[x].get(y, False) or new
    back = defaultdict(list)
    for x in range(n):
        for y, d, new in zip(near[x].tolist(), dist[x].tolist(), fresh[x].tolist(), strict=True):
            back[y].append((d, x, new))
    for y, admirers in back.items():
        for _, x, new in sorted(admirers)[: 2 * most]:
            hubs[y][x] = hubs[y].get(x, False) or new
    want = defaultdict(dict)
    for members in hubs.values():
        for x, a in members.items():
            for y, b in members.items():
                d = ((v[x] - v[y]) ** 2).sum()
                if x != y and (a or b) and d <= dist[x, -1] * (1 + 1e-12):
                    want[x][y] = d
    for x in range(n):
        best = dict(sorted(want[x].items(), key=lambda e: e[1])[:most])
        assert got[x] == pytest.approx(best)


@pytest.mark.parametrize("scale", [1.0, 1e-25, 1e25])
@pytest.mark.parametrize("noise", [None, 1e-7])
def test_blocks_hold_the_nearest(scale, noise):
    """Pairs are screened in single precision; what they are compared by is exact."""
    from labelweave.llm import neighbours

    rng = np.random.default_rng(4)
    n, most = 700, 9
    v = rng.normal(size=(n, 12))
    if noise:
        v[:300] = v[0] + noise * rng.normal(size=(300, 12))
    v *= scale
    d = np.array([((v - x) ** 2).sum(axis=1) for x in v])
    np.fill_diagonal(d, np.inf)
    worst = np.where(np.arange(n) % 2, np.inf, np.sort(d, axis=1)[:, 20])
    rows = [(5, neighbours.EDGES, 0, np.arange(at, at + 100), v[at : at + 100], worst[at : at + 100]) for at in range(0, n, 100)]
    got = defaultdict(dict)
    for batch in neighbours._first("f8", most)(list(neighbours._letters(rows))):
        for x, y, far in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got[x][y] = far
    for x in range(n):
        assert sorted(got[x].values()) == pytest.approx(np.sort(d[x])[:most], rel=1e-6, abs=0)


def test_letters_do_not_grow_with_the_tasks(spark):
    """A small table in many tasks is kept in few parts, as every part writes to every other."""
    from labelweave.llm import neighbours

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    try:
        df = spark.range(1)
        assert neighbours._parts(df, 10_000, 1000) == 10
        assert neighbours._parts(df, 0, 1000) == 1
        assert neighbours._parts(df, 10_000_000, 100_000) == -(-10_000_000 * 100_000 // neighbours.PART_BYTES)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_lists_grow_with_the_vectors(spark, monkeypatch):
    """Lists of one length hold a smaller share of the neighbours of more vectors."""
    from labelweave.llm import neighbours

    monkeypatch.setattr(neighbours, "ROOMY", 150)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(1200, 32))
    nodes = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "node long, vector array<double>")
    rows = neighbours.build_graph(frozen(nodes, "nodes")).collect()
    most = neighbours.K + 3 * neighbours.MORE
    hits = 0
    for r in rows:
        assert len(set(r.near)) == most and r.node not in r.near and r.dist == sorted(r.dist)
        d = ((v - v[r.node]) ** 2).sum(axis=1)
        assert r.dist == pytest.approx(d[r.near])
        d[r.node] = np.inf
        hits += len(set(np.argsort(d)[:10].tolist()) & set(r.near))
    assert len(rows) == 1200 and hits >= 0.9 * 10 * 1200


def holds(text, item):
    def fold(t):
        return "".join(c if ord(c) > 127 or c.isalnum() else " " for c in t.lower()).split()

    a, b = fold(text or ""), fold(item or "")
    return len(b) >= 4 and any(a[i : i + len(b)] == b for i in range(len(a) - len(b) + 1))


def test_leaks(spark):
    items = read(LARGER, "item_id, text", "benchmark")
    docs = read(LARGER, "doc_id, text", "documents")
    rows = QUERIES["op8_latent_decontamination"](spark, LARGER).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(d, i) for d, t in docs for i, b in items if holds(t, b)}


def test_paraphrases_and_answers(spark):
    item = [f"word{i}" for i in range(30)]
    noise = [f"noise{i}" for i in range(400)]

    def doc(words):
        return " ".join([*noise[:200], *words, *noise[200:]])

    loose = [w if i % 3 else f"other{i}" for i, w in enumerate(item[:22])] + item[22:]
    texts = [
        doc(item),
        doc([w if i % 6 else f"other{i}" for i, w in enumerate(item)]),  # five sixths, in order
        doc(loose),  # less, but with the whole answer
        doc(loose[:22] + [f"else{i}" for i in range(8)]),  # without it
        doc(item[::-1]),  # same words, other order
        doc(item[:12]),
    ]
    from labelweave.llm.decontamination import op8

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "nothing like it in any of those")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in op8(docs, bench).collect()} == {(0, 7), (1, 7), (2, 7)}


@pytest.mark.parametrize("cosine", [0.5, 2.0])
def test_a_paraphrase_that_only_the_latent_space_finds(spark, monkeypatch, cosine):
    """Other words of the item's topic, few of its own, and its answer."""
    from labelweave.llm import decontamination

    monkeypatch.setattr(decontamination, "RANK", 6)
    monkeypatch.setattr(decontamination, "COSINE", cosine)
    rng = np.random.default_rng(5)
    common = [f"c{i}" for i in range(40)]
    items = [
        [f"t{k % 4}x{i}" for i in sorted(rng.choice(40, 22, replace=False))] + rng.choice(common, 8, replace=False).tolist()
        for k in range(60)
    ]
    topic = [f"t0x{i}" for i in range(40) if f"t0x{i}" not in items[0]]
    own = items[0][:22:4]
    near = [w for pair in zip(topic, own + [""] * len(topic)) for w in pair if w][: len(topic) + len(own)]
    assert 0.4 * 30 <= len(own) + 8 < 0.6 * 30
    plain = [f"p{i % 9}" for i in range(60)]
    hosts = [plain + near + items[0][22:] + plain] + [plain] * 200
    hosts += [rng.choice(common, 30).tolist() for _ in range(300)]
    docs = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(hosts)], "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.op8(docs, bench).collect()}
    assert ((0, 0) in got) == (cosine < 1)


def test_every_passage_shapes_the_latent_space(spark, monkeypatch):
    """The rows that the space is fitted on hold each word of each text, by its weight."""
    from labelweave.llm import decontamination

    shaped = []

    def spy(passages, vocab, idf, rank):
        rows = passages.mapInArrow(decontamination._matrix(vocab, idf), decontamination._MATRIX)
        shaped.append((rows.collect(), len(vocab)))
        return latent_space(passages, vocab, idf, rank)

    latent_space = decontamination.latent_space
    monkeypatch.setattr(decontamination, "latent_space", spy)
    # Far more texts than a space needs, the first one of many passages.
    texts = [" ".join(f"a{i % 50}" for i in range(1000)), *["a1 a2 b b b b"] * 5000, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(f"a{i}" for i in range(50)))], "item_id long, text string")
    assert decontamination.op8(docs, bench).select("item_id").collect() == [(7,)]
    [(blocks, known)] = shaped
    assert known == 50
    dense = []
    for r in blocks:
        a = np.zeros((r.n, len(np.frombuffer(r["at"], np.int32))))
        a[np.frombuffer(r["row"], np.int32), np.frombuffer(r["col"], np.int32)] = np.frombuffer(r["w"], np.float32)
        dense += (a**2).sum(axis=1).tolist()
    # Sixteen passages of the first text, one of each other, one of the item; texts together
    # weigh as much as the items.
    assert len(dense) == 16 + 5000 + 1
    assert sorted(dense)[-1] == pytest.approx(1) and sum(dense) == pytest.approx(2, rel=1e-4)


def test_large_benchmark(spark):
    """Every one of 2,000 items in a host is found, also one of common words among rare ones."""
    from labelweave.llm.decontamination import op8

    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(6000)]
    odds = 1.0 / np.arange(10, 6010)
    odds /= odds.sum()

    def passage(n):
        return [words[i] for i in rng.choice(6000, n, p=odds)]

    items = [passage(int(rng.integers(16, 61))) for _ in range(2000)]
    hosts = [passage(150) + item + passage(150) for item in items]
    plain = [f"w{i}" for i in range(20)]
    rare = [f"rare{i}" for i in range(400)]
    items.append(plain)
    hosts.append(rare[:200] + plain + rare[200:])
    hosts += [plain] * 300
    text = [(n, " ".join(w)) for n, w in enumerate(hosts)]
    docs = frozen(spark.createDataFrame(text, "doc_id long, text string"), "hosts")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in op8(docs, bench).collect()}
    assert {(n, n) for n in range(len(items))} <= got


def test_pipeline(spark):
    """Every stage against what it must do with what it was given."""
    docs, seen = documents(spark, SF), {}
    for name, stage in corpus_pipeline.STAGES:
        out = frozen(stage(spark, docs, SF), name)
        seen[name] = (docs.collect(), out.collect())
        docs = out
    # The same network judges alone.
    given, kept = seen["toxicity"]
    scores = toxicity.op3(documents(spark, SF), table(spark, SF, "labels")).collect()
    fine = {r.doc_id for r in scores if r.predicted == 0}
    assert sorted(map(tuple, kept)) == sorted(tuple(r) for r in given if r.doc_id in fine)
    given, kept = seen["near_duplicates"]
    want = set(groups([(r.doc_id, r.text) for r in given], 5, 80).values())
    assert sorted(r.doc_id for r in kept) == sorted(want)
    given, kept = seen["decontamination"]
    items = [t for _, t in read(SF, "item_id, text", "benchmark")]
    clean = [r for r in given if not any(holds(r.text, i) for i in items)]
    assert sorted(map(tuple, kept)) == sorted(map(tuple, clean))
    given, kept = seen["mixing"]
    copies = Counter(map(tuple, kept))
    assert set(copies) <= set(map(tuple, given)) and max(copies.values()) <= 2
    words = {s: sum(len((r.text or "").split()) for r in given if r.source == s) for s in {r.source for r in given}}
    mixed = sum(len((r.text or "").split()) for r in kept)
    assert mixed == pytest.approx(1.5 * sum(words.values()), rel=0.1)
    given, kept = seen["sharding"]
    assert sorted(tuple(r)[:-1] for r in kept) == sorted(map(tuple, given))
    assert len({(r.doc_id, r.shard) for r in kept}) == len({r.doc_id for r in kept})
    final = corpus_pipeline.run(spark, SF).collect()
    assert Counter(map(tuple, final)) == Counter(map(tuple, kept))
