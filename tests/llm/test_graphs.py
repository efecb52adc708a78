"""Whitening, neighbour graph and prefix trie, each against a plain version."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import neighbour_graph, prefix_trie, whitening

VECTORS = "vec_id long, embedding array<float>, label int"
NAMES = ("node", "u", "w", "k", "x", "v", "id", "block", "kind", "near", "vector", "query", "score", "n", "component", "conv", "d", "name", "size", "parent", "depth", "place")


def clashing(df):
    return df.withColumns({name: F.lit("clash") for name in NAMES})


# whitening


@pytest.mark.parametrize("size", [1, 2, 7, 40])
def test_rank_one_updates(size):
    rng = np.random.default_rng(size)
    total, values, basis = np.zeros((size, size)), np.zeros(size), np.eye(size)
    for i in range(120):
        row = np.round(rng.standard_normal(size)) if i % 2 else rng.standard_normal(size) * 10.0 ** rng.integers(-4, 4)
        row[rng.integers(size)] = 0
        row = np.eye(size)[i % size] if i % 5 == 0 else row  # equal eigenvalues and directions without a part
        total += (1 + i % 3) * np.outer(row, row)
        values, basis = whitening.rank_one(values, basis, row, 1 + i % 3)
    top = np.abs(total).max()
    assert np.abs(basis @ np.diag(values) @ basis.T - total).max() < 1e-13 * top * size
    assert np.abs(basis.T @ basis - np.eye(size)).max() < 1e-12
    assert np.abs(values - np.linalg.eigvalsh(total)).max() < 1e-13 * top * size
    assert (np.diff(values) >= 0).all()


def test_secular_roots_between_poles():
    d, z = np.array([0.0, 1e-9, 1.0, 1.0 + 1e-12, 5.0]), np.array([1.0, 1e-3, 0.5, 1e-6, 2.0])
    at, t = whitening.secular_roots(d, z, 0.7)
    roots = d[at] + t
    assert (roots[:-1] <= d[1:]).all() and (roots >= d).all()
    full = np.linalg.eigvalsh(np.diag(d) + 0.7 * np.outer(z, z))
    assert np.abs(roots - full).max() < 1e-14 * full.max()


@pytest.mark.parametrize("block", [1, 16])
def test_spectra_join(block):
    rng = np.random.default_rng(3)
    x = rng.integers(-300, 300, (90, 9))
    parts = []
    for a, b in ((0, 20), (20, 20), (20, 21), (21, 90)):
        parts.append(whitening.Spectrum(9, block))
        parts[-1].add(x[a:b])
    for p in parts[1:]:
        parts[0].join(p)
    c = x - x.mean(axis=0)
    assert parts[0].n == 90 and parts[0].sums == x.sum(axis=0).tolist()
    assert np.allclose(parts[0].basis @ np.diag(parts[0].values) @ parts[0].basis.T, c.T @ c, atol=1e-6)


def plain_whitening(rows, k=4):
    live = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    size = max(len(v) for _, v in live)
    x = [[int(np.floor(256 * float(c))) for c in v] + [0] * (size - len(v)) for _, v in live]
    fit = np.array(sorted({tuple(r) for r in x}), dtype=float)
    n, s = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh((fit - s / n).T @ (fit - s / n) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return [(i, j + 1, n, sum((n * a - int(b)) ** 2 for a, b in zip(r, s)), float((np.array(r) - s / n) @ vectors[:, j]) / np.sqrt(values[j]), values[j] / values.sum())
            for (i, _), r in zip(live, x) for j in range(min(k, size))]


@pytest.mark.parametrize("parts", [1, 40])
def test_whitening(spark, parts):
    rng = np.random.default_rng(5)
    own = [(i, [float(c) for c in (rng.standard_normal(6) * [3, 1, 0.5, 2, 0.2, 0.1]).astype(np.float32)]) for i in range(200)]
    own += [(i, own[7][1]) for i in range(300, 360)] + [(None, own[8][1]), (7, own[9][1]), (7, own[9][1]), (401, own[3][1][:4])]
    bad = [(500, None), (501, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (502, [float("nan")] * 6), (503, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0])]
    df = clashing(spark.createDataFrame([(*r, 1) for r in own + bad], VECTORS).repartition(parts))
    got = whitening.whiten(df, block=64 if parts == 1 else 1).collect()
    want = plain_whitening(own + bad)
    key = lambda r: (r[0] is None, r[0], r[1], r[3])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [tuple(r[:4]) for r in got] == [r[:4] for r in want]
    for j in range(1, 5):
        a, b = (np.array([r[4] for r in rows if r[1] == j]) for rows in (got, want))
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
    assert max(abs(a[5] / b[5] - 1) for a, b in zip(got, want)) < 1e-12
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-10


def test_whitening_of_little(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert whitening.whiten(empty).count() == 0 and whitening.whiten(spark.createDataFrame([(1, None, 0)], VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [], 0)], VECTORS)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, -0.1], 0), (2, [0.5, -0.1], 0)], VECTORS)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, 0.0, 0.0, 0.0)] * 4
    flat = whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0], 0), (2, [0.25, 1.0], 0)], VECTORS)).collect()
    assert sorted((r.vec_id, r.component, abs(round(r.whitened, 9)), round(r.explained, 9)) for r in flat) == [(1, 1, 1.0, 1.0), (1, 2, 0.0, 0.0), (2, 1, 1.0, 1.0), (2, 2, 0.0, 0.0)]
    huge = whitening.whiten(spark.createDataFrame([(1, [3e38], 0), (2, [-3e38], 0)], VECTORS)).collect()
    assert [r.deviation for r in huge] == [None, None]


# neighbour graph


def plain_nearest(rows, every=20, top=20):
    live = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)})
    size = max(len(v) for _, v in live)
    x = np.array([list(v) + [0.0] * (size - len(v)) for _, v in live], dtype=float)
    out = {}
    for k, (i, _) in enumerate(live):
        if i % every == 0:
            s = (x * x[k]).sum(axis=1)
            order = sorted((-s[m], live[m][0]) for m in range(len(live)) if m != k)[:top]
            out.setdefault(i, []).append([(vec, -score) for score, vec in order])
    return out


def test_neighbours_of_few(spark):
    rng = np.random.default_rng(1)
    vector = lambda: [float(c) for c in (rng.standard_normal(5) * 10 ** rng.uniform(-0.5, 0.5)).astype(np.float32)]
    rows = [(i, vector()) for i in range(120)]
    rows += [(i, rows[40][1]) for i in range(200, 260)] + [(i, rows[41][1]) for i in range(300, 330)]  # copies, also of a query
    rows += [(20, rows[20][1]), (60, vector()), (None, vector()), (400, None), (420, [0.0] * 5), (440, [1.0, None]), (460, [float("nan")] * 5), (480, []), (500, vector()[:3])]
    df = clashing(spark.createDataFrame([(*r, 0) for r in rows], VECTORS).repartition(5))
    got = defaultdict(list)
    for r in sorted(neighbour_graph.nearest(df).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    want = plain_nearest(rows)
    assert set(got) == set(want)
    for i, lists in want.items():
        assert sorted(r for r, _, _ in got[i]) == sorted(list(range(1, 21)) * len(lists))
        if len(lists) == 1:
            assert [v for _, v, _ in got[i]] == [v for v, _ in lists[0]]
            assert np.allclose([s for _, _, s in got[i]], [s for _, s in lists[0]], rtol=1e-13, atol=0)
    assert neighbour_graph.nearest(spark.createDataFrame([], VECTORS)).count() == 0
    pair = neighbour_graph.nearest(spark.createDataFrame([(0, [1.0, 2.0], 0), (3, [2.0, 1.0], 0)], VECTORS)).collect()
    assert [tuple(r) for r in pair] == [(0, 1, 3, 4.0)]
    assert neighbour_graph.nearest(spark.createDataFrame([(0, [1.0], 0)], VECTORS)).count() == 0
    copies = neighbour_graph.nearest(spark.createDataFrame([(i, [3.0, 4.0], 0) for i in range(45)], VECTORS)).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in copies) == sorted((q, k + 1, v) for q in (0, 20, 40) for k, v in enumerate([v for v in range(45) if v != q][:20]))
    assert {r.score for r in copies} == {25.0}


def test_descent_finds_what_leaves_miss(spark):
    """Small leaves alone find a third of the neighbours; descent and search find nine tenths, in a cloud with a tight cluster."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 12))
    x[500:900] = x[0] + 0.01 * rng.standard_normal((400, 12))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*r, 0) for r in rows], VECTORS)
    want = plain_nearest(rows, 10)

    def recall(found):
        return np.mean([len(set(found.get(i, ())) & {v for v, _ in lists[0]}) / 20 for i, lists in want.items()])

    small = {"leaf": 128, "forests": 2, "degree": 24}
    rough = neighbour_graph.build(df, **small, rounds=0)
    assert recall({r.node: r.near_ids[:20] for r in rough.graph.where("node % 10 = 0").collect()}) < 0.7
    got = defaultdict(list)
    for r in neighbour_graph.nearest(df, every=10, **small).collect():
        got[r.query_id].append(r.vec_id)
    assert recall(got) > 0.9
    # a query that is no row of the table enters at the sampled nodes
    index = neighbour_graph.build(df, **small)
    outside = spark.createDataFrame([(1, bytearray(x[3].astype("<f8").tobytes()), None)], "query long, vector binary, own long")
    best = neighbour_graph.search(index, outside, 20).orderBy(F.desc("score"), "node").first()
    assert best.node == 3


# prefix trie

TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            token = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()[:16]
            own[c].append((t is not None, t or 0, token, r, x))
    own = {c: [tuple(v[3:]) for v in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h, head = zlib.crc32(str(c).encode()) % 6, c - int(np.fmod(c, 100))
        whole[c] = own.get(head, [])[:h] + turns[h:]
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(int)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1]) if path else 0
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items())


@pytest.mark.parametrize("parts", [1, 5])
def test_trie(spark, monkeypatch, parts):
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    monkeypatch.setattr(prefix_trie, "RUN", 3)
    rng = random.Random(parts)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé\U0001f600", "", None, "long " * 50])) for c in range(95, 260) for t in range(rng.randint(1, 9))]
    rows += [(c, t, "user", f"same {t}") for c in range(300, 340) for t in range(7)]  # copies
    rows += [(700, t, "user", str(t)) for t in range(41)] + [(701, t, "user", str(t)) for t in range(37)]  # deep, and over several tasks
    rows += [(-5, 0, "user", "x"), (-105, 1, "user", "y"), (-100, 3, "u", "z"), (901, None, "user", "q"), (901, None, "user", "p"), (901, 2, "user", "q"), (901, 2, "user", "q"), (None, 1, "user", "x")]
    df = clashing(spark.createDataFrame(rows, TURNS).repartition(parts))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        got = [tuple(r) for r in prefix_trie.trie(df).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(got, key=lambda r: r[:2]) == plain_trie(rows)


def test_trie_of_little(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).count() == 0
    # a conversation that keeps none of its turns is a member of the root alone
    alone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0)
    row = prefix_trie.trie(spark.createDataFrame([(alone, 1, "a", "b")], TURNS)).collect()
    assert [tuple(r) for r in row] == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]
