"""Operators that compare or order rows, and the pipeline, each against a plain version."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import curriculum, fingerprint, near_dup, quality_fm

# fingerprints


def plain_features(text, ranks):
    data = np.frombuffer(text, dtype=np.uint8)
    n = len(text) - 63
    if n < 1:
        return [text] if text else []
    level = [int(fingerprint.levels(data[i : i + 64])[0]) for i in range(n)]
    for i in range(0, n, 17):
        entropy = -sum(c / 64 * math.log2(c / 64) for c in Counter(text[i : i + 64]).values())
        assert abs(1000 * entropy / 6 - level[i]) < 0.51
    votes = [0] * n
    for start in range(max(1, n - 63)):
        run = [(ranks[level[i]], i) for i in range(start, min(n, start + 64))]
        rank, at = min(run)
        votes[at] += rank < fingerprint.FAR
    least = min(fingerprint.VOTES, max(1, n - 63))
    return list(dict.fromkeys(text[i : i + 64] for i in range(n) if votes[i] >= least)) or [text]


def test_features_against_plain_windows():
    rng = random.Random(1)
    some = ["".join(rng.choices("abcdefgh ij\n", k=n)).encode() for n in (0, 1, 63, 64, 65, 127, 128, 300, 700)] + [b"a" * 200, "é ü".encode() * 60]
    counts = np.zeros(1001, dtype=np.int64)
    for t in some:
        if len(t) >= 64:
            counts += np.bincount(fingerprint.levels(np.frombuffer(t, dtype=np.uint8)), minlength=1001)
    ranks = fingerprint.ranks_of(counts)
    assert fingerprint.features(some, ranks) == [plain_features(t, ranks) for t in some]


def test_likeness():
    rng = random.Random(2)
    feats = [rng.randbytes(64) for _ in range(700)]
    whole, half, none = (fingerprint.digest(feats[a:b]) for a, b in ((0, 400), (200, 600), (500, 700)))
    assert fingerprint.likeness(whole, whole) == 1 and fingerprint.likeness(b"", b"") == 1 and fingerprint.likeness(b"", whole) == 0
    assert fingerprint.likeness(whole, half) == fingerprint.likeness(half, whole) > 0.3 and fingerprint.likeness(whole, none) < 0.1


@pytest.mark.parametrize("parts", [1, 4])
def test_neighbours(spark, docs, odd, texts, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        for table in (docs(*[(r["doc_id"], r["text"]) for r in texts]), odd, docs((4, "alone " * 30)), docs((2, "x"), (1, "y"))):
            rows = [(r.doc_id, r.text or "") for r in table.withColumn("h", F.xxhash64("text")).orderBy(F.col("doc_id").desc_nulls_last(), "h", "text").collect()]
            want = []
            for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
                half = len(text) // 2
                new = text[: len(text) - half] + after[:half]
                want.append((str(key), len(text), hashlib.sha256(new.encode()).hexdigest()))
            got = fingerprint.neighbours(table).collect()
            assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
            by_text = {}
            for r in got:
                by_text.setdefault(next(t for k, t in rows if k == r.doc_id), set()).add(r.fingerprint)
                assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and base64.b64decode(r.fingerprint) is not None
            assert all(len(v) == 1 for v in by_text.values())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert fingerprint.neighbours(odd.limit(0)).collect() == []


# quality


def test_machine_scores_all_pairs():
    rng = np.random.default_rng(3)
    model = quality_fm.Model(0.3, rng.normal(size=50), rng.normal(size=(50, 4)), np.zeros((0, 7)))
    for _ in range(20):
        feature, x = rng.choice(50, 9, replace=False), rng.normal(size=9)
        pairs = sum(x[i] * x[j] * model.factors[feature[i]] @ model.factors[feature[j]] for i in range(9) for j in range(i))
        z, _ = model.margin(np.zeros(9, dtype=int), feature, x, 1)
        assert np.isclose(z[0], 0.3 + model.weights[feature] @ x + pairs)


def _labelled(spark, docs):
    rng = random.Random(4)
    words = ["river", "stone", "walks", "over", "the", "bright", "field", "of", "small", "towns", "and", "rain"]
    rows, labels = [], []
    for i in range(400):
        some = rng.choices(words, k=rng.randrange(20, 60))
        bad = i % 4 == 0
        rows.append((i, "!! ".join(some).upper() + "!!" if bad else " ".join(some).capitalize() + "."))
        labels.append((i, int(not bad)))
    return docs(*rows), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels)


def test_quality_held_out(spark, docs, odd):
    table, labels, truth = _labelled(spark, docs)
    model = quality_fm.train(table, labels)
    rows = quality_fm.score(table, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.5) for r in rows)
    assert sum(r.predicted == truth[r.doc_id] for r in rows if r.held_out) >= 0.98 * sum(r.held_out for r in rows)
    assert sorted(r.doc_id for r in quality_fm.keep_good(table, model).collect()) == sorted(r.doc_id for r in rows if r.predicted)
    got = quality_fm.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality_fm.keep_good(odd, model).columns == odd.columns
    for none in (labels.limit(0), labels.where("quality = 1"), labels.withColumn("quality", F.lit(None).cast("int"))):
        assert {0 <= r.score <= 1 for r in quality_fm.score(odd, quality_fm.train(table, none)).collect()} == {True}
    assert quality_fm.score(odd.limit(0), model).collect() == []


# near duplicates


def plain_components(rows):
    sets = []
    for key, text in rows:
        w = [] if text is None else text.encode().lower().split()
        sets.append((key, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())))
    parent = {k: k for k, _ in rows if k is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and a is not None and b is not None and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return sorted(
        (str(k), len(s), str(find(k) if k is not None else None), k is None or find(k) == k) for k, s in sets)


def _family(rng, words, copies, edits):
    base = rng.choices(words, k=160)
    for _ in range(copies):
        own = list(base)
        for i in rng.sample(range(160), rng.randrange(edits + 1)):
            own[i] = rng.choice(words)
        yield " ".join(own)


def test_near_duplicates_against_all_pairs(docs, odd):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(4000)]
    some = [t for k in range(8) for t in _family(rng, words, 12, 8)]  # chains: members that are far from the hub but near each other
    passage = " ".join(rng.choices(words, k=120))
    some += [f"{passage} {' '.join(rng.choices(words, k=60))}" for _ in range(40)]
    some += ["four words only here", "Four  words only here", "", " ", "a b c d e", "A B C D E f"] + [some[0]] * 30
    rng.shuffle(some)
    rows = list(enumerate(some)) + [(3, "second text of three " + some[3]), (3, some[3]), (None, some[5])]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dup.near_duplicates(docs(*rows)).collect())
    assert got == plain_components(rows)
    plain = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dup.near_duplicates(odd).collect())
    assert got == plain_components(plain)
    assert near_dup.near_duplicates(odd.limit(0)).collect() == []


def test_sketch_estimates():
    rng = np.random.default_rng(5)
    for share in (0.6, 0.75, 0.9):
        found = []
        for _ in range(30):
            both = rng.integers(0, 2**63, int(400 * share), dtype=np.uint64)
            x, y = (np.concatenate([both, rng.integers(0, 2**63, int(200 * (1 - share)), dtype=np.uint64)]) for _ in range(2))
            a, b = (near_dup.odd_sketch(near_dup.samples(near_dup.mix(s))).view(np.uint64) for s in (x, y))
            differing = int(np.bitwise_count(a ^ b).sum())
            found.append(1 + near_dup.SKETCH / (4 * near_dup.SAMPLES) * math.log(1 - 2 * differing / near_dup.SKETCH))
            assert share < 0.75 or differing <= near_dup.most_differing(near_dup.LEAST_ESTIMATE)
        assert abs(np.mean(found) - share) < 0.03


@pytest.mark.parametrize("block", [4, 1024])
def test_members_across_components(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rng = random.Random(9)
    base = [rng.getrandbits(63) for _ in range(200)]
    sets = {}
    for i in range(40):  # a family around one set, and strangers
        own = [rng.getrandbits(63) for _ in range(200)] if i % 4 == 0 else [x if rng.random() > 0.07 else rng.getrandbits(63) for x in base]
        sets[i] = np.unique(np.array(own, dtype=np.uint64))
    sketch = {i: near_dup.odd_sketch(near_dup.samples(s)) for i, s in sets.items()}
    component = {i: i % 9 for i in sets}
    near = {
        (i, j) for i in sets for j in range(i)
        if component[i] != component[j] and np.bitwise_count(sketch[i].view(np.uint64) ^ sketch[j].view(np.uint64)).sum() <= near_dup.most_differing(near_dup.LEAST_ESTIMATE)
    }
    rows = [(5, i, 0, component[i], sketch[i].tolist(), sets[i].tobytes(), len(sets)) for i in sets]
    table = spark.createDataFrame(rows, "band long, id long, hub long, component long, sketch array<long>, members binary, n long")
    assert sorted(r.id for r in near_dup.flag(table).collect()) == sorted({x for p in near if 0 not in p for x in p})
    links = {(r.a, r.b) for r in near_dup.join_components(table).collect()}
    alike = lambda i, j: 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
    true = {p for p in near if alike(*p)}
    assert links <= true

    def joined(pairs):
        label = dict(component)
        for i, j in pairs:
            old, new = label[i], label[j]
            label = {k: new if v == old else v for k, v in label.items()}
        return {frozenset(k for k, v in label.items() if v == c) for c in set(label.values())}

    assert joined(links) == joined(true) and len(links) < len(true)


def test_components(spark):
    rng = random.Random(8)
    for n, edges in ((40, [(i, i + 1) for i in range(0, 39)]), (60, [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]), (5, [])):
        parent = list(range(n))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
        got = {r.id: r.component for r in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


# mixing


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full, out = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(most * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        out = {s: most * sizes[s] if s in full else left * weight[s] / free for s in names}
        over = {s for s in names if s not in full and out[s] > most * sizes[s] + 1e-9}
        if not over:
            return out
        full |= over


def test_mix(spark, docs, odd):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 30)), rng.choices(["a", "b", "c", "d", None, "é"], [40, 5, 3, 1, 2, 1])[0]) for i in range(600)]
    for table in (docs(*rows), odd):
        found = [r.asDict() for r in curriculum.assign(table).collect()]
        sizes = {}
        for r in found:
            assert r["mix_size"] == len((r["text"] or "").encode().split())
            sizes[r["source"]] = sizes.get(r["source"], 0) + r["mix_size"]
        want = plain_targets(sizes)
        for s in sizes:
            own = [r for r in found if r["source"] == s]
            assert all(r["mix_total"] == sizes[s] and math.isclose(r["mix_target"], want[s], abs_tol=1e-6) for r in own)
            assert abs(sum(r["mix_taken"] for r in own) - want[s]) <= 0.5 + 1e-6
            assert all(0 <= r["mix_taken"] <= 3 * r["mix_size"] for r in own)
    again = {r.doc_id: r.mix_passes for r in curriculum.assign(docs(*rows[::-1])).collect()}
    assert again == {r.doc_id: r.mix_passes for r in curriculum.assign(docs(*rows)).collect()}
    assert curriculum.assign(odd.limit(0)).collect() == []


def test_positions_follow_the_schedule(spark, docs):
    rows = [(i, "w " * 20, "ab"[i % 2]) for i in range(2000)]
    knots = [("a", [(0.0, 0.0), (0.5, 2.0), (1.0, 2.0)])]
    schedule = spark.createDataFrame(knots, "source string, knots array<struct<t: double, w: double>>")
    order = curriculum.training_order(curriculum.assign(docs(*rows), schedule=schedule)).collect()
    at = [r.mix_position for r in order]
    assert at == sorted(at) and all(0 <= t <= 1 for t in at)
    taken = sum(r.mix_words for r in order if r.source == "a")
    for t, share in ((0.25, 0.125 / 1.5), (0.5, 0.5 / 1.5), (0.75, 1 / 1.5)):  # the integral of the schedule up to t
        assert abs(sum(r.mix_words for r in order if r.source == "a" and r.mix_position <= t) / taken - share) < 0.01


# the pipeline


def test_first_words_keep_white_space(spark):
    text = "  def f():\n\n\tx = 1  # \u00e9\u3000y\r\n    return\x0bx \n"
    rows = spark.createDataFrame([(text, n) for n in range(1, 12)] + [(None, 1), ("", 1)], "text string, n long")
    got = [r.cut for r in rows.select(curriculum.first_words(F.col("text"), F.col("n")).alias("cut")).collect()]
    ends = [m.end() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    assert got == [text[: ends[n - 1]] if n < len(ends) else text for n in range(1, 12)] + [None, ""]


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P

    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("ri", "sto", "wal", "fie") for b in ("ver", "ne", "ks", "ld", "mon", "ter", "lin")]
    rows, labels = [], []
    for i in range(300):
        some = rng.choices(words, k=rng.randrange(30, 80))
        bad = i % 5 == 0
        rows.append((i, "!! ".join(some).upper() if bad else " ".join(some) + ".", "en", f"s{i % 3}", None))
        labels.append((i, int(not bad), 0))
    rows += [(1000 + i, rows[i + 1][1], "en", "s0", 3) for i in range(3)]
    rows.append((2000, "password = abcdefghijklmnop " + " ".join(rng.choices(words, k=60)), "en", "s1", None))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in P.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert name == P.STAGES[-1][0] or out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append(docs.collect())
    good, unique, clean, mixed, packed = seen
    ids = {r.doc_id for r in good}
    assert ids >= {i for i in range(300) if i % 5} and not ids & {i for i in range(300) if i % 5 == 0}
    plain = plain_components([(r.doc_id, r.text) for r in good])
    assert sorted(str(r.doc_id) for r in unique) == sorted(k for k, _, _, kept in plain if kept)
    assert {r.doc_id for r in clean} == {r.doc_id for r in unique} and "abcdefghijklmnop" not in " ".join(r.text for r in clean)
    counts = Counter(r.doc_id for r in mixed)
    assert set(counts) <= {r.doc_id for r in clean} and max(counts.values()) <= 3
    size = lambda rows: sum(len(r.text.split()) for r in rows)
    assert abs(size(mixed) - size(clean)) <= 3
    assert len(P.run(spark, str(tmp_path)).collect()) > 0 and sum(r.length for r in packed) > size(mixed)


def test_corpus_tables(spark, texts):
    """Near duplicates and mix over the whole smallest table."""
    rows = [(r["doc_id"], r["text"]) for r in texts]
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dup.near_duplicates(table).collect())
    assert got == plain_components(rows)
