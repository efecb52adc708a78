"""Long texts cost in proportion to their length, repeated rows collapse, and results show the method."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import curriculum, license_scan, near_dup, quality_fm, secret_scan
from vitrine.llm.queries import QUERIES


@pytest.mark.parametrize("unit", [
    b"-MA", b"-----BEGIN RSA PRIVATE KEY-----\nabc\n", b"eyJ", b"MIIEab\\\\\\\\", b"MIIEogIBAAKCAQEA\n", b"MIQAAAAwAgEAAgEA", b'MAA"      ', b"30820101020100 "])
def test_secret_scan_is_linear(unit):
    """Texts that look like keys everywhere: 0.1, 1 and 10 MB."""
    seconds = []
    for size in (100_000, 1_000_000, 10_000_000):
        start = time.perf_counter()
        assert secret_scan.spans_of(unit * (size // len(unit))) == []
        seconds.append(time.perf_counter() - start)
    assert seconds[2] < 40 * max(seconds[1], 0.05) and seconds[1] < 40 * max(seconds[0], 0.02)


def test_licence_scan_is_linear():
    """A megabyte of notices: one match for every notice, and a few seconds at most."""
    lines, _, sizes = license_scan.build(license_scan.NOTICES)
    long, _, long_sizes = license_scan.build(list(license_scan.TEMPLATES.items()))
    words = license_scan.words_of(b"This work is licensed under the MIT License. " * 23_000)
    start = time.perf_counter()
    notes = lines.sentences(words, sizes)
    found = long.matches(words, license_scan.SHORTEST, every=True)
    license_scan.chains(found, need=[16] * len(long_sizes))
    assert time.perf_counter() - start < 5
    assert len(notes) == 23_000 and len(found) <= 3 * 23_000


def test_whole_notices_against_plain_search():
    rng = np.random.default_rng(1)
    labels = [("x", "a b"), ("x", "a b c"), ("x", "b c"), ("x", "c a b c d"), ("x", "d"), ("y", "a b c")]
    automaton, _, sizes = license_scan.build(labels)
    sentences = [license_scan.words_of(s.encode()) for _, s in labels]
    for _ in range(60):
        words = [bytes([97 + k]) for k in rng.integers(0, 5, rng.integers(0, 30))]
        want = []
        for stop in range(1, len(words) + 1):
            whole = [s for s in sentences if len(s) <= stop and words[stop - len(s) : stop] == s]
            if whole:
                want.append((stop - max(map(len, whole)), stop))
        assert [(a, b) for a, b, _ in automaton.sentences(words, sizes)] == want


def test_positions_by_integration(spark, docs):
    """Positions of all passes against a plain numerical inversion of each source's schedule."""
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), "abc"[i % 3] if i % 10 else None) for i in range(120)]
    plan = curriculum.assign(docs(*rows)).collect()
    by: dict = {}
    for r in plan:
        by.setdefault(r.source, []).append(r)
    total = sum(r.mix_size for r in plan)
    assert abs(sum(rs[0].mix_target for rs in by.values()) - total) < 1e-6
    rates = {s: rs[0].mix_target / rs[0].mix_total for s, rs in by.items()}
    mean = sum(rates[s] * rs[0].mix_target for s, rs in by.items()) / total
    widest = max(abs(rates[s] - mean) for s in by)
    time_ = np.linspace(0, 1, 200_001)
    for s, rs in by.items():
        tilt = curriculum.LEAN * (rates[s] - mean) / widest if widest else 0.0
        demand = (1 - tilt) * time_ + tilt * time_**2
        at = 0
        for r in sorted(rs, key=lambda r: (r.mix_order, str(r.doc_id), r.mix_size)):
            for k, piece in enumerate(r.mix_passes):
                share = (at + k * r.mix_total + piece.taken / 2) / r.mix_target
                assert abs(piece.position - np.interp(share, demand, time_)) < 1e-5
            at += r.mix_size


def test_mixing_keeps_columns_of_any_name(odd):
    plan = curriculum.assign(odd)
    assert set(odd.columns) <= set(plan.columns) and plan.count() == odd.count()
    row = plan.where("doc_id = 4").first()
    assert row.demand == row.knots == row.bucket_from == row.mix_row == "clash" and row.mix_size == 1
    order = curriculum.training_order(plan)
    assert set(odd.columns) - {"mix_passes"} <= set(order.columns)


def test_rows_without_an_id_are_spread(spark, docs):
    plan = curriculum.assign(docs(*[(None, f"text {i}") for i in range(200)]))
    assert plan.select(F.countDistinct("mix_order")).first()[0] == 200


def test_repeated_rows_are_one_document(spark, docs):
    """One id in a third of all rows: one leader, one set and one lesson."""
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, text)] * 100 + [(i, text + f" {i}") for i in range(2, 200)]
    out = near_dup.near_duplicates(docs(*rows))
    assert out.count() == 298 and {r.component_id for r in out.select("component_id").distinct().collect()} == {1}
    sets = near_dup.shingle_sets(docs(*rows), spark.createDataFrame([(1,), (2,)], "id long"), "sets", "doc_id", "text")
    assert sets.where("id = 1").count() == 1
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 200)], "doc_id long, quality int")
    seen = []
    whole = quality_fm.fit
    try:
        quality_fm.fit = lambda y, *a: seen.append(len(y)) or whole(y, *a)
        quality_fm.train(docs(*rows), labels)
    finally:
        quality_fm.fit = whole
    kept = labels.where(~quality_fm.held_out(F.col("doc_id"))).count()
    assert seen == [kept]


def test_hubs_in_parts(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    pairs = spark.createDataFrame([(i, 0) for i in range(1, 100)] + [(200, 5), (201, 5)], "a long, b long")
    table = spark.createDataFrame([(0, "x"), (5, "y"), (7, "z")], "b long, v string")
    assert sorted(map(tuple, near_dup.beside_hubs(pairs, table).select("a", "b", "v").collect())) == sorted(
        [(i, 0, "x") for i in range(1, 100)] + [(200, 5, "y"), (201, 5, "y")])


def test_all_thirteen_are_registered():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
