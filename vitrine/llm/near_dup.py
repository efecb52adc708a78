"""Near duplicates: MinHash bands, odd sketches, and confirmation on full shingle sets.

A text is the set of its five-word shingles (64-bit hashes of the lower-cased words).  Equal word
sequences form a class, of which only the document of smallest id goes on.  MinHash samples are
cut into bands; documents that share a band meet its hub, the smallest id there, so a bucket gives
as many pairs as members, not their square.  All samples also fold into one parity bitmap (odd
sketch): the population count of the XOR of two of them estimates how many samples differ, and
drops pairs that are far below the threshold.  The rest is confirmed on the full sets.

Confirmed links make components (label contraction, tables written between rounds).  A bucket
whose members then lie in more than one component may hide a link between two members that are
not its hub.  Such members are compared by sketch, in blocks of bounded size and only across
components; those with a near partner come back with their full sets, meet again in blocks, and
every link that joins two components is given out, so a block gives fewer links than it has
components, never its pairs.

Hubs of many pairs are asked in parts, so that no task holds all of one hub.

Texts without words are linked with nothing.  Rows without an id link with nothing, have no
component and are kept.  Rows that share an id are one document that holds each of their texts.
An empty table gives an empty result; columns other than the two that are named play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import map_batches, slices, utf8, worker_cache
from vitrine.session import materialize

WORDS, THRESHOLD = 5, 75
#: 48 bands of 5: a pair at the threshold is missed by all bands with probability 2.3e-6
BANDS, ROWS = 48, 5
SAMPLES = BANDS * ROWS
SKETCH = 512
#: an estimate this far below the threshold (five standard deviations) ends a pair
LEAST_ESTIMATE = 0.55
#: members of a bucket that are compared at once, and bits of the map by which texts are picked
BLOCK, PICK = 1_024, 1 << 22

_RNG = np.random.default_rng(20_240_229)
_MULTIPLY = _RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2)
_PLACE = _RNG.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RNG.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64)


class _Hashes(dict):
    """Word -> 64-bit hash; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; of fewer words, one of the whole sequence."""
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    if n < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)], dtype=np.uint64)
    known = worker_cache("shingle words", _Hashes)
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=n)
    total = h[: n - WORDS + 1] * _PLACE[0]
    for k in range(1, WORDS):
        total = mix(total) + h[k : n - WORDS + 1 + k] * _PLACE[k]
    return np.unique(mix(total))


def samples(found: np.ndarray) -> np.ndarray:
    """MinHash samples of a nonempty set."""
    low = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(found), 512):
        part = found[a : a + 512, None] * _MULTIPLY
        part += _ADD
        np.minimum(low, part.min(axis=0), out=low)
    return low


def bands(low: np.ndarray) -> np.ndarray:
    return mix((low.reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def odd_sketch(low: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples as 64-bit words."""
    bits = np.bincount((mix(low ^ _SALT) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def most_differing(estimate: float) -> int:
    """XOR population count that stands for an estimated similarity."""
    return int(SKETCH / 2 * (1 - np.exp(-2 * 2 * SAMPLES * (1 - estimate) / SKETCH)))


def describe(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class, n_shingles, bands, sketch) of every row; class is empty for texts without words."""

    def start():
        def encode(rows: dict):
            raw = utf8(rows["text"])
            for a, b in slices(raw):
                out: dict = {"doc_id": rows["doc_id"][a:b], "class": [], "n_shingles": [], "bands": [], "sketch": []}
                for t in raw[a:b]:
                    words = t.lower().split()
                    found = shingles(words)
                    low = samples(found) if len(found) else None
                    out["class"].append(xxhash.xxh3_128_digest(b" ".join(words)) if words else b"")
                    out["n_shingles"].append(len(found))
                    out["bands"].append([] if low is None else bands(low))
                    out["sketch"].append([] if low is None else odd_sketch(low))
                yield out

        return encode

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(source, "doc_id long, class binary, n_shingles long, bands array<long>, sketch array<long>", start)


def differing(a: Column, b: Column) -> Column:
    """Population count of the XOR of two sketches."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def shingle_sets(docs: DataFrame, ids: DataFrame, name: str, doc_id: str, text: str) -> DataFrame:
    """(id, members: packed sorted shingles) of the rows whose id is in ``ids`` (and of few others).

    A bitmap of fixed size, of the hashes of all wanted ids, is what travels; texts stay where they
    are.  However many ids are wanted, the map has PICK bits.
    """
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(PICK))
    place = [F.shiftright("spot", 6).alias("w"), F.expr("shiftleft(1L, CAST(spot & 63 AS INT))").alias("bit")]
    marks = ids.select(spot("id").alias("spot")).select(*place).groupBy("w").agg(F.bit_or("bit").alias("bits"))
    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).withColumn("spot", spot("id"))
    picked = source.select("id", "text", *place).join(F.broadcast(marks), "w").where(F.col("bits").bitwiseAND(F.col("bit")) != 0)

    def start():
        def encode(rows: dict):
            raw = utf8(rows["text"])
            for a, b in slices(raw):
                yield {"id": rows["id"][a:b], "members": [shingles(t.lower().split()).tobytes() for t in raw[a:b]]}

        return encode

    return materialize(map_batches(picked.where("id IS NOT NULL").select("id", "text"), "id long, members binary", start).distinct(), name)


def beside_hubs(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """Pairs (a, b) with the columns of ``table`` (b, ...). A hub of many pairs is asked in parts of about BLOCK pairs."""
    heavy = pairs.groupBy("b").agg(F.ceil(F.count("*") / BLOCK).alias("parts")).where("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    asked = pairs.join(heavy, "b", "left").withColumn("part", F.pmod(F.xxhash64("a"), parts)).drop("parts")
    hubs = table.join(heavy, "b", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
    return asked.join(hubs, ["b", "part"]).drop("part")


def enough(both: int, x: int, y: int) -> bool:
    return both > 0 and 100 * both >= THRESHOLD * (x + y - both)


LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) whose full shingle sets reach the threshold."""

    def compare(batches):
        for batch in batches:
            d = batch.to_pydict()
            near = []
            for i, (x, y) in enumerate(zip(d["x"], d["y"])):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                if enough(min(len(x), len(y)), len(x), len(y)) and enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)):
                    near.append(i)
            yield pa.RecordBatch.from_pydict({"a": [d["a"][i] for i in near], "b": [d["b"][i] for i in near]}, schema=LINK)

    both = beside_hubs(pairs, sets.select(F.col("id").alias("b"), F.col("members").alias("y"))).join(
        sets.select(F.col("id").alias("a"), F.col("members").alias("x")), "a").select("a", "b", "x", "y")
    return both.mapInArrow(compare, "a long, b long").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the smallest id that is reachable.

    Each round hangs every larger neighbour of an id, then every smaller one, below the smallest
    neighbour; when a round changes nothing, all ids hang below their smallest.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), name)
    mark = None
    while True:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), "m"), F.struct("u", "m"))).alias("e"))
        edges = materialize(small.select("e.u", F.col("e.m").alias("v")).where("u != v").distinct(), name)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == mark:
            return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id").unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        mark = now


def in_blocks(members: DataFrame, columns: list[str], ddl: str, schema: pa.Schema, compare) -> DataFrame:
    """Run ``compare(rows, same)`` over the members of each bucket (band; n members), at most two blocks at a time.

    Rows are tuples of ``columns`` and their block. A bucket of more than BLOCK members is dealt into
    blocks and every two of them meet; ``same`` says that they are one block, else only pairs of
    different blocks are to be compared, as those inside a block meet in a group of their own.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    others = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    dealt = members.withColumn("own", own).withColumn("to", F.explode(others)).select(
        "band", F.col("to.i").alias("i"), F.col("to.j").alias("j"), *columns, "own")

    def run(batches):
        held: list = []
        at = None

        def close():
            out = compare(held, at[1] == at[2]) if len(held) > 1 else None
            return pa.RecordBatch.from_pydict(out, schema=schema) if out else None

        for batch in batches:
            d = batch.to_pydict()
            for band, i, j, *row in zip(*(d[c] for c in ("band", "i", "j", *columns, "own"))):
                if at != (band, i, j):
                    if at and (out := close()):
                        yield out
                    held.clear()
                    at = (band, i, j)
                held.append((band, *row))
        if at and (out := close()):
            yield out

    return dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "id").mapInArrow(run, ddl)


def _sketches(rows: list, at: int) -> np.ndarray:
    return np.array([r[at] for r in rows], dtype=np.int64).view(np.uint64)


def flag(members: DataFrame) -> DataFrame:
    """(band, id) of members that have a near partner of another component in their bucket, hubs aside.

    ``members``: (band, id, hub, component, sketch, n).
    """
    limit = most_differing(LEAST_ESTIMATE)

    def compare(rows: list, same: bool) -> dict | None:
        ids, hubs, comps, block = (np.array([r[k] for r in rows]) for k in (1, 2, 3, 5))
        sketch, found = _sketches(rows, 4), np.zeros(len(rows), dtype=bool)
        aside = ids == hubs
        for k in range(len(rows) - 1):
            other = (comps[k + 1 :] != comps[k]) & ~aside[k + 1 :]
            if not same:
                other &= block[k + 1 :] != block[k]
            at = np.flatnonzero(other) + k + 1
            if len(at) and not aside[k]:
                near = at[np.bitwise_count(sketch[at] ^ sketch[k]).sum(axis=1) <= limit]
                found[near] = True
                found[k] |= len(near) > 0
        return {"band": [rows[0][0]] * int(found.sum()), "id": ids[found].tolist()} if found.any() else None

    schema = pa.schema([("band", pa.int64()), ("id", pa.int64())])
    return in_blocks(members, ["id", "hub", "component", "sketch"], "band long, id long", schema, compare).distinct()


def join_components(members: DataFrame) -> DataFrame:
    """Links (a, b) between members of one bucket, enough to join all components that any of its links joins.

    ``members``: (band, id, component, sketch, members, n).
    """
    limit = most_differing(LEAST_ESTIMATE)

    def compare(rows: list, same: bool) -> dict | None:
        sizes: dict = {}
        for r in rows:
            sizes[r[2]] = sizes.get(r[2], 0) + 1
        rows = sorted(rows, key=lambda r: (sizes[r[2]], r[2], r[1]))  # small components ask, large ones answer
        sketch, block = _sketches(rows, 3), np.array([r[5] for r in rows])
        sets = [np.frombuffer(r[4], dtype=np.uint64) for r in rows]
        lengths = np.array([len(s) for s in sets])
        owner, values = np.repeat(np.arange(len(rows)), lengths), np.concatenate(sets)
        by = np.argsort(values, kind="stable")
        owner, values = owner[by], values[by]
        root = np.unique([r[2] for r in rows], return_inverse=True)[1]
        a, b = [], []
        for k in range(len(rows) - 1):
            other = root[k + 1 :] != root[k]
            if not same:
                other &= block[k + 1 :] != block[k]
            at = np.flatnonzero(other) + k + 1
            at = at[np.bitwise_count(sketch[at] ^ sketch[k]).sum(axis=1) <= limit] if len(at) else at
            if not len(at):
                continue
            first, last = np.searchsorted(values, sets[k], side="left"), np.searchsorted(values, sets[k], side="right")
            spans = last - first
            shared = np.bincount(
                owner[np.repeat(first - np.r_[0, np.cumsum(spans)[:-1]], spans) + np.arange(spans.sum())], minlength=len(rows))
            for x in at.tolist():
                if root[x] != root[k] and enough(int(shared[x]), int(lengths[x]), int(lengths[k])):
                    a.append(max(rows[x][1], rows[k][1]))
                    b.append(min(rows[x][1], rows[k][1]))
                    root[root == root[x]] = root[k]
        return {"a": a, "b": b} if a else None

    return in_blocks(members, ["id", "component", "sketch", "members"], "a long, b long", LINK, compare).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    rows = materialize(describe(docs, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "near-rows")
    known = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    # one row of each class goes on: the first of its smallest id, however often that stands there
    classes = materialize(known.groupBy("class").agg(F.min(F.struct("doc_id", "row")).alias("lead")).select(
        "class", F.col("lead.doc_id").alias("leader"), F.col("lead.row").alias("row")), "near-classes")
    leaders = materialize(known.join(classes.select("class", "row"), ["class", "row"]).select(F.col("doc_id").alias("id"), "bands", "sketch"), "near-leaders")
    classes = classes.drop("row")
    buckets = leaders.select(F.explode("bands").alias("band"), "id")
    hubs = buckets.groupBy("band").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1")
    shared = materialize(buckets.join(hubs, "band"), "near-shared")
    pairs = shared.where("id != hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    sketches = leaders.select("id", "sketch")
    near = materialize(
        beside_hubs(materialize(pairs, "near-asked"), sketches.select(F.col("id").alias("b"), F.col("sketch").alias("y")))
        .join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("x")), "a")
        .where(differing(F.col("x"), F.col("y")) <= most_differing(LEAST_ESTIMATE)).select("a", "b").distinct(), "near-pairs")
    sets = shingle_sets(docs, near.select(F.explode(F.array("a", "b")).alias("id")), "near-sets", doc_id, text)
    links = materialize(confirm(near, sets), "near-links")
    first = components(links, "near-first")

    # buckets of three and more whose members are not all joined yet
    spread = shared.where("n > 2").join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_ = spread.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("band")
    members = spread.join(open_, "band", "left_semi").join(sketches, "id")
    flagged = materialize(flag(members), "near-flagged")
    count = flagged.groupBy("band").agg(F.count("*").alias("n"))
    more_sets = shingle_sets(docs, flagged.select("id"), "near-more-sets", doc_id, text)
    again = (
        flagged.join(count, "band").join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
        .join(sketches, "id").join(more_sets, "id")
    )
    more = materialize(join_components(again), "near-more-links")

    # a document that holds texts of several classes links those
    several = known.groupBy("doc_id").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low != high").select("doc_id")
    same = known.select("doc_id", "class").join(several, "doc_id").join(classes, "class").select(F.col("doc_id").alias("a"), F.col("leader").alias("b"))
    final = components(links.unionByName(more).unionByName(same), "near-final")
    placed = classes.join(final, F.col("leader") == F.col("id"), "left").select("class", F.coalesce("component", "leader").alias("component_id"))
    alone = rows.where("doc_id IS NULL OR n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return known.join(placed, "class").select("doc_id", "n_shingles", "component_id").unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
