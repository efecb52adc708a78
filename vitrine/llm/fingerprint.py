"""Similarity digests of improbable features.

Every 64-byte window of a text has an entropy.  A first pass counts, over all windows of all
texts, how often each entropy level occurs; the rarer a level, the lower its rank.  In each run
of neighbouring windows the one of lowest rank (the first of equals) gains a vote, and windows with
enough votes are the text's features.  They are hashed into Bloom filters of a fixed number of
features, one after another.  Two digests compare by the share of common bits of their filters,
above what chance gives, each filter of the shorter digest against its best partner, weighed by
its features.

Digests compare only if they were made with the same ranks.  A text without a feature (shorter
than a window, or without enough variety) has its whole content as its only feature; an empty
or null text has an empty digest, which is like another empty one (1) and unlike all others (0).

``neighbours`` finds, for every row, the next one in order of descending id without gathering
anything: rows are range-partitioned once and compared inside their partition; of each
partition only its first and last row meet those of the next.  Rows with equal ids are ordered by
the hash of their text, rows without an id come last, the row after the last is the first
(a single row follows itself).  An empty table gives an empty result.  Other columns play no
part.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vitrine.llm.common import slices, utf8
from vitrine.session import materialize

WINDOW = 64
LEVELS = 1_000
#: windows with less than this share of the highest entropy carry no feature
LEAST_LEVEL = 100
VOTES = 16
BITS, HASHES, PER_FILTER = 2_048, 5, 160
FAR = 1 << 20  # rank of what can't be a feature
CHUNK = 1 << 19

_N = np.arange(WINDOW + 1, dtype=float)
#: c log2 c in fixed point, as the gain of the c-th equal byte, so that sums are exact
_GAIN = np.r_[0, np.diff(np.round(65536 * np.r_[0, _N[1:] * np.log2(_N[1:])]))].astype(np.int64)


def levels(data: np.ndarray) -> np.ndarray:
    """Entropy level (0 to LEVELS) of each 64-byte window."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, dtype=np.int64)
    ahead, behind = np.ones(n, dtype=np.uint8), np.ones(n, dtype=np.uint8)
    same = np.empty(n, dtype=bool)
    for lag in range(1, WINDOW):
        eq = np.equal(data[:-lag], data[lag:], out=same[: n - lag]).view(np.uint8)
        ahead[:-lag] += eq
        behind[lag:] += eq
    joined = np.cumsum(_GAIN[behind])[WINDOW - 1 :]
    joined[1:] -= np.cumsum(_GAIN[ahead])[: n - WINDOW]
    highest = 65536 * 6 * WINDOW
    return (LEVELS * (highest - joined) + highest // 2) // highest


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts, each with its bytes, one text after another, and their bounds."""
    for a, b in slices(texts, CHUNK):
        data = np.frombuffer(b"".join(texts[a:b]), dtype=np.uint8)
        yield a, b, data, np.cumsum([0, *map(len, texts[a:b])])


def _inside(bounds: np.ndarray, n: int) -> np.ndarray:
    """Which windows of joined texts lie in one text."""
    ok = np.ones(n, dtype=bool)
    for stop in bounds[1:-1].tolist():
        ok[max(0, stop - WINDOW + 1) : stop] = False
    return ok


def rarity(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Rank of each entropy level over all windows of all texts: the rarest first. At most LEVELS + 1 numbers leave a task."""

    def run(batches):
        counts = np.zeros(LEVELS + 1, dtype=np.int64)
        for batch in batches:
            for _, _, data, bounds in _chunks(utf8(batch.column(0).to_pylist())):
                found = levels(data)
                counts += np.bincount(found[_inside(bounds, len(found))], minlength=LEVELS + 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"level": at, "n": counts[at]}, schema=pa.schema([("level", pa.int64()), ("n", pa.int64())]))

    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, "level long, n long").groupBy("level").agg(F.sum("n").alias("n"))
    counts = np.zeros(LEVELS + 1, dtype=np.int64)
    for r in rows.collect():
        counts[r.level] = r.n
    return ranks_of(counts)


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Ranks from counts; levels that never occur rank before the others, equal counts by level."""
    ranks = np.empty(len(counts), dtype=np.int64)
    ranks[np.lexsort((np.arange(len(counts)), counts))] = np.arange(len(counts))
    ranks[:LEAST_LEVEL] = FAR
    return ranks


def features(texts: list[bytes], ranks: np.ndarray) -> list[list[bytes]]:
    """The distinct features of each text, in order."""
    out: list[list[bytes]] = []
    for a, b, data, bounds in _chunks(texts):
        found = levels(data)
        n = len(found)
        votes = np.zeros(n, dtype=np.int64)
        most = np.full(b - a, VOTES)
        if n:
            ok = _inside(bounds, n)
            rank = np.where(ok, ranks[found], FAR)
            key = np.concatenate([rank * n + np.arange(n), np.full(WINDOW, FAR * n + n)])
            low, width = key, 1
            while width < WINDOW:  # lowest of 64 neighbours, by doubling
                low = np.minimum(low[:-width], low[width:])
                width *= 2
            low = low[:n]
            # runs inside one text; a text with fewer windows has one run, from its first
            first = bounds[:-1][np.diff(bounds) >= WINDOW]
            run = ok & np.r_[ok[WINDOW - 1 :], np.zeros(min(n, WINDOW - 1), dtype=bool)][:n]
            sizes = np.diff(bounds) - WINDOW + 1
            run[first] = True
            # windows that cross into the next text are not ok, so a run of ok windows 64 long never leaves its text
            chosen = low[run]
            votes = np.bincount(chosen[chosen < FAR * n] % n, minlength=n)
            most = np.minimum(VOTES, np.maximum(1, sizes - WINDOW + 1))
        for k, (i, j) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            text = texts[a + k]
            at = np.flatnonzero(votes[i : max(i, j - WINDOW + 1)] >= most[k]).tolist() if j - i >= WINDOW else []
            out.append(list(dict.fromkeys(text[x : x + WINDOW] for x in at)) or ([text] if text else []))
    return out


def digest(found: list[bytes]) -> bytes:
    """Chained Bloom filters: per filter its number of features (2 bytes) and its bits."""
    out = []
    for a in range(0, len(found), PER_FILTER):
        some = found[a : a + PER_FILTER]
        raw = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in some), dtype="<u2").reshape(len(some), 8)
        bits = np.zeros(BITS, dtype=np.uint8)
        bits[(raw[:, :HASHES] % BITS).ravel()] = 1
        out.append(len(some).to_bytes(2, "little") + np.packbits(bits).tobytes())
    return b"".join(out)


def likeness(a: bytes, b: bytes) -> float:
    """0 to 1: how far the common bits of two digests exceed what chance gives."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    size = 2 + BITS // 8
    x, y = (np.frombuffer(d, dtype=np.uint8).reshape(-1, size) for d in sorted((a, b), key=lambda d: (len(d), d)))
    p, q = x[:, 2:], y[:, 2:]
    weights, best = x[:, :2].copy().view("<u2").ravel(), []
    for row in p:
        shared = np.bitwise_count(row & q).sum(axis=1, dtype=np.int64)
        own, other = int(np.bitwise_count(row).sum()), np.bitwise_count(q).sum(axis=1, dtype=np.int64)
        chance = own * other / BITS
        top = np.minimum(own, other)
        best.append(max(0.0, float(np.max((shared - chance) / np.maximum(top - chance, 1e-9)))))
    return min(1.0, float(np.average(best, weights=weights)))


def edited(text: str, following: str) -> str:
    """A text whose last half is replaced by the first characters of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
EDGE = RESULT + ", place int, part int, text string, next_text string"
FIRST, LAST = 1, 2


def _compare(ids: list, texts: list[str], nexts: list[str], ranks: np.ndarray, prints: list[bytes] | None = None, next_prints: list[bytes] | None = None) -> dict:
    """Result columns of some rows; ``prints`` are the digests of the texts, if they are known."""
    new = [edited(t, x) for t, x in zip(texts, nexts)]
    own = prints or [digest(f) for f in features(utf8(texts), ranks)]
    after = next_prints or [digest(f) for f in features(utf8(nexts), ranks)]
    raw = utf8(new)
    changed = [digest(f) for f in features(raw, ranks)]
    return {
        "doc_id": ids, "n_chars": [len(t) for t in texts], "edited_sha256": [hashlib.sha256(t).hexdigest() for t in raw],
        "fingerprint": [base64.b64encode(d).decode() for d in own],
        "edited_fingerprint": [base64.b64encode(d).decode() for d in changed],
        "near_edited": [likeness(x, y) for x, y in zip(own, changed)], "near_next": [likeness(x, y) for x, y in zip(own, after)],
    }


def neighbours(docs: DataFrame, ranks: np.ndarray | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its digest, that of its edited text, and its likeness to that and to the next row's text."""
    spark = docs.sparkSession
    if ranks is None:
        ranks = rarity(docs, text)
    shared = spark.sparkContext.broadcast(ranks)
    names = [f.name for f in StructType.fromDDL(RESULT)]
    edge_schema, schema = to_arrow_schema(StructType.fromDDL(EDGE)), to_arrow_schema(StructType.fromDDL(RESULT))

    def inside(batches):
        table, part = shared.value, TaskContext.get().partitionId()
        held: tuple | None = None  # the last row seen, with its digest

        def edge(place: int, key, value: str) -> dict:
            return {**{n: [None] for n in names}, "doc_id": [key], "place": [place], "part": [part], "text": [value], "next_text": [None]}

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            raw = utf8(texts)
            for a, b in slices(raw, 4 * CHUNK):
                prints = [digest(f) for f in features(raw[a:b], table)]
                k, t, p = ids[a:b], texts[a:b], prints
                if held is None:
                    yield pa.RecordBatch.from_pydict(edge(FIRST, k[0], t[0]), schema=edge_schema)
                else:
                    k, t, p = [held[0], *k], [held[1], *t], [held[2], *p]
                held = k[-1], t[-1], p[-1]
                if len(k) > 1:
                    out = _compare(k[:-1], t[:-1], t[1:], table, p[:-1], p[1:])
                    n = len(k) - 1
                    out |= {"place": [0] * n, "part": [part] * n, "text": [None] * n, "next_text": [None] * n}
                    yield pa.RecordBatch.from_pydict(out, schema=edge_schema)
        if held:
            yield pa.RecordBatch.from_pydict(edge(LAST, held[0], held[1]), schema=edge_schema)

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    rows = source.repartitionByRange(*order[:2]).sortWithinPartitions(*order).mapInArrow(inside, EDGE)
    table = materialize(rows, "digests")
    # one number per partition: which partition follows which
    parts = sorted(r.part for r in table.where(F.col("place") == FIRST).select("part").collect())
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    firsts = table.where(F.col("place") == FIRST).select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    lasts = table.where(F.col("place") == LAST).select("doc_id", "part", "text").join(follows, "part").join(firsts, "next_part")

    def across(batches):
        for batch in batches:
            d = batch.to_pydict()
            if d["doc_id"]:
                out = _compare(d["doc_id"], d["text"], d["next_text"], shared.value)
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    ends = lasts.select("doc_id", "text", "next_text").mapInArrow(across, RESULT)
    return table.where(F.col("place") == 0).select(*names).unionByName(ends)


def digests(docs: DataFrame, ranks: np.ndarray | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row: a plain map."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity(docs, text) if ranks is None else ranks)

    def run(batches):
        out = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])
        for batch in batches:
            prints = [base64.b64encode(digest(f)).decode() for f in features(utf8(batch.column(1).to_pylist()), shared.value)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).to_pylist(), "fingerprint": prints}, schema=out)

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, "doc_id long, fingerprint string")
