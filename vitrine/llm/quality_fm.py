"""Quality score by a factorisation machine.

A text's features are its hashed words (root of the count, scaled to length one) and a fixed set
of structure statistics and metadata, each cut into equally filled bins of which one is on.  The
model adds a weight per feature and, for every pair of features, the product of two short factor
vectors; with the identity  sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 -
sum_i v_if^2 x_i^2)  all pairs cost time linear in the number of features.

It is trained in the driver on at most ``train_rows`` labelled rows: those with the smallest
hashes of their ids among the rows that may teach.  Labels, language, source and id are never
inputs.  Scoring is a map over all rows; only the model is broadcast, and its size is fixed.

Null and empty texts have no words and are scored by their statistics.  Repeated rows give
repeated results, rows without an id keep a null id and are not held out, labels that
contradict each other for one id are read as their least value, an empty table gives an empty
result, and without labels of both kinds every score is the share of good labels (0.5 without
any).  Columns other than the ones that are named play no part.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import map_batches, slices, utf8, worker_cache

WORDS = 1 << 14
BINS = 8
FACTORS = 8
TRAIN_ROWS, EPOCHS, BATCH, RATE, DECAY = 8_192, 6, 64, 0.1, 1e-4
STATISTICS = (
    "chars", "declared_chars", "words", "word_length", "upper", "marks", "symbols", "digits", "beyond_ascii", "spaces",
    "distinct_words", "lines", "repeated_lines", "closed_lines", "bars", "calls",
)

_CLASS = np.zeros(256, dtype=np.int64)  # what a byte counts as
_CLASS[65:91] = 1
_CLASS[48:58] = 2
for _c in b".,;:'\"()-?":
    _CLASS[_c] = 3
for _c in b"#*$%&<>=@^~_\\/+{}[]":
    _CLASS[_c] = 4
for _c in b" \t\r\f\v\n":
    _CLASS[_c] = 5
_CLASS[128:] = 6
_CLASS[ord("|")] = 7
_CLASS[ord("!")] = 8


class _Hashes(dict):
    """Word -> feature number; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        number = self[word] = zlib.crc32(word) & (WORDS - 1)
        return number


def features(raw: list[bytes], declared: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of some texts: (text, word feature, value) of the distinct words, and the statistics."""
    number = worker_cache("quality words", _Hashes).__getitem__
    per_text, stats = [], np.zeros((len(raw), len(STATISTICS)))
    for k, t in enumerate(raw):
        words = t.split()
        per_text.append(list(map(number, words)))
        size = max(1, len(t))
        kind = np.bincount(_CLASS[np.frombuffer(t, dtype=np.uint8)], minlength=9) / size
        lines = [x for x in t.split(b"\n") if x and not x.isspace()]
        n, m = max(1, len(words)), max(1, len(lines))
        chars = len(t) - int(kind[6] * size) // 2
        stats[k] = (
            np.log1p(chars), np.log1p(max(0, declared[k] if declared[k] is not None else chars)), np.log1p(len(words)),
            sum(map(len, words)) / n, kind[1], kind[3], kind[4], kind[2], kind[6], kind[5], len(set(words)) / n, np.log1p(len(lines)),
            1 - len(set(lines)) / m, sum(x.rstrip()[-1:] in b".!?:" for x in lines) / m, kind[7], kind[8],
        )
    sizes = [len(w) for w in per_text]
    text = np.repeat(np.arange(len(raw)), sizes)
    both, counts = np.unique(
        text * WORDS + np.fromiter((i for w in per_text for i in w), dtype=np.int64, count=sum(sizes)), return_counts=True)
    text, word = both // WORDS, both % WORDS
    value = np.sqrt(counts)
    norm = np.sqrt(np.bincount(text, weights=counts, minlength=len(raw)))
    return text, word, value / np.maximum(norm, 1e-12)[text], stats


@dataclass
class Model:
    """``edges``: bin limits of each statistic. ``weights`` and ``factors``: words, then bins."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    edges: np.ndarray

    def rows(self, text, word, value, stats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All features of some texts as (text, feature, value), sorted by text."""
        n, m = stats.shape
        bins = np.stack([np.searchsorted(self.edges[j], stats[:, j], side="right") for j in range(m)], axis=1)
        own = WORDS + np.arange(m) * BINS + bins
        t = np.concatenate([text, np.repeat(np.arange(n), m)])
        by = np.argsort(t, kind="stable")
        return (
            t[by], np.concatenate([word, own.ravel()])[by],
            np.concatenate([value, np.full(n * m, 1 / np.sqrt(m))])[by],
        )

    def margin(self, text, feature, value, n: int):
        """Score before the logistic, and the factor sums: linear in the number of features."""
        first = np.searchsorted(text, np.arange(n))
        v = self.factors[feature] * value[:, None]
        sums = np.add.reduceat(v, first, axis=0)
        squares = np.add.reduceat((v * v).sum(axis=1), first)
        linear = np.add.reduceat(self.weights[feature] * value, first)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def score(self, raw: list[bytes], declared: list[int | None]) -> np.ndarray:
        text, word, value, stats = features(raw, declared)
        z, _ = self.margin(*self.rows(text, word, value, stats), len(raw))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(label: np.ndarray, text, word, value, stats, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Logistic loss in small batches with adaptive step sizes."""
    n, m = stats.shape
    good = float(label.mean()) if n else 0.5
    size = WORDS + m * BINS
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T if n else np.zeros((m, BINS - 1))
    rng = np.random.default_rng(seed)
    model = Model(0.0, np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)), np.ascontiguousarray(edges))
    if good in (0.0, 1.0) or not n:
        share = min(max(good, 0.01), 0.99) if n else 0.5
        return Model(float(np.log(share / (1 - share))), np.zeros(size), np.zeros((size, FACTORS)), model.edges)
    text, feature, value = model.rows(text, word, value, stats)
    bounds = np.searchsorted(text, np.arange(n + 1))
    gw, gv, gb = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(epochs):
        shuffled = rng.permutation(n)
        for a in range(0, n, BATCH):
            rows = shuffled[a : a + BATCH]
            sizes = bounds[rows + 1] - bounds[rows]
            at = np.repeat(bounds[rows] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
            t, f, x = np.repeat(np.arange(len(rows)), sizes), feature[at], value[at]
            z, sums = model.margin(t, f, x, len(rows))
            slope = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label[rows]) / len(rows)
            used, place = np.unique(f, return_inverse=True)
            per = slope[t] * x
            dw = np.bincount(place, weights=per, minlength=len(used)) + DECAY * model.weights[used]
            each = per[:, None] * (sums[t] - model.factors[f] * x[:, None])
            dv = np.stack([np.bincount(place, weights=each[:, k], minlength=len(used)) for k in range(FACTORS)], axis=1)
            dv += DECAY * model.factors[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            model.weights[used] -= RATE * dw / np.sqrt(gw[used])
            model.factors[used] -= RATE * dv / np.sqrt(gv[used])
            db = slope.sum()
            gb += db * db
            model.bias -= RATE * db / np.sqrt(gb)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars",
    label: str = "quality", train_rows: int = TRAIN_ROWS,
) -> Model:
    """Fit on at most ``train_rows`` labelled rows that are not held out."""
    sample = (
        labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("label"))
        .where("id IS NOT NULL AND label IN (0, 1)").where(~held_out(F.col("id")))
        .groupBy("id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(train_rows)
    )
    # the sample is bounded, so it is what travels; of rows that repeat an id one teaches, so that what comes back is bounded too
    rows = (
        docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), F.col(n_chars).cast("long").alias("n_chars"))
        .join(F.broadcast(sample), "id")
        .groupBy("id", "label").agg(F.min(F.struct("text", "n_chars")).alias("one")).select("id", "label", "one.text", "one.n_chars")
    )

    def start():
        def encode(batch: dict):
            raw = utf8(batch["text"])
            for a, b in slices(raw):
                of, word, value, stats = features(raw[a:b], batch["n_chars"][a:b])
                cut = np.searchsorted(of, np.arange(b - a + 1))
                yield {
                    "id": batch["id"][a:b], "label": batch["label"][a:b],
                    "word": [word[i:j].astype("<u2").tobytes() for i, j in zip(cut, cut[1:])],
                    "value": [value[i:j].astype("<f4").tobytes() for i, j in zip(cut, cut[1:])],
                    "stats": stats.tolist(),
                }

        return encode

    table = map_batches(rows, "id long, label int, word binary, value binary, stats array<double>", start).toArrow().to_pydict()
    by = sorted(range(len(table["id"])), key=lambda i: (table["id"][i], table["word"][i], table["value"][i], table["stats"][i]))[:train_rows]
    words = [np.frombuffer(table["word"][i], dtype="<u2") for i in by]
    none = np.zeros(0)
    return fit(
        np.array([table["label"][i] for i in by], dtype=float),
        np.repeat(np.arange(len(by)), [len(w) for w in words]),
        np.concatenate([*words, none]).astype(np.int64),
        np.concatenate([*(np.frombuffer(table["value"][i], dtype="<f4") for i in by), none]).astype(float),
        np.array([table["stats"][i] for i in by], dtype=float).reshape(len(by), len(STATISTICS)),
    )


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        fm = shared.value

        def judge(batch: dict):
            raw = utf8(batch["text"])
            for a, b in slices(raw):
                scores = fm.score(raw[a:b], batch["n_chars"][a:b])
                yield {
                    "doc_id": batch["doc_id"][a:b], "held_out": batch["held_out"][a:b], "score": scores.tolist(),
                    "predicted": (scores >= 0.5).astype(int).tolist(),
                }

        return judge

    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(n_chars).cast("long").alias("n_chars"),
        held_out(F.col(doc_id)).alias("held_out"),
    )
    return map_batches(source, "doc_id long, held_out boolean, score double, predicted int", start)


def keep_good(docs: DataFrame, model: Model, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The rows, with all their columns, that the model does not reject."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fm = shared.value
        for batch in batches:
            raw = utf8(batch.column(text).to_pylist())
            declared = batch.column(n_chars).to_pylist()
            good: list = []
            for a, b in slices(raw):
                good += (fm.score(raw[a:b], declared[a:b]) >= 0.5).tolist()
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
