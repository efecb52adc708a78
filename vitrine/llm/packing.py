"""Vector bin packing of token streams into fixed-length sequences.

Every example is a vector of tokens, segments and loss-bearing tokens, and a sequence has a
limit on each.  Full sequences are cut off long examples first.  What is left waits in a pool;
a sequence takes, again and again, the waiting example whose vector has the largest dot
product with the room that is left (each part over its limit), and when none fits whole, the
best one is cut to fill the gap.  A sequence that ends early, because of the segment or loss
limit or at the end of a task, is cut back to a power of two, so that nothing is padded.

A task packs the rows of its own partition: no text moves, memory is one pool and one batch,
and a lost task is redone with the same result.  A task leaves at most one short sequence of
each power of two behind.

Null and empty texts are packed as their end id alone.  Repeated rows are packed as often as
they stand there, rows without an id keep a null id, an empty table gives an empty result,
and columns other than the ones that are named play no part.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vitrine.llm import tokens
from vitrine.llm.common import worker_cache

PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
POOL = 256

def packed_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    packed = array("I", ids)
    if sys.byteorder != "little":
        packed.byteswap()
    return packed.tobytes()


class Packer:
    """Packs (example, packed ids, first and last loss-bearing token) into sequences of pieces."""

    def __init__(self, tokens: int = 1024, segments: int = 64, loss: int | None = None, pool: int = POOL) -> None:
        self.limit = np.array([tokens, segments, loss or tokens], dtype=np.int64)
        self.pool = pool
        self.items: list[tuple] = []  # (key, ids, start, total, loss from, loss to)
        self.vectors = np.zeros((pool + 8, 3), dtype=np.int64)

    def _vector(self, item) -> tuple[int, int, int]:
        _, ids, start, _, lo, hi = item
        n = len(ids) // 4
        return n, 1, max(0, min(hi, start + n) - max(lo, start))

    def _cut(self, item, n: int):
        key, ids, start, total, lo, hi = item
        return (key, ids[: 4 * n], start, total, lo, hi), (key, ids[4 * n :], start + n, total, lo, hi)

    def _room(self, item, tokens: int, loss: int) -> int:
        """How many of an item's first tokens stay within both limits."""
        _, ids, start, _, lo, hi = item
        n = min(tokens, len(ids) // 4)
        over = self._vector((0, ids[: 4 * n], start, 0, lo, hi))[2] - loss
        return n if over <= 0 else max(0, max(lo, start) + loss - start)

    def _push(self, item) -> None:
        if len(self.items) == len(self.vectors):
            self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
        self.vectors[len(self.items)] = self._vector(item)
        self.items.append(item)

    def _take(self, at: int):
        item, last = self.items[at], self.items.pop()
        if at < len(self.items):
            self.items[at] = last
            self.vectors[at] = self.vectors[len(self.items)]
        return item

    def add(self, key, ids: bytes, lo: int, hi: int) -> Iterator[list[tuple]]:
        """Add one example; gives the sequences that are ready."""
        item = (key, ids, 0, len(ids) // 4, lo, hi)
        while len(item[1]) // 4 >= self.limit[0]:
            n = self._room(item, int(self.limit[0]), int(self.limit[2]))
            if n < self.limit[0]:
                break
            head, item = self._cut(item, n)
            yield [head]
        if item[1]:
            self._push(item)
        while len(self.items) > self.pool:
            yield self._sequence()

    def flush(self) -> Iterator[list[tuple]]:
        while self.items:
            yield self._sequence()

    def _sequence(self) -> list[tuple]:
        left, bin_ = self.limit.copy(), []
        while self.items and left.min() >= 0 and left[0] and left[1]:
            v = self.vectors[: len(self.items)]
            fits = (v <= left).all(axis=1)
            score = v @ (left / (self.limit * self.limit))
            if fits.any():
                item = self._take(int(np.argmax(np.where(fits, score, -1.0))))
            else:
                at = int(np.argmax(score))
                n = self._room(self.items[at], int(left[0]), int(left[2]))
                if not n:
                    break
                item, rest = self._cut(self._take(at), n)
                if rest[1]:
                    self._push(rest)
            bin_.append(item)
            left -= self._vector(item)
        used = int(self.limit[0] - left[0])
        excess = used - (1 << used.bit_length() - 1) if left[0] else 0
        while excess:  # cut back to a power of two
            item = bin_.pop()
            n = len(item[1]) // 4
            if n > excess:
                item, rest = self._cut(item, n - excess)
                bin_.append(item)
                self._push(rest)
                excess = 0
            else:
                self._push(item)
                excess -= n
        return bin_


def pack_ids(
    examples: DataFrame, doc_id: str = "doc_id", ids: str = "ids", loss_from: str | None = None,
    max_tokens: int = 1024, max_segments: int = 64, max_loss: int | None = None,
) -> DataFrame:
    """Pack examples whose token ids (array<int>) are given.

    ``loss_from`` names the column with the position of the first loss-bearing token of an
    example (a prompt bears none); without it, all tokens bear loss.  One row per piece: its ids as
    little-endian unsigned 32-bit numbers, its place in its example and in its sequence.
    """

    def start():
        def encode(rows):
            for i, values in enumerate(rows["ids"]):
                packed = np.array(values or [], dtype="<u4").tobytes()
                yield rows["doc_id"][i], packed, min(rows["lo"][i] or 0, len(packed) // 4), len(packed) // 4

        return encode

    lo = F.col(loss_from).cast("long") if loss_from else F.lit(0).cast("long")
    source = examples.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).cast("array<long>").alias("ids"), lo.alias("lo"))
    return _packed(source, start, max_tokens, max_segments, max_loss)


def pack_texts(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = 0, doc_id: str = "doc_id", text: str = "text",
    max_tokens: int = 1024, max_segments: int = 64, max_loss: int | None = None, cache: int = 1_200_000,
) -> DataFrame:
    """Pack whole texts: their ids, then ``end_id``.  All tokens but the end id bear loss."""

    def start():
        known = worker_cache(("packing", vocabulary, cache), lambda: tokens.Pieces(tokens.load(vocabulary), packed_ids, None, cache))
        end = np.array([end_id], dtype="<u4").tobytes()

        def encode(rows):
            for key, values in zip(rows["doc_id"], known.of([t or "" for t in rows["text"]])):
                values.append(end)
                packed = b"".join(values)
                yield key, packed, 0, len(packed) // 4 - 1

        return encode

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return _packed(source, start, max_tokens, max_segments, max_loss)


def _packed(source: DataFrame, start, max_tokens: int, max_segments: int, max_loss: int | None) -> DataFrame:
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")

    schema = to_arrow_schema(StructType.fromDDL(PIECE))

    def run(batches):
        encode, packer = start(), Packer(max_tokens, max_segments, max_loss)
        base, made = TaskContext.get().partitionId() << 40, 0

        def rows(sequences):
            nonlocal made
            out = {f.name: [] for f in schema}
            for sequence in sequences:
                offset = 0
                for key, ids, first, total, *_ in sequence:
                    n = len(ids) // 4
                    for name, value in zip(out, (key, first, n, ids, total, base + made, offset)):
                        out[name].append(value)
                    offset += n
                made += 1
            return pa.RecordBatch.from_pydict(out, schema=schema)

        for batch in batches:
            yield rows(s for example in encode(batch.to_pydict()) for s in packer.add(*example))
        yield rows(packer.flush())

    return source.mapInArrow(run, PIECE)
