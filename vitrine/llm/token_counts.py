"""Token counts by a two-tier lookup on the map side.

A first pass over all texts gathers a bounded summary of frequent pieces per task and joins
the summaries into one table of the most frequent ones; the driver asks the library for
their lengths and broadcasts them.  The second pass looks every piece of every text up in
that table, and sends only misses to the library, through a cache that each Python worker
keeps.  Pieces themselves are never shuffled, and the table only saves time: counts do not
depend on it.

Null and empty texts have 0 bytes and 0 tokens.  Repeated rows are counted as often as they
stand there, rows without an id keep a null id, an empty table gives an empty result, and
columns other than the two that are named play no part.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import tokens
from vitrine.llm.common import map_batches, slices, worker_cache

#: entries of the broadcast table, and of the summary that a task hands over
TABLE, PER_TASK = 16_384, 2_048
#: pieces longer than this many characters are left to the workers' caches, which bounds the table's size
LONGEST = 32
#: a task's counter is cut back to its larger half beyond this many entries
COUNTER = 200_000

def frequent_pieces(docs: DataFrame, text: str = "text", table: int = TABLE, per_task: int = PER_TASK) -> list[str]:
    """The most frequent space-led pieces of all texts, most frequent first (at most ``table``)."""

    def run(batches):
        import pyarrow as pa

        seen: Counter = Counter()
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in slices(texts):
                seen.update(" ".join(texts[a:b]).replace("\n", " \n").split(" "))
                if len(seen) > COUNTER:
                    seen = Counter(dict(seen.most_common(COUNTER // 2)))
        top = [(u, n) for u, n in seen.most_common(per_task) if u and len(u) <= LONGEST and u[:2] != "\n\n" and not u[-1].isspace() and not u.lstrip("\n")[:1].isspace()]
        yield pa.RecordBatch.from_pydict(
            {"piece": [u for u, _ in top], "n": [n for _, n in top]},
            schema=pa.schema([("piece", pa.string()), ("n", pa.int64())]),
        )

    rows = (
        docs.select(F.col(text).alias("text")).mapInArrow(run, "piece string, n long")
        .groupBy("piece").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece").limit(table)
    )
    return [r.piece for r in rows.collect()]


def count_tokens(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", doc_id: str = "doc_id", text: str = "text",
    limit: int = 512, table: int = TABLE, cache: int = 1_200_000,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    pieces = frequent_pieces(docs, text, table)
    lengths = tokens.Pieces(tokens.load(vocabulary), len).encode([p if p[0] == "\n" else " " + p for p in pieces])
    packed = docs.sparkSession.sparkContext.broadcast(("\x00".join(pieces), lengths))
    key = ("counts", vocabulary, hash(tuple(pieces)), cache)

    def start():
        def make():
            names, values = packed.value
            seed = dict(zip(names.split("\x00"), values)) if values else {}
            return tokens.Pieces(tokens.load(vocabulary), len, seed, cache)

        known = worker_cache(key, make)

        def count(rows: dict) -> dict:
            texts = [t or "" for t in rows["text"]]
            n = [sum(values) for values in known.of(texts)]
            return {
                "doc_id": rows["doc_id"], "n_bytes": [len(t.encode()) for t in texts], "n_tokens": n,
                "over_limit": [x > limit for x in n],
            }

        return count

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(source, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", start)
