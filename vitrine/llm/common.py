"""What the operators of this folder share: reading, Arrow map jobs and text slices."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# A word is a run without ASCII white space.  Python's bytes.split() cuts at exactly these characters.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def map_batches(df: DataFrame, ddl: str, start: Callable[[], Callable[[dict], dict | Iterator[dict]]]) -> DataFrame:
    """Run a function over Arrow batches.

    ``start`` is called once in every task and returns the function, which gets a dict of
    Python lists and returns a dict of lists (or yields several).
    """
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = start()
        for batch in batches:
            out = fn(batch.to_pydict())
            for piece in (out,) if isinstance(out, dict) else out:
                yield pa.RecordBatch.from_pydict(piece, schema=schema)
        pa.default_memory_pool().release_unused()  # workers wait between tasks, and what they hold counts

    return df.mapInArrow(run, ddl)


_CACHE: dict = {}


def worker_cache(key, make: Callable):
    """What a Python worker keeps from task to task: the cache of one operator, the last one that asked."""
    if key not in _CACHE:
        _CACHE.clear()
        _CACHE[key] = make()
    return _CACHE[key]


def slices(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Cut a list into runs of neighbours that hold about ``most`` bytes; a longer text is a run of its own."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def utf8(texts: list[str | None]) -> list[bytes]:
    """UTF-8 of every text; null is empty."""
    return [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), in the JVM: each word, with the white space before it, becomes one mark."""
    marks = F.regexp_replace(text, r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++", "x")
    return F.coalesce(F.length(F.rtrim(marks, F.lit(" \t\n\x0b\f\r"))), F.lit(0)).cast("long")
