"""Groups of bounded size in Arrow tasks, and summaries that meet in rounds."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vitrine.session import materialize


def schema_of(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The groups of a stream that is sorted by a column, each as one table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        change = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[-1].column(key)[-1] != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def map_groups(df: DataFrame, key: str, order: list[str], ddl: str, fn: Callable[[pa.Table], Iterator[dict]]) -> DataFrame:
    """Deal rows out by ``key`` and run ``fn`` over each group, its rows sorted by ``order``. Only for groups of bounded size."""
    schema = schema_of(ddl)

    def run(batches):
        for table in groups(batches, key):
            for out in fn(table):
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, ddl)


def lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each item, items) of a list column."""
    whole = column.combine_chunks()
    return np.repeat(np.arange(len(whole)), pc.list_value_length(whole).to_numpy(zero_copy_only=False)), whole.flatten().to_numpy(zero_copy_only=False)


def vectors(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """Rows of a binary column that hold numbers of one type, as a matrix."""
    whole = column.combine_chunks()
    return np.frombuffer(b"".join(whole.to_pylist()), dtype=kind).reshape(len(whole), -1) if len(whole) else np.zeros((0, 1), dtype=kind)


def meet(parts: DataFrame, ddl: str, add: Callable[[list[bytes]], bytes], name: str, fan: int = 16) -> bytes | None:
    """Combine the summaries of all tasks (part long, summary binary) into one, ``fan`` at a time.

    Every round is written to the shared folder, so that a task holds ``fan`` summaries and the driver the last one.
    """
    schema = schema_of(ddl)

    def run(batches):
        for table in groups(batches, "g"):
            yield pa.RecordBatch.from_pydict({"part": [table["g"][0].as_py()], "summary": [add(table["summary"].to_pylist())]}, schema=schema)

    parts = materialize(parts, name)
    while (most := parts.agg(F.max("part")).first()[0]) is not None and most > 0:
        dealt = parts.withColumn("g", F.floor(F.col("part") / fan).cast("long"))
        parts = materialize(dealt.repartition("g").sortWithinPartitions("g", "part").mapInArrow(run, ddl), name)
    last = parts.select("summary").first()
    return bytes(last[0]) if last else None


SUMMARY = "part long, summary binary"
