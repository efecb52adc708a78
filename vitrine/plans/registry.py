"""Named queries with the SQL text that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` it is covered by tests on small fixtures."""

    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return keep


def column_query(name, source, keys, inputs, outputs):
    """Register one projection over a whole driver table.

    ``inputs`` are SQL texts both engines read; ``outputs`` map a column name to
    (builder over the input columns, the same value in the checking dialect).
    """
    from pyspark.sql import functions as F

    from vitrine.plans.inputs import DEALT, dealt, table

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        read = dealt if source in DEALT else table
        base = read(spark, sf_dir, source).selectExpr(
            *keys, *[f"{expr} AS {col}" for col, expr in inputs.items()]
        )
        cols = {c: F.col(c) for c in base.columns}
        return base.select(*keys, *[fn(cols).alias(out) for out, (fn, _) in outputs.items()])

    inner = ", ".join([*keys, *[f"{expr} AS {col}" for col, expr in inputs.items()]])
    shown = ", ".join([*keys, *[f"{sql} AS {out}" for out, (_, sql) in outputs.items()]])
    query(name, f"SELECT {shown} FROM (SELECT {inner} FROM {source})")(run)
