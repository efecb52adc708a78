"""Ranks and running totals that do not put a whole run into one task.

A plain ``row_number() OVER (PARTITION BY run ORDER BY page, pos)`` sends every row
of a run to one task.  Here only one *page* of a run is ordered inside a task; the
rows in front of a page come from per-page counts, and those are summed in blocks, so a
window sees ``FANOUT`` pages of a run, and one row per ``FANOUT`` pages at the top.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FANOUT = 16384
LEVELS = 1


def prefix_sums(totals: DataFrame, keys: list[str], order: str, values: list[str],
                levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """Exclusive running sums: adds ``<value>_before`` to one row per (keys, order).

    ``order`` is an integer column, unique inside ``keys``, such as a page or entry number.
    Blocks hold ``fanout`` consecutive values; use more levels when values are far apart.
    """
    if levels == 0:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return totals.withColumns({
            f"{v}_before": F.coalesce(F.sum(v).over(w), F.lit(0)) for v in values
        })
    block = f"__block{levels}"
    blocked = totals.withColumn(block, F.floor(F.col(order) / F.lit(fanout)))
    upper = prefix_sums(
        blocked.groupBy(*keys, block).agg(*[F.sum(v).alias(v) for v in values]),
        keys, block, values, levels - 1, fanout,
    ).select(*keys, block, *[F.col(f"{v}_before").alias(f"__{v}_base{levels}") for v in values])
    w = (
        Window.partitionBy(*keys, block).orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = blocked.withColumns({
        f"__{v}_in": F.coalesce(F.sum(v).over(w), F.lit(0)) for v in values
    })
    out = inside.join(upper, [*keys, block])
    sums = {f"{v}_before": F.col(f"__{v}_in") + F.col(f"__{v}_base{levels}") for v in values}
    extra = [block] + [f"__{v}_in" for v in values] + [f"__{v}_base{levels}" for v in values]
    return out.withColumns(sums).drop(*extra)


def running_rank(df: DataFrame, keys: list[str], page: str, within: list, name: str,
                 wanted: DataFrame | None = None) -> DataFrame:
    """1-based rank over (page, within) inside ``keys``, no run in one task.

    ``page`` is an integer column that bounds the rows ordered in one task.  With ``wanted`` (distinct values of some
    columns), only rows that have them come back: all pages are counted, but only theirs are ordered.
    """
    counts = df.groupBy(*keys, page).agg(F.count(F.lit(1)).alias("__n"))
    offsets = prefix_sums(counts, keys, page, ["__n"]).select(
        *keys, page, F.col("__n_before").alias("__offset")
    )
    local = F.row_number().over(Window.partitionBy(*keys, page).orderBy(*within))
    rows = df
    if wanted is not None:
        # only pages that hold a wanted row are ordered
        pages = df.join(wanted, wanted.columns, "left_semi").select(*keys, page).distinct()
        rows = df.join(pages, [*keys, page], "left_semi")
    ranked = (
        rows.withColumn("__local", local)
        .join(offsets, [*keys, page])
        .withColumn(name, (F.col("__offset") + F.col("__local")).cast("long"))
        .drop("__local", "__offset")
    )
    return ranked if wanted is None else ranked.join(wanted, wanted.columns, "left_semi")


def one_per_key(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row per key: the smallest of its rows by ``fields``, and ``ambiguous`` when they differ.

    For the right side of a lookup, so that a row on the left comes back once.  Blank keys stay out:
    they never match, and all of them would meet in one task.
    """
    values = F.struct(*[F.col(f) for f in fields])
    known = [F.coalesce(F.col(k).cast("string"), F.lit("")) != "" for k in keys]
    rows = df.filter(reduce(lambda a, b: a & b, known))
    out = rows.groupBy(*keys).agg(F.min(values).alias("__low"), (F.min(values) != F.max(values)).alias("ambiguous"))
    return out.select(*keys, *[F.col(f"__low.{f}").alias(f) for f in fields], "ambiguous")


def spread_blank(key: Column) -> Column:
    """A text key whose blanks are dealt over many values that match nothing, so that they don't meet in one task."""
    dealt = F.concat(F.lit("\x00"), F.pmod(F.monotonically_increasing_id(), F.lit(FANOUT)).cast("string"))
    return F.when(F.coalesce(key.cast("string"), F.lit("")) != "", key.cast("string")).otherwise(dealt)


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], never_blank: list[str] | None = None) -> DataFrame:
    """Left join of rows with a table that has one row per key, on text keys.

    A blank key (of ``never_blank``, or any) never matches, so rows with one are dealt out instead of meeting in one task.
    """
    known = [F.coalesce(F.col(k).cast("string"), F.lit("")) != "" for k in never_blank or keys]
    whole = reduce(lambda a, b: a & b, known)
    asked = rows.withColumn("__ask", F.when(whole, F.col(keys[0])).otherwise(spread_blank(F.lit(""))))
    answers = table.filter(whole).withColumnRenamed(keys[0], "__ask")
    return asked.join(answers, ["__ask", *keys[1:]], "left").drop("__ask")


def first_rows(df: DataFrame, keys: list[str], order: list, n: int = 1,
               name: str | None = None) -> DataFrame:
    """First ``n`` rows per key; the limit is applied before the shuffle as well."""
    rank = name or "__rank"
    out = df.withColumn(
        rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ).filter(F.col(rank) <= n)
    return out if name else out.drop(rank)
