"""Nested JSON held as VARIANT: row-local descent without shuffles.

A level is an ``array<struct<path,doc>>``; going one level down is one expression, so a
document is walked inside its own row however many rows there are and however deep it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NODE = "array<struct<path:string,doc:variant>>"


def get(doc: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(doc, path, kind)


def as_array(doc: Column) -> Column:
    """Elements of a JSON array, NULL for anything else."""
    return F.try_variant_get(doc, "$", "array<variant>")


def as_entries(doc: Column) -> Column:
    """Key-value entries of a JSON object, NULL for anything else."""
    return F.map_entries(F.try_variant_get(doc, "$", "map<string,variant>"))


def root(doc: Column, path: str = "") -> Column:
    return F.array(F.struct(F.lit(path).alias("path"), doc.alias("doc")))


def no_nodes() -> Column:
    return F.array().cast(NODE)


def children(node: Column) -> Column:
    """Direct children of a node with their paths (``a.b``, ``a[0]``)."""
    return _below(node["path"], as_array(node["doc"]), as_entries(node["doc"]))


def _below(path: Column, items: Column, entries: Column) -> Column:
    from_list = F.transform(
        items,
        lambda d, i: F.struct(
            F.concat(path, F.lit("["), i.cast("string"), F.lit("]")).alias("path"), d.alias("doc")),
    )
    from_object = F.transform(
        entries,
        lambda e: F.struct(
            F.when(path == "", e["key"]).otherwise(F.concat(path, F.lit("."), e["key"])).alias("path"),
            e["value"].alias("doc")),
    )
    return F.coalesce(from_list, from_object, no_nodes())


def walk(df, seed: Column, out: str, step: Callable[[Column], Column]):
    """Adds ``out``: the seed nodes and everything ``step`` finds below, level by level, however deep a document is.

    A row goes down until no node has children.  The steps are counted by the opening brackets of its documents, which are
    never fewer than its levels, and a row that is done does nothing more in the steps that are left.
    """
    deepest = _deepest(seed)

    def down(state: Column, _: Column) -> Column:
        below = F.array(F.flatten(F.transform(state["front"], step)))
        next_ = F.get(F.transform(below, lambda b: F.struct(b.alias("front"), F.concat(state["nodes"], b).alias("nodes"))), F.lit(0))
        return F.when(F.size(state["front"]) == 0, state).otherwise(next_)

    start = F.struct(F.col(f"__{out}").alias("front"), F.col(f"__{out}").alias("nodes"))
    walked = F.aggregate(F.sequence(F.lit(1), F.col(f"__{out}_deep")), start, down, lambda state: state["nodes"])
    return df.withColumn(f"__{out}", F.coalesce(seed, no_nodes())).withColumn(f"__{out}_deep", deepest).withColumn(out, walked).drop(f"__{out}", f"__{out}_deep")


def _deepest(seed: Column) -> Column:
    brackets = lambda n: F.length(F.regexp_replace(F.coalesce(F.to_json(n["doc"]), F.lit("")), r"[^\[{]+", ""))
    return F.greatest(F.coalesce(F.array_max(F.transform(seed, brackets)), F.lit(0)), F.lit(1))


def find(df, seed: Column, out: str, keep: Callable[[Column], Column]):
    """Adds ``out``: those of the seed nodes and everything below them that ``keep`` holds for.

    ``keep`` sees ``path``, ``doc``, ``items`` (NULL unless a list) and ``entries`` (NULL unless an object).  A node is judged when
    it is opened, so that what is not kept is never copied: each level of a deep document holds a copy of all below it.
    """
    opened = lambda n: F.struct(
        n["path"].alias("path"), n["doc"].alias("doc"), as_array(n["doc"]).alias("items"), as_entries(n["doc"]).alias("entries"))

    def down(state: Column, _: Column) -> Column:
        nodes = F.array(F.transform(state["front"], opened))
        next_ = F.get(F.transform(nodes, lambda o: F.struct(
            F.flatten(F.transform(o, lambda n: _below(n["path"], n["items"], n["entries"]))).alias("front"),
            F.concat(state["nodes"], F.transform(
                F.filter(o, keep), lambda n: F.struct(n["path"].alias("path"), n["doc"].alias("doc")))).alias("nodes"))), F.lit(0))
        return F.when(F.size(state["front"]) == 0, state).otherwise(next_)

    start = F.struct(F.col(f"__{out}").alias("front"), no_nodes().alias("nodes"))
    # the last level is opened one step behind the last bracket
    steps = F.sequence(F.lit(0), F.col(f"__{out}_deep"))
    found = F.aggregate(steps, start, down, lambda state: state["nodes"])
    return df.withColumn(f"__{out}", F.coalesce(seed, no_nodes())).withColumn(f"__{out}_deep", _deepest(seed)).withColumn(out, found).drop(f"__{out}", f"__{out}_deep")
