"""Evidence of one product in its own row: an array of candidate values, resolved field by field without a shuffle.

The rules are those of :mod:`vitrine.operators.evidence`; there, evidence is a table and a product may be spread over many
rows, here all its labels, its description and its title stand in one row.  Each rule stands once in a plan.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import measures as S
from vitrine.functions.text import as_text, collapse_repeated_range, colour_word, let, model_year, present, squash
from vitrine.functions.validators import (
    exact_loading_direction, is_capacity_band, is_screen_size, is_washer_capacity, measure_key, refrigerator_type, type_specificity,
)
from vitrine.operators.evidence import BAND_OFFSET, POLICIES, TITLE_FALLBACK
from vitrine.operators.labels import label_rows, labels_of

EVIDENCE = "array<struct<field:string,level:int,ordinal:string,source:string,raw:string>>"


def _dictionary(layout: str, wanted: list[str]) -> Column:
    """label -> array<struct<field,level,rule>> as one literal."""
    table: dict = {}
    for label, field, level, rule in label_rows(layout):
        if field in wanted:
            table.setdefault(label, []).append({"field": field, "level": level, "rule": rule})
    return F.from_json(F.lit(json.dumps(table)), "map<string,array<struct<field:string,level:int,rule:string>>>")


def _entry(field, level, ordinal, source, raw: Column) -> Column:
    c = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(c(field).alias("field"), c(level).cast("int").alias("level"), c(ordinal).alias("ordinal"), c(source).alias("source"), raw.alias("raw"))


def _entries(field: str, level: int, source: str, raws: Column) -> Column:
    return F.transform(raws, lambda v, i: _entry(field, level, F.lpad(i.cast("string"), 12, "0"), source, v))


def _hits(labels: Column, layout: str, wanted: list[str]) -> Column:
    """Labels that speak for a wanted field, with the field's rule; see :func:`evidence.labelled_evidence` for the sources that count."""
    known = let(_dictionary(layout, wanted), lambda d: F.flatten(F.array_compact(F.transform(labels, lambda l, k: F.transform(
        F.try_element_at(d, l["label_key"]), lambda x: F.struct(
            x["field"].alias("field"), x["level"].alias("level"), x["rule"].alias("rule"), l["source"].alias("source"),
            l["order_key"].alias("ordinal"), l["value"].alias("value"), k.alias("at")))))))
    if layout != "M":
        return known
    screen = lambda h: h["field"] == "screen_size"
    counts = lambda h: screen(h) | h["source"].isin("fact", "page") | (
        (h["source"] == "attribute") & ~h["field"].isin("ref_capacity", "ldy_capacity", "ldy_loading_type"))
    later = lambda h: F.when(screen(h) & h["source"].isin("fact", "page"), 1).when(screen(h) & (h["source"] == "bundle"), 2).otherwise(0)
    return F.transform(F.filter(known, counts), lambda h: F.struct(
        h["field"].alias("field"), (h["level"] + later(h)).alias("level"), h["rule"].alias("rule"), h["source"].alias("source"),
        h["ordinal"].alias("ordinal"), h["value"].alias("value"), h["at"].alias("at")))


def _labelled(hits: Column, rules: list[str], compact: Column, read: Column) -> list[Column]:
    """Evidence of labelled values, one array per value rule; ``read`` has the volumes of every text by its number."""
    of = lambda rule, raw: F.transform(
        F.filter(hits, lambda h: h["rule"] == rule), lambda h: _entry(h["field"], h["level"], h["ordinal"], h["source"], raw(h["value"])))
    simple = {
        "mass": lambda v: F.when(is_washer_capacity(v) | (compact & S.is_compact_volume(v)), v),
        "screen": lambda v: F.when(is_screen_size(v), v),
        "loading": S.labelled_loading,
        "door": refrigerator_type,
        "door_count": lambda v: F.when(F.regexp_extract(v, r"(\d+)", 1) == "2", "Duplex"),
        "text": lambda v: v,
        "energy": lambda v: let(S.energy_text(v), S.labelled_energy),
    }

    def volume(h: Column) -> Column:
        return let(F.get(read, h["at"]), lambda x: F.concat(
            F.transform(S.scalar_capacities(h["value"], x["parts"], x["found"]), lambda raw: _entry(h["field"], h["level"], h["ordinal"], h["source"], raw)),
            F.transform(x["parts"], lambda p: _entry(h["field"], _part_level(p, 25, 42, 52), h["ordinal"], h["source"], p["raw"]))))

    return [
        F.flatten(F.transform(F.filter(hits, lambda h: h["rule"] == "volume"), volume)) if rule == "volume" else of(rule, simple[rule])
        for rule in rules
    ]


def _part_level(p: Column, total: int, refrigerator: int, freezer: int) -> Column:
    return F.when(p["kind"] == "total", total).when(p["kind"] == "refrigerator", refrigerator).otherwise(freezer)


def _stated(texts: Column, layout: str, wanted: list[str], read: Column, energy: Column) -> list[Column]:
    """Evidence that a description states in phrases, and facts (for loading, also attributes) under whatever label they stand."""
    sources = ("fact", "description") if layout == "M" else ("description",)
    told = lambda x: x["source"] == "description"
    at = lambda x, i: F.concat(x["order_key"], F.lpad(i.cast("string"), 12, "0"))
    each = lambda fn: F.flatten(F.transform(texts, lambda x, k: F.when(x["source"].isin(*sources), fn(x, k)).otherwise(F.array().cast(EVIDENCE))))
    found = []
    if "estimated_annual_electricity_use" in wanted:
        found.append(each(lambda x, k: F.transform(F.get(energy, k), lambda v, i: _entry(
            "estimated_annual_electricity_use", F.when(told(x), 40).otherwise(30), at(x, i), x["source"], v))))
    if "ref_capacity" in wanted:
        level = lambda x, p: F.when(told(x), _part_level(p, 26, 44, 54)).otherwise(_part_level(p, 25, 42, 52))
        found.append(each(lambda x, k: F.transform(F.get(read, k)["parts"], lambda p, i: _entry("ref_capacity", level(x, p), at(x, i), x["source"], p["raw"]))))
    if "ldy_loading_type" in wanted and layout == "M":
        found.append(F.transform(F.filter(texts, lambda x: x["source"].isin("fact", "attribute")), lambda x: _entry(
            "ldy_loading_type", 30, at(x, F.lit(0)), "fact", exact_loading_direction(x["value"]))))
    return found


def _described(body: Column, layout: str, wanted: list[str], compact: Column) -> list[Column]:
    """Evidence of phrases that only a description has."""
    found = []
    if "ref_capacity" in wanted:
        kinds = {"liquid_total": 11, "total": 26, "generic": 31, "refrigerator": 44, "freezer": 54}
        found.append(F.transform(S.phrases_of_capacity(body), lambda p: _entry(
            "ref_capacity", F.coalesce(*[F.when(p["kind"] == k, n) for k, n in kinds.items()]), F.lpad(p["at"].cast("string"), 12, "0"), "description", p["raw"])))
    if "ldy_capacity" in wanted:
        found += [
            _entries("ldy_capacity", 30 + level, "description", S.labelled_masses(body, labels_of(layout, "ldy_capacity", level), compact))
            for level in (10, 20)
        ]
    if "ldy_loading_type" in wanted:
        found.append(_entries("ldy_loading_type", 40, "description", S.description_loadings(body)))
    year = F.regexp_extract(as_text(body), r"(?i)\bAno\b[^<\n\d]*?\b((?:19|20)\d{2})\b", 1)
    colour = colour_word(F.regexp_extract(as_text(body), r"(?i)\bcor\s*:\s*([^;\n\r]+)", 1))
    return [*found, F.array(_entry("model_year", 40, "0", "description", year), _entry("ldy_color", 40, "0", "description", colour))]


def _titled(title: Column, wanted: list[str], compact: Column, read: Column) -> list[Column]:
    """Exact values of a title (level 0) and its fallback values (last level); ``read``: its volumes."""
    one = lambda field, level, raw: F.array(_entry(field, level, "0", "title", raw))
    found = [one("model_year", 90, model_year(title)), one("ldy_color", 90, colour_word(title)), one("ref_refrigerator_type", 0, refrigerator_type(title))]
    if "screen_size" in wanted:
        found.append(one("screen_size", 0, S.title_screen_size(title)))
    if "ref_capacity" in wanted:
        found.append(let(read, lambda x: F.array(
            _entry("ref_capacity", 0, "0", "title", S.exact_title_capacity(x["title_parts"], x["vols"])),
            _entry("ref_capacity", TITLE_FALLBACK, "0", "title", x["found"]))))
    if "ldy_capacity" in wanted:
        found += [one("ldy_capacity", 0, S.exact_title_mass(title)), one("ldy_capacity", TITLE_FALLBACK, S.title_mass(title))]
        if compact is not None:
            found.append(one("ldy_capacity", TITLE_FALLBACK, F.when(compact, S.compact_title_volume(title))))
    if "ldy_loading_type" in wanted:
        found.append(let(S.title_loadings(title), lambda loads: F.array(
            _entry("ldy_loading_type", 0, "0", "title", F.when(F.size(loads) == 1, F.get(loads, F.lit(0)))),
            _entry("ldy_loading_type", TITLE_FALLBACK, "0", "title", F.array_join(loads, ",")))))
    return found


def with_evidence(products: DataFrame, layout: str, wanted: list[str], labels: str = "labels", compact: Column | None = None, out: str = "evidence") -> DataFrame:
    """Adds ``out`` from ``labels`` (see :func:`evidence.with_fact_labels`), ``description`` (flattened) and ``title``.

    ``compact``: rows whose washer capacity may be a volume.  All texts of a row (label values, description, title) stand in one
    array, and each rule that reads volumes or energy runs over it once.
    """
    rules = list(dict.fromkeys(rule for _, field, _, rule in label_rows(layout) if field in wanted))
    text = lambda source, c: F.struct(F.lit(source).alias("source"), F.lit("").alias("label_key"), F.lit("").alias("order_key"), c.alias("value"))
    df = products.withColumn("__texts", F.concat(F.col(labels), F.array(text("description", as_text(F.col("description"))), text("title", squash(F.col("title"))))))
    texts = F.col("__texts")
    df = df.withColumns({"__compact": F.lit(False) if compact is None else compact, "__hits": _hits(F.col(labels), layout, wanted)})
    none = F.lit(None)
    staged = {"__read": none, "__energy": none}
    if "ref_capacity" in wanted:
        df = df.withColumn("__read", F.transform(texts, lambda x: F.struct(
            S.capacity_components(x["value"]).alias("parts"), F.when(x["source"] != "description", S.capacity_components(x["value"], title=True)).alias("title_parts"),
            F.when(x["source"] != "description", S.volumes(x["value"])).alias("vols"))))
        staged["__read"] = F.transform("__read", lambda x: F.struct(
            x["parts"].alias("parts"), x["title_parts"].alias("title_parts"), x["vols"].alias("vols"), S.scalar_capacity(x["title_parts"], x["vols"]).alias("found")))
    if "estimated_annual_electricity_use" in wanted:
        reads = ("fact", "description") if layout == "M" else ("description",)
        staged["__energy"] = F.transform(texts, lambda x: F.when(x["source"].isin(*reads), S.description_energy(x["value"])))
    df = df.withColumns(staged)
    small, read = F.col("__compact"), F.col("__read")
    arrays = [
        *_labelled(F.col("__hits"), rules, small, read), *_stated(texts, layout, wanted, read, F.col("__energy")),
        *_described(F.col("description"), layout, wanted, small if compact is not None else None),
        *_titled(F.element_at(texts, -1)["value"], wanted, small if compact is not None else None, F.element_at(read, -1) if "ref_capacity" in wanted else read),
    ]
    empty = F.array().cast(EVIDENCE)
    found = F.filter(F.concat(*[F.coalesce(a.cast(EVIDENCE), empty) for a in arrays]), lambda e: present(e["raw"]) & e["field"].isin(*wanted))
    return df.withColumn(out, found).drop("__hits", "__compact", "__texts", "__read", "__energy")


def resolved(evidence: Column, field: str, policy: str) -> Column:
    """The field's value under its policy (see :func:`evidence.resolve`), '' if there is no evidence."""
    own = F.transform(F.filter(evidence, lambda e: e["field"] == field), lambda e: let(collapse_repeated_range(e["raw"]), lambda raw: F.struct(
        e["level"].alias("level"), e["ordinal"].alias("ordinal"), raw.alias("raw"), e["source"].alias("source"), measure_key(raw).alias("key"))))
    # first spelling of every value of a level
    ordered = F.array_sort(F.filter(own, lambda e: e["key"] != ""))
    bound = lambda arr: F.struct(arr.alias("all"), F.transform(arr, lambda e: F.struct(e["level"].alias("level"), e["key"].alias("key"))).alias("keys"))
    firsts = let(bound(ordered), lambda x: F.filter(x["all"], lambda e, i: F.array_position(x["keys"], F.get(x["keys"], i)) == i + 1))
    ev = F.transform(firsts, lambda e: F.struct(*[e[c].alias(c) for c in ("level", "ordinal", "raw", "source")]))
    if policy == "capacity":
        ev = F.array_sort(F.transform(let(ev, S.exact_over_qualified), lambda v: F.struct(
            F.when(is_capacity_band(v["raw"]) & v["level"].between(1, TITLE_FALLBACK - 1), v["level"] + BAND_OFFSET).otherwise(v["level"]).alias("level"),
            v["ordinal"].alias("ordinal"), v["raw"].alias("raw"), v["source"].alias("source"))))
    raws = lambda arr: F.transform(arr, lambda v: v["raw"])

    def specific(arr: Column) -> Column:
        ranked = F.transform(arr, lambda v: F.struct(
            (-type_specificity(refrigerator_type(v["raw"]))).alias("a"), (v["source"] != "title").alias("b"), v["level"].alias("c"),
            v["ordinal"].alias("d"), v["raw"].alias("raw")))
        return F.array_min(ranked)["raw"]

    def choose(arr: Column) -> Column:
        top = raws(F.filter(arr, lambda v: v["level"] == F.get(arr, F.lit(0))["level"]))
        if policy in ("measure", "capacity"):
            return let(top, S.join_measurements)
        if policy == "washer":
            return S.washer_choice(arr)
        if policy == "type":
            return specific(arr)
        if policy == "first":
            return F.get(arr, F.lit(0))["raw"]
        if policy == "all":
            return F.array_join(F.array_distinct(raws(arr)), " ||| ")
        return F.array_join(let(top, S.distinct_texts), ",")

    return F.coalesce(let(ev, choose), F.lit(""))


def with_fields(products: DataFrame, wanted: list[str], evidence: str = "evidence") -> DataFrame:
    """Adds one column per field."""
    return products.withColumns({f: resolved(F.col(evidence), f, POLICIES.get(f, "distinct")) for f in wanted})
