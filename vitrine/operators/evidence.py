"""The evidence table: collect candidate values, then pick by level.

evidence(keys..., field, level, ordinal, source, raw).  Collection is row-local plus one
join with the label dictionary (small, so Spark broadcasts it).  Resolution first reduces repeated values
(hot items and copies collapse before the shuffle), then looks at one product's
distinct values at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import measures as S
from vitrine.functions import variants as V
from vitrine.functions.markup import with_page_pairs
from vitrine.functions.text import (
    clean_text, collapse_repeated_range, key_text, let, present, squash,
)
from vitrine.functions.validators import (
    exact_loading_direction, is_capacity_band, is_screen_size, is_washer_capacity, measure_key, refrigerator_type, type_specificity,
)
from vitrine.operators.labels import labels_of

RULES = ("volume", "energy", "mass", "screen", "loading", "door", "door_count", "text")
BAND_OFFSET = 100
TITLE_FALLBACK = 900


# ---- label / value rows -------------------------------------------------------------------------


LABEL = "array<struct<source:string,label_key:string,order_key:string,value:string>>"


def spec_labels(groups: Column) -> Column:
    """Spec groups (``array<struct<name,specs:array<struct<name,value>>>>``) as an array of label rows."""
    rows = F.flatten(F.transform(F.coalesce(groups, F.array().cast("array<struct<name:string,specs:array<struct<name:string,value:string>>>>")), lambda g, i: F.transform(
        F.coalesce(g["specs"], F.array().cast("array<struct<name:string,value:string>>")), lambda s, j: F.struct(
            F.lit("spec").alias("source"), key_text(clean_text(s["name"])).alias("label_key"),
            F.concat(F.lpad(i.cast("string"), 6, "0"), F.lpad(j.cast("string"), 6, "0")).alias("order_key"), clean_text(s["value"]).alias("value")))))
    return F.filter(rows, lambda r: (r["label_key"] != "") & (r["value"] != ""))


def _elements(node: Column) -> Column:
    """Child facts of a fact node."""
    return F.transform(
        F.coalesce(V.get(node["doc"], "$.elements", "array<variant>"), F.array().cast("array<variant>")),
        lambda d, i: F.struct(
            F.concat(node["path"], F.lit("."), F.lpad(i.cast("string"), 5, "0")).alias("path"), d.alias("doc")),
    )


def with_fact_labels(products: DataFrame, doc: str = "item_doc", out: str = "labels") -> DataFrame:
    """Adds ``out``: facts and attributes of a layout-M item as an array of label rows.

    Own facts count (``source`` fact); when there are none, the bundles' facts take their place.
    Otherwise the bundles' facts come as ``bundle``, for the fields that ask for them one by one.
    A labelled child is a fact of its own and its value is not lifted to the parent.
    """
    none = F.array().cast("array<variant>")
    listed = lambda d, path: F.coalesce(V.get(d, path, "array<variant>"), none)
    own = V.get(F.col(doc), "$.factsheet", "array<variant>")
    bundled = F.flatten(F.transform(V.get(F.col(doc), "$.bundles", "array<variant>"), lambda b: listed(b, "$.factsheet")))
    has_own = F.coalesce(F.size(own), F.lit(0)) > 0
    placed = lambda facts, mark: F.transform(
        F.coalesce(facts, none),
        lambda d, i: F.struct(F.concat(F.lit(mark), F.lpad(i.cast("string"), 5, "0")).alias("path"), d.alias("doc")))
    wrapped = F.concat(placed(F.when(has_own, own).otherwise(bundled), ""), placed(F.when(has_own, bundled), "b"))
    df = V.walk(products, wrapped, "__nodes", _elements)
    name = lambda d: F.coalesce(
        F.nullif(V.get(d, "$.keyName"), F.lit("")), F.nullif(V.get(d, "$.slug"), F.lit("")))
    label = lambda source, key, order, i, value: F.struct(
        source.alias("source"), key_text(key).alias("label_key"),
        F.concat(order, F.lit("#"), F.lpad(i.cast("string"), 3, "0")).alias("order_key"), clean_text(value).alias("value"))

    def of_fact(n: Column) -> Column:
        loose = F.filter(listed(n["doc"], "$.elements"), lambda e: name(e).isNull())
        values = F.concat(F.array(V.get(n["doc"], "$.value")), F.transform(loose, lambda e: V.get(e, "$.value")))
        kind = F.when(n["path"].startswith("b"), "bundle").otherwise("fact")
        return F.when(name(n["doc"]).isNotNull(), F.transform(
            F.filter(values, lambda v: v.isNotNull()), lambda v, i: label(kind, name(n["doc"]), n["path"], i, v)))

    def of_attribute(a: Column, at: Column) -> Column:
        key = F.coalesce(F.nullif(V.get(a, "$.label"), F.lit("")), V.get(a, "$.type"))
        return F.transform(
            F.filter(F.array(V.get(a, "$.current"), V.get(a, "$.value")), lambda v: v.isNotNull()),
            lambda v, i: label(F.lit("attribute"), key, F.concat(F.lit("~"), F.lpad(at.cast("string"), 5, "0")), i, v))

    # source order as text: facts by path, attributes behind them
    rows = F.flatten(F.array_compact(F.concat(
        F.transform("__nodes", of_fact), F.transform(listed(F.col(doc), "$.attributes"), of_attribute))))
    return df.withColumn(out, F.filter(rows, lambda r: r["value"] != "")).drop("__nodes")


def fact_rows(products: DataFrame, keys: list[str], doc: str = "item_doc") -> DataFrame:
    """Facts and attributes of a layout-M item as label rows, see :func:`with_fact_labels`."""
    rows = with_fact_labels(products.select(*keys, doc), doc, "__labels")
    return rows.select(*keys, F.explode_outer("__labels").alias("l")).filter("l IS NOT NULL").select(*keys, "l.*")


def description_pairs(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``label: value`` pairs of flattened texts; a value ends at ; newline or bullet."""
    pattern = r"(?:^|[;\n\r]|\s-\s|•)\s*([\p{L}][\p{L}\p{N} ()/.]*?)\s*:\s*([^;\n\r•]+?)(?=\s+-\s|[;\n\r•]|$)"
    pairs = F.transform(
        F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)),
        lambda m: F.struct(
            key_text(F.regexp_extract(m, pattern, 1)).alias("label_key"),
            squash(F.regexp_extract(m, pattern, 2)).alias("value")),
    )
    return (
        texts.select(*keys, F.posexplode(pairs).alias("ordinal", "p"))
        .select(*keys, "p.label_key", F.col("ordinal").cast("long").alias("ordinal"), "p.value")
        .filter((F.col("label_key") != "") & (F.col("value") != ""))
    )


def table_pairs(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """Label / value pairs of table rows and definition lists of the main part of a page."""
    return (
        with_page_pairs(pages.select(*keys, html), html, "__pairs")
        # the outer form: a condition on the array itself would be pushed below, with all that makes it written out again
        .select(*keys, F.posexplode_outer("__pairs").alias("ordinal", "p")).filter("ordinal IS NOT NULL")
        .select(*keys, "p.label_key", F.col("ordinal").cast("long").alias("ordinal"), "p.value")
    )


# ---- labelled values -> evidence -------------------------------------------------------------------


def labelled_evidence(rows: DataFrame, dictionary: DataFrame, keys: list[str], source: str,
                      rules: tuple = RULES) -> DataFrame:
    """Join label rows with the dictionary and apply each field's value rule.

    ``rules`` names the value rules the dictionary uses, so that a job for one field plans
    only that one.  Rows with their own ``source`` count by it: a screen is taken from an attribute
    before an own fact before a bundle's fact, other fields leave bundles out, and capacities and
    loading leave attributes out.
    """
    hits = rows.join(dictionary.filter(F.col("rule").isin(*rules)), "label_key")
    if "source" in rows.columns:
        screen, own = F.col("field") == "screen_size", F.col("source")
        facts_only = F.col("field").isin("ref_capacity", "ldy_capacity", "ldy_loading_type")
        hits = hits.filter(screen | (own == "fact") | ((own == "attribute") & ~facts_only)).withColumn(
            "level", F.col("level") + F.when(screen & (own == "fact"), 1).when(screen & (own == "bundle"), 2).otherwise(0))
    value, rule = F.col("value"), F.col("rule")
    one = lambda c: F.array(F.struct(F.col("level").alias("level"), c.alias("raw")))
    branches = {
        "mass": lambda: one(F.when(is_washer_capacity(value), value)),
        "screen": lambda: one(F.when(is_screen_size(value), value)),
        "loading": lambda: one(S.labelled_loading(value)),
        "door": lambda: one(refrigerator_type(value)),
        "door_count": lambda: one(F.when(F.regexp_extract(value, r"(\d+)", 1) == "2", "Duplex")),
        "text": lambda: one(value),
    }
    if "energy" in rules:
        hits = hits.withColumn("energy", F.when(rule == "energy", S.energy_text(value)))
        branches["energy"] = lambda: one(S.labelled_energy(F.col("energy")))
    if "volume" in rules:
        # the volume rule uses these columns several times, so they are computed once
        hits = hits.withColumns({
            "parts": F.when(rule == "volume", S.capacity_components(value)),
            "title_parts": F.when(rule == "volume", S.capacity_components(value, title=True)),
            "vols": F.when(rule == "volume", S.volumes(value)),
        }).withColumn(
            "found", F.when(rule == "volume", S.scalar_capacity(F.col("title_parts"), F.col("vols"))))
        kinds = F.create_map(
            F.lit("total"), F.lit(25), F.lit("refrigerator"), F.lit(42), F.lit("freezer"), F.lit(52))
        branches["volume"] = lambda: F.concat(
            F.transform(
                S.scalar_capacities(value, F.col("parts"), F.col("found")),
                lambda v: F.struct(F.col("level").alias("level"), v.alias("raw"))),
            F.transform(
                F.col("parts"),
                lambda p: F.struct(F.element_at(kinds, p["kind"]).alias("level"), p["raw"].alias("raw"))),
        )
    values = F.coalesce(*[F.when(rule == r, branches[r]()) for r in rules])
    order = F.col("order_key") if "order_key" in rows.columns else F.lpad(F.col("ordinal").cast("string"), 12, "0")
    out = hits.select(*keys, "field", order.alias("ordinal"), F.explode(values).alias("e"))
    return (
        out.select(*keys, "field", "e.level", "ordinal", F.lit(source).alias("source"), "e.raw")
        .filter(present(F.col("raw")))
    )


def unlabelled_evidence(rows: DataFrame, keys: list[str], fields) -> DataFrame:
    """Evidence that facts (and, for loading, attributes) state under whatever label they stand."""
    value, facts = F.col("value"), rows.filter(F.col("source") == "fact")
    entry = lambda field, level, raws: F.struct(F.lit(field).alias("field"), F.lit(level).alias("level"), raws.alias("raws"))
    found = []
    if _wanted(fields, "estimated_annual_electricity_use"):
        found.append((facts, [entry("estimated_annual_electricity_use", 30, S.description_energy(value))]))
    if _wanted(fields, "ref_capacity"):
        staged = facts.withColumn("parts", S.capacity_components(value))
        found.append((staged, [
            entry("ref_capacity", level, S.component_values(F.col("parts"), kind))
            for kind, level in (("total", 25), ("refrigerator", 42), ("freezer", 52))]))
    if _wanted(fields, "ldy_loading_type"):
        some = rows.filter(F.col("source").isin("fact", "attribute"))
        found.append((some, [entry("ldy_loading_type", 30, F.array(exact_loading_direction(value)))]))
    return union_all([
        some.select(*keys, "order_key", F.explode(F.array(*entries)).alias("f"))
        .select(*keys, "order_key", "f.field", "f.level", F.posexplode("f.raws").alias("pos", "raw"))
        .select(*keys, "field", "level", F.concat("order_key", F.lpad(F.col("pos").cast("string"), 4, "0")).alias("ordinal"),
                F.lit("fact").alias("source"), "raw").filter(present(F.col("raw")))
        for some, entries in found
    ])


def _wanted(fields, *names) -> bool:
    return fields is None or any(n in fields for n in names)


def description_evidence(products: DataFrame, keys: list[str], layout: str, text: str = "description",
                         fields=None) -> DataFrame:
    """Evidence a flattened description states in phrases (all fields, or those named)."""
    body, rows = F.col(text), products
    entry = lambda field, level, arr: F.struct(F.lit(field).alias("field"), F.lit(level).alias("level"), arr.alias("raws"))
    found = []
    if _wanted(fields, "ref_capacity"):
        rows = rows.withColumn("parts", S.capacity_components(body))
        kinds = (("liquid_total", 11), ("total", 26), ("generic", 31), ("refrigerator", 44), ("freezer", 54))
        found += [entry("ref_capacity", level, S.phrase_capacities(body, kind)) for kind, level in kinds]
        found += [
            entry("ref_capacity", level, S.component_values(F.col("parts"), kind))
            for kind, level in (("total", 26), ("refrigerator", 44), ("freezer", 54))
        ]
    if _wanted(fields, "ldy_capacity"):
        found += [
            entry("ldy_capacity", 30 + level, S.labelled_masses(body, labels_of(layout, "ldy_capacity", level)))
            for level in (10, 20)
        ]
    if _wanted(fields, "estimated_annual_electricity_use"):
        found.append(entry("estimated_annual_electricity_use", 40, S.description_energy(body)))
    if _wanted(fields, "ldy_loading_type"):
        found.append(entry("ldy_loading_type", 40, S.description_loadings(body)))
    rows = rows.select(*keys, F.explode(F.array(*found)).alias("f"))
    return rows.select(
        *keys, "f.field", "f.level", F.posexplode("f.raws").alias("pos", "raw")
    ).select(*keys, "field", "level", F.lpad(F.col("pos").cast("string"), 12, "0").alias("ordinal"),
             F.lit("description").alias("source"), "raw").filter(present(F.col("raw")))


def title_evidence(products: DataFrame, keys: list[str], title: str = "title", fields=None) -> DataFrame:
    """Exact values of a title (level 0) and its fallback values (last level)."""
    staged, t = products.select(*keys, squash(F.col(title)).alias("__t")), F.col("__t")
    entry = lambda field, level, c: F.struct(F.lit(field).alias("field"), F.lit(level).alias("level"), c.alias("raw"))
    found = []
    if _wanted(fields, "screen_size"):
        found.append(entry("screen_size", 0, S.title_screen_size(t)))
    if _wanted(fields, "ref_capacity"):
        staged = staged.withColumns({"parts": S.capacity_components(t, title=True), "vols": S.volumes(t)})
        found += [
            entry("ref_capacity", 0, S.exact_title_capacity(F.col("parts"), F.col("vols"))),
            entry("ref_capacity", TITLE_FALLBACK, S.scalar_capacity(F.col("parts"), F.col("vols"))),
        ]
    if _wanted(fields, "ldy_capacity"):
        found += [entry("ldy_capacity", 0, S.exact_title_mass(t)), entry("ldy_capacity", TITLE_FALLBACK, S.title_mass(t))]
    if _wanted(fields, "ldy_loading_type"):
        staged = staged.withColumn("loads", S.title_loadings(t))
        loads = F.col("loads")
        found += [
            entry("ldy_loading_type", 0, F.when(F.size(loads) == 1, F.get(loads, F.lit(0)))),
            entry("ldy_loading_type", TITLE_FALLBACK, F.array_join(loads, ",")),
        ]
    if not found:
        found = [entry("screen_size", 0, F.lit(None).cast("string"))]
    return (
        staged.select(*keys, F.explode(F.array(*found)).alias("f"))
        .select(*keys, "f.field", "f.level", F.lit("0").alias("ordinal"), F.lit("title").alias("source"), "f.raw")
        .filter(present(F.col("raw")))
    )


# ---- resolution -------------------------------------------------------------------------------------


def first_level(evidence: DataFrame, keys: list[str]) -> DataFrame:
    """Only the rows of the lowest level that has a value, per field."""
    lowest = evidence.groupBy(*keys, "field").agg(F.min("level").alias("level"))
    return evidence.join(lowest, [*keys, "field", "level"])


def distinct_evidence(evidence: DataFrame, keys: list[str], cmp_key=measure_key) -> DataFrame:
    """First spelling per comparison key, field and level."""
    keyed = evidence.withColumn("raw", collapse_repeated_range(F.col("raw"))).withColumn(
        "cmp_key", cmp_key(F.col("raw")))
    return (
        keyed.filter("cmp_key <> ''")
        .groupBy(*keys, "field", "level", "cmp_key")
        .agg(F.min(F.struct("ordinal", "raw", "source")).alias("f"))
        .select(*keys, "field", "level", "cmp_key", "f.ordinal", "f.raw", "f.source")
    )


def combine_distinct(evidence: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct values of the first level that has any, joined in source order."""
    # the values of a product's field are few once they are distinct: its first level is cut inside its row, so that evidence is read once
    ordered = F.array_sort(F.collect_list(F.struct("level", "ordinal", "raw")))
    known = evidence
    for c in (*keys, "field", "level"):
        known = known.filter(F.col(c).isNotNull())
    groups = distinct_evidence(known, keys, key_text).groupBy(*keys, "field").agg(ordered.alias("__ev"), F.min("level").alias("level"))
    firsts = F.filter("__ev", lambda v: v["level"] == F.col("level"))
    return groups.select(*keys, "field", F.array_join(F.transform(firsts, lambda v: v["raw"]), ",").alias("value"), "level")


POLICIES = {
    "screen_size": "measure", "estimated_annual_electricity_use": "measure", "ref_capacity": "capacity",
    "ldy_capacity": "washer", "ldy_loading_type": "distinct", "ldy_color": "first", "model_year": "first",
    "ref_refrigerator_type": "type", "reference": "all", "model": "first",
}


def resolve(evidence: DataFrame, keys: list[str], policies: dict[str, str] = POLICIES) -> DataFrame:
    """One value per product and field under the field's policy.

    distinct / measure: the first level, distinct values joined.  capacity: exact beats
    qualified, bands after every exact level, then as measure.  washer: the doubtful-value
    walk.  type: most specific, title wins ties.  first: the first value.
    """
    small = distinct_evidence(evidence, keys)
    rule = F.coalesce(*[F.when(F.col("field") == f, F.lit(p)) for f, p in policies.items()], F.lit("distinct"))
    used = set(policies.values())
    groups = small.groupBy(*keys, "field").agg(
        F.array_sort(F.collect_list(F.struct("level", "ordinal", "raw", "source"))).alias("ev")
    ).withColumn("rule", rule)
    ev = F.col("ev")
    if "capacity" in used:
        banded = lambda arr: F.array_sort(F.transform(arr, lambda v: F.struct(
            F.when(is_capacity_band(v["raw"]) & v["level"].between(1, TITLE_FALLBACK - 1), v["level"] + BAND_OFFSET)
            .otherwise(v["level"]).alias("level"),
            v["ordinal"].alias("ordinal"), v["raw"].alias("raw"), v["source"].alias("source"))))
        groups = groups.withColumn(
            "ev", F.when(F.col("rule") == "capacity", banded(S.exact_over_qualified(ev))).otherwise(ev))
    lowest = F.array_min(F.transform(ev, lambda v: v["level"]))
    groups = groups.withColumn("lowest", lowest).withColumn(
        "top", F.transform(F.filter(ev, lambda v: v["level"] == F.col("lowest")), lambda v: v["raw"]))
    top = F.col("top")
    policy = {
        "measure": lambda: S.join_measurements(top), "capacity": lambda: S.join_measurements(top),
        "washer": lambda: S.washer_choice(ev), "type": lambda: _most_specific(ev), "first": lambda: F.get(top, F.lit(0)),
        "all": lambda: F.array_join(F.array_distinct(F.transform(ev, lambda v: v["raw"])), " ||| "),
        "distinct": lambda: F.array_join(S.distinct_texts(top), ","),
    }
    if used >= {"measure", "capacity"}:
        used.discard("capacity")
        policy["measure"] = lambda: S.join_measurements(top)
    hit = lambda p: F.col("rule").isin("measure", "capacity") if p == "measure" else F.col("rule") == p
    value = F.coalesce(*[F.when(hit(p), policy[p]()) for p in sorted(used | {"distinct"})])
    return groups.select(
        *keys, "field", value.alias("value"), F.col("lowest").alias("level"), F.size("ev").alias("candidates"))


def _most_specific(ev: Column) -> Column:
    ranked = F.array_sort(F.transform(
        ev,
        lambda v: F.struct(
            (-type_specificity(refrigerator_type(v["raw"]))).alias("a"), (v["source"] != "title").alias("b"),
            v["level"].alias("c"), v["ordinal"].alias("d"), v["raw"].alias("raw"))))
    return let(ranked, lambda arr: F.get(arr, F.lit(0))["raw"])


def pivot_fields(resolved: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Resolved values as columns, '' where a product has none."""
    return resolved.groupBy(*keys).agg(*[
        F.coalesce(F.max(F.when(F.col("field") == f, F.col("value"))), F.lit("")).alias(f) for f in fields
    ])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
