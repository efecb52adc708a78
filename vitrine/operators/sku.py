"""Manufacturer-SKU resolution over product rows.

Everything is row-local: the candidates of a title or an evidence list form one array
per row, staged as columns so that each is computed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import models as D
from vitrine.functions.text import append_token, as_text, has_token, key_text, present, squash
from vitrine.functions.urls import sku_from_url
from vitrine.operators.relevance import is_line_title

_EMPTY = "array<string>"


def _evidence(c: Column) -> Column:
    return F.coalesce(c, F.array().cast(_EMPTY))


def resolve_refrigerator_sku(rows: DataFrame, title: str = "title", existing: str = "existing_sku",
                             evidence: str = "evidence", brand: str = "brand") -> DataFrame:
    """Title, else evidence that settles an ambiguous title, else evidence, else existing.

    Adds ``sku``, ``sku_short`` and ``sku_status`` (array of tokens).
    """
    context = F.concat_ws(" ", as_text(F.col(brand)), as_text(F.col(title)))
    given = F.flatten(F.transform(
        _evidence(F.col(evidence)), lambda v: D.refrigerator_candidates(v, F.col(brand))))
    df = rows.withColumns({
        "__context": context, "__titles": D.refrigerator_candidates(F.col(title), F.col(brand)),
        "__given": F.array_distinct(given), "__existing": D.normalize_sku(F.col(existing)),
    })
    context = F.col("__context")
    df = df.withColumns({
        "__from_title": D.refrigerator_choice(F.col("__titles"), context),
        "__from_given": D.refrigerator_choice(F.col("__given"), context),
        "__valid": D.is_valid_refrigerator_sku(F.col("__existing"), context),
    })
    t, g = F.col("__from_title"), F.col("__from_given")
    ambiguous = (t == "") & (F.size("__titles") > 1)
    settled = ambiguous & (g != "") & F.array_contains(F.col("__titles"), g)
    tokens = lambda *names: F.array(*[F.lit(n) for n in names])
    case = lambda on_title, on_settled, on_open, on_given, on_existing, none: (
        F.when(t != "", on_title).when(settled, on_settled).when(ambiguous, on_open)
        .when(g != "", on_given).when(F.col("__valid"), on_existing).otherwise(none))
    sku = case(t, g, F.lit(""), g, F.col("__existing"), F.lit(""))
    status = case(
        tokens(D.REF_TITLE), tokens(D.REF_AMBIGUOUS, D.REF_EVIDENCE), tokens(D.REF_AMBIGUOUS, D.REF_UNRESOLVED),
        tokens(D.REF_EVIDENCE), tokens(D.REF_EXISTING), tokens(D.REF_UNRESOLVED))
    df = df.withColumns({"sku": sku, "sku_status": status})
    short = D.refrigerator_short(F.col("sku"), context, F.col("__titles"))
    return df.withColumn("sku_short", short).drop(
        "__context", "__titles", "__given", "__existing", "__from_title", "__from_given", "__valid")


def _conflict(source: str, left: Column, right: Column) -> Column:
    safe = lambda c: F.regexp_replace(c, r"[^A-Z0-9/-]+", "_")
    return F.concat(F.lit(f"casas_ldy_sku_conflict:{source}:"), safe(left), F.lit("!="), safe(right))


def resolve_washer_sku(rows: DataFrame, title: str = "title", existing: str = "existing_sku",
                       evidence: str = "evidence", brand: str = "brand") -> DataFrame:
    """Single title candidate, else valid existing, else single evidence; conflicts are told."""
    df = rows.withColumns({
        "__titles": D.washer_candidates(F.col(title)),
        "__given": F.array_distinct(F.filter(
            F.transform(_evidence(F.col(evidence)), D.normalize_sku), D.is_valid_washer_sku)),
        "__existing": D.normalize_sku(F.col(existing)),
    })
    df = df.withColumn("__valid", D.is_valid_washer_sku(F.col("__existing")))
    titles, given, old = F.col("__titles"), F.col("__given"), F.col("__existing")
    valid = F.col("__valid")
    one_title = F.size(titles) == 1
    chosen = (
        F.when(one_title, F.get(titles, F.lit(0))).when(valid, old)
        .when(F.size(given) == 1, F.get(given, F.lit(0))).otherwise("")
    )
    origin = (
        F.when(one_title, D.LDY_TITLE).when(valid, D.LDY_EXISTING)
        .when(F.size(given) == 1, D.LDY_EVIDENCE).otherwise("casas_ldy_sku_unresolved")
    )
    df = df.withColumns({"sku": chosen, "__origin": origin})
    sku = F.col("sku")
    by_row = one_title | valid
    short = D.washer_short(sku, F.concat_ws(" ", as_text(F.col(brand)), as_text(F.col(title))))
    df = df.withColumn("__short", short)
    status = F.array_compact(F.array(
        F.when((old != "") & ~valid, "casas_ldy_sku_invalid_existing_rejected"),
        F.when(F.size(titles) > 1, "casas_ldy_sku_title_ambiguous"),
        F.when(one_title & valid & (old != sku), _conflict("existing", old, sku)),
        F.when(by_row & (F.size(given) > 0) & ~F.array_contains(given, sku),
               _conflict("product_source", sku, F.get(given, F.lit(0)))),
        F.when(~by_row & (F.size(given) > 1), "casas_ldy_sku_product_source_ambiguous"),
        F.col("__origin"),
        F.when(F.col("__short") != "", D.LDY_SHORT),
    ))
    return df.withColumns({
        "sku_status": F.array_distinct(status),
        "sku_short": F.when(F.col("__short") != "", F.col("__short")).otherwise(sku),
    }).drop("__titles", "__given", "__existing", "__valid", "__origin", "__short")


# Labels whose values are model evidence.
MODEL_LABELS = ("modelo", "modelos", "referencia", "ref", "codigo do modelo")
VOLTAGE_MODEL = r"(?i)\b(110|127|220|240)\s*v(?:olts?)?\s*[-:]\s*([A-Z0-9]+(?:[-/][A-Z0-9]+)*)"
MODEL_PHRASE = (
    r"(?i)\b(?:Modelos?|Refer(?:e|ê)ncia|Ref\.?)\s*:\s*(.{1,240}?)"
    r"(?=(?:[;\n\r]|$|\s+[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ ()/]{1,35}:))"
)


def label_models(value: Column, variant: Column) -> Column:
    """Models of one labelled value; the variant's voltage picks among voltage models."""
    text = squash(value)
    volts = F.array_distinct(F.regexp_extract_all(
        as_text(variant), F.lit(r"(?i)\b(110|127|220|240)\s*v(?:olts?)?\b"), F.lit(1)))
    pairs = F.transform(
        F.regexp_extract_all(text, F.lit(VOLTAGE_MODEL), F.lit(0)),
        lambda m: F.struct(F.regexp_extract(m, VOLTAGE_MODEL, 1).alias("v"),
                           D.normalize_sku(F.regexp_extract(m, VOLTAGE_MODEL, 2)).alias("model")))
    mine = F.array_distinct(F.transform(
        F.filter(pairs, lambda p: D.is_valid_washer_sku(p["model"]) & F.array_contains(volts, p["v"])),
        lambda p: p["model"]))
    return F.when((F.size(volts) == 1) & (F.size(mine) == 1), mine).otherwise(D.washer_candidates(text))


def label_evidence(labels: DataFrame, keys: list[str], variant: str = "variant") -> DataFrame:
    """Distinct model evidence per product from label rows (label_key, ordinal, value)."""
    rows = labels.filter(F.col("label_key").isin(*MODEL_LABELS))
    models = rows.select(*keys, "ordinal", F.posexplode(label_models(F.col("value"), F.col(variant))).alias("p", "model"))
    # repeated models collapse before the shuffle
    firsts = models.groupBy(*keys, "model").agg(F.min(F.struct("ordinal", "p")).alias("at"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "model"))), lambda m: m["model"])
    return firsts.groupBy(*keys).agg(ordered.alias("evidence"))


def phrase_models(description: Column, variant: Column) -> Column:
    """Models a description states behind a model or reference label."""
    found = F.regexp_extract_all(as_text(description), F.lit(MODEL_PHRASE), F.lit(1))
    return F.array_distinct(F.flatten(F.transform(found, lambda v: label_models(v, variant))))


# ---- TV, layout M --------------------------------------------------------------------------------


def tv_needs_recovery(row: dict[str, Column]) -> Column:
    sku = F.lower(F.trim(as_text(row["sku"])))
    own = D.same_id(sku, row["item"]) | D.same_id(sku, sku_from_url(row["product_url"]))
    return (sku == "") | D.is_descriptive(row["sku"]) | (
        ~has_token(row["parse_status"], D.TV_REFERENCE) & (own | D.is_synthetic(row["sku"])))


def recover_tv_sku(rows: DataFrame) -> DataFrame:
    """Blank, synthetic or item-equal SKU replaced by title, slug or reference model.

    rows: sku, item, product_url, retailer_sku_name, screen_size, parse_status, reference,
    detail_item_id, identity_verified.  A valid SKU stays; a different candidate then only
    leaves a conflict token.
    """
    df = rows.withColumns({
        "__tv": is_line_title(F.col("retailer_sku_name"), "TV"),
        "__title": D.strict_tv_model(F.col("retailer_sku_name"), F.col("screen_size")),
        "__slug": D.strict_tv_model_from_url(F.col("product_url"), F.col("screen_size")),
    })
    title = F.when(F.col("__tv"), F.col("__title")).otherwise("")
    slug = F.when(F.col("__tv") & (title == ""), F.col("__slug")).otherwise("")
    reference = F.trim(as_text(F.col("reference")))
    reference = F.when(D.is_descriptive(reference), "").otherwise(reference)
    candidate = F.when(title != "", title).when(slug != "", slug).otherwise(reference)
    actual = F.lower(F.trim(as_text(F.col("detail_item_id"))))
    expected = F.filter(
        F.array(F.lower(F.trim(as_text(F.col("item")))), F.lower(F.trim(sku_from_url(F.col("product_url"))))),
        lambda e: e != "")
    proven = (
        F.coalesce(F.col("identity_verified"), F.lit(False)) & (actual != "") & (F.size(expected) > 0)
        & F.forall(expected, lambda e: e == actual) & (candidate != "")
    )
    target = tv_needs_recovery({c: F.col(c) for c in rows.columns})
    token = (
        F.when(target & (title != ""), "sku_title_high_confidence_recovered")
        .when(target & (slug != ""), "sku_url_high_confidence_recovered")
        .when(target, D.TV_REFERENCE)
        .when(F.trim(as_text(F.col("sku"))) != candidate, D.TV_CONFLICT)
    )
    df = df.withColumns({"__candidate": candidate, "__take": proven & target, "__token": F.when(proven, token)})
    return df.withColumns({
        "sku": F.when(F.col("__take"), F.col("__candidate")).otherwise(F.col("sku")),
        "parse_status": F.when(
            F.col("__token").isNotNull(), append_token(F.col("parse_status"), F.col("__token"))
        ).otherwise(F.col("parse_status")),
    }).drop("__tv", "__title", "__slug", "__candidate", "__take", "__token")


def tv_title_fallback(rows: DataFrame, final_pass: bool = False) -> DataFrame:
    """Unresolved TV SKU from the row's own title or slug, when item and URL agree."""
    row = {c: F.col(c) for c in rows.columns}
    status = F.lower(as_text(row["parse_status"]))
    conflict = F.contains(status, F.lit("identity_mismatch")) | F.contains(status, F.lit("identity_conflict"))
    allowed = (
        tv_needs_recovery(row) & D.same_id(row["item"], sku_from_url(row["product_url"])) & ~conflict
        & is_line_title(row["retailer_sku_name"], "TV")
    )
    df = rows.withColumns({
        "__ok": allowed, "__title": D.strict_tv_model(row["retailer_sku_name"], row["screen_size"]),
        "__slug": D.strict_tv_model_from_url(row["product_url"], row["screen_size"]),
    })
    found = F.when(F.col("__title") != "", F.col("__title")).otherwise(F.col("__slug"))
    take = F.col("__ok") & (found != "")
    source = F.when(F.col("__title") != "", "title").otherwise("url")
    suffix = "_final_recovered" if final_pass else "_fallback_after_detail_retry"
    token = F.concat(F.lit("sku_"), source, F.lit(suffix))
    return df.withColumns({
        "parse_status": F.when(take, append_token(F.col("parse_status"), token)).otherwise(F.col("parse_status")),
        "sku": F.when(take, found).otherwise(F.col("sku")),
    }).drop("__ok", "__title", "__slug")
