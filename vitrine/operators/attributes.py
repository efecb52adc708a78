"""Detail rows: a product document turned into published attributes.

Attributes go through the evidence table (labels, description, title) and come back as
columns; prices, ratings and identity are read straight from the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import models as D
from vitrine.functions import variants as V
from vitrine.functions.markup import with_page_pairs
from vitrine.functions.measures import COMPACT_WORDS, screen_from_spec, title_mass
from vitrine.functions.money import coupon_result, format_brl
from vitrine.functions.text import (
    as_text, clean_text, first_present, key_text, present, squash, unescape_entities,
)
from vitrine.functions.urls import seller_from_url, sku_from_url, url_matches_id
from vitrine.operators import evidence as E
from vitrine.operators.labels import label_rows
from vitrine.operators.relevance import is_line_title, is_standalone_dryer
from vitrine.operators.row_evidence import with_evidence, with_fields
from vitrine.operators.sku import resolve_refrigerator_sku, resolve_washer_sku
from vitrine.sources.pages import data_island

LINE_FIELDS = {
    "TV": ["screen_size", "estimated_annual_electricity_use", "model_year"],
    "REF": ["estimated_annual_electricity_use", "ref_refrigerator_type", "ref_capacity", "model_year"],
    "LDY": ["estimated_annual_electricity_use", "ldy_loading_type", "ldy_capacity", "ldy_color", "model_year"],
}


def flat_description(html: Column) -> Column:
    """Description markup as one text; block ends become ``;``, cells ``label: value``."""
    t = as_text(html)
    t = F.regexp_replace(t, r"(?i)</\s*(?:div|td|th)\s*>\s*<\s*(?:div|td|th)\b[^>]*>", ": ")
    t = F.regexp_replace(t, r"(?i)<\s*br\s*/?\s*>", " ")
    t = F.regexp_replace(t, r"(?i)<\s*/\s*(?:p|div|li|tr|td|th|h[1-6]|section|article|ul|ol|table)\s*>", "; ")
    t = F.regexp_replace(t, r"<(?!\s*\d)[^>]+>", " ")
    return F.regexp_replace(squash(unescape_entities(t)), r":\s*:\s*", ": ")


GATED = ("screen_size", "estimated_annual_electricity_use", "ref_capacity", "ldy_capacity", "ldy_loading_type")


def resolve_fields(products: DataFrame, layout: str, line: str, context: Column | None = None) -> DataFrame:
    """All attributes of a line from labels, description and title, in the product's own row.

    products: title, description (flattened), labels.  ``context``: category texts that may tell a compact washer.
    """
    wanted = [*LINE_FIELDS[line], "reference", "model"]
    product = is_line_title(F.col("title"), line)
    compact = None
    if line == "LDY" and layout == "M":
        told = key_text(F.coalesce(context, F.lit(""))).rlike(r"\bmmlp\b|\bmini (?:maquina de lavar|lavadora)\b")
        compact = (told | (product & key_text(F.col("title")).rlike(COMPACT_WORDS))) & (title_mass(F.col("title")) == "")
    out = with_fields(with_evidence(products, layout, wanted, compact=compact, out="__evidence"), wanted, "__evidence").drop("__evidence")
    blanks = {f: F.when(product, F.col(f)).otherwise("") for f in wanted if f in GATED}
    if line == "LDY":
        dryer = is_standalone_dryer(F.col("title"))
        for f in ("ldy_capacity", "ldy_loading_type"):
            blanks[f] = F.when(dryer, "").otherwise(blanks[f])
    if line == "TV" and layout == "C":
        blanks["screen_size"] = F.when(
            product, first_present(screen_from_spec(F.col("screen_size")), F.col("screen_size"))).otherwise("")
    return out.withColumns(blanks)


def _offer(doc: Column, seller: Column) -> Column:
    """Offer of the wanted seller; without one the first offer; no match gives NULL."""
    offers = V.get(doc, "$.offers", "array<variant>")
    wanted = F.lower(squash(seller))
    mine = F.filter(offers, lambda o: F.lower(squash(V.get(o, "$.seller.id"))) == wanted)
    return F.when(wanted == "", F.get(offers, F.lit(0))).otherwise(F.get(mine, F.lit(0)))


def _page_labels(pairs: Column) -> Column:
    """Label / value pairs of a page as label rows, behind all others."""
    return F.transform(pairs, lambda p, i: F.struct(
        F.lit("page").alias("source"), p["label_key"].alias("label_key"),
        F.concat(F.lit("~~"), F.lpad(i.cast("string"), 6, "0")).alias("order_key"), p["value"].alias("value")))


def page_labels_of(layout: str, line: str) -> list[str]:
    """Keys of the labels that a page's pairs may carry for a line."""
    return [label for label, field, _, _ in label_rows(layout) if field in (*LINE_FIELDS[line], "reference", "model")]


def detail_layout_m(items: DataFrame, keys: list[str], line: str, doc: str = "doc", seller: str = "seller_id",
                    carry: list[str] = [], pairs: str | None = None) -> DataFrame:
    """Detail row of a layout-M item document and the selected seller's offer.

    Everything is decided in the row, without a shuffle.  ``carry``: further columns to keep; ``pairs``: label / value pairs of
    the page, which join the labels.
    """
    d = F.col(doc)
    g = lambda p: V.get(d, p)
    base = items.select(
        *keys, *carry, *([pairs] if pairs else []), d.alias("doc"), F.col(seller).alias("seller_id"), clean_text(g("$.title")).alias("title"),
        flat_description(g("$.description")).alias("description"))
    base = E.with_fact_labels(base, "doc", "labels")
    if pairs:
        base = base.withColumn("labels", F.concat("labels", _page_labels(F.col(pairs))))
    context = F.concat_ws(" ", *[V.get(F.col("doc"), p) for p in (
        "$.path", *(f"$.{c}{k}" for c in ("category", "subcategory") for k in ("", ".id", ".name", ".url")))])
    out = resolve_fields(base, "M", line, context)
    out = out.withColumn("offer", _offer(F.col("doc"), F.col("seller_id")))
    o, d = F.col("offer"), F.col("doc")
    tags = F.transform(
        V.get(o, "$.seller.tags", "array<variant>"),
        lambda t: F.struct(V.get(t, "$.type").alias("type"), V.get(t, "$.discountValue").alias("discountValue"),
                           V.get(t, "$.message").alias("message")))
    coupon = coupon_result(tags, V.get(o, "$.seller.id"), F.col("seller_id"))
    references = F.filter(F.split(F.col("reference"), r" \|\|\| "), lambda r: r != "")
    title_model = D.strict_tv_model(F.col("title"), F.col("screen_size")) if line == "TV" else None
    if line == "TV":
        sku = D.reference_choice(references, title_model)
    else:
        sku = first_present(
            _safe_model(F.get(references, F.lit(0))), _safe_model(F.col("model")), D.appliance_listing_model(F.col("title")))
    return out.select(
        *keys, *carry, F.lit("M").alias("layout"), F.col("title").alias("retailer_sku_name"), sku.alias("sku"),
        format_brl(V.get(o, "$.listPrice")).alias("original_sku_price"),
        format_brl(F.coalesce(F.nullif(V.get(o, "$.bestPrice.totalAmount"), F.lit("")), V.get(o, "$.price"))).alias("final_sku_price"),
        coupon["text"].alias("discount_type"), coupon["checked"].alias("discount_type_checked"),
        *LINE_FIELDS[line], squash(V.get(d, "$.rating.score")).alias("star_rating"),
        squash(V.get(d, "$.rating.count")).alias("count_of_star_ratings"),
        squash(V.get(d, "$.id")).alias("detail_item_id"),
    )


def _safe_model(c: Column) -> Column:
    text = squash(c)
    token = D.appliance_listing_model(text)
    return (
        F.when((text == "") | D.is_spec_token(text), "")
        .when(~D.is_synthetic(text), text)
        .when((token != "") & ~D.is_synthetic(token), token)
        .otherwise("")
    )


def spec_groups(doc: Column) -> Column:
    """``specGroups`` of a layout-C product as typed groups."""
    spec = lambda s: F.struct(V.get(s, "$.name").alias("name"), V.get(s, "$.value").alias("value"))
    return F.transform(
        V.get(doc, "$.product.specGroups", "array<variant>"),
        lambda g: F.struct(
            F.coalesce(V.get(g, "$.name"), V.get(g, "$.title"), V.get(g, "$.description")).alias("name"),
            F.transform(V.get(g, "$.specs", "array<variant>"), spec).alias("specs")))


def detail_layout_c(items: DataFrame, keys: list[str], line: str, doc: str = "doc", carry: list[str] = [],
                    pairs: str | None = None) -> DataFrame:
    """Detail row of a layout-C product-source document (product and sku), in the row; ``carry`` and ``pairs`` as for layout M."""
    g = lambda *ps: F.coalesce(*[F.nullif(clean_text(V.get(F.col(doc), p)), F.lit("")) for p in ps], F.lit(""))
    base = items.select(
        *keys, *carry, *([pairs] if pairs else []), F.col(doc).alias("doc"), g("$.product.name", "$.product.rawName", "$.sku.name").alias("title"),
        g("$.sku.name").alias("variant"), g("$.product.brand.name", "$.product.brand", "$.sku.brand").alias("brand"),
        flat_description(F.coalesce(
            F.nullif(V.get(F.col(doc), "$.product.description"), F.lit("")),
            V.get(F.col(doc), "$.product.rawDescription"))).alias("description"),
        spec_groups(F.col(doc)).alias("spec_groups"))
    base = base.withColumn("labels", E.spec_labels(F.col("spec_groups")))
    if pairs:
        base = base.withColumn("labels", F.concat("labels", _page_labels(F.col(pairs))))
    out = resolve_fields(base, "C", line)
    evidence = F.filter(F.split(F.col("reference"), r" \|\|\| "), lambda r: r != "")
    out = out.withColumns({"evidence": evidence, "existing_sku": F.lit("")})
    if line == "REF":
        out = resolve_refrigerator_sku(out)
    elif line == "LDY":
        from vitrine.operators.sku import phrase_models

        models = F.array_distinct(F.concat(
            F.flatten(F.transform(F.col("evidence"), lambda v: _label(v, F.col("variant")))),
            phrase_models(F.col("description"), F.col("variant"))))
        out = resolve_washer_sku(out.withColumn("evidence", models))
    else:
        out = out.withColumns({"sku": F.col("model"), "sku_short": F.lit(""),
                               "sku_status": F.array().cast("array<string>")})
    return out.select(
        *keys, *carry, F.lit("C").alias("layout"), F.col("title").alias("retailer_sku_name"), "sku", "sku_short",
        F.array_join("sku_status", "+").alias("sku_status"), *LINE_FIELDS[line],
        squash(V.get(F.col("doc"), "$.product.id")).alias("retailer_product_id"), "brand")


def _label(value: Column, variant: Column) -> Column:
    from vitrine.operators.sku import label_models

    return label_models(value, variant)


def page_identity(product_url: Column, ids: Column, page_urls: Column) -> Column:
    """(verified, conflict): the URL's id against the payload's ids, else against page URLs."""
    want = F.lower(squash(sku_from_url(product_url)))
    own = F.filter(F.transform(ids, lambda i: F.lower(squash(i))), lambda i: i != "")
    linked = F.filter(F.transform(page_urls, lambda u: F.lower(squash(sku_from_url(u)))), lambda i: i != "")
    seen = F.when(F.size(own) > 0, own).otherwise(linked)
    hit = F.array_contains(seen, want)
    return F.struct(
        F.when(want == "", F.size(own) > 0).when(F.size(seen) == 0, False).otherwise(hit).alias("verified"),
        F.when((want == "") | (F.size(seen) == 0), False).otherwise(~hit).alias("conflict"))


def _with_pairs(pages: DataFrame, proven: Column, layout: str, line: str) -> DataFrame:
    """Adds ``pairs``: label / value pairs of the page's main part where its identity is proven, and none elsewhere."""
    own = pages.withColumn("__html", F.when(proven, F.col("html")))
    return with_page_pairs(own, "__html", "pairs", page_labels_of(layout, line)).drop("__html")


def detail_from_page_m(pages: DataFrame, keys: list[str], line: str) -> DataFrame:
    """Detail row of a stored layout-M product page with its identity flags.

    pages: keys, product_url, html.  Label / value pairs of the page's main part join the evidence when identity is proven.
    """
    base = pages.select(
        *keys, "product_url", "html", V.get(data_island(F.col("html")), "$.props.pageProps.data.item", "variant").alias("doc"))
    base = base.filter(V.as_entries(F.col("doc")).isNotNull())
    base = base.withColumn("seller_id", seller_from_url(F.col("product_url")))
    item = squash(V.get(F.col("doc"), "$.id"))
    base = _with_pairs(base, url_matches_id(F.col("product_url"), item), "M", line)
    out = detail_layout_m(base, keys, line, carry=["product_url"], pairs="pairs")
    want = F.lower(squash(sku_from_url(F.col("product_url"))))
    have = F.lower(F.col("detail_item_id"))
    return out.withColumns({
        "identity_verified": (F.col("retailer_sku_name") != "") & url_matches_id(F.col("product_url"), F.col("detail_item_id")),
        "identity_conflict": (want != "") & (have != "") & (want != have),
    })


def detail_from_page_c(pages: DataFrame, keys: list[str], line: str) -> DataFrame:
    """Detail row of a stored layout-C product page with its identity flags.

    The main product sits at one of three fixed places; recommendation blocks are never
    promoted.  Label / value pairs of the page's main part join the evidence when identity is proven.
    """
    island = data_island(F.col("html"))
    at = lambda p: V.get(F.col("island"), p, "variant")
    usable = lambda d: F.when(F.size(V.as_entries(d)) > 0, d)
    base = pages.select(*keys, "product_url", "html", island.alias("island"))
    product = F.coalesce(
        usable(at("$.props.pageProps.product")), usable(at("$.props.pageProps.data.product")),
        usable(at("$.props.initialState.Product.product")))
    base = base.withColumns({"p": product, "s": at("$.props.initialState.Product.sku")})
    base = base.filter(F.col("p").isNotNull())
    ids = F.filter(
        F.array(*[V.get(F.col("p"), f"$.{k}") for k in ("skuId", "idSku", "selectedSku", "sku.id", "sku.skuId")],
                *[V.get(F.col("s"), f"$.{k}") for k in ("id", "skuId", "idSku")]),
        lambda i: i.isNotNull() & ~as_text(i).startswith("{"))
    canonical = F.regexp_extract(F.col("html"), r"""(?i)<link[^>]+rel=["']canonical["'][^>]+href=["']([^"']+)["']""", 1)
    meta = F.regexp_extract(F.col("html"), r"""(?i)<meta[^>]+property=["']og:url["'][^>]+content=["']([^"']+)["']""", 1)
    base = base.withColumn("proof", page_identity(F.col("product_url"), ids, F.array(meta, canonical)))
    doc = F.try_parse_json(F.concat(
        F.lit('{"product":'), F.to_json("p"), F.lit(',"sku":'), F.coalesce(F.to_json("s"), F.lit("{}")), F.lit("}")))
    base = base.select(*keys, "html", doc.alias("doc"), F.col("proof.verified").alias("identity_verified"), F.col("proof.conflict").alias("identity_conflict"))
    base = _with_pairs(base, F.col("identity_verified") & present(V.get(F.col("doc"), "$.product.name")), "C", line)
    return detail_layout_c(base, keys, line, carry=["identity_verified", "identity_conflict"], pairs="pairs")
