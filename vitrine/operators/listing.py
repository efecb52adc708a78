"""Pages -> product occurrences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions import models as D
from vitrine.functions import variants as V
from vitrine.functions.metrics import zero_preserving
from vitrine.functions.money import (
    card_discounts, card_name, card_prices, card_rating, card_savings, coupon_text, format_brl,
    listing_savings,
)
from vitrine.functions.text import (
    as_text, clean_text, first_present, model_year, present, squash,
)
from vitrine.functions.urls import normalized_url, seller_from_url, sku_from_url
from vitrine.functions.validators import screen_size_text
from vitrine.operators.numbering import first_rows
from vitrine.operators.relevance import relevant_layout_c, relevant_layout_m, sku_status
from vitrine.sources.pages import data_island, embedded_json

# Where each layout keeps its products.
PRODUCT_PATHS = {
    "M": "$.props.pageProps.data.search.products",
    "C": "$.props.pageProps.initialState.search.results.products",
    "S": "$.props.pageProps.data.casasBahiaSearch.products",
}
COLUMNS = [
    "pos", "title", "product_url", "item", "sku", "original_sku_price", "final_sku_price", "savings",
    "sku_status", "discount_type", "delivery_availability", "pick_up_availability", "screen_size",
    "model_year", "star_rating", "count_of_star_ratings", "seller_id", "retailer_product_id",
    "parse_status",
]


def absolute_url(base: Column, href: Column) -> Column:
    text = F.trim(as_text(href))
    host = F.regexp_extract(base, r"^([a-z]+://[^/]+)", 1)
    return (
        F.when(text == "", "")
        .when(text.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), text)
        .when(text.startswith("//"), F.concat(F.regexp_extract(base, r"^([a-z]+:)", 1), text))
        .when(text.startswith("/"), F.concat(host, text))
        .otherwise(F.concat(F.regexp_replace(base, "/?$", "/"), text))
    )


def _tags(doc: Column) -> Column:
    one = lambda d: F.struct(
        V.get(d, "$.type").alias("type"), V.get(d, "$.discountValue").alias("discountValue"),
        V.get(d, "$.message").alias("message"))
    return F.transform(V.get(doc, "$.seller.tags", "array<variant>"), one)


def _category_step(node: Column) -> Column:
    """Sub-categories of a category node."""
    below = lambda k: F.coalesce(
        V.get(node["doc"], f"$.{k}", "array<variant>"),
        F.array(V.get(node["doc"], f"$.{k}", "variant")))
    found = F.flatten(F.array(*[below(k) for k in ("category", "subcategory", "subCategory", "children")]))
    return F.transform(
        F.filter(found, lambda d: V.as_entries(d).isNotNull()),
        lambda d: F.struct(F.lit("").alias("path"), d.alias("doc")))


def with_categories(products: DataFrame, doc: str = "doc") -> DataFrame:
    """Adds ``category_names``: names of the whole category tree of a product."""
    top = lambda k: F.coalesce(
        V.get(F.col(doc), f"$.{k}", "array<variant>"),
        F.array(V.get(F.col(doc), f"$.{k}", "variant")))
    first = F.flatten(F.array(*[top(k) for k in ("categories", "department", "category", "subcategory", "subCategory")]))
    seed = F.transform(
        F.filter(first, lambda d: V.as_entries(d).isNotNull()),
        lambda d: F.struct(F.lit("").alias("path"), d.alias("doc")))
    df = V.walk(products, seed, "__cats", _category_step)
    name = lambda n: clean_text(F.coalesce(*[
        F.nullif(V.get(n["doc"], f"$.{k}"), F.lit("")) for k in ("name", "title", "description")]))
    plain = F.filter(
        F.array(*[V.get(F.col(doc), f"$.{k}") for k in ("department", "category", "subcategory", "subCategory")]),
        lambda t: t.isNotNull() & ~as_text(t).startswith("{") & ~as_text(t).startswith("["))
    names = F.concat(F.filter(F.transform(F.col("__cats"), name), lambda t: t != ""), plain)
    return df.withColumn("category_names", names).drop("__cats")


def product_docs(pages: DataFrame, keys: list[str], layout: str, html: str = "html") -> DataFrame:
    """One row per product document of a page, in page order (``pos`` from 0)."""
    docs = V.get(data_island(F.col(html)), PRODUCT_PATHS[layout], "array<variant>")
    rows = pages.select(*keys, F.posexplode(docs).alias("pos", "doc"))
    return rows.filter(V.as_entries(F.col("doc")).isNotNull())


def explode_listing(pages: DataFrame, keys: list[str], layout: str, base_url: str, line: str,
                    html: str = "html") -> DataFrame:
    """Relevant products of a layout's listing as occurrence rows."""
    docs = product_docs(pages, keys, layout, html)
    return (_layout_m if layout == "M" else _layout_c)(docs, keys, layout, base_url, F.lit(line))


def _layout_m(docs: DataFrame, keys, layout, base_url: str, line: Column) -> DataFrame:
    d = F.col("doc")
    g = lambda p: V.get(d, p)
    rows = docs.select(
        *keys, "pos", "doc", clean_text(F.coalesce(g("$.title"), g("$.name"))).alias("title"),
        as_text(g("$.path")).alias("path"), as_text(g("$.subcategory.id")).alias("category"))
    rows = rows.filter(relevant_layout_m(F.col("title"), F.col("path"), F.col("category"), line))
    seller = first_present(g("$.seller.id"), seller_from_url(F.col("path")))
    url = absolute_url(F.lit(base_url), F.col("path"))
    rows = rows.withColumns({"seller_id": squash(seller), "__url": url})
    url = F.when(
        (F.col("seller_id") != "") & ~F.contains(F.col("__url"), F.lit("seller_id=")),
        F.concat(F.col("__url"), F.when(F.contains(F.col("__url"), F.lit("?")), "&").otherwise("?"),
                 F.lit("seller_id="), F.col("seller_id")),
    ).otherwise(F.col("__url"))
    rows = rows.withColumn("product_url", url)
    item = first_present(sku_from_url(F.col("product_url")), squash(g("$.id")))
    price = lambda *ps: F.coalesce(*[F.nullif(g(p), F.lit("")) for p in ps])
    blank = F.lit("")
    return rows.select(
        *keys, "pos", "title", "product_url", item.alias("item"),
        first_present(item, g("$.seller.sku")).alias("sku"),
        format_brl(price("$.price.fullPrice")).alias("original_sku_price"),
        format_brl(price("$.price.bestPrice", "$.price.price")).alias("final_sku_price"),
        blank.alias("savings"),
        sku_status(F.lit("M"), V.get(d, "$.ads.sponsored", "boolean"), g("$.ads.label"), g("$.adsSellerId"))
        .alias("sku_status"),
        F.coalesce(coupon_text(_tags(d)), blank).alias("discount_type"),
        squash(g("$.shippingTag.time")).alias("delivery_availability"),
        squash(g("$.shippingTag.complement")).alias("pick_up_availability"),
        screen_size_text(F.col("title")).alias("screen_size"), model_year(F.col("title")).alias("model_year"),
        blank.alias("star_rating"), blank.alias("count_of_star_ratings"), "seller_id",
        blank.alias("retailer_product_id"), F.lit("listing_next_data").alias("parse_status"),
    )


def _layout_c(docs: DataFrame, keys, layout, base_url: str, line: Column) -> DataFrame:
    d = F.col("doc")
    g = lambda *ps: F.coalesce(*[F.nullif(V.get(d, p), F.lit("")) for p in ps])
    rows = with_categories(docs.withColumn("title", clean_text(g("$.title", "$.name"))))
    hay = F.concat_ws(" ", F.col("title"), F.array_join("category_names", " "))
    rows = rows.filter(relevant_layout_c(F.col("title"), hay, F.col("category_names"), line))
    rows = rows.withColumn("product_url", absolute_url(F.lit(base_url), g("$.href", "$.url")))
    old = g("$.price.oldPrice", "$.price.priceFrom", "$.oldPrice")
    scalar_price = V.get(d, "$.price", "decimal(18,2)").cast("string")
    now = F.coalesce(g("$.price.currentPrice", "$.price.price", "$.price.bestPrice"), scalar_price)
    standard = g("$.price.standardPrice", "$.price.price", "$.price.bestPrice")
    own_sku = F.when(line.isin("REF", "LDY"), "").otherwise(
        first_present(squash(g("$.sku")), sku_from_url(F.col("product_url")), squash(g("$.id"))))
    events = F.coalesce(V.get(d, "$.advertasingEvents", "array<variant>"), V.get(d, "$.advertisingEvents", "array<variant>"))
    flagged = F.coalesce(V.get(d, "$.isSponsored", "boolean"), F.lit(False)) | (F.coalesce(F.size(events), F.lit(0)) > 0)
    notes = F.flatten(F.array(*[
        F.coalesce(F.transform(
            V.get(d, p, "array<variant>"),
            lambda f: clean_text(F.coalesce(V.get(f, "$.description"), V.get(f, "$.title"), V.get(f, "$.name")))),
            F.array().cast("array<string>"))
        for p in ("$.flags", "$.seals")]))
    lead = squash(g("$.price.priceDescription", "$.price.paymentMethod", "$.price.label", "$.priceDescription"))
    discount = F.array_distinct(F.concat(
        F.filter(F.array(lead), lambda t: t.rlike(r"(?i)cupom|desconto")),
        F.filter(notes, lambda t: t.rlike(r"(?i)desconto|oferta|cupom|pix|carn"))))
    pickup = F.exists(notes, lambda t: t.rlike(r"(?i)retira"))
    status = {"C": "listing_casas_bahia_ssr", "S": "listing_casas_bahia_showcase"}[layout]
    return rows.select(
        *keys, "pos", "title", "product_url", sku_from_url(F.col("product_url")).alias("item"),
        first_present(D.listing_model(F.col("title"), line), own_sku).alias("sku"),
        format_brl(old).alias("original_sku_price"), format_brl(now).alias("final_sku_price"),
        listing_savings(g("$.price.savings"), old, standard, g("$.price.discountRate", "$.discountRate")).alias("savings"),
        sku_status(F.lit("C"), flagged, g("$.tagName"), F.lit("")).alias("sku_status"),
        F.array_join(discount, "; ").alias("discount_type"), F.lit("").alias("delivery_availability"),
        F.when(V.get(d, "$.price.availability.Retira", "boolean"), "Retirada disponivel")
        .when(pickup, "Retira Rapido").otherwise("").alias("pick_up_availability"),
        screen_size_text(F.col("title")).alias("screen_size"), model_year(F.col("title")).alias("model_year"),
        zero_preserving(g("$.rating", "$.reviews")).alias("star_rating"),
        zero_preserving(g("$.ratingCount", "$.reviewsCount", "$.ratingComments")).alias("count_of_star_ratings"),
        squash(g("$.lojista", "$.sellerId")).alias("seller_id"), squash(g("$.id")).alias("retailer_product_id"),
        F.lit(status).alias("parse_status"),
    )


def merge_card_snapshots(rows: DataFrame, cards: DataFrame, keys: list[str]) -> DataFrame:
    """Card values of the same page and URL into blanks only; the first card of a URL counts.

    cards: keys, pos, product_url and any of the listing's value columns.
    """
    values = [c for c in ("original_sku_price", "final_sku_price", "savings", "discount_type", "pick_up_availability")
              if c in cards.columns]
    keyed = first_rows(
        cards.withColumn("url_key", normalized_url(F.col("product_url"))).filter("url_key <> ''"),
        [*keys, "url_key"], ["pos"])
    theirs = keyed.select(*keys, "url_key", *[F.col(c).alias(f"c_{c}") for c in values])
    out = rows.withColumn("url_key", normalized_url(F.col("product_url"))).join(theirs, [*keys, "url_key"], "left")
    return out.withColumns({c: first_present(F.col(c), F.col(f"c_{c}")) for c in values}).drop(
        "url_key", *[f"c_{c}" for c in values])


ANCHOR = r"""(?is)<a\b[^>]*?href=["']([^"']+)["'][^>]*>(.*?)</a>"""


def anchor_listing(pages: DataFrame, keys: list[str], base_url: str, product_url: str, line: str,
                   html: str = "html") -> DataFrame:
    """Product links of a page, one per item, with the values their text states.

    ``product_url`` is the pattern a product link must match.
    """
    found = F.transform(
        F.regexp_extract_all(as_text(F.col(html)), F.lit(ANCHOR), F.lit(0)),
        lambda m: F.struct(
            absolute_url(F.lit(base_url), F.regexp_extract(m, ANCHOR, 1)).alias("url"),
            F.regexp_extract(m, r"""(?is)^<a\b[^>]*?aria-label=["']([^"']*)["']""", 1).alias("label"),
            F.regexp_extract(m, ANCHOR, 2).alias("inner")),
    )
    links = F.filter(found, lambda a: a["url"].rlike(product_url))
    rows = pages.select(*keys, F.posexplode(links).alias("pos", "a")).select(
        *keys, "pos", F.col("a.url").alias("product_url"),
        clean_text(first_present(F.col("a.label"), F.regexp_replace(F.col("a.inner"), r"<[^>]+>", " "))).alias("text"))
    rows = rows.withColumn("link_key", first_present(sku_from_url(F.col("product_url")), F.col("product_url")))
    firsts = first_rows(rows, [*keys, "link_key"], ["pos"])
    t = F.col("text")
    firsts = firsts.withColumns({"title": card_name(t), "prices": card_prices(t), "rating": card_rating(t)})
    blank = F.lit("")
    return firsts.select(
        *keys, "pos", "title", "product_url", sku_from_url(F.col("product_url")).alias("item"),
        first_present(D.listing_model(F.col("title"), F.lit(line)) if line != "TV" else blank, sku_from_url(F.col("product_url"))).alias("sku"),
        F.col("prices.original").alias("original_sku_price"), F.col("prices.final").alias("final_sku_price"),
        card_savings(t).alias("savings"),
        F.when(t.rlike(r"(?i)patrocinado|sponsored"), "Sponsored").otherwise("").alias("sku_status"),
        card_discounts(t).alias("discount_type"), blank.alias("delivery_availability"),
        blank.alias("pick_up_availability"), screen_size_text(t).alias("screen_size"),
        model_year(t).alias("model_year"), F.col("rating.rating").alias("star_rating"),
        F.col("rating.count").alias("count_of_star_ratings"), seller_from_url(F.col("product_url")).alias("seller_id"),
        blank.alias("retailer_product_id"), F.lit("listing").alias("parse_status"),
    )


def jsonld_listing(pages: DataFrame, keys: list[str], base_url: str, html: str = "html") -> DataFrame:
    """Products of linked-data blocks: item lists and single products."""
    blocks = embedded_json(pages, keys, html).filter("kind = 'linked_data'")
    kind = V.get(F.col("doc"), "$['@type']")
    listed = F.transform(
        V.get(F.col("doc"), "$.itemListElement", "array<variant>"),
        lambda e: F.coalesce(V.get(e, "$.item", "variant"), e))
    products = F.when(kind == "ItemList", listed).when(kind == "Product", F.array(F.col("doc")))
    rows = blocks.select(*keys, F.col("pos").alias("b"), F.posexplode(products).alias("p", "d"))
    d = F.col("d")
    rows = rows.withColumns({
        "product_url": absolute_url(F.lit(base_url), V.get(d, "$.url")), "title": clean_text(V.get(d, "$.name"))})
    rows = rows.filter(present(F.col("product_url")))
    blank = F.lit("")
    fixed = {c: blank for c in COLUMNS}
    fixed.update({
        "pos": (F.col("b") * 100000 + F.col("p")).cast("int"), "title": F.col("title"),
        "product_url": F.col("product_url"), "item": sku_from_url(F.col("product_url")),
        "sku": sku_from_url(F.col("product_url")), "final_sku_price": as_text(V.get(d, "$.offers.price")),
        "screen_size": screen_size_text(F.col("title")), "model_year": model_year(F.col("title")),
        "parse_status": F.lit("listing"),
    })
    return rows.select(*keys, *[fixed[c].alias(c) for c in COLUMNS])


def listing_with_fallback(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """Per page the rows of the first source (in list order) that has any."""
    tagged = None
    for priority, df in enumerate(sources):
        part = df.select(*keys, *COLUMNS).withColumn("priority", F.lit(priority))
        tagged = part if tagged is None else tagged.unionByName(part)
    best = Window.partitionBy(*keys)
    return tagged.withColumn("best", F.min("priority").over(best)).filter("priority = best").drop("best")


def listing_from_capture(entries: DataFrame, keys: list[str], url_part: str, layout: str, base_url: str,
                         line: str) -> DataFrame:
    """Listing documents recorded in a capture; the document with most rows wins.

    ``entries`` comes from the capture reader; equal counts keep the earlier document.
    """
    html = entries.filter(
        (F.col("method") == "GET") & F.contains("url", F.lit(url_part)) & F.contains(F.lower("mime"), F.lit("html"))
    ).select(*keys, "index", F.col("text").alias("html"))
    rows = explode_listing(html, [*keys, "index"], layout, base_url, line)
    counts = rows.groupBy(*keys, "index").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*keys).agg(F.max(F.struct("n", (-F.col("index")).alias("back"))).alias("b"))
    return rows.join(best.select(*keys, (-F.col("b.back")).alias("index")), [*keys, "index"], "left_semi")


def image_listing(requests: DataFrame, keys: list[str], order: str, hosts: list[str],
                  url: str = "url") -> DataFrame:
    """Listing recovered from image requests: ``/<w>x<h>/<slug>/<seller>/<product>/...``.

    Distinct (slug, seller, product) ranked by first appearance.
    """
    from vitrine.functions.urls import host_of
    from vitrine.operators.numbering import running_rank

    parts = F.filter(F.split(F.regexp_extract(F.col(url), r"^[a-z]+://[^/]+([^?#]*)", 1), "/"), lambda p: p != "")
    rows = requests.filter(host_of(F.col(url)).isin(*hosts)).withColumn("parts", parts)
    rows = rows.filter((F.size("parts") >= 5) & F.get("parts", F.lit(0)).rlike(r"^\d+x\d+$"))
    part = lambda i: F.get("parts", F.lit(i))
    rows = rows.select(*keys, order, part(1).alias("slug"), part(2).alias("seller"), part(3).alias("product_id"))
    rows = rows.filter(F.lower("slug").rlike(r"smart-tv|tv-|-tv|televisor|qled|crystal-uhd"))
    firsts = rows.groupBy(*keys, "slug", "seller", "product_id").agg(F.min(order).alias(order))
    ranked = running_rank(firsts, keys, order, ["slug", "seller", "product_id"], "main_rank")
    return ranked.withColumn("title", squash(F.replace("slug", F.lit("-"), F.lit(" "))))
