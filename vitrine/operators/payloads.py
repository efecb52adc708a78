"""Checks of stored payloads (VARIANT) and the texts taken from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import variants as V
from vitrine.functions.money import to_number
from vitrine.functions.text import as_text, ascii_fold, clean_text, present

is_object = lambda d: F.coalesce(V.as_entries(d).isNotNull(), F.lit(False))
is_list = lambda d: F.coalesce(V.as_array(d).isNotNull(), F.lit(False))


def _has(doc: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.map_keys(V.get(doc, "$", "map<string,variant>")), key), F.lit(False))


def search_error(doc: Column, page: Column, size: int, sort: Column, term: Column, max_products: int = 120) -> Column:
    """Why a search payload is unusable; '' when it is the page that was asked for."""
    g = lambda p, t="string": V.get(doc, p, t)
    products = g("$.products", "array<variant>")
    n = F.size(products)
    got_page, got_size = F.coalesce(g("$.pagination.page", "int"), F.lit(0)), F.coalesce(g("$.pagination.size", "int"), F.lit(0))
    chosen = F.get(F.filter(g("$.sorts", "array<variant>"), lambda s: F.coalesce(V.get(s, "$.selected", "boolean"), F.lit(False))), F.lit(0))
    kind, way = F.trim(as_text(V.get(chosen, "$.type"))), F.trim(as_text(V.get(chosen, "$.orientation")))
    shown = lambda c: F.when(c == "", "missing").otherwise(c)
    text = lambda c: c.cast("string")
    words = lambda c: F.lower(F.trim(F.regexp_replace(as_text(c), r"[+\s]+", " ")))
    fault = F.transform(products, lambda d, i: F.struct(i.alias("i"), (
        F.when(~is_object(d), "not_object")
        .when(~present(V.get(d, "$.title")), "missing_title")
        .when(~present(V.get(d, "$.path")), "missing_path")
        .when(~as_text(V.get(d, "$.path")).rlike(r"/p/[^/?#]+"), "invalid_path")).alias("why")))
    first = F.get(F.filter(fault, lambda f: f["why"].isNotNull()), F.lit(0))
    return (
        F.when(~is_object(doc), "invalid_search_payload")
        .when(products.isNull(), "invalid_search_products")
        .when(n == 0, "empty_products")
        .when(~is_object(g("$.pagination", "variant")), "missing_pagination")
        .when(got_page != page, F.concat(F.lit("page_mismatch:"), text(got_page), F.lit("!="), text(page)))
        .when(got_size != size, F.concat(F.lit("page_size_mismatch:"), text(got_size), F.lit(f"!={size}")))
        .when(chosen.isNull(), "selected_sort_missing")
        .when((kind != sort) | (way != "desc"), F.concat(
            F.lit("sort_mismatch:"), shown(kind), F.lit(":"), shown(way), F.lit("!="), sort, F.lit(":desc")))
        .when(~is_object(g("$.term", "variant")), "search_term_missing")
        .when(words(g("$.term.raw")) != words(term), F.concat(
            F.lit("search_term_mismatch:"), shown(words(g("$.term.raw"))), F.lit("!="), words(term)))
        .when(n > max_products, F.concat(F.lit("too_many_products:"), text(n)))
        .when(first.isNotNull(), F.concat(F.lit("invalid_product:"), text(first["i"]), F.lit(":"), first["why"]))
        .otherwise("")
    )


def product_source_error(doc: Column, expected_sku: Column) -> Column:
    """Whether a product-source payload proves identity and carries content."""
    g = lambda p, t="string": V.get(doc, p, t)
    one = lambda *ps: F.coalesce(*[F.nullif(clean_text(g(p)), F.lit("")) for p in ps], F.lit(""))
    sku = one("$.sku.id")
    usable = F.exists(
        F.flatten(F.transform(
            F.coalesce(g("$.product.specGroups", "array<variant>"), F.array().cast("array<variant>")),
            lambda gr: F.coalesce(V.get(gr, "$.specs", "array<variant>"), F.array().cast("array<variant>")))),
        lambda s: present(V.get(s, "$.name")) & present(V.get(s, "$.value")))
    has_parts = lambda p: is_object(g(p, "variant")) & (F.size(V.as_entries(g(p, "variant"))) > 0)
    return (
        F.when(~is_object(doc) | (F.size(V.as_entries(doc)) == 0), "empty_data")
        .when(~F.coalesce(g("$.isValid", "boolean"), F.lit(True)), "is_valid_false")
        .when(~has_parts("$.product") | ~has_parts("$.sku"), "missing_product_or_sku")
        .when((one("$.product.id") == "") | (sku == ""), "missing_product_identity")
        .when(present(expected_sku) & (sku != F.trim(as_text(expected_sku))), F.concat(F.lit("sku_mismatch:"), sku))
        .when(one("$.product.name", "$.product.rawName", "$.sku.name") == "", "missing_product_name")
        .when((one("$.product.description", "$.product.rawDescription") == "") & ~usable, "missing_product_content")
        .otherwise("")
    )


def review_error(doc: Column) -> Column:
    """Types and ranges of a review payload."""
    review = V.get(doc, "$.review", "variant")
    raw = V.get(review, "$.userReviews", "variant")
    items = V.as_array(raw)
    bad = lambda key, low, high: (as_text(V.get(review, f"$.{key}")) != "") & F.coalesce(
        (to_number(V.get(review, f"$.{key}")) < low)
        | (F.lit(False) if high is None else to_number(V.get(review, f"$.{key}")) > high)
        | to_number(V.get(review, f"$.{key}")).isNull(), F.lit(True))
    summary = V.get(review, "$.aiSummary", "variant")
    null = lambda d: F.coalesce(F.is_variant_null(d), F.lit(False))
    return (
        F.when(~is_object(doc), "not_object")
        .when(~is_object(review), "missing_review")
        .when(raw.isNotNull() & ~null(raw) & items.isNull(), "invalid_user_reviews")
        .when(F.exists(items, lambda i: ~is_object(i)), "invalid_review_item")
        .when(bad("rating", 0, 5), "invalid_rating")
        .when(bad("ratingQty", 0, None), "invalid_ratingQty")
        .when(bad("recommendationPercentage", 0, 100), "invalid_recommendationPercentage")
        .when(summary.isNotNull() & ~null(summary) & ~is_object(summary)
              & (as_text(V.get(review, "$.aiSummary")) != ""), "invalid_ai_summary")
        .otherwise("")
    )


def _truthy(d: Column) -> Column:
    """A JSON value that is not null, empty, zero or false."""
    text = F.to_json(d)
    return d.isNotNull() & ~text.isin("null", '""', "[]", "{}", "false", "0")


def envelope_error(doc: Column, require_item: bool = False) -> Column:
    """Error token of a response envelope, '' when its data may be used."""
    data = V.get(doc, "$.data", "variant")
    item = F.lit(False)
    if require_item:
        item = ~F.coalesce(_truthy(V.get(doc, "$.data.item", "variant")), F.lit(False))
    return (
        F.when(~is_object(doc), "invalid_json")
        .when(F.coalesce(_truthy(V.get(doc, "$.errors", "variant")), F.lit(False)), "graphql_errors")
        .when(~_has(doc, "data"), "graphql_data_missing")
        .when(~is_object(data), "graphql_data_invalid_type")
        .when(item, "graphql_item_missing")
        .otherwise("")
    )


def terminal_shipping_error(doc: Column, messages: list[str]) -> Column:
    """All errors say that shipping is not available: no retry can help."""
    errors = V.get(doc, "$.errors", "array<variant>")
    final = lambda e: (
        (F.to_json(V.get(e, "$.path", "variant")) == '["shipping"]')
        & F.trim(as_text(V.get(e, "$.message"))).isin(*messages)
        & (F.lower(F.trim(as_text(V.get(e, "$.extensions.service")))) == "freight")
        & (F.lower(F.trim(as_text(V.get(e, "$.extensions.code")))) == "not_available")
        & (F.lower(F.trim(as_text(V.get(e, "$.extensions.status")))) == "resource_not_found")
    )
    every = (F.size(errors) > 0) & F.forall(errors, lambda e: F.coalesce(final(e), F.lit(False)))
    return F.when(F.coalesce(every, F.lit(False)), "shipping_not_available").otherwise("")


# ---- delivery texts -----------------------------------------------------------------------------


def _option_step(node: Column) -> Column:
    items = F.flatten(F.array(*[
        F.coalesce(V.get(node["doc"], f"$.{k}", "array<variant>"), F.array().cast("array<variant>"))
        for k in ("options", "freights", "items", "deliveries", "shippingOptions")
    ]))
    listed = F.coalesce(V.as_array(node["doc"]), items)
    return F.transform(listed, lambda d: F.struct(F.lit("").alias("path"), d.alias("doc")))


def freight_texts(rows: DataFrame, doc: str = "doc", no_delivery: str = "Entrega indisponivel para este CEP") -> DataFrame:
    """Adds delivery and pickup texts of a freight document (options may be nested).

    Only "normal" delivery counts; a business message is used when there is none; with
    pickup alone delivery is stated as unavailable.
    """
    df = V.walk(rows, V.root(F.col(doc)), "__opts", _option_step)
    deadline = lambda d: F.coalesce(*[
        F.nullif(F.trim(as_text(V.get(d, f"$.{k}"))), F.lit(""))
        for k in ("formattedDeadlineDelivery", "deliveryDateDetailed", "deadline", "description")])
    options = F.filter(
        F.transform(F.col("__opts"), lambda n: F.struct(
            F.trim(as_text(V.get(n["doc"], "$.name"))).alias("name"), deadline(n["doc"]).alias("when"))),
        lambda o: (o["name"] != "") & o["when"].isNotNull())
    df = df.withColumn("__options", F.transform(options, lambda o: F.struct(
        F.concat_ws(" ", o["name"], o["when"]).alias("text"), F.lower(ascii_fold(o["name"])).alias("low"))))
    o = F.col("__options")
    is_pickup = lambda x: x["low"].rlike("retira|withdraw|pickup")
    texts = lambda arr: F.transform(arr, lambda x: x["text"])
    df = df.withColumns({
        "__pickup": F.array_distinct(texts(F.filter(o, is_pickup))),
        "__delivery": F.array_distinct(texts(F.filter(o, lambda x: ~is_pickup(x) & x["low"].rlike(r"\bnormal\b")))),
        "__skipped": F.exists(o, lambda x: ~is_pickup(x) & ~x["low"].rlike(r"\bnormal\b")),
    })
    message = clean_text(V.get(F.col(doc), "$.error.message"))
    usable = (message != "") & ~F.contains(F.lower(ascii_fold(message)), F.lit("calculo de frete apresentou problemas"))
    delivery = (
        F.when(F.size("__delivery") > 0, F.array_join("__delivery", "; "))
        .when(usable, message)
        .when((F.size("__pickup") > 0) & ~F.col("__skipped"), no_delivery)
        .otherwise("")
    )
    return df.withColumns({
        "delivery_availability": delivery, "pick_up_availability": F.array_join("__pickup", "; "),
    }).drop("__opts", "__options", "__pickup", "__delivery", "__skipped")


def shipping_texts(doc: Column) -> Column:
    """(delivery, pickup) of a shipping document: first description of each kind.

    Package descriptions are the fallback for delivery.
    """
    lists = lambda d, p: F.coalesce(V.get(d, p, "array<variant>"), F.array().cast("array<variant>"))
    modalities = F.flatten(F.transform(lists(doc, "$.deliveries"), lambda g: lists(g, "$.modalities")))
    told = F.filter(
        F.transform(modalities, lambda m: F.struct(
            clean_text(V.get(m, "$.shippingTime.description")).alias("text"),
            (F.contains(F.lower(as_text(V.get(m, "$.type"))), F.lit("pickup"))
             | F.contains(F.lower(as_text(V.get(m, "$.name"))), F.lit("retira"))).alias("pickup"))),
        lambda x: x["text"] != "")
    packages = F.flatten(F.transform(
        F.flatten(F.transform(lists(doc, "$.shippings"), lambda s: lists(s, "$.packages"))),
        lambda p: lists(p, "$.deliveryTypes")))
    other = F.filter(F.transform(packages, lambda t: clean_text(V.get(t, "$.description"))), lambda t: t != "")
    first = lambda flag: F.get(F.filter(told, lambda x: x["pickup"] == flag), F.lit(0))["text"]
    return F.struct(
        F.coalesce(first(F.lit(False)), F.get(other, F.lit(0)), F.lit("")).alias("delivery"),
        F.coalesce(first(F.lit(True)), F.lit("")).alias("pickup"))
