"""Offers and prices: exact matching, ambiguity, recovery with reason codes.

No operator here pairs every product row with every offer of its SKU.  Offers are
first reduced to one row per lookup key (how many there are, and the offer when it
is the only one); a product row then meets at most a handful of lookup rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.money import (
    discount_is_ambiguous, format_brl, listing_savings, price_number, to_number,
)
from vitrine.functions.text import append_token, as_text, blank, present, squash
from vitrine.functions.urls import host_allowed, sku_from_url
from vitrine.operators.numbering import lookup, one_per_key, spread_blank

PRICE_FIELDS = ["original_sku_price", "final_sku_price", "savings", "discount_type"]
QUOTE = [
    "old_price", "current_price", "standard_price", "discount_rate", "savings", "price_description",
    "avail_product", "avail_sku", "avail_seller",
]
ANY = "*"


def positive_id(c: Column) -> Column:
    """Digits without leading zeros, '' for anything else or zero."""
    text = F.trim(as_text(c))
    return F.when(text.rlike(r"^\d{1,16}$"), F.ltrim(text, F.lit("0"))).otherwise("")


def _malformed(c: Column) -> Column:
    return (as_text(c) != "") & (positive_id(c) == "")


def offer_map(offers: DataFrame) -> DataFrame:
    """One row per offer identity; differing duplicates remove the identity.

    Offers with malformed ids, or whose availability names another SKU or seller, are
    dropped first; a missing seller is taken from the availability.
    """
    names = ("product_id", "sku_id", "seller_id", "avail_sku", "avail_seller")
    # each id is cleaned once, and all rules are one flag: a filter on the ids would be moved in front and clean them again for each rule
    staged = offers.select(*[positive_id(F.col(c)).alias(f"__{c}") for c in names], *[F.col(c) for c in ("product_id", "seller_id")], *QUOTE)
    product, sku, seller, a_sku, a_seller = (F.col(f"__{c}") for c in names)
    malformed = lambda c: (as_text(F.col(c)) != "") & (F.col(f"__{c}") == "")
    bad = (
        malformed("product_id") | malformed("seller_id") | malformed("avail_sku") | malformed("avail_seller")
        | ((a_sku != "") & (a_sku != sku))
        | ((seller != "") & (a_seller != "") & (a_seller != seller))
    )
    keys = ["product_id", "sku_id", "seller_id"]
    clean = staged.select(
        product.alias("product_id"), sku.alias("sku_id"), F.when(seller != "", seller).otherwise(a_seller).alias("seller_id"), *QUOTE,
        ((sku != "") & ~bad).cast("int").alias("__good"))
    # equal offers collapse before the shuffle; an identity with two quotes left is out
    distinct = clean.groupBy(*keys, *QUOTE).agg(F.max("__good").alias("__good")).filter("__good = 1").drop("__good")
    quotes = distinct.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return quotes.filter("__n = 1").drop("__n")


def _lookup(offers: DataFrame, keys: list[str], count: str, pick: str) -> DataFrame:
    """Offers per key, and the offer itself (meaningful when it is the only one)."""
    offer = F.struct(*[c for c in ("product_id", "sku_id", "seller_id", *QUOTE) if c in offers.columns])
    return offers.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), F.min(offer).alias(pick))


def exact_offers(products: DataFrame, offers: DataFrame) -> DataFrame:
    """Offer on exact (product, SKU) and seller where known; otherwise an error status.

    ``offers`` is an :func:`offer_map`; adds ``offer`` and ``offer_status``.
    """
    by_pair = _lookup(offers, ["product_id", "sku_id"], "n_pair", "pair_offer")
    by_seller = _lookup(offers, ["product_id", "sku_id", "seller_id"], "n_seller", "seller_offer")
    known = F.col("seller_id") != ""
    n = F.coalesce(F.when(known, F.col("n_seller")).otherwise(F.col("n_pair")), F.lit(0))
    offer = F.when(known, F.col("seller_offer")).otherwise(F.col("pair_offer"))
    status = (
        F.when(n == 0, "price_or_seller_identity_incomplete")
        .when(n > 1, "ambiguous_listing_seller")
        .when(blank(offer["current_price"]), "missing_listing_price")
        .otherwise("")
    )
    return (
        # cards without a seller don't look at sellers
        lookup(products.join(by_pair, ["product_id", "sku_id"], "left"), by_seller, ["seller_id", "product_id", "sku_id"], ["seller_id"])
        .withColumns({"offer_status": status, "offer": F.when(status == "", offer)})
        .drop("n_pair", "pair_offer", "n_seller", "seller_offer")
    )


def optional_offers(products: DataFrame, offers: DataFrame, row_keys: list[str]) -> DataFrame:
    """Lenient attach by SKU, narrowed by product and seller where both sides know them.

    A blank id on either side matches anything, so a row asks for at most four lookup
    keys.  Rows: ``row_keys``, product_id, sku_id, seller_id, ``quarantined`` (bool),
    ``own_price`` (price already in the card, blank if none).
    """
    # each offer answers under its own ids and under the wildcard of either, in one pass
    cell = lambda product, seller: F.struct(product.alias("k_product"), seller.alias("k_seller"))
    own, other = (F.col("product_id"), F.col("seller_id")), F.lit(ANY)
    cube = offers.select(
        "sku_id", "seller_id", "current_price",
        F.explode(F.array(cell(*own), cell(own[0], other), cell(other, own[1]), cell(other, other))).alias("k"),
    ).select("sku_id", "seller_id", "current_price", "k.*")
    cells = cube.groupBy("sku_id", "k_product", "k_seller").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("seller_id", "current_price")).alias("only"),
    )
    wildcard = lambda c: F.when(c == "", F.array(F.lit(ANY))).otherwise(F.array(c, F.lit("")))
    asked = (
        products.filter(F.col("sku_id") != "")
        .select(*row_keys, "sku_id",
                F.explode(wildcard(F.col("product_id"))).alias("k_product"), "seller_id")
        .select(*row_keys, "sku_id", "k_product",
                F.explode(wildcard(F.col("seller_id"))).alias("k_seller"))
    )
    found = (
        asked.join(cells, ["sku_id", "k_product", "k_seller"])
        .groupBy(*row_keys).agg(F.sum("n").alias("n_offers"), F.min("only").alias("picked"))
    )
    n = F.coalesce(F.col("n_offers"), F.lit(0))
    picked = F.when(n == 1, F.col("picked"))
    quoted = F.when(~F.col("quarantined"), picked["current_price"])
    # a single offer without price, or several offers, also discard the card's own price
    own = F.when(~F.col("quarantined") & (n == 0), F.nullif(as_text(F.col("own_price")), F.lit("")))
    price = F.coalesce(F.when(present(quoted), quoted.cast("string")), own)
    seller = F.coalesce(
        F.when(present(picked["seller_id"]), picked["seller_id"]),
        F.when(F.col("seller_id") != "", F.col("seller_id")),
    )
    return products.join(found, row_keys, "left").select(
        *[F.col(c) for c in products.columns if c != "seller_id"],
        F.when(~F.col("quarantined"), seller).alias("seller_id"),
        n.alias("n_offers"), price.alias("price"),
        price.isNull().alias("price_pending"),
        (F.col("quarantined") | seller.isNull()).alias("seller_pending"),
    )


def last_price_wins(products: DataFrame, offers: DataFrame) -> DataFrame:
    """Price by product id, else by SKU; later offers overwrite earlier ones.

    Product and SKU ids share one key space, so both go into one lookup.
    """
    keyed = offers.select(
        F.explode(F.array_distinct(F.filter(
            F.array("product_id", "sku_id"), lambda k: present(k)))).alias("offer_key"),
        F.struct("pos", *[c for c in ("product_id", "sku_id", "seller_id", *QUOTE)]).alias("o"),
    )
    last = keyed.groupBy("offer_key").agg(F.max("o").alias("o"))
    by_product = last.select(F.col("offer_key").alias("product_id"), F.col("o").alias("o_product"))
    by_sku = last.select(F.col("offer_key").alias("sku_id"), F.col("o").alias("o_sku"))
    offer = F.coalesce("o_product", "o_sku")
    return (
        lookup(lookup(products, by_product, ["product_id"]), by_sku, ["sku_id"])
        .withColumns({
            "offer": offer,
            "seller_id": F.when(blank(F.col("seller_id")), F.coalesce(offer["seller_id"], F.lit("")))
            .otherwise(F.col("seller_id")),
        })
        .drop("o_product", "o_sku")
    )


def price_coverage(products: DataFrame, offers: DataFrame, row_keys: list[str]) -> DataFrame:
    """Per product: matched, ambiguous, missing, seller mismatch, related offers."""
    ids = offers.select(*[positive_id(F.col(c)).alias(c) for c in ("product_id", "sku_id", "seller_id")])
    ids = ids.filter((F.col("product_id") != "") & (F.col("sku_id") != "") & (F.col("seller_id") != ""))
    ids = ids.distinct()
    count = lambda keys, name: ids.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    out = products
    for keys, name in ((["product_id", "sku_id"], "n_pair"), (["product_id", "sku_id", "seller_id"], "n_exact"), (["product_id"], "n_product"), (["sku_id"], "n_sku")):
        out = lookup(out, count(keys, name), keys)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    n = F.when(F.col("seller_id") == "", zero("n_pair")).otherwise(zero("n_exact"))
    status = F.when(n == 1, "matched").when(n > 1, "ambiguous").otherwise("missing")
    missing = status == "missing"
    return out.select(
        *row_keys, "product_id", "sku_id", "seller_id", status.alias("coverage"),
        (missing & (F.col("seller_id") != "") & (zero("n_pair") > 0)).alias("seller_mismatch"),
        F.when(missing, zero("n_product") + zero("n_sku") - zero("n_pair")).otherwise(0)
        .alias("related_offers"),
    )


def coverage_summary(coverage: DataFrame) -> DataFrame:
    return coverage.agg(
        F.count(F.lit(1)).alias("source_products"),
        F.count_if(F.col("coverage") == "matched").alias("matched"),
        F.count_if(F.col("coverage") == "missing").alias("missing"),
        F.count_if(F.col("coverage") == "ambiguous").alias("ambiguous"),
        F.count_if("seller_mismatch").alias("seller_mismatches"),
        F.count_if(F.col("related_offers") > 0).alias("with_related"),
    )


def _row_identity(rows: DataFrame, hosts) -> DataFrame:
    url = F.col("product_url")
    p, s, l = (positive_id(F.col("retailer_product_id")), positive_id(sku_from_url(url)),
               positive_id(F.col("seller_id")))
    error = (
        F.when(~(as_text(url).startswith("https://") & host_allowed(url, hosts)), "invalid_product_url")
        .when(p == "", "missing_product_id")
        .when(s == "", "missing_sku_id")
        .when(present(F.col("seller_id")) & (l == ""), "invalid_seller_id")
        .otherwise("")
    )
    return rows.withColumns({"k_product": p, "k_sku": s, "k_seller": l, "identity_error": error})


def _offer_lookups(rows: DataFrame, offers: DataFrame) -> DataFrame:
    """Offer counts by product, by SKU and by seller, and the single match."""
    known = offers.withColumns({c: positive_id(F.col(c)) for c in ("product_id", "sku_id", "seller_id")})
    rename = lambda df: df.withColumnsRenamed(
        {"product_id": "k_product", "sku_id": "k_sku", "seller_id": "k_seller"})
    by_product = rename(known.groupBy("product_id").agg(F.count(F.lit(1)).alias("n_product")))
    by_sku = rename(_lookup(known, ["product_id", "sku_id"], "n_sku", "o_sku"))
    by_seller = rename(_lookup(known, ["product_id", "sku_id", "seller_id"], "n_seller", "o_seller"))
    out = lookup(lookup(lookup(rows, by_product, ["k_product"]), by_sku, ["k_product", "k_sku"]), by_seller, ["k_product", "k_sku", "k_seller"])
    any_seller = F.col("k_seller") == ""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.withColumns({
        "n_product": zero("n_product"), "n_sku": zero("n_sku"),
        "n_match": F.when(any_seller, zero("n_sku")).otherwise(zero("n_seller")),
        "match": F.when(any_seller, F.col("o_sku")).otherwise(F.col("o_seller")),
    }).drop("o_sku", "o_seller", "n_seller")


def _positive(c: Column) -> Column:
    n = to_number(c)
    return F.when(n > 0, n)


def _bad_quote(c: Column) -> Column:
    return present(c) & ~(F.trim(as_text(c)) == "0") & _positive(c).isNull()


def _money2(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _availability_conflict(o: Column, row: dict[str, Column]) -> Column:
    seller = positive_id(o["seller_id"])
    wrong = lambda c, want: present(c) & (positive_id(c) != want)
    return (
        wrong(o["avail_product"], row["k_product"]) | wrong(o["avail_sku"], row["k_sku"])
        | wrong(o["avail_seller"], seller)
    )


def _quote_columns(o: Column) -> dict[str, Column]:
    old = _positive(o["old_price"])
    description = squash(o["price_description"])
    return {
        "final_sku_price": format_brl(_money2(_positive(o["current_price"]))),
        "original_sku_price": F.when(old.isNotNull(), format_brl(_money2(old))).otherwise(""),
        "savings": listing_savings(o["savings"], o["old_price"], o["standard_price"], o["discount_rate"]),
        "discount_type": F.when(description.rlike(r"(?i)cupom|desconto"), description).otherwise(""),
        "seller_id": positive_id(o["seller_id"]),
    }


def _existing(c: Column) -> Column:
    """Number of an existing price text in the published form, or of a plain number."""
    text = F.regexp_replace(as_text(c), r"\s+", "")
    brl = text.rlike(r"^R\$(?:\d+|\d{1,3}(?:\.\d{3})+),\d{2}$")
    n = F.when(text.startswith("R$"), F.when(brl, price_number(text))).otherwise(to_number(text))
    return F.when(n > 0, n)


def _recover(rows: DataFrame, offers: DataFrame, hosts, reason, fields: list[str]) -> DataFrame:
    data = _offer_lookups(_row_identity(rows, hosts), offers)
    row = {c: F.col(c) for c in data.columns}
    o = row["match"]
    quote = _quote_columns(o)
    data = data.withColumns({f"q_{k}": v for k, v in quote.items()})
    row = {c: F.col(c) for c in data.columns}
    data = data.withColumn("price_reason", reason(row, row["match"]))
    ok = F.col("price_reason") == ""
    hit = {f: ok & blank(F.col(f)) & present(F.col(f"q_{f}")) for f in fields}
    filled = {f: F.when(hit[f], F.col(f"q_{f}")).otherwise(F.col(f)) for f in fields}
    names = F.array_compact(F.array(*[F.when(hit[f], F.lit(f)) for f in fields]))
    absent = F.array_compact(F.array(*[
        F.when(ok & blank(F.col(f)) & blank(F.col(f"q_{f}")), F.lit(f)) for f in PRICE_FIELDS
    ]))
    drop = [f"q_{k}" for k in quote] + ["k_product", "k_sku", "k_seller", "identity_error", "match"]
    return data.withColumns({**filled, "price_filled": names, "quote_absent": absent}).drop(*drop)


def recover_missing_price(rows: DataFrame, offers: DataFrame, hosts) -> DataFrame:
    """Fill the price of rows without one, from the single exact offer.

    ``price_reason`` says why nothing was filled ('' when the offer was accepted).
    """

    def reason(row: dict[str, Column], o: Column) -> Column:
        old = _positive(o["old_price"])
        existing = _existing(row["original_sku_price"])
        quote_savings, own = F.trim(row["q_savings"]), F.trim(as_text(row["savings"]))
        return (
            F.when(present(row["final_sku_price"]), "price_already_present")
            .when(row["identity_error"] != "", row["identity_error"])
            .when(row["n_match"] == 0, "no_matching_price_offer")
            .when(row["n_match"] > 1, "ambiguous_price_offers")
            .when(positive_id(o["seller_id"]) == "", "missing_offer_seller_id")
            .when(_availability_conflict(o, row), "price_availability_identity_conflict")
            .when(_positive(o["current_price"]).isNull(), "invalid_current_price")
            .when(_bad_quote(o["old_price"]) | _bad_quote(o["standard_price"]), "invalid_price_quote")
            .when(
                present(row["original_sku_price"])
                & ~F.coalesce(existing == old, F.lit(False)),
                "existing_price_quote_conflict",
            )
            .when((own != "") & (own != quote_savings), "existing_savings_quote_conflict")
            .otherwise("")
        )

    return _recover(rows, offers, hosts, reason, [*PRICE_FIELDS, "seller_id"])


def verify_price_fields(rows: DataFrame, offers: DataFrame, hosts) -> DataFrame:
    """Check and fill any blank price field; existing values are never overwritten."""

    def same_money(c: Column, quoted: Column) -> Column:
        return F.coalesce(_money2(_existing(c)) == _money2(quoted), F.lit(False))

    def same_savings(a: Column, b: Column) -> Column:
        pattern = r"(?i)^baixou\s+([0-9]+(?:[.,][0-9]+)?)\s*%$"
        left, right = F.trim(as_text(a)), F.trim(as_text(b))
        number = lambda c: to_number(F.regexp_extract(c, pattern, 1))
        return (left == right) | (
            left.rlike(pattern) & right.rlike(pattern) & (number(left) == number(right))
        )

    def reason(row: dict[str, Column], o: Column) -> Column:
        pending = blank(row["seller_id"])
        for f in PRICE_FIELDS:
            pending = pending | blank(row[f])
        current, old = _positive(o["current_price"]), _positive(o["old_price"])
        return (
            F.when(~pending, "price_fields_already_present")
            .when(row["identity_error"] != "", row["identity_error"])
            .when(row["n_product"] == 0, "price_product_identity_conflict")
            .when(row["n_sku"] == 0, "price_sku_identity_conflict")
            .when(row["n_match"] == 0, "price_seller_identity_conflict")
            .when(row["n_match"] > 1, "ambiguous_price_offers")
            .when(positive_id(o["seller_id"]) == "", "missing_offer_seller_id")
            .when(_availability_conflict(o, row), "price_availability_identity_conflict")
            .when(current.isNull(), "invalid_current_price")
            .when(_bad_quote(o["old_price"]) | _bad_quote(o["standard_price"]), "invalid_price_quote")
            .when(present(row["final_sku_price"]) & ~same_money(row["final_sku_price"], current),
                  "existing_current_price_quote_conflict")
            .when(present(row["original_sku_price"]) & ~same_money(row["original_sku_price"], old),
                  "existing_original_price_quote_conflict")
            .when(present(row["savings"]) & ~same_savings(row["savings"], row["q_savings"]),
                  "existing_savings_quote_conflict")
            .otherwise("")
        )

    out = _recover(rows, offers, hosts, reason, [*PRICE_FIELDS, "seller_id"])
    token = (
        F.when(F.col("price_reason") != "", F.concat(F.lit("price_failed:"), F.col("price_reason")))
        .when(F.size("price_filled") > 0, "price_recovered")
        .otherwise("price_verified")
    )
    return out.withColumn("parse_status", append_token(F.col("parse_status"), token))


# ---- single-field backfills ----------------------------------------------------------------

DEFAULT_SELLER = "10037"


def discount_backfill(rows: DataFrame, badges: DataFrame, default_seller: str = DEFAULT_SELLER) -> DataFrame:
    """Discount text by (SKU, seller) where the present one is blank or ambiguous.

    ``badges``: sku_id, seller_id, success, discount.  Adds ``discount_outcome``.  Badges of one
    (SKU, seller) that differ are ``ambiguous`` and change nothing; a row always comes back once.
    """
    digits = lambda c: F.when(F.trim(as_text(c)).rlike(r"^\d+$"), F.trim(as_text(c)))
    sku = F.coalesce(
        digits(F.regexp_extract(as_text(F.col("product_url")), r"/p/([^/?#]+)", 1)),
        digits(F.col("item")), digits(F.col("retailer_product_id")), F.lit(""),
    )
    seller = F.coalesce(digits(F.col("seller_id")), F.lit(default_seller))
    found = one_per_key(badges.select(
        F.col("sku_id").alias("k_sku"), F.col("seller_id").alias("k_seller"),
        F.col("success").alias("b_success"), F.trim(as_text(F.col("discount"))).alias("b_discount"),
    ), ["k_sku", "k_seller"], ["b_success", "b_discount"]).withColumnRenamed("ambiguous", "b_ambiguous")
    wants = discount_is_ambiguous(F.col("discount_type"))
    asked = rows.withColumns({"b_sku": sku, "b_seller": seller}).withColumn("b_key", spread_blank(F.when(wants, F.col("b_sku"))))
    out = asked.join(found, (F.col("b_key") == F.col("k_sku")) & (F.col("b_seller") == F.col("k_seller")), "left")
    outcome = (
        F.when(~wants, "skipped_existing")
        .when(F.col("b_sku") == "", "skipped_missing_keys")
        .when(F.coalesce("b_ambiguous", F.lit(False)), "ambiguous")
        .when(~F.coalesce("b_success", F.lit(False)), "failed")
        .when(F.col("b_discount") == "", "no_discount")
        .otherwise("updated")
    )
    done = F.col("discount_outcome") == "updated"
    return out.withColumn("discount_outcome", outcome).withColumns({
        "discount_type": F.when(done, F.col("b_discount")).otherwise(F.col("discount_type")),
        "fetch_method": F.when(done, append_token(F.col("fetch_method"), "casas_bahia_destaque_api"))
        .otherwise(F.col("fetch_method")),
        "parse_status": F.when(done, append_token(F.col("parse_status"), "discount_type_destaque_api"))
        .otherwise(F.col("parse_status")),
    }).drop("b_sku", "b_seller", "b_success", "b_discount", "b_key", "k_sku", "k_seller", "b_ambiguous")


def delivery_backfill(rows: DataFrame, freight: DataFrame) -> DataFrame:
    """Delivery and pickup by (SKU, seller) where delivery is blank.

    ``freight``: sku_id, seller_id, ok, valid, status, delivery, pickup; rows of one (SKU, seller)
    that differ are ``ambiguous`` and change nothing.
    """
    digits = lambda c: F.regexp_extract(F.trim(as_text(c)), r"^(\d+)$", 1)
    url_sku = F.regexp_extract(as_text(F.col("product_url")), r"/p/(\d+)(?:[/?#]|$)", 1)
    sku = F.when(url_sku != "", url_sku).otherwise(digits(F.col("item")))
    facts = ("ok", "valid", "status", "delivery", "pickup")
    found = one_per_key(freight.select(
        F.col("sku_id").alias("k_sku"), F.col("seller_id").alias("k_seller"), *[F.col(c).alias(f"f_{c}") for c in facts],
    ), ["k_sku", "k_seller"], [f"f_{c}" for c in facts]).withColumnRenamed("ambiguous", "f_ambiguous")
    asked = rows.withColumns({"f_sku": sku, "f_seller": digits(F.col("seller_id"))}).withColumn(
        "f_key", spread_blank(F.when(F.col("f_seller") != "", F.col("f_sku"))))
    out = asked.join(found, (F.col("f_key") == F.col("k_sku")) & (F.col("f_seller") == F.col("k_seller")), "left")
    has = present(F.col("f_delivery"))
    outcome = (
        F.when(present(F.col("delivery_availability")), "skipped_existing")
        .when((F.col("f_sku") == "") | (F.col("f_seller") == ""), "skipped_missing_keys")
        .when(F.coalesce("f_ambiguous", F.lit(False)), "ambiguous")
        .when(F.col("f_ok").isNull(), "not_fetched")
        .when(~F.col("f_ok"), F.when(has, "unavailable").otherwise("failed"))
        .when(~F.col("f_valid"), "failed")
        .when(~has, "empty")
        .otherwise("updated")
    )
    kind = F.col("delivery_outcome")
    take = kind.isin("updated", "unavailable")
    status_text = F.col("f_status").cast("string")
    token = (
        F.when(kind == "updated", "freight_cdp_ok")
        .when(kind == "empty", "freight_cdp_empty_delivery")
        .when(kind == "unavailable", F.concat(F.lit("freight_cdp_unavailable:status_"), status_text))
        .when((kind == "failed") & F.col("f_ok"), "freight_cdp_failed:invalid_json")
        .when(kind == "failed", F.concat(F.lit("freight_cdp_failed:status_"), status_text))
    )
    return out.withColumn("delivery_outcome", outcome).withColumns({
        "delivery_availability": F.when(take, F.col("f_delivery")).otherwise(F.col("delivery_availability")),
        "pick_up_availability": F.when(take & present(F.col("f_pickup")), F.col("f_pickup"))
        .otherwise(F.col("pick_up_availability")),
        "parse_status": F.when(token.isNotNull(), append_token(F.col("parse_status"), token))
        .otherwise(F.col("parse_status")),
    }).drop("f_sku", "f_seller", "f_key", "k_sku", "k_seller", "f_ambiguous", *[f"f_{c}" for c in facts])


def listing_quarantine(cards: DataFrame) -> DataFrame:
    """Contradicting ids inside one card: price and / or seller become pending.

    Cards: url, id, id_sku, sku, lojista, seller_id, quote_product, quote_sku,
    quote_seller, price_pending, seller_pending.
    """
    url_sku = positive_id(sku_from_url(F.col("url")))
    wrong_sku = lambda c: (as_text(c) != "") & (
        (positive_id(c) == "") | ((url_sku != "") & (positive_id(c) != url_sku))
    )
    sku_conflict = wrong_sku(F.col("id_sku")) | wrong_sku(F.col("sku"))
    bad_id = _malformed(F.col("id"))
    source_id = F.when(sku_conflict | bad_id, "").otherwise(positive_id(F.col("id")))
    a, b = positive_id(F.col("lojista")), positive_id(F.col("seller_id"))
    seller_bad = (
        _malformed(F.col("lojista")) | _malformed(F.col("seller_id"))
        | ((a != "") & (b != "") & (a != b))
    )
    seller = F.when(seller_bad, "").when(a != "", a).otherwise(b)
    off = lambda c, want: (as_text(c) != "") & (
        (positive_id(c) == "") | ((want != "") & (positive_id(c) != want))
    )
    quote_bad = (
        off(F.col("quote_product"), source_id) | off(F.col("quote_sku"), url_sku)
        | off(F.col("quote_seller"), seller)
    )
    price = F.col("price_pending") | bad_id | sku_conflict | quote_bad | seller_bad
    return cards.withColumns({
        "price_pending": price, "seller_pending": F.col("seller_pending") | seller_bad,
    })
