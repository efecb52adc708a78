"""Queries over offers, product cards and rows that miss a price."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import offers as O
from vitrine.plans import inputs as I
from vitrine.plans.registry import query

_OFFERS = I.select_sql(I.OFFERS, "lineitem")
_QUOTE = ", ".join(O.QUOTE)
_MAP = f"""o AS ({_OFFERS}),
good AS (SELECT product_id, sku_id, CASE WHEN seller_id <> '' THEN seller_id ELSE avail_seller END AS seller_id, {_QUOTE}
  FROM o WHERE seller_id <> 'x1' AND (avail_sku = sku_id)),
omap AS (SELECT product_id, sku_id, seller_id, min(old_price) AS old_price, min(current_price) AS current_price
  FROM good GROUP BY product_id, sku_id, seller_id HAVING count(DISTINCT concat_ws('#', {_QUOTE})) = 1)"""
_CARDS = f"c AS ({I.select_sql(I.CARDS, 'part')})"


@query("offer_map", f"WITH {_MAP} SELECT product_id, sku_id, seller_id, old_price, current_price FROM omap")
def offer_map(spark, sf):
    out = O.offer_map(I.offers(spark, sf))
    return out.select("product_id", "sku_id", "seller_id", "old_price", "current_price")


@query("offer_exact_match", f"""WITH {_MAP}, {_CARDS},
m AS (SELECT c.card, count(o.sku_id) AS n, min(o.current_price) AS price FROM c LEFT JOIN omap o
  ON c.product_id = o.product_id AND c.sku_id = o.sku_id AND (c.seller_id = '' OR c.seller_id = o.seller_id) GROUP BY c.card)
SELECT card, CASE WHEN n = 0 THEN 'price_or_seller_identity_incomplete' WHEN n > 1 THEN 'ambiguous_listing_seller'
  WHEN price = '' THEN 'missing_listing_price' ELSE '' END AS offer_status,
  CASE WHEN n = 1 AND price <> '' THEN price END AS current_price FROM m""")
def offer_exact_match(spark, sf):
    out = O.exact_offers(I.cards(spark, sf), O.offer_map(I.offers(spark, sf)))
    return out.select("card", "offer_status", F.col("offer.current_price").alias("current_price"))


@query("optional_price_attach", f"""WITH {_MAP}, {_CARDS},
m AS (SELECT c.card, count(o.sku_id) AS n, min(o.current_price) AS price, min(o.seller_id) AS o_seller FROM c LEFT JOIN omap o
  ON c.sku_id = o.sku_id AND (c.product_id = '' OR o.product_id = '' OR c.product_id = o.product_id)
  AND (c.seller_id = '' OR o.seller_id = '' OR c.seller_id = o.seller_id) GROUP BY c.card),
j AS (SELECT c.*, n, CASE WHEN n = 1 THEN price END AS price, CASE WHEN n = 1 THEN nullif(o_seller, '') END AS o_seller FROM c JOIN m USING (card)),
k AS (SELECT card, n, quarantined, CASE WHEN quarantined THEN NULL WHEN n = 0 THEN nullif(own_price, '') ELSE nullif(price, '') END AS price,
  CASE WHEN quarantined THEN NULL ELSE coalesce(o_seller, nullif(seller_id, '')) END AS seller_id FROM j)
SELECT card, n AS n_offers, price, seller_id, CASE WHEN price IS NULL THEN 1 ELSE 0 END AS price_pending,
 CASE WHEN seller_id IS NULL THEN 1 ELSE 0 END AS seller_pending FROM k""")
def optional_price_attach(spark, sf):
    out = O.optional_offers(I.cards(spark, sf), O.offer_map(I.offers(spark, sf)), ["card"])
    return out.select("card", "n_offers", "price", "seller_id",
                      F.col("price_pending").cast("int").alias("price_pending"),
                      F.col("seller_pending").cast("int").alias("seller_pending"))


_LAST = "{" + ", ".join(f"'{c}': {c}" for c in (
    "pos", "product_id", "sku_id", "seller_id", "old_price", "current_price", "standard_price", "discount_rate", "savings", "price_description",
    "avail_product", "avail_sku", "avail_seller")) + "}"


@query("last_price_wins", f"""WITH o AS ({_OFFERS}), {_CARDS},
keyed AS (SELECT product_id AS k, * FROM o WHERE product_id <> '' UNION ALL SELECT sku_id AS k, * FROM o WHERE sku_id <> product_id),
lst AS (SELECT k, o.seller_id AS seller_id, o.current_price AS current_price FROM (SELECT k, max({_LAST}) AS o FROM keyed GROUP BY k))
SELECT c.card, coalesce(a.current_price, b.current_price) AS current_price,
 CASE WHEN c.seller_id <> '' THEN c.seller_id ELSE coalesce(CASE WHEN a.k IS NOT NULL THEN a.seller_id ELSE b.seller_id END, '') END AS seller_id
FROM c LEFT JOIN lst a ON c.product_id = a.k LEFT JOIN lst b ON c.sku_id = b.k""")
def last_price_wins(spark, sf):
    out = O.last_price_wins(I.cards(spark, sf), I.offers(spark, sf))
    return out.select("card", F.col("offer.current_price").alias("current_price"), "seller_id")


_COVER = f"""o AS ({_OFFERS}), {_CARDS},
ids AS (SELECT DISTINCT product_id, sku_id, seller_id FROM o WHERE product_id <> '' AND sku_id <> '' AND seller_id NOT IN ('', 'x1')),
s AS (SELECT c.card, c.product_id, c.sku_id, c.seller_id,
 count(CASE WHEN i.product_id = c.product_id AND i.sku_id = c.sku_id THEN 1 END) AS n_pair,
 count(CASE WHEN i.product_id = c.product_id AND i.sku_id = c.sku_id AND (c.seller_id = '' OR i.seller_id = c.seller_id) THEN 1 END) AS n_exact,
 count(i.sku_id) AS n_any
 FROM c LEFT JOIN ids i ON i.product_id = c.product_id OR i.sku_id = c.sku_id GROUP BY c.card, c.product_id, c.sku_id, c.seller_id),
cov AS (SELECT card, product_id, sku_id, seller_id, CASE WHEN n_exact = 1 THEN 'matched' WHEN n_exact > 1 THEN 'ambiguous' ELSE 'missing' END AS coverage,
 CASE WHEN n_exact = 0 AND seller_id <> '' AND n_pair > 0 THEN 1 ELSE 0 END AS seller_mismatch,
 CASE WHEN n_exact = 0 THEN n_any ELSE 0 END AS related_offers FROM s)"""


@query("price_coverage", f"WITH {_COVER} SELECT * FROM cov")
def price_coverage(spark, sf):
    out = O.price_coverage(I.cards(spark, sf), I.offers(spark, sf), ["card"])
    return out.withColumn("seller_mismatch", F.col("seller_mismatch").cast("int"))


@query("price_coverage_summary", f"""WITH {_COVER} SELECT count(*) AS source_products,
count(CASE WHEN coverage = 'matched' THEN 1 END) AS matched, count(CASE WHEN coverage = 'missing' THEN 1 END) AS missing,
count(CASE WHEN coverage = 'ambiguous' THEN 1 END) AS ambiguous, cast(sum(seller_mismatch) AS bigint) AS seller_mismatches,
count(CASE WHEN related_offers > 0 THEN 1 END) AS with_related FROM cov""")
def price_coverage_summary(spark, sf):
    return O.coverage_summary(O.price_coverage(I.cards(spark, sf), I.offers(spark, sf), ["card"]))


_BRL = "replace(concat('R$', %s), '.', ',')"
_RECOVER = f"""o0 AS ({_OFFERS}), o AS (SELECT *, CASE WHEN seller_id = 'x1' THEN '' ELSE seller_id END AS sid FROM o0),
r AS ({I.select_sql(I.PRICE_ROWS, 'part')}),
i AS (SELECT *, CASE WHEN contains(product_url, '/p/') THEN split_part(product_url, '/p/', 2) ELSE '' END AS k_sku,
 CASE WHEN NOT starts_with(product_url, 'https') THEN 'invalid_product_url' WHEN retailer_product_id = '' THEN 'missing_product_id'
 WHEN seller_id = 'zz' THEN 'invalid_seller_id' ELSE '' END AS id_error FROM r),
np AS (SELECT product_id, count(*) AS n_product FROM o GROUP BY product_id),
ns AS (SELECT product_id, sku_id, count(*) AS n_sku FROM o GROUP BY product_id, sku_id),
m AS (SELECT i.card, count(o.sku_id) AS n_match, min(o.sid) AS q_seller, min(o.old_price) AS old_price, min(o.current_price) AS current_price,
 min(o.avail_sku) AS avail_sku, min(o.price_description) AS q_discount, min(o.avail_seller) AS avail_seller
 FROM i LEFT JOIN o ON o.product_id = i.retailer_product_id AND o.sku_id = i.k_sku
 AND (i.seller_id = '' OR i.seller_id = 'zz' OR o.sid = i.seller_id) GROUP BY i.card),
q AS (SELECT i.*, coalesce(n_product, 0) AS n_product, coalesce(n_sku, 0) AS n_sku, n_match, q_seller, old_price, current_price, avail_sku, avail_seller, q_discount,
 {_BRL % 'current_price'} AS q_final, CASE WHEN old_price = '' THEN '' ELSE {_BRL % 'old_price'} END AS q_original,
 CASE WHEN old_price = '' THEN '' ELSE concat('Baixou ', cast(round_even(2500.0 / try_cast(old_price AS double), 0) AS bigint), '%') END AS q_savings
 FROM i JOIN m USING (card) LEFT JOIN np ON np.product_id = i.retailer_product_id LEFT JOIN ns ON ns.product_id = i.retailer_product_id AND ns.sku_id = i.k_sku)"""
_OUT = """SELECT card, reason AS price_reason,
 CASE WHEN reason = '' AND final_sku_price = '' THEN q_final ELSE final_sku_price END AS final_sku_price,
 CASE WHEN reason = '' AND original_sku_price = '' THEN q_original ELSE original_sku_price END AS original_sku_price,
 CASE WHEN reason = '' AND savings = '' THEN q_savings ELSE savings END AS savings,
 CASE WHEN reason = '' AND discount_type = '' THEN q_discount ELSE discount_type END AS discount_type,
 CASE WHEN reason = '' AND seller_id = '' THEN q_seller ELSE seller_id END AS seller_id"""
_SHOWN = ["card", "price_reason", "final_sku_price", "original_sku_price", "savings", "discount_type", "seller_id"]
HOSTS = ["shop.example"]


@query("recover_missing_price", f"""WITH {_RECOVER},
x AS (SELECT *, CASE WHEN final_sku_price <> '' THEN 'price_already_present' WHEN id_error <> '' THEN id_error
 WHEN n_match = 0 THEN 'no_matching_price_offer' WHEN n_match > 1 THEN 'ambiguous_price_offers' WHEN q_seller = '' THEN 'missing_offer_seller_id'
 WHEN avail_sku <> k_sku OR (avail_seller <> '' AND avail_seller <> q_seller) THEN 'price_availability_identity_conflict'
 WHEN current_price = '' THEN 'invalid_current_price'
 WHEN original_sku_price <> '' AND original_sku_price <> q_original THEN 'existing_price_quote_conflict'
 WHEN savings <> '' AND savings <> q_savings THEN 'existing_savings_quote_conflict' ELSE '' END AS reason FROM q)
{_OUT} FROM x""")
def recover_missing_price(spark, sf):
    return O.recover_missing_price(I.price_rows(spark, sf), I.offers(spark, sf), HOSTS).select(*_SHOWN)


@query("verify_price_fields", f"""WITH {_RECOVER},
x AS (SELECT *, CASE WHEN id_error <> '' THEN id_error WHEN n_product = 0 THEN 'price_product_identity_conflict'
 WHEN n_sku = 0 THEN 'price_sku_identity_conflict' WHEN n_match = 0 THEN 'price_seller_identity_conflict'
 WHEN n_match > 1 THEN 'ambiguous_price_offers' WHEN q_seller = '' THEN 'missing_offer_seller_id'
 WHEN avail_sku <> k_sku OR (avail_seller <> '' AND avail_seller <> q_seller) THEN 'price_availability_identity_conflict'
 WHEN current_price = '' THEN 'invalid_current_price'
 WHEN final_sku_price <> '' AND final_sku_price <> q_final THEN 'existing_current_price_quote_conflict'
 WHEN original_sku_price <> '' AND original_sku_price <> q_original THEN 'existing_original_price_quote_conflict'
 WHEN savings <> '' AND savings <> q_savings THEN 'existing_savings_quote_conflict' ELSE '' END AS reason FROM q)
{_OUT}, CASE WHEN reason <> '' THEN concat('listing+price_failed:', reason)
 WHEN final_sku_price = '' OR (original_sku_price = '' AND q_original <> '') OR (savings = '' AND q_savings <> '')
  OR q_discount <> '' OR seller_id = '' THEN 'listing+price_recovered' ELSE 'listing+price_verified' END AS parse_status FROM x""")
def verify_price_fields(spark, sf):
    out = O.verify_price_fields(I.price_rows(spark, sf), I.offers(spark, sf), HOSTS)
    return out.select(*_SHOWN, "parse_status")


# ---- single-field backfills: rows from lineitem, answers from orders ------------------------------

_DROWS = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_suppkey": "l_suppkey", "l_partkey": "l_partkey",
    "product_url": f"CASE WHEN l_linenumber = 7 THEN '' ELSE concat('https://shop.example/a/p/', {I.vc('l_orderkey')}, '?x=1') END",
    "item": f"CASE WHEN l_linenumber = 7 AND l_suppkey < 50 THEN 'n/a' ELSE {I.vc('l_orderkey')} END",
    "retailer_product_id": "'x'",
    "seller_id": "CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber = 2 THEN '2' ELSE '1' END",
    "discount_type": "CASE l_linenumber WHEN 3 THEN 'use o cupom desconto 5%' WHEN 4 THEN '5% off' ELSE '' END",
    "delivery_availability": "CASE WHEN l_linenumber = 3 THEN 'Receba' ELSE ' ' END",
    "pick_up_availability": "''", "fetch_method": "'api'", "parse_status": "'ok'",
}
_BADGES = {
    "sku_id": I.vc("o_orderkey"), "seller_id": "CASE WHEN o_orderstatus = 'F' THEN '10037' ELSE '1' END",
    "success": "o_orderpriority <> '5-LOW'",
    "discount": "CASE WHEN o_totalprice < 100000 THEN '' ELSE o_orderpriority END",
}
_DSQL = f"WITH r AS ({I.select_sql(_DROWS, 'lineitem')}), b AS ({I.select_sql(_BADGES, 'orders')})"
_DKEY = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]
# every fifth answer comes twice, and every tenth with another value
_TWICE = "WHEN cast({}.sku_id AS bigint) % 10 = 0 THEN 'ambiguous'"


def _answers(spark, sf, columns: dict, changed: str):
    once = I.select(I.table(spark, sf, "orders"), columns)
    again = once.filter("cast(sku_id AS bigint) % 5 = 0").withColumn(
        changed, F.expr(f"CASE WHEN cast(sku_id AS bigint) % 10 = 0 THEN 'other' ELSE {changed} END"))
    return once.unionByName(again)


@query("discount_backfill", f"""{_DSQL},
k AS (SELECT *, CASE WHEN product_url <> '' OR item <> 'n/a' THEN cast(l_orderkey AS varchar) ELSE '' END AS sku,
 CASE WHEN seller_id = '' THEN '10037' ELSE seller_id END AS seller FROM r),
j AS (SELECT k.*, b.success, b.discount, CASE WHEN l_linenumber = 3 THEN 'skipped_existing' WHEN sku = '' THEN 'skipped_missing_keys'
 {_TWICE.format('b')} WHEN b.success IS NULL OR NOT b.success THEN 'failed' WHEN b.discount = '' THEN 'no_discount' ELSE 'updated' END AS outcome
 FROM k LEFT JOIN b ON b.sku_id = k.sku AND b.seller_id = k.seller)
SELECT {', '.join(_DKEY)}, outcome AS discount_outcome, CASE WHEN outcome = 'updated' THEN discount ELSE discount_type END AS discount_type,
 CASE WHEN outcome = 'updated' THEN 'api+casas_bahia_destaque_api' ELSE fetch_method END AS fetch_method FROM j""")
def discount_backfill(spark, sf):
    rows = I.select(I.table(spark, sf, "lineitem"), _DROWS)
    out = O.discount_backfill(rows, _answers(spark, sf, _BADGES, "discount"))
    return out.select(*_DKEY, "discount_outcome", "discount_type", "fetch_method")


@query("discount_backfill_outcomes", f"""{_DSQL},
k AS (SELECT *, CASE WHEN product_url <> '' OR item <> 'n/a' THEN cast(l_orderkey AS varchar) ELSE '' END AS sku,
 CASE WHEN seller_id = '' THEN '10037' ELSE seller_id END AS seller FROM r)
SELECT CASE WHEN l_linenumber = 3 THEN 'skipped_existing' WHEN sku = '' THEN 'skipped_missing_keys'
 {_TWICE.format('b')} WHEN b.success IS NULL OR NOT b.success THEN 'failed' WHEN b.discount = '' THEN 'no_discount' ELSE 'updated' END AS discount_outcome, count(*) AS n
 FROM k LEFT JOIN b ON b.sku_id = k.sku AND b.seller_id = k.seller GROUP BY 1""")
def discount_backfill_outcomes(spark, sf):
    rows = I.select(I.table(spark, sf, "lineitem"), _DROWS)
    out = O.discount_backfill(rows, _answers(spark, sf, _BADGES, "discount"))
    return out.groupBy("discount_outcome").agg(F.count(F.lit(1)).alias("n"))


_FREIGHT = {
    "sku_id": I.vc("o_orderkey"), "seller_id": "'1'", "ok": "o_orderpriority <> '5-LOW'", "valid": "o_orderpriority <> '1-URGENT'",
    "status": "CASE WHEN o_orderpriority = '5-LOW' THEN 500 ELSE 200 END",
    "delivery": "CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'Receba amanha' END", "pickup": "'Retire'",
}


@query("delivery_backfill", f"""WITH r AS ({I.select_sql(_DROWS, 'lineitem')}), f AS ({I.select_sql(_FREIGHT, 'orders')}),
j AS (SELECT r.*, f.ok, f.valid, f.status, f.delivery, f.pickup,
 CASE WHEN l_linenumber = 3 THEN 'skipped_existing' WHEN (product_url = '' AND item = 'n/a') OR r.seller_id = '' THEN 'skipped_missing_keys'
 {_TWICE.format('f')} WHEN f.ok IS NULL THEN 'not_fetched' WHEN NOT f.ok THEN CASE WHEN delivery <> '' THEN 'unavailable' ELSE 'failed' END
 WHEN NOT f.valid THEN 'failed' WHEN delivery = '' THEN 'empty' ELSE 'updated' END AS outcome
 FROM r LEFT JOIN f ON f.sku_id = cast(r.l_orderkey AS varchar) AND f.seller_id = r.seller_id AND NOT (product_url = '' AND item = 'n/a'))
SELECT {', '.join(_DKEY)}, outcome AS delivery_outcome,
 CASE WHEN outcome IN ('updated', 'unavailable') THEN delivery ELSE delivery_availability END AS delivery_availability,
 CASE WHEN outcome IN ('updated', 'unavailable') THEN pickup ELSE pick_up_availability END AS pick_up_availability,
 CASE outcome WHEN 'updated' THEN 'ok+freight_cdp_ok' WHEN 'empty' THEN 'ok+freight_cdp_empty_delivery'
  WHEN 'unavailable' THEN concat('ok+freight_cdp_unavailable:status_', status)
  WHEN 'failed' THEN CASE WHEN ok THEN 'ok+freight_cdp_failed:invalid_json' ELSE concat('ok+freight_cdp_failed:status_', status) END ELSE 'ok' END AS parse_status FROM j""")
def delivery_backfill(spark, sf):
    rows = I.select(I.table(spark, sf, "lineitem"), _DROWS)
    out = O.delivery_backfill(rows, _answers(spark, sf, _FREIGHT, "pickup"))
    return out.select(*_DKEY, "delivery_outcome", "delivery_availability", "pick_up_availability", "parse_status")


_QCARDS = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_suppkey": "l_suppkey", "l_partkey": "l_partkey",
    "url": f"concat('https://shop.example/p/', {I.vc('l_partkey + 1')})",
    "id": "CASE WHEN l_linenumber = 1 THEN 'bad' ELSE '5' END",
    "id_sku": f"CASE WHEN l_linenumber = 2 THEN '1' ELSE {I.vc('l_partkey + 1')} END", "sku": "''",
    "lojista": "CASE WHEN l_linenumber = 3 THEN 'x' ELSE '3' END", "seller_id": "CASE WHEN l_linenumber = 4 THEN '4' ELSE '03' END",
    "quote_product": "CASE WHEN l_linenumber = 5 THEN '6' ELSE '5' END", "quote_sku": "''",
    "quote_seller": "CASE WHEN l_linenumber = 6 THEN '9' ELSE '' END",
    "price_pending": "l_suppkey = 1", "seller_pending": "l_suppkey = 2",
}


@query("listing_quarantine", f"""WITH c AS ({I.select_sql(_QCARDS, 'lineitem')})
SELECT {', '.join(_DKEY)}, CASE WHEN price_pending OR id = 'bad' OR id_sku <> cast(l_partkey + 1 AS varchar)
 OR lojista = 'x' OR seller_id = '4' OR quote_product = '6' OR quote_seller = '9' THEN 1 ELSE 0 END AS price_pending,
 CASE WHEN seller_pending OR lojista = 'x' OR seller_id = '4' THEN 1 ELSE 0 END AS seller_pending FROM c""")
def listing_quarantine(spark, sf):
    out = O.listing_quarantine(I.select(I.table(spark, sf, "lineitem"), _QCARDS))
    return out.select(*_DKEY, F.col("price_pending").cast("int").alias("price_pending"),
                      F.col("seller_pending").cast("int").alias("seller_pending"))
