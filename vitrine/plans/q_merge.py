"""Queries that merge detail rows (orders) into target rows (order lines)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import merge as M
from vitrine.plans import inputs as I
from vitrine.plans.registry import column_query, query

K = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KS = ", ".join(K)
N = I.vc("l_linenumber")

# the key of a detail row is the order; every line of the order is a target row
_ROWS = {
    **{k: k for k in K}, "item": I.vc("l_orderkey"),
    "product_url": f"concat('https://shop.example/x/p/', {I.vc('l_orderkey')}, '/')",
    "retailer_sku_name": f"CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber = 2 THEN concat('Order ', {I.vc('l_orderkey')}) WHEN l_linenumber = 3 THEN 'cut...' ELSE 'Other' END",
    "screen_size": "CASE WHEN l_linestatus = 'O' THEN '' ELSE '50' END",
    "model_year": "CASE WHEN l_returnflag = 'R' THEN '' ELSE '2020' END",
    "final_sku_price": "CASE WHEN l_returnflag = 'A' THEN '' ELSE 'R$9,00' END",
    "sku": "CASE WHEN l_linenumber = 4 THEN '' ELSE 'OLD1' END",
    "parse_status": "CASE WHEN l_suppkey < 50 THEN 'listing' ELSE 'listing+casas_tv_sku_model_product_source' END",
    "fetch_method": "'api'", "star_rating": "'3'", "count_of_star_ratings": "''", "count_of_reviews": "'5'",
    "recommendation_intent": "''", "summarized_review_content": "CASE WHEN l_linenumber = 1 THEN 'mine' ELSE '' END",
    "detailed_review_content": "'none'",
}
_DETAIL = {
    "item": I.vc("o_orderkey"),
    "retailer_sku_name": f"CASE WHEN o_custkey % 2 = 0 THEN concat('ORDER  ', {I.vc('o_orderkey')}) ELSE 'other' END",
    "screen_size": "CASE WHEN o_totalprice < 100000 THEN '' ELSE '65' END", "has_screen_size": "o_orderpriority <> '5-LOW'",
    "model_year": "CASE WHEN o_totalprice < 200000 THEN ' ' ELSE '2024' END",
    "final_sku_price": "'R$7,00'", "sku": "CASE WHEN o_custkey % 3 = 0 THEN '' ELSE 'NEW9' END",
    "identity_conflict": "o_orderstatus = 'F'", "identity_verified": "o_orderstatus = 'O' AND o_custkey % 5 <> 0",
    "exact_model": "o_totalprice > 150000",
}
_RS, _DS = I.select_sql(_ROWS, "lineitem"), I.select_sql(_DETAIL, "orders")
_NORM = "trim(regexp_replace(lower(%s), '[^a-z0-9]+', ' ', 'g'))"
_MODE = (
    f"CASE WHEN d.identity_conflict THEN 'conflict' WHEN d.identity_verified THEN 'verified' "
    f"WHEN {_NORM % 'r.retailer_sku_name'} <> '' AND {_NORM % 'r.retailer_sku_name'} = {_NORM % 'd.retailer_sku_name'} THEN 'same_name' ELSE '' END"
)
_JOIN = f"""j AS (SELECT r.*, {_MODE} AS mode, d.retailer_sku_name AS d_name, d.screen_size AS d_screen, d.has_screen_size AS d_has, d.model_year AS d_year,
 d.final_sku_price AS d_price, d.sku AS d_sku, d.exact_model AS d_exact, d.item AS d_item FROM ({_RS}) r LEFT JOIN ({_DS}) d ON r.item = d.item)"""


def rows(spark, sf):
    return I.select(I.table(spark, sf, "lineitem"), _ROWS)


def detail(spark, sf):
    return I.select(I.table(spark, sf, "orders"), _DETAIL)


@query("detail_merge", f"""WITH {_JOIN} SELECT {KS}, mode AS identity_mode,
 CASE mode WHEN 'verified' THEN CASE WHEN d_has THEN d_screen ELSE screen_size END
  WHEN 'same_name' THEN CASE WHEN screen_size = '' AND d_screen <> '' THEN d_screen ELSE screen_size END ELSE screen_size END AS screen_size,
 CASE mode WHEN 'verified' THEN CASE WHEN trim(d_year) <> '' THEN d_year ELSE model_year END
  WHEN 'same_name' THEN CASE WHEN model_year = '' AND trim(d_year) <> '' THEN d_year ELSE model_year END ELSE model_year END AS model_year,
 CASE WHEN mode = 'verified' AND d_sku <> '' THEN d_sku ELSE sku END AS sku FROM j""")
def detail_merge(spark, sf):
    out = M.merge_detail(rows(spark, sf), detail(spark, sf), ["item"], ["screen_size", "model_year", "sku"],
                         verified_only=("sku",))
    return out.select(*K, "identity_mode", "screen_size", "model_year", "sku")


_NAMES = {
    "conflict": "event_type = 'error'", "verified": "event_type IN ('error', 'view')",
    "a": f"concat('Tv ', {I.vc('user_id')}, ' É')", "b": f"concat('TV-', {I.vc('user_id')}, CASE WHEN event_type = 'click' THEN ' e' ELSE ' x' END)",
}
column_query("identity_mode", "events", ["event_id"], _NAMES, {
    "mode": (lambda c: M.identity_mode(c["conflict"], c["verified"], c["a"], c["b"]),
             "CASE WHEN conflict THEN 'conflict' WHEN verified THEN 'verified' WHEN b LIKE '% e' THEN 'same_name' ELSE '' END")})


@query("target_field_recovery", f"""WITH {_JOIN},
f AS (SELECT *, d_item IS NOT NULL AND d_exact AS ok,
 concat_ws(',', CASE WHEN screen_size = '' AND d_screen <> '' THEN 'screen_size' END, CASE WHEN model_year = '' AND trim(d_year) <> '' THEN 'model_year' END) AS got,
 concat_ws(',', CASE WHEN screen_size = '' THEN 'screen_size' END, CASE WHEN model_year = '' THEN 'model_year' END) AS missing FROM j)
SELECT {KS}, missing AS missing_before, CASE WHEN ok THEN got ELSE '' END AS filled,
 CASE WHEN ok AND screen_size = '' THEN d_screen ELSE screen_size END AS screen_size,
 CASE WHEN ok AND model_year = '' AND trim(d_year) <> '' THEN d_year ELSE model_year END AS model_year,
 concat(parse_status, CASE WHEN NOT ok THEN '+field_failed:late' WHEN got <> '' THEN concat('+field_recovered:', got) ELSE '+field_no_target_values' END) AS parse_status,
 CASE WHEN ok AND got <> '' THEN 'api+field_source' ELSE fetch_method END AS fetch_method FROM f WHERE d_item IS NOT NULL
UNION ALL SELECT {KS}, missing, '', screen_size, model_year, parse_status, fetch_method FROM f WHERE d_item IS NULL""")
def target_field_recovery(spark, sf):
    d = detail(spark, sf).withColumns({"success": F.col("exact_model"), "error": F.lit("late")})
    out = M.fill_missing(rows(spark, sf), d, ["item"], ["screen_size", "model_year"], "field_source", "field")
    return out.select(*K, F.array_join("missing_before", ",").alias("missing_before"),
                      F.array_join("filled", ",").alias("filled"), "screen_size", "model_year", "parse_status", "fetch_method")


@query("page_detail_backfill", f"""WITH {_JOIN},
u AS (SELECT *, mode IN ('verified', 'same_name') AS ok, mode = 'verified' AND d_exact AND d_sku <> '' AND NOT contains(parse_status, 'product_source') AS proven FROM j)
SELECT {KS}, CASE WHEN ok AND (retailer_sku_name = '' OR retailer_sku_name LIKE '%...') THEN d_name ELSE retailer_sku_name END AS retailer_sku_name,
 CASE WHEN ok AND final_sku_price = '' THEN d_price ELSE final_sku_price END AS final_sku_price,
 CASE WHEN ok AND d_screen <> '' THEN d_screen ELSE screen_size END AS screen_size,
 CASE WHEN proven THEN d_sku ELSE sku END AS sku,
 CASE WHEN d_item IS NULL THEN parse_status WHEN proven THEN concat(parse_status, '+detail_casas_bahia_html+casas_tv_sku_model_pdp_html')
  WHEN ok THEN concat(parse_status, '+detail_casas_bahia_html') WHEN mode = 'conflict' THEN concat(parse_status, '+casas_html_backfill_identity_conflict')
  ELSE concat(parse_status, '+casas_html_backfill_missing_product_identity') END AS parse_status FROM u""")
def page_detail_backfill(spark, sf):
    fields = ["retailer_sku_name", "final_sku_price", "screen_size", "sku"]
    out = M.page_backfill(rows(spark, sf), detail(spark, sf), ["item"], fields, F.lit("TV"))
    return out.select(*K, *fields, "parse_status")


_BLOCKS = {
    "item": I.vc("o_custkey"), "pos": "o_orderkey",
    "block_type": "CASE WHEN o_orderpriority = '5-LOW' THEN 'Offer' ELSE 'Product' END",
    "name": "CASE o_orderstatus WHEN 'F' THEN 'other name' WHEN 'O' THEN '' ELSE concat('Customer ', cast(o_custkey AS varchar(20))) END",
    "sku": f"CASE WHEN o_totalprice > 250000 THEN {I.vc('o_custkey')} WHEN o_totalprice > 200000 THEN 'zz' ELSE '' END",
    "price": I.vc("cast(floor(o_totalprice) AS bigint)"), "rating_value": "'4.5'", "rating_count": I.vc("o_orderkey"), "review_count": "'2'",
}
_CUST = {
    "item": I.vc("c_custkey"), "product_url": f"concat('https://shop.example/x/p/', {I.vc('c_custkey')}, '/')",
    "retailer_sku_name": "CASE WHEN c_nationkey < 5 THEN '' ELSE concat('CUSTOMER  ', cast(c_custkey AS varchar(20))) END",
    "sku": "CASE WHEN c_acctbal < 3000 THEN '' ELSE 'HAVE' END", "final_sku_price": "''", "star_rating": "''",
    "count_of_star_ratings": "CASE WHEN c_nationkey > 20 THEN '7' ELSE '' END", "count_of_reviews": "''",
}


@query("jsonld_merge", f"""WITH b AS ({I.select_sql(_BLOCKS, 'orders')}), c AS ({I.select_sql(_CUST, 'customer')}),
m AS (SELECT c.item, b.pos, b.name, b.sku, b.price, b.rating_count, row_number() OVER (PARTITION BY c.item ORDER BY b.pos) AS r
 FROM c JOIN b ON b.item = c.item WHERE block_type = 'Product'
 AND NOT (c.retailer_sku_name <> '' AND b.name <> '' AND lower(b.name) <> regexp_replace(lower(c.retailer_sku_name), ' +', ' ', 'g'))
 AND NOT (b.sku <> '' AND b.sku <> c.item)
 AND ((b.name <> '') OR b.sku = c.item))
SELECT c.item, CASE WHEN c.retailer_sku_name = '' THEN coalesce(m.name, '') ELSE c.retailer_sku_name END AS retailer_sku_name,
 CASE WHEN c.sku = '' THEN coalesce(m.sku, '') ELSE c.sku END AS sku, coalesce(m.price, '') AS final_sku_price,
 CASE WHEN m.item IS NULL THEN '' ELSE '4.5' END AS star_rating,
 CASE WHEN count_of_star_ratings <> '' THEN count_of_star_ratings ELSE coalesce(m.rating_count, '') END AS count_of_star_ratings,
 CASE WHEN m.item IS NULL THEN '' ELSE '2' END AS count_of_reviews
FROM c LEFT JOIN m ON m.item = c.item AND m.r = 1""")
def jsonld_merge(spark, sf):
    c, b = I.select(I.table(spark, sf, "customer"), _CUST), I.select(I.table(spark, sf, "orders"), _BLOCKS)
    out = M.jsonld_merge(c, b, ["item"], with_review_count=True)
    return out.select("item", "retailer_sku_name", "sku", "final_sku_price", "star_rating", "count_of_star_ratings", "count_of_reviews")


_REV = {
    "item": I.vc("o_orderkey"), "success": "o_orderpriority <> '5-LOW'", "error": "CASE WHEN o_custkey % 2 = 0 THEN '' ELSE 'timeout' END",
    "failure": "CASE WHEN o_orderpriority = '5-LOW' THEN 'timeout' ELSE '' END",
    "n_reviews": "CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 2 END", "seen": "CASE WHEN o_orderstatus = 'O' THEN 9 ELSE 2 END",
    "summary": "'good'", "rating": "CASE WHEN o_totalprice < 90000 THEN '' WHEN o_totalprice < 150000 THEN '0,0' ELSE '4.50' END",
    "rating_count": I.vc("o_custkey"), "recommendation_percent": "CASE WHEN o_custkey % 2 = 0 THEN '' ELSE '93' END",
    "review_count": I.vc("o_custkey"), "comment_count": "CASE WHEN o_custkey % 3 = 0 THEN '' ELSE '11' END",
    "page_total": "CASE WHEN o_custkey % 4 = 0 THEN '' ELSE '12' END",
}
_REVS = f"""WITH r AS ({_RS}), v AS ({I.select_sql(_REV, 'orders')}),
j AS (SELECT r.*, v.success, v.error, v.failure, v.n_reviews, v.seen, v.rating, v.rating_count, v.recommendation_percent, v.comment_count, v.page_total, v.item AS v_item
 FROM r LEFT JOIN v ON r.item = v.item)"""
_RSHOW = ["summarized_review_content", "star_rating", "count_of_star_ratings", "count_of_reviews", "recommendation_intent", "fetch_method", "parse_status"]


def reviews(spark, sf):
    v = I.select(I.table(spark, sf, "orders"), _REV)
    bodies = F.when(F.col("n_reviews") > 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>"))
    return v.withColumn("reviews", bodies).drop("n_reviews")


@query("reviews_layout_c", f"""{_REVS} SELECT {KS}, CASE WHEN success AND summarized_review_content = '' THEN 'good' ELSE summarized_review_content END AS summarized_review_content,
 CASE WHEN success AND rating <> '' THEN CASE rating WHEN '0,0' THEN '0' ELSE '4.5' END ELSE star_rating END AS star_rating,
 CASE WHEN success THEN rating_count ELSE count_of_star_ratings END AS count_of_star_ratings,
 CASE WHEN success THEN rating_count ELSE count_of_reviews END AS count_of_reviews,
 CASE WHEN success AND recommendation_percent <> '' THEN concat(recommendation_percent, '% dos clientes recomendam esse produto') ELSE '' END AS recommendation_intent,
 CASE WHEN success AND n_reviews > 0 THEN 'api+review_api' ELSE 'api' END AS fetch_method,
 CASE WHEN v_item IS NULL THEN parse_status WHEN NOT success THEN concat(parse_status, '+reviews_api_failed:', CASE WHEN error = '' THEN 'unknown' ELSE error END)
  WHEN n_reviews > 0 THEN concat(parse_status, CASE WHEN seen = 9 THEN '+reviews_2/9' ELSE '+reviews_2' END) ELSE parse_status END AS parse_status FROM j""")
def reviews_layout_c(spark, sf):
    base = rows(spark, sf).withColumn("detailed_review_content", F.array("detailed_review_content"))
    return M.merge_reviews_c(base, reviews(spark, sf), ["item"], "review_api").select(*K, *_RSHOW)


@query("reviews_layout_m", f"""{_REVS} SELECT {KS}, summarized_review_content, CASE WHEN coalesce(rating, '') <> '' THEN rating ELSE star_rating END AS star_rating,
 CASE WHEN v_item IS NULL THEN count_of_star_ratings ELSE rating_count END AS count_of_star_ratings,
 CASE WHEN coalesce(comment_count, '') <> '' THEN comment_count WHEN coalesce(page_total, '') <> '' THEN page_total ELSE count_of_reviews END AS count_of_reviews,
 recommendation_intent, CASE WHEN n_reviews > 0 THEN 'api+product_rating' ELSE 'api' END AS fetch_method,
 concat(parse_status, CASE WHEN failure <> '' THEN '+reviews_graphql_failed:timeout' ELSE '' END, CASE WHEN n_reviews > 0 THEN '+reviews_2' ELSE '' END) AS parse_status FROM j""")
def reviews_layout_m(spark, sf):
    base = rows(spark, sf).withColumn("detailed_review_content", F.array("detailed_review_content"))
    return M.merge_reviews_m(base, reviews(spark, sf), ["item"], "product_rating").select(*K, *_RSHOW)


# ---- dataset comparison and trace coverage ------------------------------------------------------

_TARGET = {"run": "o_orderpriority", "position": "o_orderkey", "item": I.vc("o_custkey"), "product_url": "o_orderstatus"}
_CAND = {**_TARGET, "item": "CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 400000 THEN 'zz' ELSE cast(o_custkey AS varchar(40)) END"}
_CFILTER = "NOT (o_orderpriority = '2-HIGH' AND o_totalprice > 450000) AND o_orderpriority <> '3-MEDIUM'"


@query("positional_comparison", f"""WITH t AS ({I.select_sql(_TARGET, 'orders')}), c AS ({I.select_sql(_CAND, 'orders')} WHERE {_CFILTER}),
j AS (SELECT coalesce(t.run, c.run) AS run, coalesce(t.position, c.position) AS position, t.item AS a, c.item AS b, t.product_url AS u, c.product_url AS w
 FROM t FULL JOIN c ON t.run = c.run AND t.position = c.position),
g AS (SELECT run, count(a) AS expected_rows, count(b) AS actual_rows, min(CASE WHEN a IS DISTINCT FROM b OR u IS DISTINCT FROM w THEN position END) AS first_mismatch FROM j GROUP BY run)
SELECT *, CASE WHEN actual_rows = 0 THEN 'empty' WHEN actual_rows <> expected_rows THEN 'row_count' WHEN first_mismatch IS NOT NULL THEN 'identity' ELSE '' END AS error FROM g""")
def positional_comparison(spark, sf):
    orders = I.table(spark, sf, "orders")
    return M.compare_positions(I.select(orders, _TARGET), I.select(orders.filter(_CFILTER), _CAND), ["run"], ["item", "product_url"])


_TRACE = {"row_index": f"CASE WHEN l_linenumber = 7 AND l_suppkey < 3 THEN 'x' ELSE {I.vc('l_orderkey')} END",
          "item": f"CASE WHEN l_linenumber = 6 AND l_suppkey < 5 THEN 'zz' ELSE {I.vc('l_orderkey')} END",
          "product_url": "CASE WHEN l_linenumber = 5 AND l_suppkey < 5 THEN 'u2' ELSE 'u' END"}
_EXPECT = {"row_index": "o_orderkey", "item": I.vc("o_orderkey"), "product_url": "'u'"}


@query("trace_coverage", f"""WITH t AS (SELECT *, try_cast(row_index AS bigint) AS idx FROM ({I.select_sql(_TRACE, 'lineitem')})), e AS ({I.select_sql(_EXPECT, 'orders')})
SELECT idx AS index, CASE WHEN idx IS NULL THEN 'row_index_invalid' ELSE 'row_index_out_of_slice' END AS violation FROM t WHERE idx IS NULL OR idx > 900
UNION ALL SELECT DISTINCT t.idx, CASE WHEN t.item <> e.item THEN 'item_identity' ELSE 'product_url_identity' END FROM t JOIN e ON e.row_index = t.idx WHERE t.idx <= 900 AND (t.item <> e.item OR t.product_url <> e.product_url)
UNION ALL SELECT e.row_index, 'coverage_missing' FROM e WHERE e.row_index BETWEEN 0 AND 900 AND e.row_index NOT IN (SELECT idx FROM t WHERE idx IS NOT NULL)""")
def trace_coverage(spark, sf):
    return M.trace_coverage(I.select(I.table(spark, sf, "lineitem"), _TRACE), I.select(I.table(spark, sf, "orders"), _EXPECT), [], 0, 900)
