"""Queries of the field audit; the audited rows are derived from order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import audit as A
from vitrine.plans import inputs as I
from vitrine.plans.registry import column_query, query

AUDITED = {
    "run": "l_linestatus",
    "position": "((l_orderkey * 10 + l_linenumber) * 100 + cast(l_quantity AS bigint)) * 10000000 + l_partkey",
    "item": f"CASE WHEN l_linenumber = 7 THEN '' ELSE {I.vc('l_orderkey')} END",
    "product_url": f"concat('https://shop.example/x/p/', {I.vc('l_orderkey')}, '/?seller_id=', {I.vc('l_suppkey')})",
    "retailer_sku_name": "l_returnflag", "sku": "CASE WHEN l_suppkey = 3 THEN ' ' ELSE 'S1' END",
    "delivery_availability": "CASE WHEN l_suppkey < 2 THEN '' ELSE 'Receive today' END",
    "sku_status": "CASE WHEN l_suppkey = 4 THEN 'Patrocinado' WHEN l_suppkey < 10 THEN 'Sponsored' ELSE '' END",
    "original_sku_price": "CASE WHEN l_suppkey = 5 THEN '10,00' ELSE 'R$1.200,00' END",
    "final_sku_price": "CASE WHEN l_suppkey = 6 THEN 'R$1200,00' ELSE '' END",
    "star_rating": "CASE WHEN l_suppkey = 7 THEN '5,5' WHEN l_suppkey = 8 THEN 'bom' ELSE '4.5' END",
    "count_of_star_ratings": I.vc("l_suppkey"), "count_of_reviews": I.vc("l_linenumber"),
    "retailer_sku_name_similar": "''",
    "detailed_review_content": "CASE WHEN l_suppkey = 9 THEN 'review1 - a review2 - b' WHEN l_suppkey = 10 THEN 'review1 - a' ELSE '' END",
    "estimated_annual_electricity_use": f"CASE l_linenumber WHEN 1 THEN concat({I.vc('l_suppkey')}, ' kWh') WHEN 2 THEN {I.vc('l_suppkey')} WHEN 3 THEN 'bivolt' ELSE '' END",
    "fetch_method": "CASE WHEN l_returnflag = 'R' THEN 'api' ELSE 'html+api' END",
    "parse_status": "CASE WHEN l_linenumber < 3 THEN 'listing+detail_ok' ELSE 'listing' END",
}
_ROWS = f"a AS ({I.select_sql(AUDITED, 'lineitem')})"


def audited(spark, sf):
    return I.select(I.table(spark, sf, "lineitem"), AUDITED)


COLUMNS = ["item", "product_url", "sku", "delivery_availability", "star_rating", "count_of_star_ratings"]


@query("field_stats", f"WITH {_ROWS} " + " UNION ALL ".join(
    f"SELECT run, '{c}' AS \"column\", count(*) AS nonempty, count(DISTINCT trim({c})) AS unique_values FROM a WHERE trim({c}) <> '' GROUP BY run"
    for c in COLUMNS))
def field_stats(spark, sf):
    return A.field_stats(audited(spark, sf), ["run"], COLUMNS)


_ENERGY = ("CASE WHEN estimated_annual_electricity_use = '' THEN 'blank' WHEN contains(estimated_annual_electricity_use, 'kWh') THEN 'kWh' "
           "WHEN estimated_annual_electricity_use = 'bivolt' THEN 'other' ELSE 'number_only' END")


@query("class_counts", f"""WITH {_ROWS}, u AS (SELECT run, 'energy_class' AS kind, {_ENERGY} AS value FROM a
 UNION ALL SELECT run, 'fetch_method', fetch_method FROM a UNION ALL SELECT run, 'parse_status', parse_status FROM a)
SELECT run, kind, value, count(*) AS n FROM u GROUP BY run, kind, value""")
def class_counts(spark, sf):
    return A.class_counts(audited(spark, sf), ["run"])


@query("token_counts", f"""WITH {_ROWS}, t AS (SELECT run, unnest(string_split(parse_status, '+')) AS token FROM a)
SELECT run, token, count(*) AS n FROM t GROUP BY run, token""")
def token_counts(spark, sf):
    return A.token_counts(audited(spark, sf), ["run"], "parse_status")


_CHECKS = [
    ("delivery_availability_blank", "critical", "delivery_availability = ''", "delivery_availability"),
    ("invalid_sku_status", "high", "sku_status = 'Patrocinado'", "sku_status"),
    ("invalid_price_format", "high", "NOT regexp_full_match(original_sku_price, 'R\\$\\d{1,3}(\\.\\d{3})*,\\d{2}') OR (final_sku_price <> '' AND NOT regexp_full_match(final_sku_price, 'R\\$\\d{1,3}(\\.\\d{3})*,\\d{2}'))", "original_sku_price,final_sku_price"),
    ("review_comments_gt_star_ratings", "high", "cast(count_of_reviews AS int) > cast(count_of_star_ratings AS int)", "count_of_star_ratings,count_of_reviews"),
    ("invalid_star_rating", "medium", "star_rating IN ('5,5', 'bom')", "star_rating"),
    ("empty_sku", "medium", "trim(sku) = ''", "sku"),
    ("review_missing_delimiter", "low", "contains(detailed_review_content, 'review2 -')", "detailed_review_content"),
    ("energy_value_other", "low", f"{_ENERGY} = 'other'", "estimated_annual_electricity_use"),
    ("energy_unit_missing", "info", f"{_ENERGY} = 'number_only'", "estimated_annual_electricity_use"),
    ("single_review_body_but_total_count_gt_one", "info", "starts_with(detailed_review_content, 'review1 -') AND cast(count_of_reviews AS int) > 1", "detailed_review_content"),
]
_HITS = "hits AS (" + " UNION ALL ".join(
    f"SELECT run, position, item, product_url, sku, '{n}' AS anomaly, '{s}' AS severity, '{f}' AS field, "
    + "concat(" + ", ' | ', ".join(f"'{c}=', {c}" for c in f.split(",")) + f") AS value FROM a WHERE {p}"
    for n, s, p, f in _CHECKS) + ")"
_SUS = ["run", "position", "item", "sku", "anomaly", "severity", "field", "value"]


@query("suspicious_rows", f"WITH {_ROWS}, {_HITS} SELECT {', '.join(_SUS)} FROM hits")
def suspicious_rows(spark, sf):
    return A.suspicious_rows(audited(spark, sf), ["run"]).select(*_SUS)


@query("anomaly_summary", f"""WITH {_ROWS}, {_HITS},
c AS (SELECT run, anomaly, severity, count(*) AS n FROM hits GROUP BY run, anomaly, severity)
SELECT run, anomaly, hits.severity, c.n, position, row_number() OVER (PARTITION BY run, anomaly ORDER BY position) AS sample_rank FROM hits JOIN c USING (run, anomaly)""")
def anomaly_summary(spark, sf):
    return A.anomaly_summary(A.suspicious_rows(audited(spark, sf), ["run"]), ["run"])


_ENRICHED = {
    "run": "CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'O' END", "position": "o_orderkey",
    "item": f"CASE WHEN o_orderpriority = '5-LOW' THEN concat('i', {I.vc('o_orderkey')}) ELSE {I.vc('o_custkey')} END",
    "product_url": f"CASE WHEN o_orderpriority = '1-URGENT' THEN concat('https://shop.example/x/p/', {I.vc('o_orderkey')}, '/?seller_id=4') ELSE '' END",
    "parse_status": "concat('p', cast(o_orderkey AS varchar(20)))", "fetch_method": "o_orderpriority",
}
_EITEM = "CASE WHEN product_url = '' THEN '' ELSE split_part(split_part(product_url, '/p/', 2), '/', 1) END"


@query("suspicious_provenance", f"""WITH {_ROWS}, {_HITS}, e AS ({I.select_sql(_ENRICHED, 'orders')}),
ek AS (SELECT run, item AS k, position, parse_status, fetch_method FROM e UNION ALL SELECT run, {_EITEM}, position, parse_status, fetch_method FROM e
 UNION ALL SELECT run, product_url, position, parse_status, fetch_method FROM e),
ef AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run, k ORDER BY position) AS r FROM ek WHERE k <> '') WHERE r = 1),
h AS (SELECT *, {_EITEM} AS url_item FROM hits)
SELECT h.run, h.position, h.anomaly, coalesce(a1.parse_status, a2.parse_status, a3.parse_status, '') AS parse_status,
 coalesce(a1.fetch_method, a2.fetch_method, a3.fetch_method, '') AS fetch_method
FROM h LEFT JOIN ef a1 ON a1.run = h.run AND a1.k = h.item AND h.item <> '' LEFT JOIN ef a2 ON a2.run = h.run AND a2.k = h.url_item
LEFT JOIN ef a3 ON a3.run = h.run AND a3.k = h.product_url""")
def suspicious_provenance(spark, sf):
    hits = A.suspicious_rows(audited(spark, sf), ["run"])
    out = A.with_provenance(hits, I.select(I.table(spark, sf, "orders"), _ENRICHED), ["run"])
    return out.select("run", "position", "anomaly", "parse_status", "fetch_method")


column_query("schema_anomalies", "documents", ["doc_id"], {
    "k": "doc_id % 3",
    "header": "CASE doc_id % 3 WHEN 0 THEN 'item,sku,country' WHEN 1 THEN concat('item,sku,', lang) ELSE concat(source, ',sku,item,country') END", "lang": "lang", "source": "source"}, {
    "problems": (lambda c: F.array_join(F.transform(
        A.schema_anomalies(F.split(c["header"], ","), ["item", "sku", "country"]),
        lambda e: F.concat(e["anomaly"], F.lit(":"), e["severity"], F.lit(":"), F.array_join(e["columns"], ","))), ";"),
        "CASE k WHEN 0 THEN '' WHEN 1 THEN concat('missing_columns:critical:country;extra_columns:low:', lang) ELSE concat('extra_columns:low:', source) END")})
