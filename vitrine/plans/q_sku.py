"""Queries of model tokens, SKU resolution, detail rows and the published projection."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import models as D
from vitrine.functions import variants as V
from vitrine.operators import attributes as A
from vitrine.operators import sku as S
from vitrine.plans import final as FN
from vitrine.plans import inputs as I
from vitrine.plans.registry import column_query, query
from vitrine.sources.snapshot import SNAPSHOT_COLUMNS, final_columns

KEY = ["p_partkey"]
N = I.vc("1000 + p_partkey")
VOLT = "CASE p_size % 3 WHEN 0 THEN ' 127V' WHEN 1 THEN ' 12kg' ELSE ' Bivolt' END"

column_query("model_token_candidates", "part", KEY,
    {"n": N, "title": f"concat('Geladeira ', p_name, ' BRM', {N}, 'A/b 400L ', 'xy-', {N}, ' ', p_brand)", "b": "p_brand"},
    {"tokens": (lambda c: F.array_join(D.refrigerator_candidates(c["title"], F.lit("")), "|"),
                "concat('BRM', n, 'A/B|XY-', n)")})
column_query("valid_refrigerator_sku", "part", KEY,
    {"k": "p_size % 8", "n": N, "value": f"CASE p_size % 8 WHEN 0 THEN concat('brm', {N}) WHEN 1 THEN '400L' WHEN 2 THEN {N} WHEN 3 THEN 'IM8' WHEN 4 THEN '2portas' WHEN 5 THEN 'A 1' WHEN 6 THEN concat('(RT', {N}, ').') ELSE '127V' END",
     "brand": "CASE WHEN p_type = 'SMALL' THEN 'Electrolux' ELSE p_brand END"},
    {"valid": (lambda c: D.is_valid_refrigerator_sku(c["value"], c["brand"]).cast("int"),
               "CASE WHEN k IN (0, 6) THEN 1 WHEN k = 3 AND brand = 'Electrolux' THEN 1 ELSE 0 END")})
column_query("valid_washer_sku", "part", KEY,
    {"k": "p_size % 8", "n": N, "value": f"CASE p_size % 8 WHEN 0 THEN concat('LWA', {N}) WHEN 1 THEN '12KG' WHEN 2 THEN concat('12kgX', {N}) WHEN 3 THEN 'ABC220VBRANCA' WHEN 4 THEN 'TURBO-12' WHEN 5 THEN '127/220V' WHEN 6 THEN concat('ww11', 'tp', {N}) ELSE 'W1' END"},
    {"valid": (lambda c: D.is_valid_washer_sku(c["value"]).cast("int"), "CASE WHEN k IN (0, 6) THEN 1 ELSE 0 END")})
column_query("spec_token", "part", KEY,
    {"k": "p_size % 6", "value": "CASE p_size % 6 WHEN 0 THEN concat(cast(p_size AS varchar(5)), ',5 kg') WHEN 1 THEN '127/220V' WHEN 2 THEN '10x20x30cm' WHEN 3 THEN 'bivolt' WHEN 4 THEN '220V60/50Hz' ELSE concat('BR', cast(p_size AS varchar(5))) END"},
    {"is_spec": (lambda c: D.is_spec_token(c["value"]).cast("int"), "CASE WHEN k < 5 THEN 1 ELSE 0 END")})
column_query("maximal_candidate", "part", KEY,
    {"k": "p_size % 3", "n": N, "text": f"concat('BRM', {N}, CASE p_size % 3 WHEN 0 THEN concat(' BRM', {N}, 'AB') WHEN 1 THEN '' ELSE concat(' KX', {N}) END)"},
    {"sku": (lambda c: D.maximal_candidate(D.refrigerator_candidates(c["text"], F.lit(""))),
             "CASE k WHEN 0 THEN concat('BRM', n, 'AB') WHEN 1 THEN concat('BRM', n) ELSE '' END")})
column_query("strict_tv_title_model", "part", KEY,
    {"k": "p_size % 6", "s": I.vc("32 + p_size"), "n": N,
     "title": "concat(CASE p_size % 6 WHEN 0 THEN 'Suporte TV ' ELSE 'Smart TV ' END, " + I.vc("32 + p_size") + ", ' polegadas 4K ', CASE p_size % 6 WHEN 1 THEN 'UN' WHEN 2 THEN 'HDMI2 ' WHEN 3 THEN 'UN5 QN' WHEN 4 THEN 'controle ' ELSE 'UN' END, "
              + I.vc("32 + p_size") + ", 'TU', " + N + ", CASE p_size % 6 WHEN 5 THEN concat(' QN', " + I.vc("32 + p_size") + ", 'X', " + N + ") ELSE '' END)"},
    {"model": (lambda c: D.strict_tv_model(c["title"], F.lit("")),
               "CASE k WHEN 1 THEN concat('UN', s, 'TU', n) WHEN 2 THEN concat(s, 'TU', n) WHEN 3 THEN concat('QN', s, 'TU', n) ELSE '' END")})
column_query("tv_slug_model", "part", KEY,
    {"s": I.vc("32 + p_size"), "n": N, "url": "concat('https://shop.example/smart-tv-', " + I.vc("32 + p_size") + ", '-polegadas-un', " + I.vc("32 + p_size") + ", 'tu', " + N + ", '/p/', " + N + ", '/et/tv4k/')"},
    {"model": (lambda c: D.strict_tv_model_from_url(c["url"], F.lit("")), "concat('UN', s, 'TU', n)")})
column_query("tv_title_model_loose", "part", KEY,
    {"k": "p_size % 4", "n": N, "title": f"concat('Smart TV ', p_name, CASE p_size % 4 WHEN 0 THEN ' chipset MT' WHEN 1 THEN ' HDMI3 PTV' WHEN 2 THEN ' + Smart TV QA' ELSE ' AQ' END, {N}, 'K')"},
    {"model": (lambda c: D.tv_title_model(c["title"], F.lit("")), "CASE k WHEN 1 THEN concat('PTV', n, 'K') WHEN 3 THEN concat('AQ', n, 'K') ELSE '' END")})
column_query("tv_reference_choice", "part", KEY,
    {"k": "p_size % 3", "n": N, "refs": f"concat('REF', {N}, CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN concat('#UN50TU', {N}, ' - B#Z1') ELSE '#Z1' END)", "model": f"concat('UN50TU', {N})"},
    {"reference": (lambda c: D.reference_choice(F.split(c["refs"], "#"), c["model"]),
                   "CASE k WHEN 0 THEN concat('REF', n) WHEN 1 THEN concat('UN50TU', n, ' - B') ELSE '' END")})

_RES = {
    "p_partkey": "p_partkey", "k": "p_size % 5", "n": N, "brand": "CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 'Samsung' ELSE p_brand END",
    "title": f"concat('Geladeira ', CASE p_size % 5 WHEN 0 THEN concat('RT38K', {N}) WHEN 1 THEN concat('AA', {N}, ' BB', {N}) WHEN 2 THEN concat('AA', {N}, ' CC', {N}) ELSE p_name END)",
    "existing_sku": f"CASE p_size % 5 WHEN 4 THEN concat('old-', {N}) ELSE '400L' END",
    "ev": f"CASE p_size % 5 WHEN 1 THEN concat('modelo bb', {N}) WHEN 3 THEN concat('EV', {N}) ELSE '' END",
}


@query("resolve_refrigerator_sku", f"""WITH r AS ({I.select_sql(_RES, 'part')}) SELECT p_partkey,
 CASE k WHEN 0 THEN concat('RT38K', n) WHEN 1 THEN concat('BB', n) WHEN 2 THEN '' WHEN 3 THEN concat('EV', n) ELSE concat('OLD-', n) END AS sku,
 CASE k WHEN 0 THEN CASE WHEN brand = 'Samsung' THEN 'RT38K' ELSE concat('RT38K', n) END WHEN 1 THEN concat('BB', n) WHEN 2 THEN '' WHEN 3 THEN concat('EV', n) ELSE concat('OLD-', n) END AS sku_short,
 CASE k WHEN 0 THEN 'casas_ref_sku_title_selected' WHEN 1 THEN 'casas_ref_sku_title_ambiguous+casas_ref_sku_product_source_selected' WHEN 2 THEN 'casas_ref_sku_title_ambiguous+casas_ref_sku_unresolved'
  WHEN 3 THEN 'casas_ref_sku_product_source_selected' ELSE 'casas_ref_sku_existing_selected' END AS sku_status FROM r""")
def resolve_refrigerator_sku(spark, sf):
    rows = I.select(I.dealt(spark, sf, "part"), _RES).withColumn("evidence", F.array("ev"))
    return S.resolve_refrigerator_sku(rows).select("p_partkey", "sku", "sku_short", F.array_join("sku_status", "+").alias("sku_status"))


_RESW = {**_RES, "title": f"concat('Lavadora ', CASE p_size % 5 WHEN 0 THEN concat('WW11T', {N}) WHEN 1 THEN concat('AA', {N}, ' BB', {N}) ELSE p_name END)",
         "existing_sku": f"CASE p_size % 5 WHEN 4 THEN concat('old-', {N}) WHEN 0 THEN concat('X', {N}) WHEN 3 THEN '12kg' ELSE '' END",
         "ev": f"CASE p_size % 5 WHEN 1 THEN concat('CC', {N}) WHEN 3 THEN concat('EV', {N}) WHEN 4 THEN concat('EV', {N}) ELSE '' END"}


@query("resolve_washer_sku", f"""WITH r AS ({I.select_sql(_RESW, 'part')}) SELECT p_partkey,
 CASE k WHEN 0 THEN concat('WW11T', n) WHEN 1 THEN concat('CC', n) WHEN 2 THEN '' WHEN 3 THEN concat('EV', n) ELSE concat('OLD-', n) END AS sku,
 CASE k WHEN 0 THEN CASE WHEN brand = 'Samsung' THEN 'WW11T' ELSE concat('WW11T', n) END WHEN 1 THEN concat('CC', n) WHEN 2 THEN '' WHEN 3 THEN concat('EV', n) ELSE concat('OLD-', n) END AS sku_short,
 CASE k WHEN 0 THEN concat('casas_ldy_sku_conflict:existing:X', n, '!=WW11T', n, '+casas_ldy_sku_title_selected', CASE WHEN brand = 'Samsung' THEN '+casas_ldy_sku_short_derived' ELSE '' END)
  WHEN 1 THEN 'casas_ldy_sku_title_ambiguous+casas_ldy_sku_product_source_selected' WHEN 2 THEN 'casas_ldy_sku_unresolved' WHEN 3 THEN 'casas_ldy_sku_invalid_existing_rejected+casas_ldy_sku_product_source_selected'
  ELSE concat('casas_ldy_sku_conflict:product_source:OLD-', n, '!=EV', n, '+casas_ldy_sku_existing_selected') END AS sku_status FROM r""")
def resolve_washer_sku(spark, sf):
    rows = I.select(I.dealt(spark, sf, "part"), _RESW).withColumn("evidence", F.array("ev"))
    return S.resolve_washer_sku(rows).select("p_partkey", "sku", "sku_short", F.array_join("sku_status", "+").alias("sku_status"))


# ---- label evidence: order lines are labelled values of their part --------------------------------------

_LAB = {
    "item": "l_partkey", "ordinal": "(l_orderkey * 10 + l_linenumber) * 1000 + l_suppkey", "variant": "CASE WHEN l_returnflag = 'R' THEN 'x 220 V' ELSE 'x' END",
    "label_key": "CASE l_linenumber WHEN 1 THEN 'modelo' WHEN 2 THEN 'referencia' ELSE 'cor' END",
    "value": f"CASE l_linenumber WHEN 1 THEN concat('127V - AB', {I.vc('l_suppkey')}, '7; 220V: CD', {I.vc('l_suppkey')}, '7') ELSE concat('ef', {I.vc('l_suppkey')}, '-12 12kg') END",
}


@query("model_label_evidence", f"""WITH l AS ({I.select_sql(_LAB, 'lineitem')}), s AS (SELECT *, regexp_extract(value, '(\\d+)7; 220', 1) AS a, regexp_extract(value, 'ef(\\d+)-', 1) AS b FROM l),
m AS (SELECT item, ordinal, 0 AS p, concat('CD', a, '7') AS model FROM s WHERE label_key = 'modelo' AND variant LIKE '%220%' UNION ALL SELECT item, ordinal, 0, concat('AB', a, '7') FROM s WHERE label_key = 'modelo' AND variant = 'x'
 UNION ALL SELECT item, ordinal, 1, concat('CD', a, '7') FROM s WHERE label_key = 'modelo' AND variant = 'x' UNION ALL SELECT item, ordinal, 0, concat('EF', b, '-12') FROM s WHERE label_key = 'referencia'),
g AS (SELECT item, model, min(ordinal * 10 + p) AS o FROM m WHERE length(replace(model, '-', '')) >= 4 GROUP BY item, model)
SELECT item, string_agg(model, '|' ORDER BY o, model) AS evidence FROM g GROUP BY item""")
def model_label_evidence(spark, sf):
    rows = I.select(I.table(spark, sf, "lineitem"), _LAB)
    return S.label_evidence(rows, ["item"]).select("item", F.array_join("evidence", "|").alias("evidence"))


# ---- TV recovery ---------------------------------------------------------------------------------------------

_TV = {
    "p_partkey": "p_partkey", "k": "p_size % 6", "n": N, "item": N, "product_url": f"concat('https://shop.example/tv/p/', {N}, '/')",
    "retailer_sku_name": f"CASE p_size % 6 WHEN 0 THEN concat('Smart TV 50 polegadas UN50TU', {N}) WHEN 5 THEN concat('Smart TV 50 polegadas UN50TU', {N}) ELSE 'Smart TV 50 polegadas' END",
    "sku": f"CASE p_size % 6 WHEN 0 THEN {N} WHEN 1 THEN '' WHEN 2 THEN 'bivolt' WHEN 3 THEN 'GOOD1' WHEN 4 THEN '' ELSE 'KEEP9' END",
    "screen_size": "'50'", "parse_status": "'detail'", "reference": f"CASE WHEN p_size % 6 = 4 THEN 'Smart TV boa' ELSE concat('R-', {N}) END",
    "detail_item_id": f"CASE WHEN p_size % 6 = 2 THEN 'zz' ELSE {N} END", "identity_verified": "true",
}


@query("tv_sku_recovery", f"""WITH r AS ({I.select_sql(_TV, 'part')}) SELECT p_partkey, CASE k WHEN 0 THEN concat('UN50TU', n) WHEN 1 THEN concat('R-', n) ELSE sku END AS sku,
 CASE k WHEN 0 THEN 'detail+sku_title_high_confidence_recovered' WHEN 1 THEN 'detail+sku_factsheet_reference_recovered' WHEN 3 THEN 'detail+sku_reference_conflict_preserved' WHEN 5 THEN 'detail+sku_reference_conflict_preserved' ELSE 'detail' END AS parse_status FROM r""")
def tv_sku_recovery(spark, sf):
    return S.recover_tv_sku(I.select(I.dealt(spark, sf, "part"), _TV)).select("p_partkey", "sku", "parse_status")


@query("tv_sku_title_fallback", f"""WITH r AS ({I.select_sql(_TV, 'part')}) SELECT p_partkey, CASE k WHEN 0 THEN concat('UN50TU', n) ELSE sku END AS sku,
 CASE k WHEN 0 THEN 'detail+sku_title_final_recovered' ELSE 'detail' END AS parse_status FROM r""")
def tv_sku_title_fallback(spark, sf):
    return S.tv_title_fallback(I.select(I.dealt(spark, sf, "part"), _TV), final_pass=True).select("p_partkey", "sku", "parse_status")


_ROWC = lambda c: {k: c.get(k, F.lit("")) for k in ("sku", "item", "product_url", "retailer_sku_name", "screen_size", "parse_status", "retailer_product_id", "sku_short_version")}
_SKUROW = {
    "k": "p_size % 6", "n": N, "item": N, "product_url": f"concat('https://www.shop.example/tv/p/', {N}, '/')",
    "retailer_sku_name": f"CASE p_size % 6 WHEN 0 THEN concat('TV LED 50 polegadas PTV50G', {N}) ELSE 'TV LED 50 polegadas' END",
    "sku": f"CASE p_size % 6 WHEN 1 THEN concat('M-', {N}) WHEN 2 THEN {N} WHEN 3 THEN 'Smart TV qualquer' WHEN 4 THEN '127V' ELSE concat('K', {N}) END",
    "parse_status": "CASE p_size % 6 WHEN 1 THEN 'x+casas_tv_sku_model_pdp_html' WHEN 5 THEN 'sku_factsheet_reference_recovered' ELSE 'x' END",
}
column_query("sku_for_output_layout_c_tv", "part", KEY, _SKUROW, {
    "sku": (lambda c: D.sku_for_output(_ROWC(c), "C", "TV", ["shop.example"], F.lit(""), F.lit(False)),
            "CASE k WHEN 0 THEN concat('PTV50G', n) WHEN 1 THEN concat('M-', n) ELSE '' END")})
column_query("sku_for_output_layout_m", "part", KEY, _SKUROW, {
    "tv_sku": (lambda c: D.sku_for_output(_ROWC(c), "M", "TV", [], F.lit(""), F.lit(False)),
               "CASE k WHEN 2 THEN '' WHEN 3 THEN '' WHEN 4 THEN '' ELSE sku END"),
    "ref_sku": (lambda c: D.sku_for_output(_ROWC(c), "M", "REF", [], F.lit(""), F.lit(False)),
                "CASE k WHEN 2 THEN '' WHEN 3 THEN '' WHEN 4 THEN '' ELSE sku END")})
_APPROW = {
    "k": "p_size % 5", "n": N, "item": N, "product_url": "''",
    "retailer_sku_name": f"CASE p_size % 5 WHEN 0 THEN concat('Samsung WW11T', {N}, ' lavadora') WHEN 1 THEN concat('Lavadora AA', {N}, ' BB', {N}) ELSE 'Lavadora' END",
    "sku": f"CASE p_size % 5 WHEN 2 THEN concat('sku', {N}) WHEN 3 THEN '12kg' ELSE '' END", "parse_status": "CASE p_size % 5 WHEN 2 THEN 'casas_ldy_sku_existing_selected' ELSE '' END",
    "sku_short_version": "''",
}


@query("sku_for_output_layout_c_washer", f"""WITH r AS (SELECT p_partkey, {', '.join(f'{e} AS {n}' for n, e in _APPROW.items())} FROM part)
SELECT p_partkey, CASE k WHEN 0 THEN concat('WW11T', n) WHEN 2 THEN concat('SKU', n) ELSE '' END AS sku, CASE k WHEN 0 THEN 'WW11T' WHEN 2 THEN concat('SKU', n) ELSE '' END AS short FROM r""")
def sku_for_output_layout_c_washer(spark, sf):
    rows = I.select(I.dealt(spark, sf, "part"), {"p_partkey": "p_partkey", **_APPROW})
    c = _ROWC({k: F.col(k) for k in rows.columns})
    rows = rows.withColumn("resolved", D.sku_for_output(c, "C", "LDY", [], F.lit(""), F.lit(False)))
    return rows.select("p_partkey", F.col("resolved").alias("sku"),
                       D.short_for_output(c, F.col("resolved"), "C", "LDY", F.lit("")).alias("short"))


# ---- detail rows ---------------------------------------------------------------------------------------------

_MDOC = (
    "concat('{\"id\":\"', " + N + ", '\",\"title\":\"Geladeira Frost Free ', p_name, '\",\"description\":\"<p>Consumo: 45 kWh/mes</p><p>Ano 2023</p>\",\"factsheet\":', "
    "CASE p_size % 3 WHEN 0 THEN '[]' ELSE concat('[{\"keyName\":\"Capacidades\",\"elements\":[{\"keyName\":\"Capacidade total\",\"value\":\"', " + I.vc("300 + p_size") + ", ' litros\"},{\"keyName\":\"Capacidade do freezer\",\"value\":\"90 L\"}]},"
    "{\"slug\":\"portas\",\"value\":\"Inverse\"},{\"keyName\":\"Referência\",\"elements\":[{\"value\":\"BRM', " + N + ", '\"}]}]') END, ',\"bundles\":[{\"factsheet\":[{\"keyName\":\"Capacidade\",\"value\":\"', " + I.vc("200 + p_size") + ", ' L\"}]}],"
    "\"offers\":[{\"seller\":{\"id\":\"a\",\"tags\":[]},\"listPrice\":10,\"price\":9},{\"seller\":{\"id\":\"b\"},\"listPrice\":', " + I.vc("p_size") + ", ',\"bestPrice\":{\"totalAmount\":8}}],\"rating\":{\"score\":4.5,\"count\":', " + I.vc("p_size") + ", '}}')"
)


@query("fact_evidence", """SELECT p_partkey, 'capacidade total' AS label_key, concat(300 + p_size, ' litros') AS value, 'fact' AS source FROM part WHERE p_size % 3 <> 0 UNION ALL SELECT p_partkey, 'capacidade do freezer', '90 L', 'fact' FROM part WHERE p_size % 3 <> 0
UNION ALL SELECT p_partkey, 'portas', 'Inverse', 'fact' FROM part WHERE p_size % 3 <> 0 UNION ALL SELECT p_partkey, 'referencia', concat('BRM', 1000 + p_partkey), 'fact' FROM part WHERE p_size % 3 <> 0
UNION ALL SELECT p_partkey, 'capacidade', concat(200 + p_size, ' L'), CASE WHEN p_size % 3 = 0 THEN 'fact' ELSE 'bundle' END FROM part""")
def fact_evidence(spark, sf):
    from vitrine.operators.evidence import fact_rows

    docs = I.dealt(spark, sf, "part").selectExpr("p_partkey", f"try_parse_json({_MDOC}) AS item_doc")
    return fact_rows(docs, KEY).select("p_partkey", "label_key", "value", "source")


@query("detail_row_layout_m", """SELECT p_partkey, concat('Geladeira Frost Free ', p_name) AS retailer_sku_name, CASE WHEN p_size % 3 = 0 THEN '' ELSE concat('BRM', 1000 + p_partkey) END AS sku,
concat('R$', p_size, ',00') AS original_sku_price, 'R$8,00' AS final_sku_price, '45 kWh/mes' AS estimated_annual_electricity_use, CASE WHEN p_size % 3 = 0 THEN '' ELSE 'Inverse' END AS ref_refrigerator_type,
CASE WHEN p_size % 3 = 0 THEN concat(200 + p_size, ' L') ELSE concat(300 + p_size, ' litros') END AS ref_capacity, '2023' AS model_year, '4.5' AS star_rating, cast(p_size AS varchar) AS count_of_star_ratings FROM part""")
def detail_row_layout_m(spark, sf):
    docs = I.dealt(spark, sf, "part").selectExpr("p_partkey", f"try_parse_json({_MDOC}) AS doc", "'b' AS seller_id")
    return A.detail_layout_m(docs, KEY, "REF").select(
        "p_partkey", "retailer_sku_name", "sku", "original_sku_price", "final_sku_price", "estimated_annual_electricity_use",
        "ref_refrigerator_type", "ref_capacity", "model_year", "star_rating", "count_of_star_ratings")


_CDOC = (
    "concat('{\"product\":{\"id\":', " + N + ", ',\"name\":\"', CASE p_size % 4 WHEN 0 THEN 'Secadora de roupas' ELSE 'Lavadora' END, ' ', p_name, CASE p_size % 4 WHEN 1 THEN ' 13kg' ELSE '' END, ' branca\",\"brand\":{\"name\":\"Samsung\"},"
    "\"description\":\"<p>Tipo de abertura: frontal</p><p>Capacidade de lavagem: 9 kg</p>\",\"specGroups\":[{\"name\":\"G\",\"specs\":[{\"name\":\"Capacidade (Kg) de Roupas\",\"value\":\"', CASE p_size % 4 WHEN 2 THEN '0,5' ELSE '11 kg' END, '\"},"
    "{\"name\":\"Modelo\",\"value\":\"ww11t', " + N + ", '\"},{\"name\":\"Consumo de energia\",\"value\":\"0.3 kWh, Voltagem: 220V\"}]}]},\"sku\":{\"id\":5,\"name\":\"x 220V\"}}')"
)


@query("detail_row_layout_c", """SELECT p_partkey, concat('WW11T', 1000 + p_partkey) AS sku, 'WW11T' AS sku_short, '0.3 kWh' AS estimated_annual_electricity_use,
CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN '13kg' WHEN 2 THEN '9 kg' ELSE '11 kg' END AS ldy_capacity, CASE p_size % 4 WHEN 0 THEN '' ELSE 'Front load' END AS ldy_loading_type, 'branca' AS ldy_color, cast(1000 + p_partkey AS varchar) AS retailer_product_id FROM part""")
def detail_row_layout_c(spark, sf):
    docs = I.dealt(spark, sf, "part").selectExpr("p_partkey", f"try_parse_json({_CDOC}) AS doc")
    return A.detail_layout_c(docs, KEY, "LDY").select(
        "p_partkey", "sku", "sku_short", "estimated_annual_electricity_use", "ldy_capacity", "ldy_loading_type", "ldy_color", "retailer_product_id")


@query("detail_row_page_m", """SELECT page_id, 'Smart TV 50 polegadas' AS retailer_sku_name, '50 polegadas' AS screen_size, CASE WHEN page_id % 4 = 0 THEN 0 ELSE 1 END AS identity_verified, CASE WHEN page_id % 4 = 0 THEN 1 ELSE 0 END AS identity_conflict,
'R$7,00' AS final_sku_price FROM pages""")
def detail_row_page_m(spark, sf):
    pages = I.table(spark, sf, "pages").selectExpr(
        "page_id", "concat('https://shop.example/x/p/', page_id, '/') AS product_url",
        "concat(html, '<script id=\"__NEXT_DATA__\">{\"props\":{\"pageProps\":{\"data\":{\"item\":{\"id\":\"', CASE WHEN page_id % 4 = 0 THEN 'zz' ELSE cast(page_id AS string) END, '\",\"title\":\"Smart TV 50 polegadas\",\"offers\":[{\"price\":7}]}}}}}</script>') AS html")
    out = A.detail_from_page_m(pages, ["page_id"], "TV")
    return out.select("page_id", "retailer_sku_name", "screen_size", F.col("identity_verified").cast("int").alias("identity_verified"),
                      F.col("identity_conflict").cast("int").alias("identity_conflict"), "final_sku_price")


@query("detail_row_page_c", """SELECT page_id, 'Geladeira Duplex' AS retailer_sku_name, '400 L' AS ref_capacity, CASE WHEN page_id % 3 = 1 THEN 0 ELSE 1 END AS identity_verified, CASE WHEN page_id % 3 = 1 THEN 1 ELSE 0 END AS identity_conflict FROM pages""")
def detail_row_page_c(spark, sf):
    pages = I.table(spark, sf, "pages").selectExpr(
        "page_id", "concat('https://shop.example/x/p/', page_id, '/') AS product_url",
        "concat(html, '<link rel=\"canonical\" href=\"https://shop.example/x/p/', page_id, '\"><script id=\"__NEXT_DATA__\">{\"props\":{\"initialState\":{\"Product\":{\"product\":{\"id\":1,\"name\":\"Geladeira Duplex\",\"specGroups\":[{\"specs\":[{\"name\":\"Capacidade total\",\"value\":\"400 L\"}]}]}', "
        "CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN ',\"sku\":{\"id\":\"zz\"}' ELSE concat(',\"sku\":{\"id\":', page_id, '}') END, '}}}}</script>') AS html")
    out = A.detail_from_page_c(pages, ["page_id"], "REF")
    return out.select("page_id", "retailer_sku_name", "ref_capacity", F.col("identity_verified").cast("int").alias("identity_verified"),
                      F.col("identity_conflict").cast("int").alias("identity_conflict"))


# the same page, with the pairs of its main part: they count where the id of the page is the URL's, regions of other products never
_PAIRED = (
    '<div class="shelf"><div><dl><dt>Capacidade total</dt><dd>111 L</dd></dl></div><dl><dt>Capacidade total</dt><dd>222 L</dd></dl></div>'
    '<table><tr><th>Capacidade total</th><td>310 litros</td></tr></table><p>Consumo de energia: 42 kWh</p>')


@query("detail_row_page_pairs", """SELECT page_id, CASE WHEN page_id % 4 = 0 THEN '' ELSE '310 litros' END AS ref_capacity, CASE WHEN page_id % 4 = 0 THEN '' ELSE '42 kWh' END AS estimated_annual_electricity_use, 'M' AS layout FROM pages
UNION ALL SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '' ELSE '310 litros' END, CASE WHEN page_id % 3 = 0 THEN '' ELSE '42 kWh' END, 'C' FROM pages""")
def detail_row_page_pairs(spark, sf):
    pages = I.table(spark, sf, "pages")
    url = "concat('https://shop.example/x/p/', page_id, '/') AS product_url"
    m = pages.selectExpr("page_id", url, f"concat(html, '{_PAIRED}', '<script id=\"__NEXT_DATA__\">{{\"props\":{{\"pageProps\":{{\"data\":{{\"item\":{{\"id\":\"', "
                         "CASE WHEN page_id % 4 = 0 THEN 'zz' ELSE cast(page_id AS string) END, '\",\"title\":\"Geladeira Duplex\",\"offers\":[{\"price\":7}]}}}}}</script>') AS html")
    c = pages.selectExpr("page_id", url, f"concat(html, '{_PAIRED}', '<script id=\"__NEXT_DATA__\">{{\"props\":{{\"initialState\":{{\"Product\":{{\"product\":{{\"id\":1,\"name\":\"Geladeira Duplex\"}},\"sku\":{{\"id\":\"', "
                         "CASE WHEN page_id % 3 = 0 THEN 'zz' ELSE cast(page_id AS string) END, '\"}}}}}</script>') AS html")
    shown = ["page_id", "ref_capacity", "estimated_annual_electricity_use", "layout"]
    return A.detail_from_page_m(m, ["page_id"], "REF").select(*shown).unionByName(A.detail_from_page_c(c, ["page_id"], "REF").select(*shown))


@query("detail_row_compact_washer", """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN concat(3 + p_size, ' litros') WHEN 1 THEN '11 kg' WHEN 2 THEN '' ELSE concat(2 + p_size, 'L') END AS ldy_capacity FROM part""")
def detail_row_compact_washer(spark, sf):
    title = ("CASE p_size % 4 WHEN 0 THEN 'Mini lavadora' WHEN 1 THEN 'Mini lavadora 11 kg' WHEN 2 THEN 'Lavadora' ELSE concat('Lavadora mini ', " + I.vc("2 + p_size") + ", 'L') END")
    docs = I.dealt(spark, sf, "part").selectExpr(
        "p_partkey", "'b' AS seller_id", f"try_parse_json(concat('{{\"title\":\"', {title}, '\",\"factsheet\":[', CASE WHEN p_size % 4 IN (0, 2) THEN concat('{{\"keyName\":\"Capacidade de lavagem\",\"value\":\"', {I.vc('3 + p_size')}, ' litros\"}}') ELSE '' END, ']}}')) AS doc")
    return A.detail_layout_m(docs, KEY, "LDY").select("p_partkey", "ldy_capacity")


# ---- published rows ------------------------------------------------------------------------------------------------

_GIVEN = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_partkey": "l_partkey", "l_suppkey": "l_suppkey",
    "retailer": "'Magalu'", "item": "''", "product_url": f"concat('https://www.magazineluiza.com.br/x/p/', {I.vc('l_partkey')}, '/')",
    "main_rank": f"CASE WHEN l_returnflag = 'R' THEN '' ELSE {I.vc('l_linenumber')} END", "bsr_rank": "CASE WHEN l_returnflag = 'N' THEN '' ELSE '7' END",
    "retailer_sku_name": "'Smart TV'", "original_sku_price": f"concat({I.vc('cast(floor(l_extendedprice) AS bigint)')}, '.00')",
    "final_sku_price": f"CASE WHEN l_linenumber = 1 THEN concat({I.vc('cast(floor(l_extendedprice) AS bigint)')}, '.00') ELSE '10.5' END",
    "savings": "'5%'", "sku_status": "CASE WHEN l_linenumber = 2 THEN 'Patrocinado' ELSE '' END", "discount_type": "'5% OFF'",
    "delivery_availability": "'Receba hoje'", "pick_up_availability": "'Retire na loja'",
    "sku": f"CASE WHEN l_linenumber = 3 THEN {I.vc('l_partkey')} ELSE concat('UN', {I.vc('l_suppkey')}) END", "screen_size": "'50 pol'",
    "star_rating": "'4,50'", "count_of_star_ratings": "'1.200'", "count_of_reviews": "''", "parse_status": "CASE WHEN l_linenumber = 4 THEN 'x+reviews_graphql_failed:t' ELSE 'x' END",
    "recommendation_intent": "''", "detailed_review_content": "'[\"a\",\"b\"]'", "retailer_sku_name_similar": "'A ||| Digite seu CEP'",
}


@query("final_projection", f"""WITH r AS ({I.select_sql(_GIVEN, 'lineitem')}) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'BR' AS country, 'TV' AS product, cast(l_partkey AS varchar) AS item, 'Magalu' AS account_name,
 CASE WHEN main_rank <> '' THEN 'main' ELSE 'bsr' END AS page_type, CASE WHEN l_linenumber = 1 THEN '' ELSE concat('R$', translate(format('{{:,}}', cast(replace(original_sku_price, '.00', '') AS bigint)), ',', '.'), ',00') END AS original_sku_price,
 '' AS savings, CASE WHEN sku_status <> '' THEN 'Sponsored' ELSE '' END AS sku_status, '5% discount off' AS discount_type, 'Receive today' AS delivery_availability, 'Pick up in store' AS pick_up_availability,
 CASE WHEN l_linenumber = 3 THEN '' ELSE sku END AS sku, '50 inches' AS screen_size, '4.5' AS star_rating, '1200' AS count_of_star_ratings, CASE WHEN l_linenumber = 4 THEN '' ELSE '0' END AS count_of_reviews,
 'review1 - a ||| review2 - b' AS detailed_review_content, 'A' AS retailer_sku_name_similar, 'w10' AS calendar_week, 'm_20240304_050607' AS batch_id FROM r""")
def final_projection(spark, sf):
    rows = I.select(I.table(spark, sf, "lineitem"), _GIVEN)
    rows = rows.withColumns({c: F.lit("") for c in SNAPSHOT_COLUMNS if c not in rows.columns})
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    out = FN.final_rows(rows, keys, "M", "TV", "BR", [], F.lit("2024-03-04 05:06:07").cast("timestamp"))
    return out.select(*keys, "country", "product", "item", "account_name", "page_type", "original_sku_price", "savings", "sku_status",
                      "discount_type", "delivery_availability", "pick_up_availability", "sku", "screen_size", "star_rating",
                      "count_of_star_ratings", "count_of_reviews", "detailed_review_content", "retailer_sku_name_similar", "calendar_week", "batch_id")
