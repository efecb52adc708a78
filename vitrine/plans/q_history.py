"""Queries over the history table and the rows it backfills."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import models as D
from vitrine.functions.text import blank, null_if_blank
from vitrine.operators import history as H
from vitrine.plans import inputs as I
from vitrine.plans.registry import query

ORDER = ["crawl_strdatetime", "batch_id", "product_url"]
FIELDS = ["screen_size", "model_year", "sku"]
_ORDER = ", ".join(f"nullif(trim({c}), '') DESC NULLS LAST" for c in ORDER)
_HIST = f"h AS ({I.select_sql(I.HISTORY, 'orders')})"
_ALL = f"w AS (SELECT *, row_number() OVER (PARTITION BY item_key ORDER BY {_ORDER}) AS history_rank FROM hh)"


@query("history_window", f"""WITH {_HIST}, hh AS (SELECT * FROM h), {_ALL}
SELECT item_key, batch_id, crawl_strdatetime, history_rank FROM w WHERE history_rank <= 5""")
def history_window(spark, sf):
    out = H.history_window(I.history(spark, sf), ["item_key"], ORDER, 5)
    return out.select("item_key", "batch_id", "crawl_strdatetime", "history_rank")


def _pick(field: str) -> str:
    return f"arg_min(nullif(trim({field}), ''), history_rank) FILTER (trim({field}) <> '') AS {field}"


@query("latest_non_blank", f"""WITH {_HIST}, hh AS (SELECT * FROM h), {_ALL}
SELECT item_key, {', '.join(_pick(f) for f in FIELDS)} FROM w GROUP BY item_key""")
def latest_non_blank(spark, sf):
    return H.last_known(I.history(spark, sf), ["item_key"], FIELDS, ORDER)


def _backfilled(spark, sf):
    rows, hist = I.current_rows(spark, sf), I.history(spark, sf)
    known = F.col("item_key") != ""
    needs = {f: known & blank(F.col(f)) for f in FIELDS}
    needs["sku"] = known & (blank(F.col("sku")) | D.is_descriptive(F.col("sku")))
    values = {f: null_if_blank(F.col(f)) for f in FIELDS}
    return H.backfill(rows, hist, ["item_key"], FIELDS, needs, values, ORDER,
                      F.col("item") == F.col("item_key"))


_NEED = {f: f"c.item_key <> '' AND trim(c.{f}) = ''" for f in FIELDS}
_NEED["sku"] = "c.item_key <> '' AND (c.sku = '' OR c.sku = 'bivolt')"
_BACK = f"""WITH {_HIST}, c AS ({I.select_sql(I.CURRENT, 'customer')}),
asked AS (SELECT DISTINCT item_key FROM c WHERE {' OR '.join('(' + n + ')' for n in _NEED.values())}),
hh AS (SELECT * FROM h WHERE item_key IN (SELECT item_key FROM asked)), {_ALL},
k AS (SELECT item_key, {', '.join(_pick(f) for f in FIELDS)} FROM w WHERE item = item_key GROUP BY item_key),
f AS (SELECT c.c_custkey, c.segment, c.item_key, """ + ", ".join(
    f"CASE WHEN {_NEED[f]} AND k.{f} IS NOT NULL THEN k.{f} ELSE c.{f} END AS {f}, "
    f"CASE WHEN {_NEED[f]} AND k.{f} IS NOT NULL THEN 1 ELSE 0 END AS got_{f}" for f in FIELDS
) + " FROM c LEFT JOIN k ON c.item_key = k.item_key)"


@query("history_backfill", f"""{_BACK} SELECT c_custkey, item_key, {', '.join(FIELDS)},
concat_ws('+', {', '.join(f"CASE WHEN got_{f} = 1 THEN '{f}' END" for f in FIELDS)}) AS recovered FROM f""")
def history_backfill(spark, sf):
    return _backfilled(spark, sf).select(
        "c_custkey", "item_key", *FIELDS, F.array_join("recovered", "+").alias("recovered"))


@query("recovery_counters", f"""{_BACK} SELECT segment, count(*) AS row_count,
count(CASE WHEN {' + '.join('got_' + f for f in FIELDS)} > 0 THEN 1 END) AS recovered_rows,
cast(sum({' + '.join('got_' + f for f in FIELDS)}) AS bigint) AS recovered_fields FROM f GROUP BY segment""")
def recovery_counters(spark, sf):
    return H.recovery_counters(_backfilled(spark, sf), ["segment"])


@query("recovered_by_field", f"{_BACK} " + " UNION ALL ".join(
    f"SELECT segment, '{f}' AS field, count(*) AS recovered_rows FROM f WHERE got_{f} = 1 GROUP BY segment" for f in FIELDS))
def recovered_by_field(spark, sf):
    return H.recovered_by_field(_backfilled(spark, sf), ["segment"])


# ---- the product-line form: current rows from customer, published rows from orders ---------------

_TITLE = ("concat('Geladeira Frost Free ', CASE WHEN %s %% 4 = 0 THEN '' ELSE concat('RX', cast(%s AS varchar(20)), 'B ') END, '400 litros')")
_LINE_ROWS = {
    "c_custkey": "c_custkey", "item": I.vc("c_custkey"),
    "product_url": f"concat('https://www.shop.example/x/p/', {I.vc('c_custkey')}, '/')",
    "retailer_product_id": "''", "screen_size": "''",
    "retailer_sku_name": "'Geladeira Frost Free 400 litros'", "sku": "''", "sku_short_version": "''",
    "ref_refrigerator_type": "CASE WHEN c_acctbal < 3000 THEN '' ELSE 'Duplex' END",
    "ref_capacity": "CASE WHEN c_nationkey < 10 THEN '' ELSE '400 L' END",
    "parse_status": "CASE WHEN c_nationkey = 3 THEN 'listing+identity_conflict' ELSE 'listing' END",
}
_LINE_HIST = {
    "item": I.vc("o_custkey"),
    "product_url": f"CASE WHEN o_orderkey % 7 = 0 THEN 'https://www.shop.example/x/p/zz/' ELSE concat('https://www.shop.example/x/p/', {I.vc('o_custkey')}, '/') END",
    "retailer_sku_name": _TITLE % ("o_orderkey", "o_orderkey"),
    "sku": "CASE WHEN o_orderstatus = 'F' THEN '400 litros' WHEN o_orderstatus = 'O' THEN '' ELSE concat('rx', cast(o_orderkey AS varchar(20)), 'a') END",
    "sku_short_version": "CASE WHEN o_orderstatus = 'O' THEN concat('RX', cast(o_orderkey AS varchar(20)), 'B') ELSE '' END",
    "ref_refrigerator_type": "CASE WHEN o_totalprice < 250000 THEN ' ' ELSE 'Inverse' END",
    "ref_capacity": "CASE WHEN o_totalprice > 250000 THEN '' ELSE '310 L' END",
    "crawl_strdatetime": "cast(cast(o_orderdate AS date) AS varchar(20))", "batch_id": f"concat('b_', {I.vc('o_orderkey')})",
    "ok": "o_orderkey",
}


@query("line_history_backfill", f"""WITH r AS ({I.select_sql(_LINE_ROWS, 'customer')}), h AS ({I.select_sql(_LINE_HIST, 'orders')}),
hh AS (SELECT *, item AS item_key FROM h), {_ALL},
v AS (SELECT *, CASE WHEN sku LIKE 'rx%' THEN upper(sku) WHEN sku_short_version <> '' AND ok % 4 <> 0 THEN sku_short_version END AS good
  FROM w WHERE ok % 7 <> 0),
k AS (SELECT item_key, arg_min(good, history_rank) FILTER (good IS NOT NULL) AS k_sku,
  {_pick('ref_refrigerator_type')}, {_pick('ref_capacity')} FROM v GROUP BY item_key)
SELECT c_custkey, coalesce(k_sku, '') AS sku, coalesce(k_sku, '') AS sku_short_version,
 CASE WHEN r.ref_refrigerator_type = '' AND c_ok THEN coalesce(k.ref_refrigerator_type, '') ELSE r.ref_refrigerator_type END AS ref_refrigerator_type,
 CASE WHEN r.ref_capacity = '' AND c_ok THEN coalesce(k.ref_capacity, '') ELSE r.ref_capacity END AS ref_capacity,
 CASE WHEN k_sku IS NOT NULL THEN concat(parse_status, '+casas_ref_sku_last_known_selected') ELSE parse_status END AS parse_status
FROM (SELECT *, parse_status = 'listing' AS c_ok FROM r) r LEFT JOIN k ON r.item = k.item_key""")
def line_history_backfill(spark, sf):
    rows = I.select(I.table(spark, sf, "customer"), _LINE_ROWS)
    hist = I.select(I.table(spark, sf, "orders"), _LINE_HIST)
    out = H.backfill_line(rows, hist, "REF", "C", ["shop.example"])
    return out.select("c_custkey", "sku", "sku_short_version", "ref_refrigerator_type", "ref_capacity", "parse_status")
