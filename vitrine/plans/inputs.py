"""Engine inputs derived from the driver tables.

Every view is written once as SQL text that Spark and the checking engine both
read, so a query and its check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
# tables of few bytes a row: their files give too few tasks for rules that cost up to milliseconds a row
DEALT = ("customer", "supplier", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str, rows: int = 8192) -> DataFrame:
    """A table whose rows are dealt out evenly, about ``rows`` to a task, for work that costs far more than reading.

    A narrow table of millions of rows is a few MB, so its files alone give one or a few tasks.  Small tables are dealt over the
    cores.  The count comes from the footers of the files.
    """
    df = table(spark, sf_dir, name)
    n = df.count()
    return df.repartition(max(n // rows, min(n // 256, spark.sparkContext.defaultParallelism)) + 1)


def select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def select_sql(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {source}"


LINE = "CASE WHEN p_type IN ('ECONOMY','PROMO') THEN 'TV' WHEN p_type IN ('LARGE','MEDIUM') THEN 'REF' ELSE 'LDY' END"

# ---- listing occurrences: one row per order line -------------------------------------------

LISTING = {
    "retailer": "CASE WHEN l_linestatus = 'O' THEN 'North Shop' ELSE 'South Shop' END",
    "product_line": LINE,
    "run_date": "cast(year(l_shipdate) AS varchar(4))",
    "run_id": "CASE WHEN l_returnflag = 'R' THEN 'bsr' ELSE 'main' END",
    "page": "l_orderkey",
    "pos": "(l_linenumber * 100 + cast(l_quantity AS bigint)) * 1000000000000 + l_partkey * 1000000 + l_suppkey",
    "item": "cast(l_partkey AS varchar(20))",
    "sku": "concat('SKU', cast(l_partkey AS varchar(20)))",
    "product_url": "CASE WHEN l_tax = 0.0 THEN '' ELSE concat('https://Shop.example/', replace(p_name, ' ', '-'), '/p/', cast(l_partkey AS varchar(20)), '/?utm_source=x&seller_id=', CASE WHEN l_linenumber <= 4 THEN '1' ELSE '2' END) END",
    "retailer_sku_name": "concat(p_name, ' ', p_brand)",
    "final_price": "cast(l_extendedprice AS decimal(14,2))",
}
LISTING_FROM = "lineitem JOIN part ON l_partkey = p_partkey"
# the identity rule, written out for the checking engine
LISTING_SQL = (
    "SELECT *, CASE WHEN product_url = '' THEN '' ELSE concat('https://shop.example/', "
    "split_part(substr(product_url, 22), '/?', 1), '?', "
    "substr(product_url, length(product_url) - 10)) END AS url_key, "
    "CASE WHEN product_url = '' THEN concat('sku|', lower(retailer), '|', sku) ELSE "
    "concat('url|https://shop.example/', split_part(substr(product_url, 22), '/?', 1), '?', "
    "substr(product_url, length(product_url) - 10)) END AS identity FROM ("
    + select_sql(LISTING, LISTING_FROM) + ")"
)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return select(lineitem.join(part, lineitem.l_partkey == part.p_partkey), LISTING)


def vc(expr: str) -> str:
    return f"cast({expr} AS varchar(40))"


# ---- offers and the product cards that look for them ----------------------------------------

_STEP = "(100 + 10 * cast(floor(l_quantity / 10) AS bigint))"
OFFERS = {
    "product_id": f"CASE WHEN l_tax = 0.01 THEN '' ELSE {vc('l_partkey + 1')} END",
    "sku_id": vc("(l_partkey + 1) * 10 + l_linenumber"),
    "seller_id": f"CASE WHEN l_tax = 0.02 THEN '' WHEN l_tax = 0.03 THEN 'x1' ELSE {vc('1 + l_suppkey % 4')} END",
    "old_price": f"CASE WHEN l_discount = 0.0 THEN '' ELSE concat({vc(_STEP + ' + 25')}, '.00') END",
    "current_price": f"CASE WHEN l_tax = 0.04 THEN '' ELSE concat({vc(_STEP)}, '.00') END",
    "standard_price": f"concat({vc(_STEP)}, '.00')",
    "discount_rate": "''",
    "savings": "''",
    "price_description": "CASE WHEN l_returnflag = 'R' THEN 'desconto pix' ELSE '' END",
    "avail_product": "''",
    "avail_sku": f"CASE WHEN l_tax = 0.05 THEN '7' ELSE {vc('(l_partkey + 1) * 10 + l_linenumber')} END",
    "avail_seller": f"CASE WHEN l_tax = 0.02 THEN {vc('1 + l_suppkey % 4')} ELSE '' END",
    "pos": "l_orderkey * 10 + l_linenumber",
}
CARDS = {
    "card": "p_partkey",
    "product_id": f"CASE WHEN p_size % 5 = 0 THEN '' ELSE {vc('p_partkey + 1')} END",
    "sku_id": vc("(p_partkey + 1) * 10 + 1 + p_size % 7"),
    "seller_id": f"CASE WHEN p_size % 3 = 0 THEN '' ELSE {vc('1 + p_size % 4')} END",
    "quarantined": "p_size % 11 = 0",
    "own_price": "CASE WHEN p_size % 2 = 0 THEN '99.00' ELSE '' END",
}
PRICE_ROWS = {
    "card": "p_partkey",
    "product_url": f"CASE WHEN p_size = 13 THEN 'http://shop.example/x' ELSE concat('https://www.shop.example/x/p/', {vc('(p_partkey + 1) * 10 + 1 + p_size % 7')}) END",
    "retailer_product_id": f"CASE WHEN p_size = 17 THEN '' ELSE {vc('p_partkey + 1')} END",
    "seller_id": f"CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size = 20 THEN 'zz' ELSE {vc('1 + p_size % 4')} END",
    "final_sku_price": "CASE WHEN p_size % 4 = 0 THEN 'R$120,00' ELSE '' END",
    "original_sku_price": "CASE WHEN p_size % 8 = 1 THEN 'R$145,00' ELSE '' END",
    "savings": "CASE WHEN p_size % 16 = 3 THEN 'Baixou 17%' ELSE '' END",
    "discount_type": "''",
    "parse_status": "'listing'",
}


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(table(spark, sf_dir, "lineitem"), OFFERS)


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(dealt(spark, sf_dir, "part"), CARDS)


def price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(dealt(spark, sf_dir, "part"), PRICE_ROWS)


# ---- history and current rows -------------------------------------------------------------------

HISTORY = {
    "item_key": vc("o_custkey"),
    "item": f"CASE WHEN o_orderkey % 9 = 0 THEN 'zz' ELSE {vc('o_custkey')} END",
    "product_url": f"concat('https://www.shop.example/x/p/', {vc('o_custkey')}, '/')",
    "crawl_strdatetime": "CASE WHEN o_orderpriority = '5-LOW' THEN ' ' ELSE cast(cast(o_orderdate AS date) AS varchar(20)) END",
    "batch_id": f"concat('b_', {vc('o_orderkey')})",
    "screen_size": "CASE o_orderstatus WHEN 'F' THEN '' ELSE o_orderstatus END",
    "model_year": f"CASE WHEN o_totalprice > 200000 THEN ' ' ELSE {vc('year(o_orderdate)')} END",
    "sku": f"CASE WHEN o_totalprice < 300000 THEN '' ELSE concat('S', {vc('o_orderkey')}) END",
}
CURRENT = {
    "item_key": f"CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE {vc('c_custkey')} END",
    "segment": "c_mktsegment",
    "c_custkey": "c_custkey",
    "screen_size": "CASE WHEN c_acctbal < 4000 THEN ' ' ELSE c_name END",
    "model_year": f"CASE WHEN c_nationkey < 12 THEN '' ELSE {vc('c_nationkey')} END",
    "sku": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'bivolt' WHEN c_nationkey > 20 THEN 'KEEP1' ELSE '' END",
}


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(table(spark, sf_dir, "orders"), HISTORY)


def current_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(table(spark, sf_dir, "customer"), CURRENT)
