"""Queries over stored pages; each page carries a data island built from its own row."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import variants as V
from vitrine.operators import listing as L
from vitrine.plans import inputs as I
from vitrine.plans.registry import column_query, query
from vitrine.session import work_dir
from vitrine.sources import pages as P

KEYS = ["page_id"]
PID = I.vc("page_id")


def _product_m(k: int, title: str, extra: str = "") -> str:
    return (f"""'{{"id":"', {PID}, '{k}","title":"', {title}, '","path":"/tv-x/p/', {PID}, '{k}/","price":{{"fullPrice":"', {PID}, '.50","bestPrice":', {PID}, '}},"""
            f""""seller":{{"id":"s{k}","tags":[{{"type":"coupon","discountValue":{k}}}]}}{extra}}}'""")


_M_HTML = (
    "concat(html, '<script id=\"__NEXT_DATA__\" type=\"application/json\">{\"props\":{\"pageProps\":{\"data\":{\"search\":{\"products\":[', "
    + _product_m(1, "'Smart TV 50 polegadas &amp; cia'") + ", ',', " + _product_m(2, "'Suporte para TV'") + ", ',', "
    + _product_m(3, "'Smart TV 65\\\\\" 2024'", ',"ads":{"sponsored":true}') + ", ']}}}}}</script>')"
)


def _product_c(k: int, title: str, extra: str = "") -> str:
    return (f"""'{{"id":{k},"title":"', {title}, '","href":"https://www.shop.example/a/p/', {PID}, '{k}","price":{{"oldPrice":200,"currentPrice":', {PID}, ',"standardPrice":150}},"""
            f""""rating":"4.50","ratingCount":0,"lojista":"9"{extra}}}'""")


_C_HTML = (
    "concat(html, '<script id=\"__NEXT_DATA__\">{\"props\":{\"pageProps\":{\"initialState\":{\"search\":{\"results\":{\"products\":[', "
    + _product_c(1, "'Geladeira Duplex RT38'") + ", ',', "
    + _product_c(2, "'Item'", ',"categories":[{"name":"Casa","subCategory":[{"name":"Freezer"}]}],"isSponsored":true') + ", ',', "
    + _product_c(3, "'Filtro geladeira'") + ", ']}}}}}}</script>')"
)
# the same products where layout "S" keeps them
_S_HTML = _C_HTML.replace('"initialState":{"search":{"results":{', '"data":{"' + L.PRODUCT_PATHS["S"].split(".")[-2] + '":{').replace("]}}}}}}</script>", "]}}}}}</script>")
_LINKS = (
    f"concat(html, '<a href=\"/x/p/', {PID}, '1/\"><b>TV 43</b> 4,5 (12) R$ 900,00 ou R$ 800,00 no pix 10% de desconto</a>"
    f"<a class=c href=''/x/p/', {PID}, '1/?a=1''>again</a><a href=\"https://www.shop.example/y/p/', {PID}, '2\" aria-label=\"Full TV 50 2025 R$ 1.000,00\"><i>x</i></a>')"
)
_JSONLD = (
    f"concat(html, '<script type=\"application/ld+json\">[{{\"@type\":\"ItemList\",\"itemListElement\":[{{\"item\":{{\"@type\":\"Product\",\"name\":\"TV A\",\"url\":\"/a/p/', {PID}, '1\",\"offers\":{{\"price\":10}}}}}},"
    f"{{\"name\":\"TV B\",\"url\":\"/b/p/', {PID}, '2\"}}]}}]</script><script type=\"application/ld+json\">broken{{</script>"
    f"<script type=\"application/ld+json\">{{\"@type\":\"Product\",\"name\":\"TV C\",\"url\":\"/c/p/', {PID}, '3\"}}</script>')"
)
BASE, PRODUCT = "https://www.shop.example", r"^https://www\.shop\.example/.*/p/"


def pages(spark, sf, html: str):
    return I.table(spark, sf, "pages").selectExpr("page_id", f"{html} AS html")


_BRL = "concat('R$', translate(format('{:,.2f}', cast(%s AS double)), ',.', '.,'))"


_STORE = {
    "retailer": "CASE WHEN page_id % 3 = 0 THEN 'North Shop' ELSE 'south_shop' END", "run_id": "concat('run:', " + I.vc("page_id % 4") + ")",
    "page": "page_id", "listing_mode": "CASE page_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '1' ELSE '4' END",
    "source_url": "CASE page_id % 5 WHEN 0 THEN NULL WHEN 2 THEN 'https://other.example/' ELSE url END", "html": "html",
}


@query("page_store", f"""WITH s AS ({I.select_sql({**_STORE, "url": "url"}, "pages")})
SELECT page AS page_id, retailer, run_id, source_url, length(html) AS n_chars, md5(html) AS html_md5,
 CASE WHEN listing_mode IS NULL THEN 'raw_listing_mode_unverified' WHEN listing_mode <> '4' THEN 'raw_listing_mode_mismatch'
  WHEN source_url <> url THEN 'raw_listing_source_mismatch' ELSE '' END AS reuse_error FROM s""")
def page_store(spark, sf):
    """Every page written to a page folder and read from it again with its side file."""
    stored = I.table(spark, sf, "pages")
    folder = work_dir(spark, "page-store")
    P.write_pages(I.select(stored, _STORE), folder)
    back = P.read_pages(spark, folder, side=True).join(stored.selectExpr("page_id AS page", "url AS asked"), "page")
    error = P.side_error(F.lit("4"), F.col("listing_mode"), F.col("asked"), F.col("source_url"))
    return back.select(
        F.col("page").cast("long").alias("page_id"), "retailer", "run_id", "source_url", F.length("html").alias("n_chars"),
        F.md5("html").alias("html_md5"), error.alias("reuse_error"))


@query("embedded_json", """SELECT page_id, 'linked_data' AS kind, 0 AS pos, 'ItemList' AS block_type FROM pages
UNION ALL SELECT page_id, 'linked_data', 1, 'Product' FROM pages""")
def embedded_json(spark, sf):
    docs = P.embedded_json(pages(spark, sf, _JSONLD), KEYS)
    return docs.select("page_id", "kind", "pos", V.get(F.col("doc"), "$['@type']").alias("block_type"))


@query("listing_layout_m", f"""SELECT page_id, k - 1 AS pos, CASE k WHEN 1 THEN 'Smart TV 50 polegadas & cia' ELSE 'Smart TV 65" 2024' END AS title,
 concat('https://www.shop.example/tv-x/p/', page_id, k, '/?seller_id=s', k) AS product_url, concat(page_id, k) AS item, {_BRL % "(page_id + 0.5)"} AS original_sku_price,
 {_BRL % 'page_id'} AS final_sku_price, CASE k WHEN 3 THEN 'Patrocinado' ELSE '' END AS sku_status, concat('Cupom R$ ', k, ' OFF') AS discount_type,
 CASE k WHEN 1 THEN '50"' ELSE '65"' END AS screen_size, CASE k WHEN 3 THEN '2024' ELSE '' END AS model_year, concat('s', k) AS seller_id
FROM pages, (VALUES (1), (3)) v(k)""")
def listing_layout_m(spark, sf):
    out = L.explode_listing(pages(spark, sf, _M_HTML), KEYS, "M", BASE, "TV")
    return out.select("page_id", "pos", "title", "product_url", "item", "original_sku_price", "final_sku_price",
                      "sku_status", "discount_type", "screen_size", "model_year", "seller_id")


@query("listing_layout_c", f"""SELECT page_id, k - 1 AS pos, CASE k WHEN 1 THEN 'Geladeira Duplex RT38' ELSE 'Item' END AS title,
 concat('https://www.shop.example/a/p/', page_id, k) AS product_url, CASE k WHEN 1 THEN 'RT38' ELSE '' END AS sku, 'R$200,00' AS original_sku_price, {_BRL % 'page_id'} AS final_sku_price,
 'Baixou 25%' AS savings, CASE k WHEN 2 THEN 'Sponsored' ELSE '' END AS sku_status, '4.5' AS star_rating, '0' AS count_of_star_ratings, '9' AS seller_id
FROM pages, (VALUES (1), (2)) v(k)""")
def listing_layout_c(spark, sf):
    out = L.explode_listing(pages(spark, sf, _C_HTML), KEYS, "C", BASE, "REF")
    return out.select("page_id", "pos", "title", "product_url", "sku", "original_sku_price", "final_sku_price",
                      "savings", "sku_status", "star_rating", "count_of_star_ratings", "seller_id")


@query("listing_layout_s", """SELECT page_id, k - 1 AS pos, CASE k WHEN 1 THEN 'Geladeira Duplex RT38' ELSE 'Item' END AS title,
 concat('https://www.shop.example/a/p/', page_id, k) AS product_url, CASE k WHEN 1 THEN 'RT38' ELSE '' END AS sku
FROM pages, (VALUES (1), (2)) v(k)""")
def listing_layout_s(spark, sf):
    out = L.explode_listing(pages(spark, sf, _S_HTML), KEYS, "S", BASE, "REF")
    return out.select("page_id", "pos", "title", "product_url", "sku")


@query("category_tree_haystack", """SELECT page_id, 1 AS pos, 'Casa|Freezer' AS names FROM pages UNION ALL SELECT page_id, 0, '' FROM pages UNION ALL SELECT page_id, 2, '' FROM pages""")
def category_tree_haystack(spark, sf):
    docs = L.product_docs(pages(spark, sf, _C_HTML), KEYS, "C")
    return L.with_categories(docs).select("page_id", "pos", F.array_join("category_names", "|").alias("names"))


_ANCHORS = """SELECT page_id, k AS n, CASE k WHEN 1 THEN 'TV 43' ELSE 'TV 50 2025' END AS title,
 CASE k WHEN 1 THEN concat('https://www.shop.example/x/p/', page_id, '1/') ELSE concat('https://www.shop.example/y/p/', page_id, '2') END AS product_url,
 concat(page_id, k) AS item, CASE k WHEN 1 THEN 'R$ 900,00' ELSE 'R$ 1.000,00' END AS original_sku_price,
 CASE k WHEN 1 THEN 'R$ 800,00' ELSE 'R$ 1.000,00' END AS final_sku_price, CASE k WHEN 1 THEN '10%' ELSE '' END AS savings,
 CASE k WHEN 2 THEN '2025' ELSE '' END AS model_year FROM pages, (VALUES (1), (2)) v(k)"""


@query("anchor_listing", _ANCHORS)
def anchor_listing(spark, sf):
    out = L.anchor_listing(pages(spark, sf, _LINKS), KEYS, BASE, PRODUCT, "TV")
    return out.select("page_id", F.when(F.col("item").endswith("1") & F.col("title").startswith("TV 43"), 1).otherwise(2).alias("n"),
                         "title", "product_url", "item", "original_sku_price", "final_sku_price", "savings", "model_year")


@query("listing_fallback_chain", """SELECT page_id, CASE page_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS priority,
 CASE page_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 2 ELSE 3 END AS n_rows FROM pages""")
def listing_fallback_chain(spark, sf):
    html = f"CASE page_id % 3 WHEN 0 THEN concat({_M_HTML}, {_LINKS}) WHEN 1 THEN concat({_LINKS}, {_JSONLD}) ELSE {_JSONLD} END"
    base = pages(spark, sf, html)
    out = L.listing_with_fallback([
        L.explode_listing(base, KEYS, "M", BASE, "TV"), L.anchor_listing(base, KEYS, BASE, PRODUCT, "TV"),
        L.jsonld_listing(base, KEYS, BASE)], KEYS)
    return out.groupBy("page_id", "priority").agg(F.count(F.lit(1)).alias("n_rows"))


@query("jsonld_listing", """SELECT page_id, CASE k WHEN 1 THEN 'TV A' WHEN 2 THEN 'TV B' ELSE 'TV C' END AS title,
 concat('https://www.shop.example/', CASE k WHEN 1 THEN 'a' WHEN 2 THEN 'b' ELSE 'c' END, '/p/', page_id, k) AS product_url,
 CASE k WHEN 1 THEN '10' ELSE '' END AS final_sku_price FROM pages, (VALUES (1), (2), (3)) v(k)""")
def jsonld_listing(spark, sf):
    out = L.jsonld_listing(pages(spark, sf, _JSONLD), KEYS, BASE)
    return out.select("page_id", "title", "product_url", "final_sku_price")


@query("card_snapshot_merge", f"""SELECT page_id, k - 1 AS pos, 'R$200,00' AS original_sku_price, CASE k WHEN 1 THEN concat('card ', page_id) ELSE '' END AS discount_type
FROM pages, (VALUES (1), (2)) v(k)""")
def card_snapshot_merge(spark, sf):
    base = pages(spark, sf, _C_HTML)
    rows = L.explode_listing(base, KEYS, "C", BASE, "REF")
    cards = base.selectExpr(
        "page_id", "posexplode(array(concat('https://WWW.shop.example/a/p/', page_id, '1/?utm_source=x'), concat('https://www.shop.example/a/p/', page_id, '1'))) AS (pos, product_url)")
    cards = cards.selectExpr("page_id", "pos", "product_url", "'R$1,00' AS original_sku_price",
                             "CASE pos WHEN 0 THEN concat('card ', page_id) ELSE 'second' END AS discount_type")
    return L.merge_card_snapshots(rows, cards, KEYS).select("page_id", "pos", "original_sku_price", "discount_type")


@query("listing_from_capture", """WITH p AS (SELECT page_id, page_id // 5 AS capture, page_id % 5 AS entry FROM pages WHERE page_id % 5 IN (1, 2, 4)),
b AS (SELECT capture, min(entry) AS entry FROM p WHERE entry <> 4 GROUP BY capture)
SELECT capture, entry AS index, k AS pos, concat('TV ', entry, k) AS title FROM b, (VALUES (0), (1)) v(k)""")
def listing_from_capture(spark, sf):
    entries = I.table(spark, sf, "pages").selectExpr(
        "page_id div 5 AS capture", "cast(page_id % 5 AS int) AS index", "CASE WHEN page_id % 5 = 0 THEN 'POST' ELSE 'GET' END AS method",
        "CASE WHEN page_id % 5 = 3 THEN 'https://shop.example/x' ELSE 'https://shop.example/busca/tv' END AS url", "'text/HTML' AS mime",
        "concat(html, '<script id=\"__NEXT_DATA__\">{\"props\":{\"pageProps\":{\"data\":{\"search\":{\"products\":[{\"title\":\"TV ', page_id % 5, '0\",\"path\":\"/p/1/\"}', "
        "CASE WHEN page_id % 5 = 4 THEN '' ELSE concat(',{\"title\":\"TV ', page_id % 5, '1\",\"path\":\"/p/2/\"}') END, ']}}}}}</script>') AS text")
    out = L.listing_from_capture(entries, ["capture"], "/busca/tv", "M", BASE, "TV")
    return out.select("capture", "index", "pos", "title")


# ---- image requests: every order line is one request --------------------------------------------------

_REQ = {
    "run": "l_linestatus", "seq": "l_orderkey * 10 + l_linenumber",
    "url": f"concat(CASE WHEN l_linenumber = 7 THEN 'https://other.example' ELSE 'https://img.shop.example' END, '/', CASE WHEN l_linenumber = 6 THEN 'logo' ELSE '450x450' END, '/', "
           f"CASE WHEN l_linenumber = 5 THEN 'geladeira' ELSE concat('smart-tv-', {I.vc('l_partkey')}) END, '/s', {I.vc('l_suppkey')}, '/', {I.vc('l_partkey')}, '/a.jpg?x=1')",
}


@query("listing_from_image_requests", f"""WITH r AS ({I.select_sql(_REQ, 'lineitem')}),
p AS (SELECT run, min(seq) AS seq, slug, seller, product_id FROM (SELECT run, seq, split_part(url, '/', 5) AS slug, split_part(url, '/', 6) AS seller, split_part(url, '/', 7) AS product_id
 FROM r WHERE url LIKE 'https://img.shop.example/450x450/smart-tv-%') GROUP BY run, slug, seller, product_id)
SELECT run, slug, seller, product_id, row_number() OVER (PARTITION BY run ORDER BY seq, slug, seller, product_id) AS main_rank FROM p""")
def listing_from_image_requests(spark, sf):
    rows = I.select(I.table(spark, sf, "lineitem"), _REQ)
    out = L.image_listing(rows, ["run"], "seq", ["img.shop.example"])
    return out.select("run", "slug", "seller", "product_id", "main_rank")


column_query("listing_sku", "part", ["p_partkey"],
             {"line": I.LINE, "k": "p_size % 4", "n": I.vc("1000 + p_partkey"),
              "title": "concat(p_name, CASE p_size % 4 WHEN 0 THEN ' 127V 12kg 2025 4K ' WHEN 1 THEN ' LG-' ELSE ' BRM' END, " + I.vc("1000 + p_partkey") + ", CASE p_size % 4 WHEN 0 THEN 'W' ELSE 'A HDR10' END)"},
             {"sku": (lambda c: L.D.listing_model(c["title"], c["line"]),
                      "CASE k WHEN 0 THEN CASE WHEN line = 'TV' THEN '127V' ELSE '' END WHEN 1 THEN concat('LG-', n, 'A') ELSE concat('BRM', n, 'A') END")})
