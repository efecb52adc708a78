"""Queries for relevance rules, title classes and page usability."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import relevance as R
from vitrine.plans import inputs as I
from vitrine.plans.registry import column_query

KEY = ["p_partkey"]
_LINE = {"product_line": I.LINE}
_M_TITLE = (
    "CASE WHEN p_type IN ('ECONOMY','PROMO') THEN CASE p_size % 6 WHEN 0 THEN 'Suporte para TV 55' WHEN 1 THEN concat('Smart TV ', p_name) "
    "WHEN 2 THEN concat('Controle ', p_name) WHEN 3 THEN concat('Monitor LED 43\" ', p_name) ELSE concat('Caixa ', p_name) END "
    "WHEN p_type IN ('LARGE','MEDIUM') THEN CASE p_size % 3 WHEN 0 THEN concat('Geladeira ', p_name) WHEN 1 THEN 'Filtro para geladeira' ELSE p_name END "
    "ELSE CASE p_size % 3 WHEN 0 THEN concat('Lavadora ', p_name) WHEN 1 THEN 'Kit lavadora' ELSE concat('Máquina de Lavar ', p_name) END END"
)
_M_PATH = "CASE WHEN p_size % 6 = 4 THEN '/x/et/tv4k/' WHEN p_size % 6 = 3 THEN '/x/et/suar/' ELSE concat('/', replace(p_name, ' ', '-'), '/') END"
column_query(
    "relevant_layout_m", "part", KEY,
    {**_LINE, "title": _M_TITLE, "path": _M_PATH, "category": "CASE WHEN p_size % 12 = 11 THEN 'tled' ELSE '' END", "n": "p_size"},
    {"relevant": (lambda c: R.relevant_layout_m(c["title"], c["path"], c["category"], c["product_line"]).cast("int"),
                  "CASE product_line WHEN 'TV' THEN CASE WHEN title LIKE 'Suporte%' THEN 0 WHEN category = 'tled' OR contains(path, 'tv4k') THEN 1 "
                  "WHEN title LIKE 'Smart TV%' OR title LIKE 'Monitor LED 43%' THEN 1 ELSE 0 END "
                  "WHEN 'REF' THEN CASE WHEN n % 3 = 0 THEN 1 ELSE 0 END ELSE CASE WHEN n % 3 = 1 THEN 0 ELSE 1 END END")},
)
_C_CATS = "CASE WHEN p_size % 4 = 0 THEN 'Televisões' WHEN p_size % 4 = 1 THEN 'Geladeiras e Freezer' WHEN p_size % 4 = 2 THEN 'Lavadora' ELSE 'Outros' END"
column_query(
    "relevant_layout_c", "part", KEY,
    {**_LINE, "title": "CASE WHEN p_size % 5 = 0 THEN concat('Rack ', p_name) WHEN p_size % 5 = 1 THEN concat('Mangueira e gaveta ', p_name) "
                       "WHEN p_size % 5 = 2 THEN concat('Televisor ', p_name) ELSE p_name END",
     "cats": _C_CATS, "n": "p_size"},
    {"relevant": (lambda c: R.relevant_layout_c(
        c["title"], F.concat_ws(" ", c["title"], c["cats"]), F.array(c["cats"]), c["product_line"]).cast("int"),
        "CASE product_line WHEN 'TV' THEN CASE WHEN title LIKE 'Rack%' THEN 0 WHEN title LIKE 'Televisor%' OR cats LIKE 'Telev%' THEN 1 ELSE 0 END "
        "WHEN 'REF' THEN CASE WHEN title NOT LIKE 'Mangueira%' AND cats LIKE 'Gelad%' THEN 1 ELSE 0 END "
        "ELSE CASE WHEN title NOT LIKE 'Mangueira%' AND cats = 'Lavadora' THEN 1 ELSE 0 END END")},
)
column_query(
    "product_title_for_line", "part", KEY,
    {**_LINE, "n": "p_size",
     "title": f"concat(CASE p_size % 4 WHEN 0 THEN 'Prateleira painel suporte ' ELSE '' END, CASE {I.LINE} WHEN 'TV' THEN CASE p_size % 6 WHEN 1 THEN 'TV Box ' ELSE 'Smart TV55 ' END "
              "WHEN 'REF' THEN 'Geladeira ' ELSE CASE p_size % 6 WHEN 1 THEN 'Lavadora de louças ' ELSE 'Máquina de lavar ' END END, p_name, ' com filtro e suporte')"},
    {"is_product": (lambda c: R.is_product_title(c["title"], c["product_line"]).cast("int"),
                    "CASE WHEN n % 4 = 0 THEN 0 WHEN n % 6 = 1 AND product_line IN ('TV', 'LDY') THEN 0 ELSE 1 END")},
)
column_query(
    "standalone_dryer", "part", KEY,
    {"n": "p_size", "title": "concat(CASE p_size % 3 WHEN 0 THEN 'Secadora de roupas ' WHEN 1 THEN 'Lava e Seca secadora ' ELSE 'Lavadora ' END, p_name)"},
    {"dryer": (lambda c: R.is_standalone_dryer(c["title"]).cast("int"), "CASE WHEN n % 3 = 0 THEN 1 ELSE 0 END")},
)
column_query(
    "similar_titles", "part", KEY,
    {**_LINE, "a": "concat('Smart TV ', p_name)", "b": "concat('Freezer ', p_name)", "c": "concat('Lavadora ', p_name)"},
    {"similar": (lambda c: F.array_join(R.similar_titles(F.array(c["a"], c["b"], c["c"], c["a"], F.lit("")), c["product_line"]), "|"),
                 "CASE product_line WHEN 'TV' THEN a WHEN 'REF' THEN b ELSE c END")},
)
column_query(
    "blocked_page", "pages", ["page_id"],
    {"html": "CASE WHEN page_id % 5 = 1 THEN concat(html, '<p>Não é possível acessar a página</p>') WHEN page_id % 5 = 2 THEN concat(html, 'CAPTCHA __NEXT_DATA__ pageProps') ELSE html END",
     "status": "CASE WHEN page_id % 5 = 3 THEN 403 ELSE 200 END"},
    {"reason": (lambda c: R.blocked_reason(c["html"], c["status"]),
                "CASE WHEN contains(lower(html), '__next_data__') THEN '' WHEN status = 403 THEN 'status_403' "
                + "".join(f"WHEN contains(strip_accents(lower(html)), '{m}') THEN '{m}' " for m in R.BLOCK_MARKERS) + "ELSE '' END")},
)
column_query(
    "sponsored_status", "events", ["event_id"],
    {"layout": "CASE WHEN user_id % 2 = 0 THEN 'M' ELSE 'C' END", "flag": "event_type = 'view'",
     "label": "CASE event_type WHEN 'click' THEN 'Anúncio patrocinado' WHEN 'view' THEN '' ELSE 'novo' END",
     "ad_seller": "CASE WHEN event_type = 'error' THEN 's1' ELSE '' END"},
    {"sku_status": (lambda c: R.sku_status(c["layout"], c["flag"], c["label"], c["ad_seller"]),
                    "CASE WHEN layout = 'M' THEN CASE WHEN flag OR ad_seller <> '' THEN 'Patrocinado' WHEN contains(label, 'patroc') THEN label ELSE '' END "
                    "ELSE CASE WHEN flag OR contains(label, 'patroc') THEN 'Sponsored' ELSE '' END END")},
)
