"""Queries for the scalar functions, each over a whole driver table."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import metrics as X
from vitrine.functions import money as M
from vitrine.functions import text as T
from vitrine.functions import translate as R
from vitrine.functions import urls as U
from vitrine.functions import validators as V
from vitrine.plans.registry import column_query

LI = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
DOC = ["doc_id"]
EV = ["event_id"]


def vc(expr: str) -> str:
    return f"cast({expr} AS varchar(40))"


def money(expr: str) -> str:
    return vc(f"cast({expr} AS decimal(14,2))")


# ---- normalisation -----------------------------------------------------------------------

_ENT = "replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')"
column_query(
    "clean_text", "pages", ["page_id"], {"html": "html"},
    {"text_md5": (lambda c: F.md5(T.clean_text(c["html"])),
                  f"md5(trim(regexp_replace({_ENT}, '\\s+', ' ', 'g')))"),
     "text_length": (lambda c: F.length(T.clean_text(c["html"])),
                     f"length(trim(regexp_replace({_ENT}, '\\s+', ' ', 'g')))")},
)
# character references as pages have them: without semicolon, doubly escaped, Windows-1252 numbers, numbers of no character
_ODD = ("&copy b", "&amp y", "&#39 z", "a &gt", "&notit;", "&#150;", "&#x80;", "&#0;", "&amp;lt;")
_ODD_READ = ("\u00a9 b", "& y", "' z", "a >", "\u00acit;", "\u2013", "\u20ac", "\ufffd", "&lt;")
_odd = lambda texts: "CASE doc_id % 9 " + " ".join(f"WHEN {i} THEN '{t.replace(chr(39), chr(39) * 2)}'" for i, t in enumerate(texts)) + " END"
column_query("odd_entities", "documents", ["doc_id"], {"text": f"concat(lang, ' ', {_odd(_ODD)})", "want": f"concat(lang, ' ', {_odd(_ODD_READ)})"},
             {"read": (lambda c: T.clean_text(c["text"]), "want")})
_KEY = "trim(regexp_replace(replace(strip_accents(lower(text)), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g'))"
column_query(
    "normalize_key", "documents", DOC, {"text": "text"},
    {"key_md5": (lambda c: F.md5(T.key_text(c["text"])), f"md5({_KEY})")},
)
column_query(
    "ascii_fold", "documents", DOC, {"text": "text"},
    {"folded_md5": (lambda c: F.md5(T.ascii_fold(c["text"])),
                    "md5(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g'))")},
)

# ---- URLs ----------------------------------------------------------------------------------

_BARE = "regexp_replace(url, '#.*$', '')"
_PATHQ = f"regexp_replace(rtrim(split_part({_BARE}, '?', 1), '/'), '^http', 'http')"
_KEPT = (
    f"array_to_string(list_filter(string_split(split_part({_BARE}, '?', 2), '&'), "
    "lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_')), '&')"
)
column_query(
    "normalized_url", "pages", ["page_id"], {"url": "url"},
    {"norm_url": (lambda c: U.normalized_url(c["url"]),
                  f"{_PATHQ} || CASE WHEN {_KEPT} <> '' THEN '?' || {_KEPT} ELSE '' END")},
)
_LURL = (
    "concat('https://Shop.example/x/', CASE WHEN l_linenumber = 1 THEN 'c' ELSE 'p' END, '/', "
    f"{vc('l_partkey')}, '/?skuId=', {vc('l_suppkey')}, '&seller_id=s', {vc('l_linenumber')})"
)
_PATH_ITEM = "CASE WHEN contains(url, '/p/') THEN split_part(split_part(url, '/p/', 2), '/', 1) ELSE '' END"
column_query(
    "item_from_url", "lineitem", LI, {"url": _LURL},
    {"item": (lambda c: U.item_from_url(c["url"]), _PATH_ITEM)},
)
column_query(
    "sku_from_url", "lineitem", LI, {"url": _LURL},
    {"sku": (lambda c: U.sku_from_url(c["url"]),
             "CASE WHEN contains(url, '/p/') THEN split_part(split_part(url, '/p/', 2), '/', 1) "
             "ELSE regexp_extract(url, 'skuId=([^&]+)', 1) END")},
)
column_query(
    "seller_from_url", "lineitem", LI, {"url": _LURL},
    {"seller": (lambda c: U.seller_from_url(c["url"]), "split_part(url, 'seller_id=', 2)")},
)
column_query(
    "url_item_key", "lineitem", LI,
    {"url": f"concat(CASE WHEN l_linenumber = 2 THEN 'https://other.example' ELSE 'https://www.Shop.example' END, "
            f"'/x/p/A', {vc('l_partkey')}, '/')",
     "item": f"CASE WHEN l_suppkey = l_partkey THEN 'zz' WHEN l_linenumber = 3 THEN '' ELSE concat('a', {vc('l_partkey')}) END"},
    {"item_key": (lambda c: U.url_item_key(c["url"], c["item"], ["shop.example"]),
                  "CASE WHEN contains(url, 'other') OR item = 'zz' THEN '' "
                  "ELSE lower(split_part(split_part(url, '/p/', 2), '/', 1)) END")},
)
column_query(
    "page_url", "events", EV,
    {"base": f"concat('https://shop.example/busca?page=1&sort=', event_type)", "page": "user_id"},
    {"listing_url": (lambda c: U.page_url(c["base"], c["page"]),
                     "CASE WHEN page <= 1 THEN base ELSE concat('https://shop.example/busca?sort=', "
                     "split_part(base, 'sort=', 2), '&page=', page) END")},
)
_ACC = ("CASE o_orderstatus WHEN 'F' THEN 'Magazine Luiza' WHEN 'O' THEN 'CasasBahia.com.br' "
        "ELSE 'Other Shop' END")
column_query(
    "account_name", "orders", ["o_orderkey"], {"retailer": _ACC},
    {"account_key": (lambda c: U.canonical_retailer(c["retailer"]),
                     "CASE WHEN retailer LIKE 'Mag%' THEN 'magalu' WHEN retailer LIKE 'Casas%' THEN 'casas_bahia' ELSE '' END"),
     "account_name": (lambda c: U.account_name(c["retailer"], F.lit("")),
                      "CASE WHEN retailer LIKE 'Mag%' THEN 'Magalu' WHEN retailer LIKE 'Casas%' THEN 'CasasBahia' ELSE retailer END")},
)
column_query(
    "url_matches_id", "lineitem", LI,
    {"url": _LURL, "payload_id": f"CASE WHEN l_linenumber < 4 THEN {vc('l_partkey')} ELSE {vc('l_suppkey')} END"},
    {"matches": (lambda c: U.url_matches_id(c["url"], c["payload_id"]).cast("int"),
                 "CASE WHEN payload_id = CASE WHEN contains(url, '/p/') THEN split_part(split_part(url, '/p/', 2), '/', 1) "
                 "ELSE regexp_extract(url, 'skuId=([^&]+)', 1) END THEN 1 ELSE 0 END")},
)

# ---- money ----------------------------------------------------------------------------------

PRICE = money("l_extendedprice")
_CENTS = "cast(round(l_extendedprice * 100) AS bigint)"
_LESS = f"({_CENTS} - cast(floor({_CENTS} * cast(round(100 * l_discount) AS int) / 100.0) AS bigint))"
FINAL = f"concat({vc(f'cast(floor({_LESS} / 100.0) AS bigint)')}, '.', lpad({vc(f'{_LESS} % 100')}, 2, '0'))"
_BRL = "concat('R$', translate(format('{:,.2f}', cast(%s AS double)), ',.', '.,'))"
_brl = lambda col: _BRL % col
column_query(
    "format_brl", "lineitem", LI,
    {"price": f"CASE WHEN l_linenumber = 7 THEN 'sob consulta' WHEN l_linenumber = 6 THEN '' ELSE {PRICE} END"},
    {"brl": (lambda c: M.format_brl(c["price"]),
             f"CASE WHEN price IN ('', 'sob consulta') THEN price ELSE {_BRL % 'try_cast(price AS double)'} END")},
)
_BRLTXT = f"concat('R$ ', {vc('cast(floor(l_extendedprice) AS bigint)')}, ',', {vc('10 + l_linenumber')}, ' cada')"
column_query(
    "price_number", "lineitem", LI,
    {"price": f"CASE WHEN l_linenumber = 1 THEN {PRICE} WHEN l_linenumber = 2 THEN 'gratis' ELSE {_BRLTXT} END"},
    {"number": (lambda c: M.price_number(c["price"]).cast("double"),
                "try_cast(CASE WHEN contains(price, ',') THEN replace(replace(regexp_replace(price, '[^0-9,.-]', '', 'g'), '.', ''), ',', '.') "
                "ELSE regexp_replace(price, '[^0-9,.-]', '', 'g') END AS double)")},
)
column_query(
    "price_for_output", "lineitem", LI,
    {"price": f"CASE WHEN l_linenumber = 1 THEN 'R$ 1' WHEN l_linenumber = 2 THEN 'R$1.234,56' ELSE {PRICE} END"},
    {"shown": (lambda c: M.price_for_output(c["price"]),
               f"CASE WHEN price LIKE 'R$%' THEN price ELSE {_BRL % 'try_cast(price AS double)'} END")},
)
column_query(
    "original_price_blank_when_equal", "lineitem", LI,
    {"original": PRICE, "final": f"concat('R$ ', replace({FINAL}, '.', ','))"},
    {"original_price": (lambda c: M.original_for_output(c["original"], c["final"]),
                        "CASE WHEN cast(original AS decimal(14,2)) = cast(replace(substr(final, 4), ',', '.') AS decimal(14,2)) "
                        "THEN '' ELSE original END")},
)
column_query(
    "discount_percent", "lineitem", LI, {"old": PRICE, "final": FINAL},
    {"percent": (lambda c: M.discount_percent(c["old"], c["final"]),
                 "CASE WHEN cast(final AS double) < cast(old AS double) AND cast(final AS double) > 0 THEN "
                 "cast(round_even((cast(old AS double) - cast(final AS double)) / cast(old AS double) * 100, 0) AS int) END")},
)
column_query(
    "offer_discount_rate", "lineitem", LI,
    {"old": PRICE, "current": FINAL,
     "explicit": f"CASE WHEN l_linenumber = 1 THEN concat('-', {vc('l_suppkey')}) WHEN l_linenumber = 2 THEN '0.4' ELSE '' END"},
    {"rate": (lambda c: M.offer_discount_rate(c["explicit"], c["old"], c["current"]),
              "CASE WHEN explicit <> '' THEN CASE WHEN abs(cast(explicit AS double)) >= 1 THEN cast(round(abs(cast(explicit AS double))) AS int) END "
              "WHEN cast(current AS double) < cast(old AS double) AND (cast(old AS decimal(14,2)) - cast(current AS decimal(14,2))) * 100 >= cast(old AS decimal(14,2)) "
              "THEN cast(round((cast(old AS double) - cast(current AS double)) / cast(old AS double) * 100) AS int) END")},
)
_PCT = "cast(round(100 * l_discount) AS int)"
column_query(
    "savings_text", "lineitem", LI,
    {"layout": "CASE WHEN l_linenumber = 5 THEN 'M' ELSE 'C' END", "p": vc(_PCT),
     "savings": f"CASE WHEN l_linenumber = 1 THEN concat('baixou ', {vc(_PCT)}, ',5% hoje') "
                f"WHEN l_linenumber = 2 THEN concat({vc(_PCT)}, ',5%') WHEN l_linenumber = 3 THEN 'oferta' ELSE '' END"},
    {"listing_savings": (lambda c: M.listing_savings(F.lit(""), F.lit(None).cast("string"), F.lit(None).cast("string"), c["p"]),
                         "CASE WHEN p = '0' THEN '' ELSE concat('Baixou ', p, '%') END"),
     "published_savings": (lambda c: M.savings_for_output(c["savings"], c["layout"]),
                           "CASE WHEN layout = 'M' THEN '' WHEN contains(savings, 'hoje') OR savings LIKE '%,5%%' THEN concat('Baixou ', p, '.5%') ELSE savings END")},
)
column_query(
    "discount_type_for_output", "lineitem", LI,
    {"p": vc(_PCT),
     "discount": f"concat({vc(_PCT)}, CASE l_linenumber WHEN 1 THEN '% OFF' WHEN 2 THEN '% de desconto' WHEN 3 THEN '% discount' "
                 "WHEN 4 THEN '% desconto' WHEN 5 THEN ' reais' ELSE '% off no pix' END)"},
    {"discount_type": (lambda c: M.discount_type_for_output(c["discount"]),
                       "CASE WHEN contains(discount, 'reais') OR contains(discount, 'pix') THEN discount ELSE concat(p, '% discount off') END")},
)
column_query(
    "coupon_text", "lineitem", LI,
    {"amount": vc("cast(l_quantity AS int)"),
     "kind": "CASE WHEN l_linenumber = 6 THEN 'badge' WHEN l_linenumber = 5 THEN 'COUPON ' ELSE 'coupon' END"},
    {"coupon": (lambda c: M.coupon_text(F.array(
        F.struct(c["kind"].alias("type"), c["amount"].alias("discountValue"), F.lit("x").alias("message")),
        F.struct(F.lit("coupon").alias("type"), F.lit("12.5").alias("discountValue"), F.lit("").alias("message")),
        F.struct(F.lit("coupon").alias("type"), F.lit(None).cast("string").alias("discountValue"), F.lit(" Leve  2 ").alias("message")))),
        "concat(CASE WHEN kind = 'badge' THEN '' ELSE concat('Cupom R$ ', amount, ' OFF; ') END, 'Cupom R$ 12,5 OFF; Leve 2')")},
)
column_query(
    "coupon_checked", "lineitem", LI,
    {"seller": vc("l_suppkey"), "wanted": f"CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber = 2 THEN 'zz' ELSE {vc('l_suppkey')} END"},
    {"checked": (lambda c: M.coupon_result(
        F.when(c["seller"] != "7", F.array().cast("array<struct<type:string,discountValue:string,message:string>>")),
        c["seller"], c["wanted"])["checked"].cast("int"),
        "CASE WHEN seller <> '7' AND wanted <> 'zz' THEN 1 ELSE 0 END")},
)
column_query(
    "promotion_badge", "lineitem", LI,
    {"p": vc(_PCT), "flag": f"CASE WHEN l_linenumber < 4 THEN concat('Cupom de ', {vc(_PCT)}, ',50 %') ELSE 'Cupom surpresa' END",
     "title": f"concat({vc(_PCT)}, '% de desconto')"},
    {"badge": (lambda c: M.badge_discounts(F.array(
        F.struct(c["flag"].alias("flag"), F.lit("").alias("title"), F.lit("").alias("text")),
        F.struct(F.lit("").alias("flag"), c["title"].alias("title"), F.lit("7,0% de desconto").alias("text")))),
        "CASE WHEN contains(flag, '%') THEN concat('USE O CUPOM DESCONTO ', p, '.5%') "
        "WHEN p = '7' THEN '7% de desconto' ELSE concat(p, '% de desconto; 7% de desconto') END")},
)
column_query(
    "ambiguous_discount", "lineitem", LI,
    {"discount": f"CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN concat('use o cupom desconto ', {vc(_PCT)}, '%') "
                 f"WHEN 3 THEN concat({vc(_PCT)}, '% off') WHEN 4 THEN 'novo cupom' ELSE 'oferta' END"},
    {"ambiguous": (lambda c: M.discount_is_ambiguous(c["discount"]).cast("int"),
                   "CASE WHEN discount = '' OR contains(discount, 'off') OR discount = 'novo cupom' THEN 1 ELSE 0 END")},
)
_CARD = (
    f"concat('Full TV ', {vc('l_partkey')}, ' 4,', {vc('l_linenumber')}, ' (1.', {vc('100 + l_suppkey')}, ') R$ ', "
    f"{vc('cast(floor(l_extendedprice) AS bigint)')}, ',00 ou R$ ', {vc('cast(l_quantity AS bigint)')}, ',90 ', "
    "CASE WHEN l_linenumber < 4 THEN 'no pix R$ 5,00 ' ELSE 'em 10x ' END, "
    f"{vc(_PCT)}, '% de desconto Cupom R$ 50 OFF')"
)
column_query(
    "card_phrases", "lineitem", LI,
    {"card": _CARD, "e": vc("cast(floor(l_extendedprice) AS bigint)"), "q": vc("cast(l_quantity AS bigint)"),
     "p": vc(_PCT), "k": vc("l_partkey"), "n": vc("l_linenumber"), "s": vc("100 + l_suppkey")},
    {"original": (lambda c: M.card_prices(c["card"])["original"], "concat('R$ ', e, ',00')"),
     "final": (lambda c: M.card_prices(c["card"])["final"], "concat('R$ ', q, ',90')"),
     "rating": (lambda c: M.card_rating(c["card"])["rating"], "concat('4.', n)"),
     "rating_count": (lambda c: M.card_rating(c["card"])["count"], "concat('1.', s)"),
     "savings": (lambda c: M.card_savings(c["card"]), "concat(p, '%')"),
     "discounts": (lambda c: M.card_discounts(c["card"]), "concat('Cupom R$ 50 OFF; ', p, '% de desconto')"),
     "name": (lambda c: M.card_name(c["card"]), "concat('TV ', k)")},
)

# ---- counts, ratings, short texts ---------------------------------------------------------------

column_query(
    "star_rating", "events", EV,
    {"rating": f"CASE event_type WHEN 'error' THEN 'nan' WHEN 'click' THEN 'bom' ELSE replace({money('value / 80')}, '.', ',') END"},
    {"star_rating": (lambda c: X.star_rating(c["rating"]),
                     "CASE rating WHEN 'nan' THEN '0' WHEN 'bom' THEN 'bom' ELSE "
                     "regexp_replace(cast(cast(cast(replace(rating, ',', '.') AS decimal(10,2)) AS decimal(10,1)) AS varchar), '\\.0$', '') END")},
)
column_query(
    "count_metric", "events", EV,
    {"n": f"cast(floor(value) AS bigint)",
     "metric": f"CASE event_type WHEN 'error' THEN '' WHEN 'click' THEN concat({vc('cast(floor(value) AS bigint)')}, '.000 avaliacoes') "
               f"WHEN 'view' THEN concat('1.', {vc('100 + cast(floor(value) AS bigint)')}, ',50') ELSE {vc('cast(floor(value) AS bigint)')} END"},
    {"metric_text": (lambda c: X.count_metric(c["metric"]),
                     "CASE WHEN metric = '' THEN '0' WHEN contains(metric, 'aval') THEN cast(n * 1000 AS varchar) "
                     "WHEN contains(metric, ',50') THEN concat(cast(1100 + n AS varchar), '.5') ELSE cast(n AS varchar) END"),
     "kept_blank": (lambda c: X.count_metric(c["metric"], F.lit(True)),
                    "CASE WHEN metric = '' THEN '' WHEN contains(metric, 'aval') THEN cast(n * 1000 AS varchar) "
                    "WHEN contains(metric, ',50') THEN concat(cast(1100 + n AS varchar), '.5') ELSE cast(n AS varchar) END")},
)
column_query(
    "review_count_failed", "events", EV,
    {"status": f"CASE WHEN event_type = 'error' THEN concat('ok+reviews_graphql_failed:', {vc('user_id')}) ELSE 'xreviews_graphql_failed:+ok' END"},
    {"failed": (lambda c: T.has_token_prefix(c["status"], "reviews_graphql_failed:").cast("int"),
                "CASE WHEN starts_with(status, 'ok+') THEN 1 ELSE 0 END")},
)
column_query(
    "digits_int", "events", EV, {"text": f"concat('4.', {vc('user_id')}, ' de ', event_type)"},
    {"digits": (lambda c: X.digits_int(c["text"]).cast("long"),
                "cast(regexp_replace(text, '[^0-9]', '', 'g') AS bigint)")},
)
column_query(
    "zero_preserving_metric", "events", EV,
    {"metric": f"CASE event_type WHEN 'error' THEN '0,0' WHEN 'click' THEN 'n/a' ELSE {money('value')} END"},
    {"metric_text": (lambda c: X.zero_preserving(c["metric"]),
                     "CASE metric WHEN '0,0' THEN '0' WHEN 'n/a' THEN 'n/a' ELSE "
                     "regexp_replace(regexp_replace(metric, '(\\.\\d*?)0+$', '\\1'), '\\.$', '') END")},
)
column_query(
    "recommendation_percent", "events", EV,
    {"text": f"CASE WHEN event_type = 'view' THEN 'sem dados' ELSE concat({vc('cast(floor(value) AS bigint)')}, ',9% recomendam') END",
     "n": vc("cast(floor(value) AS bigint)")},
    {"recommendation": (lambda c: X.recommendation_percent(c["text"]),
                        "CASE WHEN text = 'sem dados' THEN text ELSE concat(n, '% recomendam') END")},
)
column_query(
    "screen_size_output", "part", ["p_partkey"],
    {"n": vc("p_size + 10"),
     "size": f"concat({vc('p_size + 10')}, CASE p_type WHEN 'ECONOMY' THEN ' polegadas' WHEN 'PROMO' THEN '\"' WHEN 'LARGE' THEN '' WHEN 'SMALL' THEN ' cm' ELSE ' pol.' END)"},
    {"screen_size": (lambda c: X.screen_size_for_output(c["size"]),
                     "CASE WHEN contains(size, 'cm') THEN size ELSE concat(n, ' inches') END")},
)
_LIST = (
    "CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN concat('[\"A', %s, '\",\"\",{\"name\":\" B \"}]') "
    "WHEN 3 THEN concat('A', %s, ' ||| B ||| ') WHEN 4 THEN concat('{\"title\":\"A', %s, '\"}') "
    "WHEN 5 THEN concat('[A', %s) ELSE concat('A', %s) END"
) % ((vc("l_partkey"),) * 5)
column_query(
    "as_list", "lineitem", LI, {"k": vc("l_partkey"), "list_text": _LIST},
    {"items": (lambda c: F.array_join(T.as_list(c["list_text"]), "#"),
               "CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN concat('A', k, '#B') WHEN 3 THEN concat('A', k, '#B |||') "
               "WHEN 5 THEN concat('[A', k) ELSE concat('A', k) END")},
)
column_query(
    "join_values_without_noise", "lineitem", LI,
    {"k": vc("l_partkey"), "list_text": f"concat('Digite seu CEP ||| A', {vc('l_partkey')}, ' ||| Cadastre-se agora ||| B')"},
    {"joined": (lambda c: T.join_values(c["list_text"], drop_noise=True), "concat('A', k, ' ||| B')")},
)
column_query(
    "synthetic_summary", "documents", DOC,
    {"summary": f"CASE WHEN lang = 'en' THEN concat('ok ||| Comments: ', {vc('n_chars')}) ELSE concat('Boa compra ', source) END"},
    {"summary_text": (lambda c: T.summary_text(c["summary"]),
                      "CASE WHEN contains(summary, '|||') THEN '' ELSE summary END")},
)
column_query(
    "delivery_cleanup", "documents", DOC,
    {"layout": "CASE WHEN lang = 'en' THEN 'M' ELSE 'C' END",
     "delivery": "CASE WHEN n_chars > 400 THEN 'O cálculo de frete apresentou problemas' ELSE concat(' Receba ', source) END"},
    {"delivery_availability": (lambda c: X.delivery_for_output(c["delivery"], c["layout"]),
                               "CASE WHEN layout = 'C' AND contains(delivery, 'frete') THEN '' ELSE trim(delivery) END")},
)
column_query(
    "pickup_deadline", "events", EV,
    {"formatted": "CASE WHEN event_type = 'view' THEN ' 2 dias ' ELSE '' END",
     "hours": f"CASE WHEN event_type = 'click' THEN {vc('user_id')} ELSE '' END",
     "days": f"CASE WHEN event_type = 'error' THEN '' ELSE {vc('user_id')} END"},
    {"pickup": (lambda c: X.pickup_deadline(c["formatted"], c["hours"], c["days"]),
                "CASE WHEN formatted <> '' THEN 'Retira Rapido Retirar em 2 dias' WHEN hours <> '' THEN concat('Retira Rapido Retirar em ', hours, 'h') "
                "WHEN days <> '' THEN concat('Retira Rapido Retirar em ', days, ' dias') ELSE '' END")},
)

# ---- tokens, time, classes -------------------------------------------------------------------------

column_query(
    "append_token", "events", EV, {"status": "concat('listing+', event_type, '+')"},
    {"status_tokens": (lambda c: T.append_token(c["status"], "view"),
                       "CASE WHEN contains(status, 'view') THEN 'listing+view' ELSE concat(status, 'view') END")},
)
column_query(
    "replace_token_family", "events", EV,
    {"status": "concat('model_', event_type, '+listing+model_x')"},
    {"status_tokens": (lambda c: T.replace_token_family(c["status"], "model_", "model_html"), "'listing+model_html'")},
)
column_query(
    "run_stamps", "orders", ["o_orderkey"], {"ts": "o_orderdate", "layout": "CASE WHEN o_orderstatus = 'F' THEN 'M' ELSE 'C' END"},
    {"calendar_week": (lambda c: X.iso_week(c["ts"]), "concat('w', week(ts))"),
     "crawl_strdatetime": (lambda c: X.crawl_time(c["ts"]), "strftime(ts, '%Y-%m-%d %H:%M:%S')"),
     "batch_id": (lambda c: X.batch_id(c["ts"], c["layout"]),
                  "concat(CASE WHEN layout = 'M' THEN 'm_' ELSE 'c_' END, strftime(ts, '%Y%m%d_%H%M%S'))")},
)
column_query(
    "model_year", "orders", ["o_orderkey"],
    {"title": f"concat('TV ', {vc('year(o_orderdate)')}, ' 20', {vc('10 + o_custkey % 40')}, ' 2009')",
     "y": "2010 + o_custkey % 40"},
    {"model_year": (lambda c: T.model_year(c["title"]),
                    "CASE WHEN y <= 2039 THEN cast(y AS varchar) ELSE '' END")},
)
column_query(
    "colour_word", "part", ["p_partkey"],
    {"title": "concat(p_name, CASE p_type WHEN 'ECONOMY' THEN ' Inoxidavel' WHEN 'PROMO' THEN ' titânio' WHEN 'LARGE' THEN ' Preto/Branco' ELSE ' BLACK' END)"},
    {"colour": (lambda c: T.colour_word(c["title"]),
                "CASE WHEN contains(title, 'nio') THEN 'titânio' WHEN contains(title, 'Preto') THEN 'Preto' WHEN contains(title, 'BLACK') THEN 'BLACK' ELSE '' END")},
)
column_query(
    "collapse_repeated_range", "lineitem", LI,
    {"a": vc("l_linenumber"), "b": vc("cast(l_quantity AS int)"),
     "range_text": f"concat({vc('l_linenumber')}, ' - ', {vc('cast(l_quantity AS int)')})"},
    {"collapsed": (lambda c: T.collapse_repeated_range(c["range_text"]), "CASE WHEN a = b THEN a ELSE range_text END")},
)
column_query(
    "energy_class", "part", ["p_partkey"],
    {"energy": f"CASE p_type WHEN 'ECONOMY' THEN concat({vc('p_size')}, ' kWh/mes') WHEN 'PROMO' THEN concat({vc('p_size')}, 'W') "
               f"WHEN 'LARGE' THEN {vc('p_size')} WHEN 'SMALL' THEN '' ELSE 'bivolt' END"},
    {"energy_class": (lambda c: X.energy_class(c["energy"]),
                      "CASE WHEN energy = '' THEN 'blank' WHEN contains(energy, 'kWh') THEN 'kWh' WHEN contains(energy, 'W') THEN 'W' WHEN energy = 'bivolt' THEN 'other' ELSE 'number_only' END")},
)
column_query(
    "cost_class", "events", EV,
    {"mode": "CASE WHEN event_type = 'signup' THEN 'auto' ELSE '' END", "js": "CASE WHEN event_type IN ('click', 'view') THEN 'True' ELSE '' END",
     "premium": "CASE WHEN event_type IN ('click', 'error') THEN 'true' ELSE 'false' END"},
    {"multiplier": (lambda c: X.cost_class(c["mode"], c["js"], c["premium"]),
                    "CASE WHEN mode = 'auto' THEN 'auto:1x/5x/10x/25x_success_only' WHEN js <> '' AND premium = 'true' THEN '25x' "
                    "WHEN premium = 'true' THEN '10x' WHEN js <> '' THEN '5x' ELSE '1x' END")},
)

# ---- translation --------------------------------------------------------------------------------------


def _translated(name, field, value, want, source="events", keys=EV, extra=None):
    column_query(
        name, source, keys, {**(extra or {}), "value_text": value},
        {field: (lambda c: R.translate_value(field, c["value_text"]), want)},
    )


N = vc("user_id")
_translated("translate_parts", "sku_status", f"concat('Patrocinado; ', event_type, ';sponsored;', event_type)",
            "concat('Sponsored; ', split_part(value_text, ';', 4))")
_translated("translate_discount_type", "discount_type",
            f"CASE event_type WHEN 'view' THEN concat('Use o cupom desconto ', {N}, ',50%') WHEN 'click' THEN concat('Cupom R$ ', {N}, ' OFF') "
            f"WHEN 'error' THEN concat({N}, '% OFF') WHEN 'signup' THEN 'Desconto no carnê' ELSE concat('use o cupom X', {N}) END",
            "CASE WHEN contains(value_text, ',50') THEN concat('USE O CUPOM DESCONTO ', n, '.5%') WHEN contains(value_text, 'R$') THEN concat('Coupon R$ ', n, ' off') "
            "WHEN contains(value_text, '%') THEN concat(n, '% discount off') WHEN contains(value_text, 'Desc') THEN 'Discount with digital payment booklet' ELSE concat('Use coupon X', n) END",
            extra={"n": N})
_translated("translate_delivery", "delivery_availability",
            f"CASE event_type WHEN 'view' THEN concat('Receba em até ', {N}, ' dias úteis') WHEN 'click' THEN concat('Normal até terça-feira, ', {vc('1 + user_id % 28')}, ' de março') "
            f"WHEN 'error' THEN 'Frete grátis; Receba amanhã' WHEN 'signup' THEN 'Produto indisponível' ELSE concat('Expressa até ', {vc('1 + user_id % 28')}, ' de maio, sexta') END",
            "CASE WHEN contains(value_text, 'úteis') THEN concat('Receive within ', n, CASE WHEN n = '1' THEN ' business day' ELSE ' business days' END) "
            "WHEN contains(value_text, 'Normal') THEN concat('Normal by Tuesday, March ', d) WHEN contains(value_text, 'Frete') THEN 'Free shipping; Receive tomorrow' "
            "WHEN contains(value_text, 'Produto') THEN 'Delivery unavailable for your region at the moment. Try another ZIP code?' ELSE concat('Express delivery by Friday, May ', d) END",
            extra={"n": N, "d": vc("1 + user_id % 28")})
_translated("translate_pickup", "pick_up_availability",
            f"CASE event_type WHEN 'view' THEN concat('Retira Rápido Retirar em ', {N}, ' dias') WHEN 'click' THEN 'Retire amanhã' WHEN 'error' THEN 'Retire na loja' ELSE concat('Fast pickup in ', {N}, 'h') END",
            "CASE WHEN contains(value_text, 'dias') THEN concat('Fast pickup in ', n, CASE WHEN n = '1' THEN ' day' ELSE ' days' END) WHEN contains(value_text, 'amanh') THEN 'Pick up in store starting tomorrow' "
            "WHEN contains(value_text, 'loja') THEN 'Pick up in store' ELSE value_text END", extra={"n": N})
_translated("translate_recommendation", "recommendation_intent",
            f"CASE WHEN event_type = 'view' THEN 'sem dados' ELSE concat({N}, ',7% dos clientes recomendam esse produto') END",
            "CASE WHEN value_text = 'sem dados' THEN value_text ELSE concat(n, '% recommend this product') END", extra={"n": N})
_translated("translate_door_type", "ref_refrigerator_type",
            "CASE event_type WHEN 'view' THEN 'Porta Francesa' WHEN 'click' THEN '2 portas' WHEN 'error' THEN 'Freezer inferior' WHEN 'signup' THEN 'chapa pintada' ELSE 'Inverter; Duplex; Portátil' END",
            "CASE value_text WHEN 'Porta Francesa' THEN 'French Door' WHEN '2 portas' THEN 'Two Door' WHEN 'Freezer inferior' THEN 'Freezer-on-Bottom' WHEN 'chapa pintada' THEN '' ELSE 'Freezer-on-Top; Portátil' END")
_translated("translate_loading", "ldy_loading_type",
            "CASE event_type WHEN 'view' THEN 'Abertura superior' WHEN 'click' THEN 'sem abertura frontal, carga superior' WHEN 'error' THEN 'Automática' WHEN 'signup' THEN 'Front Load e Top Load' ELSE 'painel frontal' END",
            "CASE value_text WHEN 'Abertura superior' THEN 'Top load' WHEN 'sem abertura frontal, carga superior' THEN 'Top load' WHEN 'Front Load e Top Load' THEN 'Front load,Top load' ELSE '' END")
column_query(
    "translate_dates", "events", EV,
    {"d": vc("1 + user_id % 28"),
     "date_text": f"CASE event_type WHEN 'view' THEN concat('sabado, ', {vc('1 + user_id % 28')}, ' de junho') WHEN 'click' THEN concat({vc('1 + user_id % 28')}, ' de abril, domingo') ELSE concat('quinta, ate ', {vc('1 + user_id % 28')}, ' de maio') END"},
    {"translated": (lambda c: R.date_text(c["date_text"]),
                    "CASE WHEN contains(date_text, 'sab') THEN concat('Saturday, June ', d) WHEN contains(date_text, 'abril') THEN concat('Sunday, April ', d) ELSE concat('Thursday, ate ', d, ' May') END")},
)
column_query(
    "translate_preserve_list", "events", EV,
    {"recovered": "CASE WHEN user_id < 20 THEN 'ref_refrigerator_type' ELSE 'sku' END", "door": "'2 portas'"},
    {"ref_refrigerator_type": (
        lambda c: F.when(F.array_contains(F.split(c["recovered"], ","), "ref_refrigerator_type"), c["door"])
        .otherwise(R.translate_value("ref_refrigerator_type", c["door"])),
        "CASE WHEN recovered = 'sku' THEN 'Two Door' ELSE door END")},
)

# ---- value rules ------------------------------------------------------------------------------------------

_VALUE = (
    f"concat({vc('cast(l_quantity AS int)')}, CASE l_linenumber WHEN 1 THEN ' litros' WHEN 2 THEN ' kg' WHEN 3 THEN ' kWh/mês' "
    "WHEN 4 THEN '' WHEN 5 THEN ' latas' WHEN 6 THEN ' polegadas' ELSE 'V' END)"
)
column_query(
    "value_validators", "lineitem", LI, {"q": "cast(l_quantity AS int)", "value_text": _VALUE},
    {"ref_capacity": (lambda c: V.is_refrigerator_capacity(c["value_text"]).cast("int"),
                      "CASE WHEN l_linenumber IN (1, 4, 6) THEN 1 ELSE 0 END"),
     "ldy_capacity": (lambda c: V.is_washer_capacity(c["value_text"]).cast("int"),
                      "CASE WHEN l_linenumber = 2 OR (l_linenumber IN (4, 5, 6) AND q <= 100) THEN 1 ELSE 0 END"),
     "energy": (lambda c: V.is_energy_use(c["value_text"]).cast("int"), "CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END"),
     "screen": (lambda c: V.is_screen_size(c["value_text"]).cast("int"),
                "CASE WHEN l_linenumber IN (4, 5, 6) AND q BETWEEN 10 AND 200 THEN 1 ELSE 0 END")},
)
column_query(
    "measurement_key", "lineitem", LI, {"q": vc("cast(l_quantity AS int)"), "value_text": _VALUE},
    {"measure_number": (lambda c: V.measure_number(c["value_text"]),
                        "CASE WHEN l_linenumber IN (1, 2, 4, 6) THEN q END"),
     "measure_unit": (lambda c: V.measure_unit(c["value_text"]),
                      "CASE l_linenumber WHEN 1 THEN 'l' WHEN 2 THEN 'kg' WHEN 4 THEN '' WHEN 6 THEN 'inch' END")},
)
column_query(
    "refrigerator_type", "part", ["p_partkey"],
    {"title": "concat('Geladeira ', CASE p_type WHEN 'ECONOMY' THEN 'Frost Free Duplex 2 portas' WHEN 'PROMO' THEN 'Side by Side 3 portas' "
              "WHEN 'LARGE' THEN 'Freezer Embaixo' WHEN 'SMALL' THEN '1 porta' ELSE p_name END)"},
    {"type_name": (lambda c: V.refrigerator_type(c["title"]),
                   "CASE WHEN contains(title, 'Duplex') THEN 'Duplex' WHEN contains(title, 'Side') THEN 'Side by Side' "
                   "WHEN contains(title, 'Embaixo') THEN 'Inverse' WHEN contains(title, '1 porta') THEN '1 porta' ELSE '' END"),
     "specificity": (lambda c: V.type_specificity(V.refrigerator_type(c["title"])),
                     "CASE WHEN contains(title, 'Duplex') THEN 1 WHEN contains(title, 'Side') THEN 5 "
                     "WHEN contains(title, 'Embaixo') THEN 4 WHEN contains(title, '1 porta') THEN 2 ELSE 0 END")},
)
