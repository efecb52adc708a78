"""Product URLs and product identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import as_text, lookup, present, squash


def _split_url(url: Column) -> tuple[Column, Column, Column, Column]:
    """(scheme, host, path, query) by plain text cuts, so odd URLs never fail."""
    bare = F.substring_index(F.trim(as_text(url)), "#", 1)
    before_query = F.substring_index(bare, "?", 1)
    mark = F.instr(bare, "?")
    query = F.when(mark > 0, F.substring(bare, mark + 1, F.length(bare))).otherwise("")
    sep = F.instr(before_query, "://")
    scheme = F.when(sep > 0, F.lower(F.substring(before_query, F.lit(1), sep - 1))).otherwise("")
    rest = F.when(sep > 0, F.substring(before_query, sep + 3, F.length(before_query))).otherwise(before_query)
    host = F.when(sep > 0, F.lower(F.substring_index(rest, "/", 1))).otherwise("")
    slash = F.instr(rest, "/")
    path = F.when(sep == 0, rest).when(slash > 0, F.substring(rest, slash, F.length(rest))).otherwise("")
    return scheme, host, path, query


def _param_name(p: Column) -> Column:
    name = F.substring_index(p, "=", 1)
    return F.lower(F.coalesce(F.try_url_decode(name), name))


def _reencode(p: Column) -> Column:
    """Decode and encode both halves so equal parameters get equal spellings."""
    name = F.regexp_extract(p, r"^([^=]*)", 1)
    value = F.regexp_extract(p, r"=(.*)$", 1)
    fix = lambda x: F.url_encode(F.coalesce(F.try_url_decode(x), x))
    plain = p.rlike(r"^[A-Za-z0-9_.=-]*$") & F.contains(p, F.lit("="))
    return F.when(plain, p).otherwise(F.concat(fix(name), F.lit("="), fix(value)))


def _params(query: Column) -> Column:
    return F.filter(F.split(query, "&"), lambda p: p != "")


def _joined_params(query: Column, cut: Column) -> Column:
    """Kept parameters; most queries need no decoding, hence no walk over them."""
    simple = cut.rlike(r"^(?:[A-Za-z0-9_.-]+=[A-Za-z0-9_.-]*(?:&(?=[A-Za-z0-9])|$))*$")
    kept = F.filter(_params(query), lambda p: ~_param_name(p).startswith("utm_"))
    return (
        F.when(query == "", "").when(~F.contains(F.lower(cut), F.lit("utm_")) & simple, cut)
        .otherwise(F.array_join(F.transform(kept, _reencode), "&"))
    )


def _without_utm(query: Column) -> Column:
    return F.ltrim(F.regexp_replace(query, r"(?i)(?:^|&)utm_[^&=]*=[^&]*", ""), F.lit("&"))


def _assembled(url: Column, scheme: Column, host: Column, path: Column, joined: Column) -> Column:
    prefix = F.when(scheme != "", F.concat(scheme, F.lit("://"), host)).otherwise(F.lit(""))
    suffix = F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(F.lit(""))
    return F.when(present(url), F.concat(prefix, F.rtrim(path, F.lit("/")), suffix)).otherwise(F.lit(""))


def normalized_url(url: Column) -> Column:
    """Lower-case scheme and host, no ``utm_*``, no fragment, no trailing slash."""
    scheme, host, path, query = _split_url(url)
    return _assembled(url, scheme, host, path, _joined_params(query, _without_utm(query)))


def with_normalized_url(df: DataFrame, url: str, out: str) -> DataFrame:
    """:func:`normalized_url` with its pieces staged, so that each is computed once."""
    scheme, host, path, query = _split_url(F.col(url))
    df = df.withColumns({"__scheme": scheme, "__host": host, "__path": path, "__query": query})
    df = df.withColumn("__cut", _without_utm(F.col("__query")))
    df = df.withColumn("__joined", _joined_params(F.col("__query"), F.col("__cut")))
    value = _assembled(F.col(url), F.col("__scheme"), F.col("__host"), F.col("__path"), F.col("__joined"))
    return df.withColumn(out, value).drop("__scheme", "__host", "__path", "__query", "__cut", "__joined")


def identity_of(url_key: Column, retailer: Column, sku: Column) -> Column:
    """One text key from an already normalized URL, else retailer and SKU."""
    fallback = F.concat_ws("|", F.lit("sku"), F.lower(F.trim(as_text(retailer))), as_text(sku))
    return F.when(url_key != "", F.concat(F.lit("url|"), url_key)).otherwise(fallback)


def identity(url: Column, retailer: Column, sku: Column) -> Column:
    """One text key: the normalized URL, else retailer and SKU."""
    return identity_of(normalized_url(url), retailer, sku)


def item_from_url(url: Column) -> Column:
    """Path segment after the first segment that is exactly ``p``."""
    parts = F.filter(F.split(as_text(url), "/"), lambda s: s != "")
    at = F.array_position(parts, "p")
    hit = F.try_element_at(parts, (at + 1).cast("int"))
    return F.when(at > 0, F.coalesce(hit, F.lit(""))).otherwise(F.lit(""))


def sku_from_url(url: Column) -> Column:
    """``/p/<x>`` in the path, else a product parameter of the query."""
    _, _, path, query = _split_url(url)
    in_path = F.regexp_extract(path, r"/p/([^/]+)(?:/|$)", 1)
    in_query = F.regexp_extract(query, r"(?:skuId|produto|productId)=([^&]+)", 1)
    return F.when(in_path != "", in_path).otherwise(in_query)


def seller_from_url(url: Column) -> Column:
    _, _, _, query = _split_url(url)
    raw = F.regexp_extract(query, r"(?:^|&)seller_id=([^&]*)", 1)
    return squash(F.coalesce(F.try_url_decode(raw), raw))


def host_of(url: Column) -> Column:
    return _split_url(url)[1]


def host_allowed(url: Column, hosts) -> Column:
    """Host is one of the given names or a subdomain of one."""
    host = F.regexp_replace(host_of(url), r":\d+$", "")
    ok = F.lit(False)
    for h in hosts:
        ok = ok | (host == h) | host.endswith("." + h)
    return ok


def url_item_key(url: Column, item: Column, hosts) -> Column:
    """Lower-case item of the URL; blank for a foreign host or a contradicting item."""
    in_url = F.lower(F.regexp_extract(_split_url(url)[2], r"(?i)(?:^|/)p/([^/?#]+)(?:/|$)", 1))
    wanted = F.lower(F.trim(as_text(item)))
    agrees = (in_url != "") & ((wanted == "") | (wanted == in_url))
    return F.when(host_allowed(url, hosts) & agrees, in_url).otherwise(F.lit(""))


def page_url(base: Column, page: Column) -> Column:
    """Listing URL of a page: the base for page 1, else ``page`` replaced."""
    scheme, host, path, query = _split_url(base)
    kept = F.filter(_params(query), lambda p: _param_name(p) != "page")
    all_params = F.concat(
        F.transform(kept, _reencode), F.array(F.concat(F.lit("page="), page.cast("string")))
    )
    built = F.concat(scheme, F.lit("://"), host, path, F.lit("?"), F.array_join(all_params, "&"))
    return F.when(page <= 1, base).otherwise(built)


def url_matches_id(url: Column, structured_id: Column) -> Column:
    """Identity proof: an id shown in the URL must equal the payload's id."""
    expected = F.lower(squash(sku_from_url(url)))
    return (expected == "") | (expected == F.lower(squash(structured_id)))


# Spellings of the two accounts, letters only.
ACCOUNT_KEYS = {
    "magalu": "magalu",
    "magazineluiza": "magalu",
    "casasbahia": "casas_bahia",
    "casasbahiacombr": "casas_bahia",
}
ACCOUNT_NAMES = {"magalu": "Magalu", "casas_bahia": "CasasBahia"}


def canonical_retailer(name: Column, aliases: dict[str, str] = ACCOUNT_KEYS) -> Column:
    letters = F.regexp_replace(F.lower(as_text(name)), "[^a-z]", "")
    return lookup(letters, aliases, F.lit(""))


def account_name(name: Column, url: Column) -> Column:
    """Display name: by alias, then by a fragment of name or host, else as given."""
    key = canonical_retailer(name)
    low, low_url = F.lower(as_text(name)), F.lower(as_text(url))
    is_m = F.contains(low, F.lit("magalu")) | F.contains(low_url, F.lit("magazineluiza.com.br"))
    is_c = F.contains(low, F.lit("casas")) | F.contains(low_url, F.lit("casasbahia.com.br"))
    return (
        F.when((key == "magalu") | is_m, ACCOUNT_NAMES["magalu"])
        .when((key == "casas_bahia") | is_c, ACCOUNT_NAMES["casas_bahia"])
        .otherwise(as_text(name))
    )
