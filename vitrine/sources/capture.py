"""Recorded network captures (HAR documents)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import variants as V
from vitrine.functions.text import as_text, squash, starts
from vitrine.operators.numbering import running_rank
from vitrine.session import materialize

# Headers that never leave the reader.
SENSITIVE_HEADERS = ("authorization", "cookie", "set-cookie", "x-api-key")


def safe_endpoint(url: Column) -> Column:
    """Host and path only."""
    return F.concat(
        F.regexp_extract(as_text(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1),
        F.regexp_extract(as_text(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1))


def safe_headers(headers: Column) -> Column:
    """Header list (``array<struct<name,value>>``) without the sensitive ones."""
    return F.filter(headers, lambda h: ~F.lower(h["name"]).isin(*SENSITIVE_HEADERS))


def decoded_body(text: Column, encoding: Column) -> Column:
    """Response text; bodies that are, or look, base64-encoded are decoded."""
    looks = (F.length(as_text(text)) >= 24) & as_text(text).rlike(r"^[A-Za-z0-9+/=]+$")
    decoded = F.try_to_binary(text, F.lit("base64"))
    shown = F.when(decoded.isNotNull(), F.decode(decoded, "UTF-8"))
    return F.when((encoding == "base64") | looks, F.coalesce(shown, text)).otherwise(as_text(text))


def capture_entries(docs: DataFrame, keys: list[str], doc: str = "doc") -> DataFrame:
    """One row per entry of a capture document (VARIANT), secrets left out."""
    rows = docs.select(*keys, F.posexplode(V.get(F.col(doc), "$.log.entries", "array<variant>")).alias("index", "e"))
    e = F.col("e")
    g = lambda p, t="string": V.get(e, p, t)
    header = lambda d: F.struct(V.get(d, "$.name").alias("name"), V.get(d, "$.value").alias("value"))
    return rows.select(
        *keys, "index", as_text(g("$.request.method")).alias("method"), as_text(g("$.request.url")).alias("url"),
        safe_endpoint(g("$.request.url")).alias("endpoint"), g("$.response.status", "int").alias("status"),
        as_text(g("$.response.content.mimeType")).alias("mime"),
        F.trim(as_text(g("$.request.postData.text"))).alias("body"),
        decoded_body(g("$.response.content.text"), g("$.response.content.encoding")).alias("text"),
        safe_headers(F.transform(g("$.request.headers", "array<variant>"), header)).alias("headers"),
    )


def read_capture(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("file"), F.try_parse_json("value").alias("doc"))
    return capture_entries(raw, ["file"])


# ---- operations --------------------------------------------------------------------------------


def _is_operation(d: Column) -> Column:
    keys = F.map_keys(V.get(d, "$", "map<string,variant>"))
    return F.coalesce(F.arrays_overlap(
        keys, F.array(*[F.lit(k) for k in ("operationName", "query", "variables", "extensions")])), F.lit(False))


def capture_requests(entries: DataFrame, keys: list[str]) -> DataFrame:
    """One row per operation of a request body (single or batch).

    A graph endpoint without a readable body still counts as one unnamed operation.
    """
    # only lists and objects hold operations, and a text that is no JSON is slow to refuse; generated, a body is parsed once
    read = F.when(F.col("body").rlike(r"^\s*[\[{]"), F.try_parse_json("body"))
    entries = entries.select("*", F.explode(F.array(read)).alias("__body"))
    body = F.col("__body")
    many = F.filter(F.coalesce(V.as_array(body), F.array(body)), lambda d: d.isNotNull() & _is_operation(d))
    graph = F.contains(F.lower("url"), F.lit("graphql"))
    none = F.array(F.try_parse_json(F.lit("{}")))
    rows = entries.withColumn("batch", V.as_array(body).isNotNull()).withColumn(
        "payloads", F.when(F.coalesce(F.size(many), F.lit(0)) > 0, many).when(graph, none))
    rows = rows.select(*keys, "index", "method", "url", "endpoint", "status", "batch",
                       F.posexplode("payloads").alias("payload_pos", "p"))
    p = F.col("p")
    query = as_text(V.get(p, "$.query"))
    name = F.trim(as_text(V.get(p, "$.operationName")))
    from_query = F.regexp_extract(query, r"\b(?:query|mutation|subscription)\s+([A-Za-z_][A-Za-z0-9_]*)", 1)
    return rows.select(
        *keys, "index", "payload_pos", "method", "url", "endpoint", "status", "batch",
        F.when(name != "", name).otherwise(from_query).alias("operation"), query.alias("query"),
        F.coalesce(F.map_keys(V.get(p, "$.variables", "map<string,variant>")), F.array().cast("array<string>"))
        .alias("variable_keys"),
        V.get(p, "$.variables", "variant").alias("variables"),
    )


def capture_operations(requests: DataFrame, keys: list[str]) -> DataFrame:
    """Requests grouped by endpoint and operation.

    The sets are sets of names (methods, status codes, variable keys), so they are as
    small as the interface; the first query seen gives the head.
    """
    first = F.min(F.struct("index", "payload_pos", squash(F.col("query")).alias("head"), "batch"))
    grouped = requests.groupBy(*keys, "endpoint", "operation").agg(
        F.count(F.lit(1)).alias("calls"),
        F.sort_array(F.collect_set(F.when(F.col("method") != "", F.col("method")))).alias("methods"),
        F.sort_array(F.collect_set("status")).alias("status_codes"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("variable_keys")))).alias("variable_keys"),
        first.alias("f"),
    )
    return grouped.select(
        *keys, "endpoint", "operation", "calls", "methods", "status_codes", "variable_keys",
        F.col("f.head").alias("query_head"), F.col("f.batch").alias("batch_seen"),
        ((F.col("operation") != "") | (F.col("f.head") != "")).alias("batch_candidate"),
    )


def operations_report(operations: DataFrame, keys: list[str]) -> DataFrame:
    """Operations of a capture, most called first, then by endpoint and name; ``place`` counts from 1."""
    # one row per operation is small beside the captures, which are read once
    counted = materialize(operations.withColumn("__down", -F.col("calls")), "operations")
    placed = running_rank(counted, keys, "__down", ["endpoint", "operation"], "place")
    return placed.drop("__down").orderBy(*keys, "place")


# ---- discovery inside documents ---------------------------------------------------------------

# Key names that make an object a product or a review.
PRODUCT_IDS = ("sku", "idsku", "id", "title", "name", "price", "url")
PRODUCT_FACTS = ("title", "name", "url", "price", "oldprice", "precovenda")
REVIEW_TEXT = (
    "review", "reviews", "comment", "comments", "content", "description", "message", "text", "title", "body",
)
REVIEW_META = ("rating", "score", "stars", "star", "grade", "author", "name", "nickname", "user", "customer")


def _has_any(keys: Column, names) -> Column:
    return F.coalesce(F.arrays_overlap(keys, F.array(*[F.lit(n) for n in names])), F.lit(False))


def array_discovery(docs: DataFrame, keys: list[str], doc: str = "doc") -> DataFrame:
    """Paths whose arrays hold product-like or review-like objects."""
    lists = lambda n: (F.coalesce(F.size(n["items"]), F.lit(0)) > 0) & (n["path"] != "") & ~n["path"].endswith("]")
    df = V.find(docs, V.root(F.col(doc)), "__nodes", lists)
    nodes = df.select(*keys, F.explode("__nodes").alias("n")).select(*keys, F.col("n.path").alias("path"), F.col("n.doc").alias("d"))
    items = V.as_array(F.col("d"))
    # object keys come out sorted by name
    names = F.map_keys(V.get(F.get(V.as_array(F.col("d")), F.lit(0)), "$", "map<string,variant>"))
    nodes = nodes.withColumns({"length": F.size(items), "first_keys": names,
                               "low": F.transform(names, lambda k: F.lower(k))})
    low = F.col("low")
    kinds = F.array_compact(F.array(
        F.when(_has_any(low, PRODUCT_IDS) & _has_any(low, PRODUCT_FACTS), "product"),
        F.when(_has_any(low, REVIEW_TEXT) & _has_any(low, REVIEW_META), "review")))
    return nodes.select(*keys, "path", F.explode(kinds).alias("kind"), "length", "first_keys")


def term_paths(docs: DataFrame, keys: list[str], pattern: str, doc: str = "doc") -> DataFrame:
    """Paths whose key or text matches a term."""
    kind = lambda d: F.schema_of_variant(d)
    text = lambda d: F.when(kind(d) == "STRING", V.get(d, "$")).otherwise("")

    def matches(n: Column) -> Column:
        # the schema of a list or an object is gathered from all below it, so a single value alone is asked for its kind
        single = n["items"].isNull() & n["entries"].isNull()
        said = F.when(single, text(n["doc"])).otherwise("").rlike(pattern)
        return (n["path"] != "") & (F.regexp_extract(n["path"], r"([^.\[\]]+)$", 1).rlike(pattern) | said)

    df = V.find(docs, V.root(F.col(doc)), "__nodes", matches)
    nodes = df.select(*keys, F.explode("__nodes").alias("n")).select(
        *keys, F.col("n.path").alias("path"), F.col("n.doc").alias("d"))
    return nodes.select(*keys, "path", F.regexp_extract(kind(F.col("d")), r"^(\w+)", 1).alias("kind"), text(F.col("d")).alias("sample"))


def term_positions(texts: DataFrame, keys: list[str], terms: list[str], limit: int | None = None, before: int = 260,
                   after: int = 520, text: str = "text") -> DataFrame:
    """Positions (from 0) of each term (with ``limit``, the first ones) with a window of context."""
    hits = [_term_hits(F.col(text), t, limit, before, after) for t in terms]
    return texts.select(*keys, F.explode(F.flatten(F.array(*hits))).alias("h")).select(*keys, "h.*")


def _term_hits(body: Column, term: str, limit: int | None, before: int, after: int) -> Column:
    every = starts(F.lower(body), term.lower())
    found = F.when(F.contains(F.lower(body), F.lit(term.lower())), every if limit is None else F.slice(every, 1, limit))
    shown = F.transform(found, lambda at: F.struct(
        F.lit(term).alias("term"), (at - 1).alias("position"),
        F.substring(body, F.greatest(at - before, F.lit(1)), at + after - F.greatest(at - before, F.lit(1))).alias("context")))
    return F.coalesce(shown, F.array().cast("array<struct<term:string,position:int,context:string>>"))
