"""Queries of run reports, usage, captures, sources and payload checks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from vitrine.operators import payloads as PL
from vitrine.operators import reports as R
from vitrine.plans import inputs as I
from vitrine.plans.registry import column_query, query
from vitrine.session import materialize, work_dir
from vitrine.sources import capture as C
from vitrine.sources import snapshot as S
from vitrine.sources import tables as TB
from vitrine.sources import usage as U

# ---- listing statistics: products are order lines, a page is an order --------------------------------

_PROD = {
    "run": "l_linestatus", "page": "l_orderkey", "pos": "l_linenumber", "relevant": "l_returnflag <> 'R'",
    "parsed": "l_returnflag <> 'R' AND l_suppkey <> 5", "sponsored": "l_discount > 0.08",
}
_PS = f"p AS ({I.select_sql(_PROD, 'lineitem')})"
_STATS = ("s AS (SELECT run, page, count(*) AS raw_products, count(CASE WHEN relevant THEN 1 END) AS kept_products, "
          "count(CASE WHEN NOT relevant THEN 1 END) AS dropped_products, count(CASE WHEN parsed THEN 1 END) AS parsed_rows FROM p GROUP BY run, page)")


def _stats(spark, sf):
    rows = I.select(I.table(spark, sf, "lineitem"), _PROD)
    return R.page_stats(rows, ["run", "page"], F.col("relevant"), F.col("parsed"))


@query("page_stats", f"WITH {_PS}, {_STATS} SELECT * FROM s")
def page_stats(spark, sf):
    return _stats(spark, sf)


@query("listing_arithmetic", f"""WITH {_PS}, {_STATS} SELECT run, page, CASE WHEN kept_products <> parsed_rows THEN concat('parsed_rows_mismatch:', parsed_rows, '!=', kept_products) ELSE '' END AS content_error FROM s""")
def listing_arithmetic(spark, sf):
    s = _stats(spark, sf)
    err = R.content_error(F.col("raw_products"), F.col("kept_products"), F.col("dropped_products"), F.col("parsed_rows"))
    return s.select("run", "page", err.alias("content_error"))


column_query("listing_sort_check", "events", ["event_id"],
             {"run_id": "CASE WHEN user_id % 2 = 0 THEN 'bsr' ELSE 'main' END", "kind": "CASE event_type WHEN 'view' THEN 'score' WHEN 'click' THEN '' ELSE 'soldQuantity' END"},
             {"sort_error": (lambda c: R.sort_error(c["run_id"], c["kind"], F.lit("desc")),
                             "CASE WHEN (run_id = 'bsr' AND kind = 'soldQuantity') OR (run_id = 'main' AND kind = 'score') THEN '' ELSE concat('selected_sort_mismatch:', CASE kind WHEN '' THEN 'missing' ELSE kind END, ':desc!=', CASE run_id WHEN 'bsr' THEN 'soldQuantity' ELSE 'score' END, ':desc') END")})


@query("product_summary", f"""WITH {_PS} SELECT run, page, count(*) AS returned, count(CASE WHEN relevant THEN 1 END) AS relevant,
count(CASE WHEN NOT relevant THEN 1 END) AS filtered, count(CASE WHEN sponsored THEN 1 END) AS sponsored FROM p GROUP BY run, page""")
def product_summary(spark, sf):
    rows = I.select(I.table(spark, sf, "lineitem"), _PROD)
    return R.product_summary(rows, ["run", "page"], F.col("relevant"), F.col("sponsored"))


_LROWS = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_suppkey": "l_suppkey", "l_partkey": "l_partkey",
    "retailer": "CASE WHEN l_suppkey = 1 THEN 'Other' ELSE 'North' END", "product_line": "CASE WHEN l_suppkey = 2 THEN 'REF' ELSE 'TV' END",
    "item": f"CASE WHEN l_suppkey = 3 THEN ' ' ELSE {I.vc('l_partkey')} END", "retailer_sku_name": "CASE WHEN l_suppkey = 4 THEN '' ELSE 'n' END",
    "product_url": f"concat(CASE WHEN l_suppkey = 5 THEN 'https://x.example' ELSE 'https://shop.example' END, '/p/', CASE WHEN l_suppkey = 6 THEN '0' ELSE {I.vc('l_partkey')} END)",
    "source_url": "CASE WHEN l_suppkey = 7 THEN 'u2' ELSE 'u' END",
}


@query("listing_row_check", f"""WITH r AS ({I.select_sql(_LROWS, 'lineitem')}) SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, violation FROM (
SELECT *, 'retailer' AS violation FROM r WHERE l_suppkey = 1 UNION ALL SELECT *, 'product_line' FROM r WHERE l_suppkey = 2 UNION ALL SELECT *, 'item_missing' FROM r WHERE l_suppkey = 3
UNION ALL SELECT *, 'url_item_mismatch' FROM r WHERE l_suppkey = 3 UNION ALL SELECT *, 'name_missing' FROM r WHERE l_suppkey = 4 UNION ALL SELECT *, 'product_url_invalid' FROM r WHERE l_suppkey = 5
UNION ALL SELECT *, 'url_item_mismatch' FROM r WHERE l_suppkey = 6 AND l_partkey <> 0 UNION ALL SELECT *, 'source_url_mismatch' FROM r WHERE l_suppkey = 7)""")
def listing_row_check(spark, sf):
    rows = I.select(I.table(spark, sf, "lineitem"), _LROWS)
    return R.row_violations(rows, ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"], "North", "TV", ["shop.example"], F.lit("u"))


# ---- page attempts and retries: events ---------------------------------------------------------------

_ATT = {"run": "event_type", "page": "user_id % 400", "pass": "CASE WHEN value < 40 THEN 0 WHEN value < 90 THEN 1 ELSE 2 END",
        "error": "CASE WHEN event_id % 3 = 0 THEN 'timeout' ELSE '' END"}
_AT = f'a AS ({I.select_sql({**{k: v for k, v in _ATT.items() if k != "pass"}, "pass_no": _ATT["pass"]}, "events")})'


def _attempts(spark, sf):
    return I.table(spark, sf, "events").selectExpr(*[f"{e} AS {n}" for n, e in _ATT.items()])


@query("failed_pages", f"WITH {_AT} SELECT DISTINCT run, page FROM a WHERE page > 0 AND error <> ''")
def failed_pages(spark, sf):
    return R.failed_pages(_attempts(spark, sf), ["run"])


@query("retry_sets", f"""WITH {_AT}, l AS (SELECT run, max(pass_no) AS lp FROM a GROUP BY run),
g AS (SELECT run, page, bool_or(pass_no = 0 AND error <> '') AS ini, bool_or(pass_no > 0) AS later, bool_or(pass_no = lp) AS fin, bool_or(pass_no = lp AND error <> '') AS unres FROM a JOIN l USING (run) GROUP BY run, page)
SELECT run, page, later::int AS retried, (fin AND NOT unres)::int AS recovered, (NOT fin)::int AS not_required, unres::int AS unresolved FROM g WHERE ini AND page > 0""")
def retry_sets(spark, sf):
    out = R.retry_sets(_attempts(spark, sf), ["run"])
    return out.withColumns({c: F.col(c).cast("int") for c in ("retried", "recovered", "not_required", "unresolved")})


# ---- reviews ------------------------------------------------------------------------------------------

_REVSQL = "r AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE trim(text) <> '')"


def _reviews(spark, sf):
    turns = I.table(spark, sf, "conversations")
    stated = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    arrays = R.review_arrays(turns, ["conv_id"], "turn", "text")
    empty = F.array().cast("array<string>")
    return stated.join(arrays, "conv_id", "left").select(
        "conv_id", F.coalesce("reviews", empty).alias("reviews"), (F.col("n") + F.col("conv_id") % 3).cast("string").alias("count_of_reviews"))


@query("review_rows", f"WITH {_REVSQL} SELECT conv_id, k AS review_rank, text AS detailed_review_content FROM r")
def review_rows(spark, sf):
    return R.ranked_reviews(I.table(spark, sf, "conversations"), ["conv_id"], "turn", "text")


@query("short_reviews", f"""WITH c AS (SELECT conv_id, count(*) AS n, count(CASE WHEN trim(text) <> '' THEN 1 END) AS actual FROM conversations GROUP BY conv_id)
SELECT conv_id, cast(n + conv_id % 3 AS varchar) AS count_of_reviews, n + conv_id % 3 AS expected_review_count, actual AS actual_review_count FROM c
WHERE n + conv_id % 3 > actual""")
def short_reviews(spark, sf):
    return R.short_reviews(_reviews(spark, sf), ["conv_id"])


@query("numbered_reviews", f"""WITH {_REVSQL} SELECT conv_id, md5(string_agg(concat('review', k, ' - ', trim(text)), ' ||| ' ORDER BY k)) AS reviews_md5 FROM r GROUP BY conv_id""")
def numbered_reviews(spark, sf):
    from vitrine.functions.text import join_reviews

    return _reviews(spark, sf).select("conv_id", F.md5(join_reviews(F.col("reviews"))).alias("reviews_md5"))


# ---- usage ledger: every event is one ledger line -----------------------------------------------------

_LINE = (
    "CASE WHEN event_type = 'error' AND user_id < 20 THEN 'not json' WHEN event_type = 'error' THEN '{\"event\":\"other\"}' ELSE "
    "concat('{\"event\":\"zenrows_http_request_attempt\",\"recorded_at_utc\":\"', substr(cast(ts AS varchar(30)), 1, 19), '\",\"retailer\":\"', event_type, '\",\"product_line\":\"', "
    "CASE WHEN user_id % 3 = 0 THEN 'TV' WHEN user_id % 3 = 1 THEN 'REF' ELSE '' END, '\",\"method\":\"', CASE WHEN value < 50 THEN 'POST' ELSE 'GET' END, '\",\"profile\":\"p\",\"estimated_multiplier\":\"1x\"}') END"
)


def ledger(spark, sf):
    lines = I.table(spark, sf, "events").selectExpr("event_id", f"{_LINE} AS value")
    return U.parse_ledger(lines)


@query("usage_ledger", """SELECT event_id, CASE WHEN event_type = 'error' AND user_id < 20 THEN 'invalid_ledger_json' WHEN event_type = 'error' THEN 'invalid_ledger_event' ELSE '' END AS error,
CASE WHEN event_type <> 'error' THEN event_type END AS retailer, CASE WHEN event_type <> 'error' THEN CASE user_id % 3 WHEN 0 THEN 'tv' WHEN 1 THEN 'ref' ELSE 'unknown' END END AS product_line,
CASE WHEN event_type <> 'error' THEN CASE WHEN value < 50 THEN 'POST' ELSE 'GET' END END AS method FROM events""")
def usage_ledger(spark, sf):
    return ledger(spark, sf).select("event_id", "error", "retailer", "product_line", "method")


@query("usage_summary", """WITH e AS (SELECT * FROM events WHERE event_type <> 'error')
SELECT 'total' AS kind, coalesce((SELECT concat('error:', string_agg(DISTINCT x, ',' ORDER BY x)) FROM (SELECT CASE WHEN user_id < 20 THEN 'invalid_ledger_json' ELSE 'invalid_ledger_event' END AS x FROM events WHERE event_type = 'error')), 'complete') AS name, count(*) AS calls FROM e
UNION ALL SELECT 'retailer', event_type, count(*) FROM e GROUP BY event_type
UNION ALL SELECT 'product_line', CASE user_id % 3 WHEN 0 THEN 'tv' WHEN 1 THEN 'ref' ELSE 'unknown' END, count(*) FROM e GROUP BY 2""")
def usage_summary(spark, sf):
    return U.usage_summary(ledger(spark, sf))


_LADDER = [(1, "POST", "p", "10x"), (2, "GET", "p", "10x"), (3, "GET", "q", "25x")]


@query("usage_ladder_check", """WITH c AS (SELECT user_id, event_id, CASE WHEN event_type IN ('view', 'click') THEN 'POST' ELSE 'GET' END AS method, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS step FROM events),
g AS (SELECT user_id, count(*) AS calls, min(CASE WHEN step <= 3 AND (step = 3 OR (step = 1 AND method <> 'POST') OR (step = 2 AND method <> 'GET')) THEN step END) AS first_wrong_step FROM c GROUP BY user_id)
SELECT user_id, calls, first_wrong_step, CASE WHEN first_wrong_step IS NULL AND calls <= 3 THEN 1 ELSE 0 END AS matches_ladder FROM g""")
def usage_ladder_check(spark, sf):
    calls = I.table(spark, sf, "events").selectExpr(
        "user_id", "event_id", "CASE WHEN event_type IN ('view', 'click') THEN 'POST' ELSE 'GET' END AS method", "'p' AS profile", "'10x' AS multiplier")
    out = U.ladder_violations(calls, ["user_id"], "event_id", _LADDER)
    return out.withColumn("matches_ladder", F.col("matches_ladder").cast("int"))


# ---- run reports ---------------------------------------------------------------------------------------

@query("run_report", """WITH e AS (SELECT user_id % 50 AS run, event_id, ts, CASE event_type WHEN 'view' THEN 'page_end' WHEN 'click' THEN 'api_end' WHEN 'signup' THEN 'run_start' WHEN 'purchase' THEN 'run_end' ELSE 'noise' END AS event,
 CASE WHEN value > 150 THEN 403 ELSE 200 END AS status, value < 60 AS ok, props AS detail FROM events)
SELECT run, count(CASE WHEN event <> 'noise' THEN 1 END) AS event_count, count(CASE WHEN event = 'noise' THEN 1 END) AS ignored_lines,
 arg_max(detail, ts) FILTER (event = 'run_start') AS run_detail, coalesce(arg_max(detail, ts) FILTER (event = 'run_end'), 'interrupted') AS outcome,
 count(CASE WHEN event = 'page_end' THEN 1 END) AS pages, count(CASE WHEN event = 'page_end' AND ok THEN 1 END) AS pages_ok, count(CASE WHEN event = 'api_end' THEN 1 END) AS calls,
 arg_min(event_id, ts) FILTER (event = 'api_end' AND status = 403) AS first_403_event FROM e GROUP BY run""")
def run_report(spark, sf):
    events = I.table(spark, sf, "events").selectExpr(
        "user_id % 50 AS run", "event_id", "ts", "CASE event_type WHEN 'view' THEN 'page_end' WHEN 'click' THEN 'api_end' WHEN 'signup' THEN 'run_start' WHEN 'purchase' THEN 'run_end' ELSE 'noise' END AS event",
        "CASE WHEN value > 150 THEN 403 ELSE 200 END AS status", "value < 60 AS ok", "props AS detail")
    renamed = events.withColumnRenamed("run", "run_key")
    out = R.run_report(renamed, ["run_key"])
    return out.select(F.col("run_key").alias("run"), "event_count", "ignored_lines", F.col("run").alias("run_detail"),
                      "outcome", "pages", "pages_ok", "calls", "first_403_event")


_STATUS = """counts AS (SELECT o_custkey AS run, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS main_rows, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS bsr_rows,
 count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS final_output_rows FROM orders GROUP BY o_custkey),
st AS (SELECT counts.*, coalesce(c_acctbal > 0, false) AS load_success, coalesce(c_nationkey % 10, 0) AS inserted FROM counts LEFT JOIN customer ON c_custkey = run)"""


def _status(spark, sf):
    counts = I.table(spark, sf, "orders").selectExpr(
        "o_custkey AS run", "CASE o_orderstatus WHEN 'F' THEN 'main_rows' WHEN 'O' THEN 'bsr_rows' ELSE 'final_output_rows' END AS stage", "1L AS row_count")
    loads = I.table(spark, sf, "customer").selectExpr("c_custkey AS run", "c_acctbal > 0 AS load_success", "c_nationkey % 10 AS inserted")
    return R.run_status(counts, loads, ["run"])


@query("run_status", f"""WITH {_STATUS} SELECT run, main_rows, bsr_rows, final_output_rows, inserted, CASE WHEN final_output_rows > 0 AND load_success AND inserted = final_output_rows THEN 1 ELSE 0 END AS success FROM st""")
def run_status(spark, sf):
    return _status(spark, sf).select("run", "main_rows", "bsr_rows", "final_output_rows", "inserted", F.col("success").cast("int").alias("success"))


@query("status_issues", f"""WITH {_STATUS} SELECT run, 'Final output row count is 0.' AS issue FROM st WHERE final_output_rows = 0 UNION ALL SELECT run, 'DB load did not report success.' FROM st WHERE NOT load_success
UNION ALL SELECT run, concat('DB inserted rows mismatch: inserted=', inserted, ', final_output=', final_output_rows, '.') FROM st WHERE inserted <> final_output_rows""")
def status_issues(spark, sf):
    return R.status_issues(_status(spark, sf), ["run"]).select("run", "issue")


@query("stages_to_run", """WITH s AS (SELECT l_orderkey, l_linenumber AS step_no, CASE WHEN l_linenumber = 7 THEN 'db_load' ELSE concat('stage', l_linenumber) END AS stage, bool_and(l_returnflag <> 'R') AS complete FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, step_no, stage, CASE WHEN stage = 'db_load' OR max(CASE WHEN NOT complete AND stage <> 'db_load' THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY step_no) = 1 THEN 1 ELSE 0 END AS todo FROM s""")
def stages_to_run(spark, sf):
    stages = I.table(spark, sf, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("step_no")).agg(
        F.bool_and(F.col("l_returnflag") != "R").alias("complete"))
    stages = stages.withColumn("stage", F.when(F.col("step_no") == 7, "db_load").otherwise(F.concat(F.lit("stage"), F.col("step_no").cast("string"))))
    return R.stages_to_run(stages, ["l_orderkey"]).select("l_orderkey", "step_no", "stage", F.col("todo").cast("int").alias("todo"))


@query("expired_runs", """SELECT o_custkey, max(o_orderdate) AS latest_modified FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) GROUP BY o_custkey HAVING max(o_orderdate) <= TIMESTAMP '2000-01-01'""")
def expired_runs(spark, sf):
    files = I.table(spark, sf, "orders").selectExpr("o_custkey", "o_orderdate AS modified")
    kept = I.table(spark, sf, "customer").filter("c_acctbal > 5000").selectExpr("c_custkey AS o_custkey")
    return R.expired_runs(files, kept, ["o_custkey"], F.lit("2000-01-01").cast("timestamp"))


@query("run_context_check", """WITH r AS (SELECT o_custkey AS run, o_orderkey AS position, CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '1-URGENT' THEN 'XX' ELSE 'TV' END AS l, CASE o_orderstatus WHEN 'F' THEN 'Magalu' WHEN 'O' THEN 'CasasBahia' ELSE 'Magazine Luiza' END AS n FROM orders),
v AS (SELECT *, CASE WHEN l = '' THEN 'product_line_missing' WHEN l = 'XX' THEN 'product_line_unknown' WHEN n = 'CasasBahia' THEN 'retailer_mismatch' END AS reason FROM r)
SELECT run, min(position) AS position, arg_min(reason, position) AS reason, count(*) AS violations FROM v WHERE reason IS NOT NULL GROUP BY run""")
def run_context_check(spark, sf):
    rows = I.table(spark, sf, "orders").selectExpr(
        "o_custkey AS run", "o_orderkey AS position", "CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '1-URGENT' THEN 'XX' ELSE 'tv ' END AS product_line",
        "CASE o_orderstatus WHEN 'F' THEN 'Magalu' WHEN 'O' THEN 'CasasBahia' ELSE 'Magazine Luiza' END AS retailer", "'TV' AS expected_line", "'magalu' AS expected_retailer")
    return R.context_violation(rows, ["run"])


@query("field_catalogue", """SELECT count(*) AS field_count, string_agg(DISTINCT r_name, ',' ORDER BY r_name) AS retailers FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0""")
def field_catalogue(spark, sf):
    nation, region = I.table(spark, sf, "nation"), I.table(spark, sf, "region")
    rows = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "CASE WHEN n_nationkey % 2 = 0 THEN 'BR' ELSE 'XX' END AS country", "'tv ' AS product_line", "r_name AS retailer")
    return R.field_catalogue(rows, "BR", "TV").withColumn("retailers", F.array_join("retailers", ","))


# ---- captures: one document per order, its lines are the entries -----------------------------------------

_ENTRY = (
    "concat('{\"request\":{\"method\":\"', CASE WHEN l_returnflag = 'R' THEN 'GET' ELSE 'POST' END, '\",\"url\":\"https://api.example/', l_returnflag, CASE WHEN l_linenumber < 4 THEN '/graphql' ELSE '/x' END, "
    "'?a=1\",\"headers\":[{\"name\":\"Cookie\",\"value\":\"s\"},{\"name\":\"Accept\",\"value\":\"*\"}],\"postData\":{\"text\":\"', CASE WHEN l_linenumber IN (1, 2) THEN concat('{\\\\\"operationName\\\\\":\\\\\"op', cast(l_linenumber AS varchar(3)), '\\\\\",\\\\\"variables\\\\\":{\\\\\"v', l_linestatus, '\\\\\":1}}') "
    "WHEN l_linenumber = 5 THEN '[{\\\\\"query\\\\\":\\\\\"query Q5 { x }\\\\\"},{\\\\\"query\\\\\":\\\\\"mutation M5 { x }\\\\\"}]' ELSE '' END, '\"}},\"response\":{\"status\":', CASE WHEN l_linestatus = 'F' THEN '200' ELSE '403' END, ',\"content\":{\"text\":\"eyJhIjoxfSAgICAgICAgICAgICAgICAg\",\"encoding\":\"base64\"}}}')"
)


def captures(spark, sf):
    lines = I.table(spark, sf, "lineitem").selectExpr("l_orderkey", f"{_ENTRY} AS entry")
    docs = lines.groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list("entry")), ",").alias("entries"))
    return docs.select("l_orderkey", F.try_parse_json(F.concat(F.lit('{"log":{"entries":['), F.col("entries"), F.lit("]}}"))).alias("doc"))


def entries(spark, sf):
    return C.capture_entries(captures(spark, sf), ["l_orderkey"])


@query("capture_entries", """SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 'GET' ELSE 'POST' END AS method, concat('api.example/', l_returnflag, CASE WHEN l_linenumber < 4 THEN '/graphql' ELSE '/x' END) AS endpoint,
CASE WHEN l_linestatus = 'F' THEN 200 ELSE 403 END AS status, '{"a":1}' AS text, 'Accept' AS header_names, count(*) AS n FROM lineitem GROUP BY ALL""")
def capture_entries(spark, sf):
    e = entries(spark, sf)
    return e.select("l_orderkey", "method", "endpoint", "status", F.trim("text").alias("text"),
                    F.array_join(F.transform("headers", lambda h: h["name"]), ",").alias("header_names")).groupBy(
        "l_orderkey", "method", "endpoint", "status", "text", "header_names").agg(F.count(F.lit(1)).alias("n"))


_REQS = """q AS (SELECT l_orderkey, l_returnflag, l_linestatus, CASE WHEN l_returnflag = 'R' THEN 'GET' ELSE 'POST' END AS method, concat('api.example/', l_returnflag, CASE WHEN l_linenumber < 4 THEN '/graphql' ELSE '/x' END) AS endpoint,
 CASE WHEN l_linestatus = 'F' THEN 200 ELSE 403 END AS status, unnest(CASE WHEN l_linenumber IN (1, 2) THEN [concat('op', l_linenumber)] WHEN l_linenumber = 3 THEN [''] WHEN l_linenumber = 5 THEN ['Q5', 'M5'] END) AS operation, l_linenumber FROM lineitem)"""


@query("capture_requests", f"WITH {_REQS} SELECT l_orderkey, method, endpoint, status, operation, CASE WHEN l_linenumber IN (1, 2) THEN concat('v', l_linestatus) ELSE '' END AS variable_keys, count(*) AS n FROM q GROUP BY ALL")
def capture_requests(spark, sf):
    r = C.capture_requests(entries(spark, sf), ["l_orderkey"])
    return r.select("l_orderkey", "method", "endpoint", "status", "operation", F.array_join("variable_keys", ",").alias("variable_keys")).groupBy(
        "l_orderkey", "method", "endpoint", "status", "operation", "variable_keys").agg(F.count(F.lit(1)).alias("n"))


@query("capture_operations", f"""WITH {_REQS} SELECT endpoint, operation, count(*) AS calls, string_agg(DISTINCT method, ',' ORDER BY method) AS methods, string_agg(DISTINCT status, ',' ORDER BY status) AS status_codes,
coalesce(string_agg(DISTINCT CASE WHEN l_linenumber IN (1, 2) THEN concat('v', l_linestatus) END, ',' ORDER BY CASE WHEN l_linenumber IN (1, 2) THEN concat('v', l_linestatus) END), '') AS variable_keys,
CASE operation WHEN 'Q5' THEN 'query Q5 {{ x }}' WHEN 'M5' THEN 'mutation M5 {{ x }}' ELSE '' END AS query_head FROM q GROUP BY endpoint, operation""")
def capture_operations(spark, sf):
    out = C.capture_operations(C.capture_requests(entries(spark, sf), ["l_orderkey"]), [])
    return out.select("endpoint", "operation", "calls", F.array_join("methods", ",").alias("methods"),
                      F.array_join(F.col("status_codes").cast("array<string>"), ",").alias("status_codes"),
                      F.array_join("variable_keys", ",").alias("variable_keys"), "query_head")


@query("operations_report", f"""WITH {_REQS}, c AS (SELECT l_orderkey, endpoint, operation, count(*) AS calls FROM q GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY calls DESC, endpoint, operation) AS place FROM c""")
def operations_report(spark, sf):
    counted = C.capture_operations(C.capture_requests(entries(spark, sf), ["l_orderkey"]), ["l_orderkey"])
    return C.operations_report(counted, ["l_orderkey"]).select("l_orderkey", "endpoint", "operation", "calls", "place")


_NEST = "concat('{\"page\":{\"more\":[0,0,0,0,0,0,0,0,0,{\"deep\":[{\"sku\":1,\"price\":2}]}],\"list\":[{\"id\":1,\"title\":\"t', cast(event_id AS varchar(20)), '\",\"sub\":{\"notes\":[{\"text\":\"a\",\"author\":\"b\"}]}}],\"n\":[1,2],\"', event_type, '\":{\"summaryText\":\"x\"}}}')"


def _docs(spark, sf):
    return I.dealt(spark, sf, "events", 65536).selectExpr("event_id", f"try_parse_json({_NEST}) AS doc")


@query("array_discovery", """SELECT event_id, 'page.list' AS path, 'product' AS kind, 1 AS length, 'id,sub,title' AS first_keys FROM events UNION ALL SELECT event_id, 'page.list[0].sub.notes', 'review', 1, 'author,text' FROM events
UNION ALL SELECT event_id, 'page.more[9].deep', 'product', 1, 'price,sku' FROM events""")
def array_discovery(spark, sf):
    out = C.array_discovery(_docs(spark, sf), ["event_id"])
    return out.withColumn("first_keys", F.array_join("first_keys", ","))


@query("deep_documents", """SELECT event_id, concat(repeat('a[0].', 40), 'summaryText') AS path, 'x' AS sample FROM events WHERE event_id % 3 = 0
UNION ALL SELECT event_id, 'summaryText', 'y' FROM events WHERE event_id % 3 <> 0""")
def deep_documents(spark, sf):
    deep = "concat(repeat('{\"a\":[', 40), '{\"summaryText\":\"x\"}', repeat(']}', 40))"
    docs = I.dealt(spark, sf, "events", 16384).selectExpr(
        "event_id", f"try_parse_json(CASE WHEN event_id % 3 = 0 THEN {deep} ELSE '{{\"summaryText\":\"y\"}}' END) AS doc")
    return C.term_paths(docs, ["event_id"], "(?i)summary").select("event_id", "path", "sample")


@query("term_paths", """SELECT event_id, concat('page.', event_type, '.summaryText') AS path, 'STRING' AS kind, 'x' AS sample FROM events""")
def term_paths(spark, sf):
    return C.term_paths(_docs(spark, sf), ["event_id"], "(?i)summary")


@query("term_positions", """WITH t AS (SELECT doc_id, text, string_split(lower(text), 'er') AS parts FROM documents),
p AS (SELECT doc_id, text, unnest(range(1, len(parts))) AS k, parts FROM t),
q AS (SELECT doc_id, text, CAST(list_sum(list_transform(parts[1:k], lambda x: length(x))) + 2 * (k - 1) AS INTEGER) AS position FROM p)
SELECT doc_id, 'er' AS term, position, md5(substr(text, greatest(position + 1 - 5, 1), position + 1 + 10 - greatest(position + 1 - 5, 1))) AS context_md5 FROM q""")
def term_positions(spark, sf):
    out = C.term_positions(I.table(spark, sf, "documents"), ["doc_id"], ["er"], before=5, after=10)
    return out.select("doc_id", "term", "position", F.md5("context").alias("context_md5"))


column_query("safe_endpoint", "pages", ["page_id"], {"url": "url"}, {
    "endpoint": (lambda c: C.safe_endpoint(c["url"]), "regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '')")})

# ---- sources, contracts, loads ---------------------------------------------------------------------------

_FINALROWS = {
    "account_name": "CASE o_orderstatus WHEN 'F' THEN 'Magalu' WHEN 'O' THEN 'Casas Bahia' ELSE 'CasasBahia.com.br' END",
    "product": "CASE WHEN o_orderpriority < '3' THEN 'TV' ELSE ' ref' END", "item": "concat(' ', cast(o_orderkey AS varchar(20)))",
    "main_rank": "CASE WHEN o_custkey % 3 = 0 THEN '' WHEN o_custkey % 3 = 1 THEN concat(' ', cast(o_custkey AS varchar(20)), ' ') ELSE '1.5' END", "sku": "CASE WHEN o_totalprice < 100000 THEN '  ' ELSE 's' END",
}


@query("typed_load", f"""SELECT trim(account_name) AS account_name, trim(product) AS product, trim(item) AS item, try_cast(CASE WHEN contains(main_rank, '.') THEN NULL ELSE nullif(trim(main_rank), '') END AS int) AS main_rank, nullif(trim(sku), '') AS sku
FROM ({I.select_sql(_FINALROWS, 'orders')})""")
def typed_load(spark, sf):
    return TB.typed_load(I.select(I.table(spark, sf, "orders"), _FINALROWS))


@query("replace_slice_content", f"""WITH h AS ({I.select_sql(_FINALROWS, 'orders')}), n AS (SELECT 'Casas Bahia' AS account_name, 'TV' AS product, cast(c_custkey AS varchar) AS item, '1' AS main_rank, 'new' AS sku FROM customer)
SELECT * FROM h WHERE NOT (account_name <> 'Magalu' AND product = 'TV') UNION ALL SELECT * FROM n""")
def replace_slice_content(spark, sf):
    existing = I.select(I.table(spark, sf, "orders"), _FINALROWS)
    new = I.table(spark, sf, "customer").selectExpr("'Casas Bahia' AS account_name", "'TV' AS product", "cast(c_custkey AS string) AS item", "'1' AS main_rank", "'new' AS sku")
    return TB.replaced_slice(existing, new, "casas_bahia", "TV")


# ---- loads into history tables: each query makes tables of its own and drops them ------------------------------

_NEW = {"account_name": "CASE WHEN c_nationkey = 3 THEN 'Magalu' ELSE 'Casas Bahia' END", "product": "'TV'", "item": I.vc("c_custkey"), "main_rank": "'1'", "sku": "'new'"}
_LOADED = """SELECT CASE account_name WHEN 'Magalu' THEN 'magalu' ELSE 'casas_bahia' END AS account_key, upper(trim(product)) AS product, trim(item) AS item_key,
 CASE WHEN contains(main_rank, '.') THEN NULL ELSE try_cast(nullif(trim(main_rank), '') AS int) END AS main_rank, nullif(trim(sku), '') AS sku FROM"""
_OLDSQL, _NEWSQL = I.select_sql(_FINALROWS, "orders"), I.select_sql(_NEW, "customer")


def _publishable(rows, line):
    """Rows of a line with all published columns, blank where a row has none."""
    rows = rows.filter(F.upper(F.trim("product")) == line)
    return rows.withColumns({c: F.lit("") for c in S.final_columns(line) if c not in rows.columns})


def _loads(spark, steps):
    """Content of the tables after loads of (line, rows, mode, retailer), and what the last load of a line inserted."""
    pattern, inserted = f"vitrine_{{line}}_{uuid.uuid4().hex}", {}
    try:
        for line, rows, mode, retailer in steps:
            TB.prepare_table(spark, TB.output_table(line, pattern=pattern), line)
            inserted[line] = TB.load(_publishable(rows, line), TB.output_table(line, pattern=pattern), line, mode, retailer)["inserted"]
        tables = [
            spark.table(TB.output_table(line, pattern=pattern)).select(
                "account_key", "product", "item_key", "main_rank", "sku", F.lit(n).cast("long").alias("inserted"))
            for line, n in inserted.items()]
        return materialize(reduce(lambda a, b: a.unionByName(b), tables), "loaded")
    finally:
        for line in {line for line, *_ in steps}:
            spark.sql(f"DROP TABLE IF EXISTS {TB.output_table(line, pattern=pattern)}")


@query("load_append", f"""WITH o AS ({_LOADED} ({_OLDSQL})), n AS ({_LOADED} ({_NEWSQL}))
SELECT *, (SELECT count(*) FROM n) AS inserted FROM o WHERE product = 'TV' UNION ALL SELECT *, (SELECT count(*) FROM n) FROM n
UNION ALL SELECT *, (SELECT count(*) FROM o WHERE product = 'REF') FROM o WHERE product = 'REF'""")
def load_append(spark, sf):
    """Each line is appended to the table it is routed to."""
    old, new = I.select(I.table(spark, sf, "orders"), _FINALROWS), I.select(I.table(spark, sf, "customer"), _NEW)
    return _loads(spark, [("TV", old, "append", None), ("REF", old, "append", None), ("TV", new, "append", None)])


@query("load_replace_slice", f"""WITH o AS ({_LOADED} ({_OLDSQL})), n AS ({_LOADED} ({_NEWSQL})), s AS (SELECT * FROM n WHERE account_key = 'casas_bahia')
SELECT *, (SELECT count(*) FROM s) AS inserted FROM (SELECT * FROM o WHERE product = 'TV' AND account_key = 'magalu' UNION ALL SELECT * FROM s)""")
def load_replace_slice(spark, sf):
    """One retailer's slice is replaced; the other slice stays, and new rows of other retailers stay out."""
    old, new = I.select(I.table(spark, sf, "orders"), _FINALROWS), I.select(I.table(spark, sf, "customer"), _NEW)
    return _loads(spark, [("TV", old, "append", None), ("TV", new, "replace_slice", "casas_bahia")])


@query("load_overwrite", f"""WITH n AS ({_LOADED} ({_NEWSQL})) SELECT *, (SELECT count(*) FROM n) AS inserted FROM n""")
def load_overwrite(spark, sf):
    """The whole table is replaced."""
    old, new = I.select(I.table(spark, sf, "orders"), _FINALROWS), I.select(I.table(spark, sf, "customer"), _NEW)
    return _loads(spark, [("TV", old, "append", None), ("TV", new, "overwrite", None)])


@query("snapshot_round_trip", """SELECT CAST(doc_id AS varchar) AS item, coalesce(lang, '') AS sku, '' AS country, length(coalesce(text, '')) AS n_chars, md5(coalesce(text, '')) AS text_md5,
 concat(' "', coalesce(source, ''), '", ') AS savings FROM documents""")
def snapshot_round_trip(spark, sf):
    """Whole texts written as a snapshot and read again by other columns in another order."""
    rows = I.table(spark, sf, "documents").selectExpr(
        "cast(doc_id AS string) AS item", "lang AS sku", "text AS retailer_sku_name", "concat(' \"', coalesce(source, ''), '\", ') AS savings")
    path = work_dir(spark, "snapshot")
    S.write_snapshot(rows, path, ["retailer_sku_name", "item", "savings", "sku"], translate=False)
    back = S.read_snapshot(spark, path, ["item", "sku", "country", "retailer_sku_name", "savings"])
    return back.select("item", "sku", "country", "savings", F.length("retailer_sku_name").alias("n_chars"), F.md5("retailer_sku_name").alias("text_md5"))


@query("header_contract", """WITH h AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'item,sku,item' WHEN 1 THEN 'item,sku,price,extra' ELSE 'item,sku,price' END AS header FROM documents)
SELECT doc_id, 'duplicate_columns' AS kind, 'critical' AS severity, 'item' AS "column" FROM h WHERE header = 'item,sku,item' UNION ALL SELECT doc_id, 'missing_columns', 'critical', 'price' FROM h WHERE header = 'item,sku,item'
UNION ALL SELECT doc_id, 'extra_columns', 'low', 'extra' FROM h WHERE header LIKE '%extra'""")
def header_contract(spark, sf):
    headers = I.table(spark, sf, "documents").selectExpr(
        "doc_id", "split(CASE doc_id % 3 WHEN 0 THEN 'item,sku,item' WHEN 1 THEN 'item,sku,price,extra' ELSE 'item,sku,price' END, ',') AS header")
    return S.header_contract(headers, ["doc_id"], ["item", "sku", "price"])


@query("row_contract", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber WHEN 1 THEN 2 ELSE 4 END AS fields, CASE l_linenumber WHEN 1 THEN 'short_row' ELSE 'extra_values_without_header' END AS violation FROM lineitem WHERE l_linenumber IN (1, 2)""")
def row_contract(spark, sf):
    lines = I.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "CASE l_linenumber WHEN 1 THEN 'a,b' WHEN 2 THEN 'a,b,c,d' WHEN 3 THEN '\"x,y\",b,\"q\"\",r\"' ELSE 'a,,' END AS line")
    return S.row_contract(lines, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 3)


@query("best_source", """WITH c AS (SELECT o_custkey, o_orderkey, o_orderdate AS modified, CASE WHEN o_orderpriority = '5-LOW' THEN 'bad_header' WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'old' ELSE '' END AS reason, o_orderkey % 3 AS priority FROM orders),
g AS (SELECT o_custkey, count(CASE WHEN reason <> '' THEN 1 END) AS rejected FROM c GROUP BY o_custkey),
b AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY modified DESC, priority DESC, cast(o_orderkey AS varchar) DESC) AS r FROM c WHERE reason = '')
SELECT g.o_custkey, cast(b.o_orderkey AS varchar) AS path, rejected FROM g LEFT JOIN b ON b.o_custkey = g.o_custkey AND b.r = 1""")
def best_source(spark, sf):
    c = I.table(spark, sf, "orders").selectExpr(
        "o_custkey", "cast(o_orderkey AS string) AS path", "o_orderdate AS modified", "o_orderkey % 3 AS priority", "timestamp'1997-01-01' AS target_modified",
        "CASE WHEN o_orderpriority = '5-LOW' THEN 'bad_header' ELSE '' END AS header_error", "'' AS row_error")
    return S.best_source(c, ["o_custkey"])


@query("publish_gate", """WITH t AS (SELECT o_custkey AS run, count(*) AS n, min(CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN o_orderkey END) AS bad FROM orders GROUP BY o_custkey),
m AS (SELECT t.*, c_acctbal > 0 AS complete, n + CASE WHEN c_nationkey = 7 THEN 1 ELSE 0 END AS declared FROM t JOIN customer ON c_custkey = run)
SELECT run, CASE WHEN NOT complete THEN 'incomplete' WHEN n <> declared THEN 'product_rows' WHEN bad IS NOT NULL THEN 'product_identity' ELSE '' END AS reason, bad AS first_mismatch FROM m""")
def publish_gate(spark, sf):
    orders = I.table(spark, sf, "orders")
    target = orders.selectExpr("o_custkey AS run", "o_orderkey AS position", "cast(o_custkey AS string) AS item", "o_orderstatus AS product_url")
    product = target.join(orders.selectExpr("o_orderkey AS position", "o_totalprice"), "position").withColumn(
        "product_url", F.expr("CASE WHEN product_url = 'P' AND o_totalprice > 400000 THEN 'z' ELSE product_url END")).drop("o_totalprice")
    hashes = TB.content_hash(target, ["run"], ["item", "product_url", "position"])
    cust = I.table(spark, sf, "customer").selectExpr("c_custkey AS run", "c_acctbal > 0 AS complete", "CASE WHEN c_nationkey = 7 THEN 1 ELSE 0 END AS off")
    manifest = cust.join(hashes, "run").select(
        "run", "complete", (F.col("rows") + F.col("off")).alias("expected_rows"), F.col("content").alias("target_content"))
    return TB.publish_gate(target, product, manifest, ["run"])


# ---- payload checks: documents built from events -------------------------------------------------------------

def _payload_query(name, json_sql, check, want, extra=None):
    column_query(name, "events", ["event_id"], {**(extra or {}), "doc_text": json_sql}, {
        "error": (lambda c: check({**c, "doc": F.try_parse_json(c["doc_text"])}), want)})


U_ = I.vc("user_id")
_payload_query("search_payload_check",
    f"""CASE event_type WHEN 'view' THEN concat('{{"products":[{{"title":"a","path":"/x/p/1/"}},{{"title":"', CASE WHEN user_id % 2 = 0 THEN 'b' ELSE ' ' END, '","path":"/x/p/2/"}}],"pagination":{{"page":1,"size":', CASE WHEN user_id % 3 = 0 THEN '30' ELSE '60' END, '}},"sorts":[{{"selected":true,"type":"score","orientation":"desc"}}],"term":{{"raw":"Smart  TV"}}}}')
     WHEN 'click' THEN '{{"products":[]}}' WHEN 'error' THEN '[1]' WHEN 'signup' THEN '{{"products":[1],"pagination":{{"page":2,"size":60}}}}' ELSE '{{"products":[{{"title":"a"}}],"pagination":{{"page":1,"size":60}},"sorts":[]}}' END""",
    lambda c: PL.search_error(c["doc"], F.lit(1), 60, F.lit("score"), F.lit("smart+tv")),
    "CASE event_type WHEN 'view' THEN CASE WHEN user_id % 3 = 0 THEN 'page_size_mismatch:30!=60' WHEN user_id % 2 = 0 THEN '' ELSE 'invalid_product:1:missing_title' END WHEN 'click' THEN 'empty_products' WHEN 'error' THEN 'invalid_search_payload' WHEN 'signup' THEN 'page_mismatch:2!=1' ELSE 'selected_sort_missing' END",
    {"event_type": "event_type", "user_id": "user_id"})
_payload_query("product_source_check",
    """CASE event_type WHEN 'view' THEN concat('{"product":{"id":1,"name":"n","description":"', CASE WHEN user_id % 2 = 0 THEN 'd' ELSE '' END, '"},"sku":{"id":', cast(user_id % 3 AS varchar(3)), '}}') WHEN 'click' THEN '{}' WHEN 'error' THEN '{"isValid":false}' WHEN 'signup' THEN '{"product":{"id":1},"sku":{}}' ELSE '{"product":{"id":1,"specGroups":[{"specs":[{"name":"a","value":"b"}]}]},"sku":{"id":2,"name":"x"}}' END""",
    lambda c: PL.product_source_error(c["doc"], F.lit("2")),
    "CASE event_type WHEN 'view' THEN CASE WHEN user_id % 3 <> 2 THEN concat('sku_mismatch:', user_id % 3) WHEN user_id % 2 = 0 THEN '' ELSE 'missing_product_content' END WHEN 'click' THEN 'empty_data' WHEN 'error' THEN 'is_valid_false' WHEN 'signup' THEN 'missing_product_or_sku' ELSE '' END",
    {"event_type": "event_type", "user_id": "user_id"})
_payload_query("review_payload_check",
    """CASE event_type WHEN 'view' THEN concat('{"review":{"rating":"', cast(user_id % 8 AS varchar(3)), '","ratingQty":3,"userReviews":[{}]}}') WHEN 'click' THEN '{"review":{"userReviews":[1]}}' WHEN 'error' THEN '{"x":1}' WHEN 'signup' THEN '{"review":{"userReviews":{}}}' ELSE '{"review":{"recommendationPercentage":"abc"}}' END""",
    lambda c: PL.review_error(c["doc"]),
    "CASE event_type WHEN 'view' THEN CASE WHEN user_id % 8 > 5 THEN 'invalid_rating' ELSE '' END WHEN 'click' THEN 'invalid_review_item' WHEN 'error' THEN 'missing_review' WHEN 'signup' THEN 'invalid_user_reviews' ELSE 'invalid_recommendationPercentage' END",
    {"event_type": "event_type", "user_id": "user_id"})
_payload_query("response_envelope_check",
    """CASE event_type WHEN 'view' THEN concat('{"data":{"item":', CASE WHEN user_id % 2 = 0 THEN '{"a":1}' ELSE 'null' END, '}}') WHEN 'click' THEN '{"errors":[1],"data":{}}' WHEN 'error' THEN 'x' WHEN 'signup' THEN '{"errors":[]}' ELSE '{"data":[]}' END""",
    lambda c: PL.envelope_error(c["doc"], require_item=True),
    "CASE event_type WHEN 'view' THEN CASE WHEN user_id % 2 = 0 THEN '' ELSE 'graphql_item_missing' END WHEN 'click' THEN 'graphql_errors' WHEN 'error' THEN 'invalid_json' WHEN 'signup' THEN 'graphql_data_missing' ELSE 'graphql_data_invalid_type' END",
    {"event_type": "event_type", "user_id": "user_id"})


@query("freight_texts", """SELECT event_id, CASE event_type WHEN 'view' THEN concat('Entrega normal ', user_id, ' dias') WHEN 'click' THEN 'Entrega indisponivel para este CEP' WHEN 'error' THEN 'sem entrega' ELSE '' END AS delivery_availability,
CASE event_type WHEN 'view' THEN 'Retira loja hoje' WHEN 'click' THEN 'Pickup 2h' ELSE '' END AS pick_up_availability FROM events""")
def freight_texts(spark, sf):
    docs = I.table(spark, sf, "events").selectExpr("event_id", f"""try_parse_json(CASE event_type WHEN 'view' THEN concat('{{"options":[{{"name":"Entrega normal","deadline":"', {U_}, ' dias"}},{{"freights":[{{"name":"Retira loja","description":"hoje"}},{{"name":"Agendada","deadline":"x"}}]}}]}}')
        WHEN 'click' THEN '{{"items":[{{"name":"Pickup","deadline":"2h"}}]}}' WHEN 'error' THEN '{{"error":{{"message":"sem entrega"}}}}' WHEN 'signup' THEN '{{"error":{{"message":"O cálculo de frete apresentou problemas"}}}}' ELSE '[]' END) AS doc""")
    return PL.freight_texts(docs).select("event_id", "delivery_availability", "pick_up_availability")


column_query("shipping_texts", "events", ["event_id"],
    {"event_type": "event_type", "n": U_, "doc_text": f"""CASE event_type WHEN 'view' THEN concat('{{"deliveries":[{{"modalities":[{{"type":"x","shippingTime":{{"description":""}}}},{{"type":"pickup_store","shippingTime":{{"description":"P', {U_}, '"}}}},{{"shippingTime":{{"description":"D', {U_}, '"}}}}]}}]}}')
     WHEN 'click' THEN '{{"shippings":[{{"packages":[{{"deliveryTypes":[{{"description":" "}},{{"description":"pack"}}]}}]}}]}}' ELSE '{{}}' END"""},
    {"delivery": (lambda c: PL.shipping_texts(F.try_parse_json(c["doc_text"]))["delivery"], "CASE event_type WHEN 'view' THEN concat('D', n) WHEN 'click' THEN 'pack' ELSE '' END"),
     "pickup": (lambda c: PL.shipping_texts(F.try_parse_json(c["doc_text"]))["pickup"], "CASE event_type WHEN 'view' THEN concat('P', n) ELSE '' END")})
