"""Streaming jobs run to the end of the stored events; results equal the batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators.ranking import with_identity
from vitrine.plans import inputs as I
from vitrine.plans.registry import query
from vitrine.session import work_dir
from vitrine.streaming import jobs as J


@query("usage_counts_stream", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type AS retailer, count(*) AS calls FROM events GROUP BY 1, 2")
def usage_counts_stream(spark, sf):
    base = work_dir(spark, "usage")
    events = J.table_stream(spark, sf, "events.parquet").withColumnRenamed("event_type", "retailer")
    # update mode: a batch writes only the windows it changed, and old windows leave the state
    J.run_available(J.usage_counts(events, ["retailer"]), f"{base}/checkpoint", J.write_batches(f"{base}/out"), "update")
    out = J.latest(spark, f"{base}/out", ["window_start", "retailer"], ["calls"])
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "retailer", "calls")


_IDS = ("SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d') AS run, CASE WHEN l_linestatus = 'O' THEN 'North Shop' ELSE 'South Shop' END AS retailer, l_partkey AS item, "
        "CASE WHEN l_linenumber <= 4 THEN '1' ELSE '2' END AS seller FROM lineitem")


@query("first_seen_stream", _IDS)
def first_seen_stream(spark, sf):
    base = work_dir(spark, "first-seen")
    lines = J.table_stream(spark, sf, "lineitem.parquet").selectExpr(
        "CASE WHEN l_linestatus = 'O' THEN 'North Shop' ELSE 'South Shop' END AS retailer", "l_partkey AS item", "'' AS sku",
        "CASE WHEN l_linenumber <= 4 THEN '1' ELSE '2' END AS seller", "l_shipdate",
        "concat('https://Shop.example/p/', l_partkey, '/?utm_source=x&seller_id=', CASE WHEN l_linenumber <= 4 THEN '1' ELSE '2' END) AS product_url")
    firsts = J.first_seen(with_identity(lines), "l_shipdate", ["retailer", "identity"])
    J.run_available(firsts, f"{base}/checkpoint", J.write_batches(f"{base}/out"))
    return spark.read.parquet(f"{base}/out").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("run"), "retailer", "item", "seller")


@query("resumable_load_stream", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def resumable_load_stream(spark, sf):
    base = work_dir(spark, "resume")
    sink = J.write_batches(f"{base}/out")
    for _ in range(2):  # the second run finds nothing new behind its checkpoint
        J.run_available(J.table_stream(spark, sf, "events.parquet"), f"{base}/checkpoint", sink)
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
