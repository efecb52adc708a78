"""Request usage ledger: append-only JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.text import as_text

EVENT = "zenrows_http_request_attempt"
SCHEMA = (
    "event string, recorded_at_utc timestamp, retailer string, product_line string, method string, "
    "profile string, estimated_multiplier string"
)


def parse_ledger(lines: DataFrame, line: str = "value", event: str = EVENT) -> DataFrame:
    """One row per line; invalid JSON and foreign events stay as ``error`` rows."""
    doc = F.try_parse_json(F.col(line))
    is_object = F.schema_of_variant(doc).startswith("OBJECT")
    e = F.from_json(F.when(doc.isNotNull(), F.col(line)), SCHEMA)
    error = (
        F.when(doc.isNull(), "invalid_ledger_json")
        .when(~is_object | ~F.coalesce(e["event"] == event, F.lit(False)), "invalid_ledger_event")
        .otherwise("")
    )
    name = lambda c: F.regexp_replace(F.lower(F.trim(as_text(c))), r"[^a-z0-9_-]+", "_")
    segment = lambda c: F.coalesce(
        F.nullif(F.regexp_replace(name(c), r"^_+|_+$", ""), F.lit("")), F.lit("unknown"))
    out = lines.withColumns({"e": e, "error": error})
    return out.select(
        *[c for c in lines.columns if c != line], "error",
        *[F.when(F.col("error") == "", F.col(f"e.{c}")).alias(c)
          for c in ("recorded_at_utc", "method", "profile", "estimated_multiplier")],
        *[F.when(F.col("error") == "", segment(F.col(f"e.{c}"))).alias(c) for c in ("retailer", "product_line")],
    )


def read_usage_ledger(spark: SparkSession, path: str, event: str = EVENT) -> DataFrame:
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return parse_ledger(lines, event=event)


def usage_summary(ledger: DataFrame) -> DataFrame:
    """Calls in total, by retailer, by line; distinct errors and the tracking status."""
    ok = ledger.filter("error = ''")
    # both breakdowns in one pass over the ledger
    by = ok.groupingSets([("retailer",), ("product_line",)], "retailer", "product_line").agg(
        F.count(F.lit(1)).alias("calls"), F.grouping("retailer").alias("g"))
    split = by.select(
        F.when(F.col("g") == 0, "retailer").otherwise("product_line").alias("kind"),
        F.when(F.col("g") == 0, F.col("retailer")).otherwise(F.col("product_line")).alias("name"), "calls")
    total = ledger.agg(
        F.count_if(F.col("error") == "").alias("calls"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("error") != "", F.col("error")))), ",").alias("errors"))
    status = total.select(
        F.lit("total").alias("kind"),
        F.when(F.col("errors") == "", "complete").otherwise(F.concat(F.lit("error:"), F.col("errors"))).alias("name"),
        "calls")
    return status.unionByName(split)


def ladder_violations(events: DataFrame, keys: list[str], order: str, ladder: list[tuple]) -> DataFrame:
    """Calls that are not the expected step of the request ladder, per run.

    ladder: (step from 1, method, profile, multiplier) of every step.  A run may be shorter
    than the ladder, never longer or different.
    """
    from vitrine.operators.numbering import first_rows

    steps = len(ladder)
    # only the first steps can match; any further call is a violation by itself
    head = first_rows(events, keys, [order], steps, "step")
    want = events.sparkSession.createDataFrame(ladder, "step int, w_method string, w_profile string, w_multiplier string")
    wrong = head.join(want, "step", "left").filter(
        (F.col("method") != F.col("w_method")) | (F.col("profile") != F.col("w_profile"))
        | (F.col("multiplier") != F.col("w_multiplier")))
    counts = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("calls"))
    bad = wrong.groupBy(*keys).agg(F.min("step").alias("first_wrong_step"))
    return counts.join(bad, keys, "left").select(
        *keys, "calls", "first_wrong_step",
        (F.col("first_wrong_step").isNull() & (F.col("calls") <= steps)).alias("matches_ladder"))
