"""Text snapshots and their contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.functions.text import as_text
from vitrine.functions.translate import translate_columns

# Columns of the internal snapshot and of the published rows.
SNAPSHOT_COLUMNS = (
    "retailer", "country", "product_line", "item", "category", "main_rank", "bsr_rank", "product_url",
    "retailer_sku_name", "original_sku_price", "final_sku_price", "savings", "sku_status",
    "discount_type", "delivery_availability", "pick_up_availability", "sku", "screen_size",
    "estimated_annual_electricity_use", "model_year", "ref_refrigerator_type", "ref_capacity",
    "ldy_loading_type", "ldy_color", "ldy_capacity", "sku_short_version", "summarized_review_content",
    "retailer_sku_name_similar", "star_rating", "count_of_star_ratings", "count_of_reviews",
    "recommendation_intent", "detailed_review_content", "source_url", "crawl_datetime",
    "fetch_method", "parse_status", "retailer_product_id", "seller_id",
)
COMMON_FINAL = (
    "country", "product", "item", "account_name", "page_type", "retailer_sku_name", "product_url",
    "original_sku_price", "final_sku_price", "savings", "sku_status", "discount_type",
    "delivery_availability", "pick_up_availability",
)
LINE_FINAL = {
    "TV": ("sku", "screen_size", "estimated_annual_electricity_use", "model_year"),
    "REF": ("ref_refrigerator_type", "ref_capacity", "sku_short_version", "sku"),
    "LDY": ("ldy_loading_type", "ldy_color", "ldy_capacity", "sku_short_version", "sku"),
}
REVIEW_FINAL = (
    "summarized_review_content", "retailer_sku_name_similar", "star_rating", "count_of_star_ratings",
    "count_of_reviews", "recommendation_intent", "detailed_review_content", "bsr_rank", "main_rank",
    "calendar_week", "crawl_strdatetime", "batch_id",
)


def final_columns(line: str) -> list[str]:
    """Published columns of a product line in contract order (unknown lines as TV)."""
    return [*COMMON_FINAL, *LINE_FINAL.get(line.strip().upper(), LINE_FINAL["TV"]), *REVIEW_FINAL]


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_snapshot(spark: SparkSession, path: str, columns=SNAPSHOT_COLUMNS) -> DataFrame:
    """Header-named CSV as text; blanks are empty strings; a missing path has no rows.

    Columns are found by the file's header, in whatever order it lists them; a column the
    header lacks is blank.
    """
    schema = text_schema(columns)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False,
                         encoding="UTF-8", nullValue="\u0000", emptyValue="")
    named = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    return named.select(*[
        (as_text(F.col(f"`{c}`")) if c in named.columns else F.lit("")).alias(c) for c in columns
    ])


def write_snapshot(df: DataFrame, path: str, columns, translate: bool = True,
                   preserve: Column | None = None, mode: str = "overwrite") -> None:
    """Project to the declared columns, blank-fill, translate coded texts, write CSV."""
    if translate:
        df = translate_columns(df, preserve=preserve)
    shown = df.select(*[
        (as_text(F.col(c)) if c in df.columns else F.lit("")).alias(c) for c in columns
    ])
    shown.write.mode(mode).csv(path, header=True, escape='"', quoteAll=True, emptyValue="",
                              ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


# ---- contracts over many files at once ------------------------------------------------------------


def header_contract(headers: DataFrame, keys: list[str], expected: list[str],
                    header: str = "header") -> DataFrame:
    """Duplicate, missing and extra columns of every header (``array<string>``)."""
    want = F.array(*[F.lit(c) for c in expected])
    have = F.col(header)
    twice = F.array_distinct(F.filter(
        have, lambda c: F.size(F.filter(have, lambda o: o == c)) > 1))
    entry = lambda kind, severity, cols: F.transform(
        F.sort_array(cols),
        lambda c: F.struct(F.lit(kind).alias("kind"), F.lit(severity).alias("severity"), c.alias("column")))
    found = F.concat(
        entry("duplicate_columns", "critical", twice),
        entry("missing_columns", "critical", F.array_except(want, have)),
        entry("extra_columns", "low", F.array_except(have, want)),
    )
    return headers.select(*keys, F.explode(found).alias("f")).select(*keys, "f.*")


def row_contract(lines: DataFrame, keys: list[str], width: int, line: str = "line") -> DataFrame:
    """Rows of a CSV text that are short or over-long for the header.

    Quoted commas do not separate fields.
    """
    bare = F.regexp_replace(F.col(line), r'"(?:[^"]|"")*"', "q")
    fields = F.size(F.split(bare, ",", -1))
    return lines.withColumn("fields", fields).filter(F.col("fields") != width).select(
        *keys, "fields",
        F.when(F.col("fields") < width, "short_row").otherwise("extra_values_without_header").alias("violation"),
    )


def best_source(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Newest complete candidate per run, ties by priority.

    candidates: path, modified, priority, target_modified, header_error, row_error.
    """
    reason = (
        F.when(F.col("modified") < F.col("target_modified"), "older_than_targets")
        .when(as_text(F.col("header_error")) != "", F.col("header_error"))
        .otherwise(as_text(F.col("row_error")))
    )
    judged = candidates.withColumn("reason", reason)
    good = F.when(F.col("reason") == "", F.struct("modified", "priority", "path"))
    return judged.groupBy(*keys).agg(
        F.max(good).alias("best"), F.count_if(F.col("reason") != "").alias("rejected")
    ).select(*keys, F.col("best.path").alias("path"), "rejected")
