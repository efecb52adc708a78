"""Run reports: page statistics, reviews, usage of retries, status, stage resume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.text import as_text, blank, present
from vitrine.functions.urls import canonical_retailer, host_allowed, sku_from_url
from vitrine.operators.numbering import first_rows, running_rank


# ---- listing pages --------------------------------------------------------------------------------


def page_stats(products: DataFrame, keys: list[str], relevant: Column, parsed: Column) -> DataFrame:
    """Raw, kept, dropped and parsed products of every page."""
    return products.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("raw_products"), F.count_if(relevant).alias("kept_products"),
        F.count_if(~relevant).alias("dropped_products"), F.count_if(parsed).alias("parsed_rows"),
    )


def content_error(raw: Column, kept: Column, dropped: Column, parsed: Column) -> Column:
    """Arithmetic of a page's statistics; '' when it adds up."""
    return (
        F.when(raw <= 0, "empty_products")
        .when(raw != kept + dropped, "product_arithmetic_mismatch")
        .when(kept != parsed, F.concat(F.lit("parsed_rows_mismatch:"), parsed.cast("string"), F.lit("!="), kept.cast("string")))
        .otherwise("")
    )


def sort_error(run_id: Column, kind: Column, direction: Column) -> Column:
    """The page must be sorted by sold quantity (best-sellers) or by score."""
    want = F.when(F.lower(run_id) == "bsr", "soldQuantity").otherwise("score")
    shown = lambda c: F.when(as_text(c) == "", "missing").otherwise(as_text(c))
    return F.when((as_text(kind) == want) & (as_text(direction) == "desc"), "").otherwise(F.concat(
        F.lit("selected_sort_mismatch:"), shown(kind), F.lit(":"), shown(direction), F.lit("!="), want, F.lit(":desc")))


def row_violations(rows: DataFrame, keys: list[str], retailer: str, line: str, hosts: list[str],
                   source_url: Column) -> DataFrame:
    """Listing rows that contradict their run: one row per broken rule."""
    # the URL is taken apart once, and every rule is a flag of its own: rules inside an array function would not be compiled
    read = rows.withColumns({"__url_item": sku_from_url(F.col("product_url")), "__allowed": host_allowed(F.col("product_url"), hosts)})
    url_item = F.col("__url_item")
    bad_url = ~F.col("__allowed") | (url_item == "")
    rules = (
        ("retailer", F.trim("retailer") != retailer), ("product_line", F.trim("product_line") != line),
        ("item_missing", blank(F.col("item"))), ("name_missing", blank(F.col("retailer_sku_name"))),
        ("product_url_invalid", bad_url),
        ("url_item_mismatch", ~bad_url & (url_item != F.trim("item"))),
        ("source_url_mismatch", F.trim("source_url") != source_url),
    )
    flagged = read.select(*keys, *[F.coalesce(test, F.lit(True)).alias(f"__{name}") for name, test in rules])
    none = F.array().cast("array<string>")
    found = F.concat(*[F.when(F.col(f"__{name}"), F.array(F.lit(name))).otherwise(none) for name, _ in rules])
    return flagged.select(*keys, F.explode(found).alias("violation"))


def product_summary(products: DataFrame, keys: list[str], relevant: Column, sponsored: Column) -> DataFrame:
    """Returned, relevant, filtered and sponsored products per page."""
    return products.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("returned"), F.count_if(relevant).alias("relevant"),
        F.count_if(~relevant).alias("filtered"), F.count_if(sponsored).alias("sponsored"),
    )


def failed_pages(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct positive failed pages, in page order."""
    bad = attempts.filter((F.col("page") > 0) & present(F.col("error")))
    return bad.select(*keys, "page").distinct().orderBy(*keys, "page")


def retry_sets(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """Per page that failed in the first pass: retried, recovered, not required, unresolved.

    attempts: pass (0 = first), page, error.  The last pass decides what was attempted
    finally and what is still failing.
    """
    last = attempts.groupBy(*keys).agg(F.max("pass").alias("last_pass"))
    a = attempts.join(last, keys)
    failed = present(F.col("error"))
    per_page = a.groupBy(*keys, "page").agg(
        F.max((F.col("pass") == 0) & failed).alias("initial"),
        F.max(F.col("pass") > 0).alias("attempted_later"),
        F.max(F.col("pass") == F.col("last_pass")).alias("attempted_last"),
        F.max((F.col("pass") == F.col("last_pass")) & failed).alias("unresolved"),
    )
    return per_page.filter("initial AND page > 0").select(
        *keys, "page", F.col("attempted_later").alias("retried"),
        (F.col("attempted_last") & ~F.col("unresolved")).alias("recovered"),
        (~F.col("attempted_last")).alias("not_required"), "unresolved",
    )


# ---- reviews -----------------------------------------------------------------------------------------


def review_arrays(reviews: DataFrame, keys: list[str], order: str, body: str, limit: int | None = None) -> DataFrame:
    """Non-empty reviews of a product as an array, with their count.

    A caller who wants only the first ``limit`` says so; that cut is made before anything
    is collected.
    """
    some = reviews.filter(present(F.col(body)))
    if limit is None:
        listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(body).alias("body"))))
        return some.groupBy(*keys).agg(F.transform(listed, lambda r: r["body"]).alias("reviews"), F.count(F.lit(1)).alias("n_reviews"))
    kept = first_rows(some, keys, [order], limit, "review_rank")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("review_rank", body))), lambda r: r[body])
    counts = some.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_reviews"))
    return kept.groupBy(*keys).agg(ordered.alias("reviews")).join(counts, keys)


def review_rows(rows: DataFrame, keys: list[str], reviews: str = "reviews", limit: int | None = None) -> DataFrame:
    """One row per review, ranked from 1; with ``limit``, the first ones of a product."""
    bodies = F.filter(F.col(reviews), lambda r: present(r))
    cut = bodies if limit is None else F.slice(bodies, 1, limit)
    return rows.select(*keys, F.posexplode(cut).alias("p", "detailed_review_content")).select(
        *keys, (F.col("p") + 1).alias("review_rank"), "detailed_review_content")


def ranked_reviews(reviews: DataFrame, keys: list[str], order: str, body: str) -> DataFrame:
    """The same from a long table of reviews: no product's reviews meet in one array or one task.

    ``order`` is an integer column, nulls first; reviews of one place stand by their text.
    """
    some = reviews.filter(present(F.col(body))).select(
        *keys, F.coalesce(F.col(order).cast("long"), F.lit(-(1 << 40))).alias("__place"), F.col(body).alias("detailed_review_content"))
    ranked = running_rank(some, keys, "__place", ["detailed_review_content"], "review_rank")
    return ranked.select(*keys, F.col("review_rank").cast("int").alias("review_rank"), "detailed_review_content")


def short_reviews(rows: DataFrame, keys: list[str], reviews: str = "reviews", limit: int | None = None) -> DataFrame:
    """Products with fewer reviews than stated (with ``limit``, than that many of them)."""
    count = F.replace(F.trim(as_text(F.col("count_of_reviews"))), F.lit("."), F.lit("")).try_cast("int")
    stated = F.greatest(count, F.lit(0))
    expected = stated if limit is None else F.least(F.lit(limit), stated)
    actual = F.size(F.filter(F.col(reviews), lambda r: present(r)))
    return rows.select(
        *keys, "count_of_reviews", F.coalesce(expected, F.lit(0)).alias("expected_review_count"),
        actual.alias("actual_review_count"),
    ).filter("expected_review_count > 0 AND actual_review_count < expected_review_count")


# ---- event log ------------------------------------------------------------------------------------------


def run_report(events: DataFrame, keys: list[str]) -> DataFrame:
    """Event log of a run: latest start and end, page outcomes, calls, first refused call.

    events: event (run_start, page_end, api_end, run_end or anything else), ts, event_id,
    status, ok, detail.
    """
    known = F.col("event").isin("run_start", "page_end", "api_end", "run_end")
    order = F.struct("ts", "event_id")
    of = lambda name: F.col("event") == name
    latest = lambda name: F.max(F.when(of(name), F.struct("ts", "event_id", "detail")))["detail"]
    return events.groupBy(*keys).agg(
        F.count_if(known).alias("event_count"), F.count_if(~known).alias("ignored_lines"),
        latest("run_start").alias("run"), F.coalesce(latest("run_end"), F.lit("interrupted")).alias("outcome"),
        F.count_if(of("page_end")).alias("pages"), F.count_if(of("page_end") & F.col("ok")).alias("pages_ok"),
        F.count_if(of("api_end")).alias("calls"),
        F.min(F.when(of("api_end") & (F.col("status") == 403), order))["event_id"].alias("first_403_event"),
    )


def run_status(counts: DataFrame, loads: DataFrame, keys: list[str]) -> DataFrame:
    """Row counts of all stages in one row per run and the success flag.

    counts: stage, row_count (long form).  loads: load_success, inserted.
    """
    stages = ("main_rows", "main_target_rows", "bsr_rows", "final_target_rows", "final_output_rows", "review_rows")
    wide = counts.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col("stage") == s, F.col("row_count"))), F.lit(0)).alias(s) for s in stages])
    out = wide.join(loads, keys, "left").withColumns({
        "load_success": F.coalesce("load_success", F.lit(False)), "inserted": F.coalesce("inserted", F.lit(0))})
    ok = (F.col("final_output_rows") > 0) & F.col("load_success") & (F.col("inserted") == F.col("final_output_rows"))
    return out.withColumn("success", ok)


def status_issues(status: DataFrame, keys: list[str]) -> DataFrame:
    """Readable issues of a run status; tracking_error is optional text."""
    n = lambda c: F.col(c).cast("string")
    rules = [
        F.when(F.col("final_output_rows") <= 0, F.lit("Final output row count is 0.")),
        F.when(~F.col("load_success"), F.lit("DB load did not report success.")),
        F.when(F.col("inserted") != F.col("final_output_rows"), F.concat(
            F.lit("DB inserted rows mismatch: inserted="), n("inserted"), F.lit(", final_output="),
            n("final_output_rows"), F.lit("."))),
    ]
    if "tracking_error" in status.columns:
        rules.append(F.when(present(F.col("tracking_error")), F.concat(
            F.lit("HTTP request tracking is unavailable: "), F.col("tracking_error"), F.lit("."))))
    return status.select(*keys, F.posexplode(F.array_compact(F.array(*rules))).alias("issue_no", "issue"))


# Stages that run again whenever they are selected.
ALWAYS_AGAIN = ("status_check", "s3_sync", "local_cleanup", "db_prepare", "db_load")


def stages_to_run(stages: DataFrame, keys: list[str]) -> DataFrame:
    """Stages a resumed run repeats: everything from the first incomplete one on.

    stages: step_no, stage, complete.  A run has some twenty stages, so the window is tiny.
    """
    refresh = F.col("stage").isin(*ALWAYS_AGAIN)
    gap = (~F.col("complete") & ~refresh).cast("int")
    before = Window.partitionBy(*keys).orderBy("step_no").rowsBetween(Window.unboundedPreceding, 0)
    forced = F.max(gap).over(before) == 1
    return stages.withColumn("todo", forced | refresh | ~F.col("complete"))


def expired_runs(files: DataFrame, protected: DataFrame, keys: list[str], cutoff: Column) -> DataFrame:
    """Runs whose newest file is not newer than the cutoff, minus protected ones."""
    newest = files.groupBy(*keys).agg(F.max("modified").alias("latest_modified"))
    return newest.filter(F.col("latest_modified") <= cutoff).join(protected.select(*keys), keys, "left_anti")


def context_violation(rows: DataFrame, keys: list[str], position: str = "position") -> DataFrame:
    """First row of a run whose line or retailer is not the run's.

    rows: expected_line, expected_retailer, product_line, retailer.
    """
    line = F.upper(F.trim(as_text(F.col("product_line"))))
    given, key = F.trim(as_text(F.col("retailer"))), canonical_retailer(F.col("retailer"))
    reason = (
        F.when(line == "", "product_line_missing")
        .when(~line.isin("TV", "REF", "LDY"), "product_line_unknown")
        .when(line != F.col("expected_line"), "product_line_mismatch")
        .when(given == "", "retailer_missing")
        .when(key == "", "retailer_unknown")
        .when(key != F.col("expected_retailer"), "retailer_mismatch")
    )
    bad = rows.withColumn("reason", reason).filter("reason IS NOT NULL")
    return bad.groupBy(*keys).agg(F.min(F.struct(position, "reason")).alias("f"), F.count(F.lit(1)).alias("violations")).select(
        *keys, F.col(f"f.{position}").alias(position), "f.reason", "violations")


def field_catalogue(catalogue: DataFrame, country: str, line: str) -> DataFrame:
    """Fields of a country and line: how many, and which retailers."""
    kept = catalogue.filter((F.col("country") == country) & (F.upper(F.trim("product_line")) == line))
    return kept.agg(
        F.count(F.lit(1)).alias("field_count"),
        F.sort_array(F.collect_set(F.when(F.col("retailer") != "", F.col("retailer")))).alias("retailers"))
