"""Published rows: one projection from the internal snapshot to the output contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import metrics as X
from vitrine.functions import models as D
from vitrine.functions import money as M
from vitrine.functions import text as T
from vitrine.functions.translate import translate_columns
from vitrine.functions.urls import account_name, item_from_url
from vitrine.operators.ranking import page_type
from vitrine.sources.snapshot import final_columns

PRESERVED = ("ref_refrigerator_type", "ldy_loading_type")


def final_rows(rows: DataFrame, keys: list[str], layout: str, line: str, country: str, hosts: list[str],
               run_time: Column, translate: bool = True) -> DataFrame:
    """All output columns of one layout and line, in contract order.

    ``rows`` carries the snapshot columns, ``recovered`` (field names taken from the
    history) and ``keys``.  ``run_time`` is the run's timestamp.
    """
    r = {c: F.col(c) for c in rows.columns}
    recovered = F.coalesce(r["recovered"], F.array().cast("array<string>")) if "recovered" in r else F.array().cast("array<string>")
    from_history = lambda f: F.array_contains(recovered, f)
    lay = F.lit(layout)
    item_in_url = item_from_url(r["product_url"])
    sku = D.sku_for_output({**r, "item": item_in_url}, layout, line, hosts, F.lit(""), from_history("sku"))
    staged = rows.withColumns({"__sku": sku, "__url_item": item_in_url})
    sku = F.col("__sku")
    no_item = F.lit("") if (layout, line) == ("C", "TV") else sku
    original, final = M.price_for_output(r["original_sku_price"]), M.price_for_output(r["final_sku_price"])
    screen = (
        F.when(from_history("screen_size"), F.trim(T.as_text(r["screen_size"])))
        .otherwise(X.screen_size_for_output(r["screen_size"])) if line == "TV" else T.as_text(r["screen_size"])
    )
    failed = T.has_token_prefix(r["parse_status"], "reviews_graphql_failed:") & F.lit(layout == "M")
    pickup = F.lit("") if layout == "M" and line != "TV" else T.as_text(r["pick_up_availability"])
    text = lambda c: T.as_text(r[c])
    made = {
        "country": F.lit(country), "product": F.lit(line),
        "item": T.first_present(r["item"], F.col("__url_item"), no_item),
        "account_name": account_name(r["retailer"], r["product_url"]),
        "page_type": page_type(r["main_rank"], r["bsr_rank"], F.lit("")),
        "retailer_sku_name": text("retailer_sku_name"), "product_url": text("product_url"),
        "original_sku_price": M.original_for_output(original, final), "final_sku_price": final,
        "savings": M.savings_for_output(r["savings"], lay), "sku_status": text("sku_status"),
        "discount_type": M.discount_type_for_output(r["discount_type"]),
        "delivery_availability": X.delivery_for_output(r["delivery_availability"], lay),
        "pick_up_availability": pickup, "sku": sku, "screen_size": screen,
        "estimated_annual_electricity_use": F.trim(text("estimated_annual_electricity_use")),
        "model_year": text("model_year"), "ref_refrigerator_type": text("ref_refrigerator_type"),
        "ref_capacity": text("ref_capacity"), "ldy_loading_type": text("ldy_loading_type"),
        "ldy_color": text("ldy_color"), "ldy_capacity": text("ldy_capacity"),
        "sku_short_version": D.short_for_output(r, sku, layout, line, F.lit("")),
        "summarized_review_content": T.summary_text(r["summarized_review_content"]),
        "retailer_sku_name_similar": T.join_values(r["retailer_sku_name_similar"], drop_noise=True),
        "star_rating": X.star_rating(r["star_rating"]),
        "count_of_star_ratings": X.count_metric(r["count_of_star_ratings"]),
        "count_of_reviews": X.count_metric(r["count_of_reviews"], failed),
        "recommendation_intent": X.recommendation_percent(r["recommendation_intent"]),
        "detailed_review_content": T.join_reviews(T.as_list(r["detailed_review_content"])),
        "bsr_rank": r["bsr_rank"], "main_rank": r["main_rank"], "calendar_week": X.iso_week(run_time),
        "crawl_strdatetime": X.crawl_time(run_time), "batch_id": X.batch_id(run_time, lay),
    }
    columns = final_columns(line)
    out = staged.select(*keys, *[made[c].alias(c) for c in columns if c not in keys], recovered.alias("__recovered"))
    if translate:
        kept = F.filter(F.col("__recovered"), lambda f: f.isin(*PRESERVED))
        out = translate_columns(out, preserve=kept)
    return out.drop("__recovered")


def manifest_counts(final: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and ranked rows of a published run."""
    return final.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(T.present(F.col("main_rank"))).alias("main_rank_rows"),
        F.count_if(T.present(F.col("bsr_rank"))).alias("bsr_rank_rows"))
