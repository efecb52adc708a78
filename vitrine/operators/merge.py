"""Merging detail rows into target rows under identity proof.

Every left row comes back exactly once.  "Absent" differs from "blank": audited
fields carry a ``has_<field>`` flag, because an evaluated blank clears an old value
while a field the payload never mentioned leaves it alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.metrics import zero_preserving
from vitrine.functions.models import TV_VERIFIED
from vitrine.functions.text import (
    append_token, as_text, blank, first_present, has_token, key_text, present, squash, tokens,
)
from vitrine.functions.urls import sku_from_url
from vitrine.operators.numbering import first_rows, lookup, one_per_key

# Fields whose evaluated blank clears the listing's value.
AUDITED_FIELDS = (
    "screen_size", "estimated_annual_electricity_use", "ref_capacity", "ldy_capacity",
    "ldy_loading_type",
)


def identity_mode(conflict: Column, verified: Column, row_name: Column, detail_name: Column) -> Column:
    """``conflict``, ``verified``, ``same_name`` or '' (no proof)."""
    left, right = key_text(row_name), key_text(detail_name)
    return (
        F.when(F.coalesce(conflict, F.lit(False)), "conflict")
        .when(F.coalesce(verified, F.lit(False)), "verified")
        .when((left != "") & (left == right), "same_name")
        .otherwise("")
    )


def _with_detail(rows: DataFrame, detail: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the columns of their detail row as ``d_*``; each row comes back once.

    Of several detail rows of a key the smallest by its values is taken, and ``d_ambiguous`` says that they differ.
    """
    others = [c for c in detail.columns if c not in keys]
    renamed = one_per_key(detail, keys, others).select(
        *keys, *[F.col(c).alias(f"d_{c}") for c in others], F.col("ambiguous").alias("d_ambiguous"))
    return lookup(rows, renamed, keys)


def merge_detail(rows: DataFrame, detail: DataFrame, keys: list[str], fields: list[str],
                 audited: tuple = AUDITED_FIELDS, verified_only: tuple = ()) -> DataFrame:
    """Apply a detail row by the strength of its identity proof.

    verified: non-blank values overwrite, audited fields also when blank.
    same name: only blanks are filled (never the ``verified_only`` fields).
    conflict, several detail rows that differ (``ambiguous``) or no proof: nothing is merged.
    ``detail``: one row per key with the fields, ``has_<audited>`` flags,
    ``retailer_sku_name``, ``identity_conflict``, ``identity_verified``.
    """
    out = _with_detail(rows, detail, keys).withColumn(
        "identity_mode",
        F.when(F.coalesce("d_ambiguous", F.lit(False)), "ambiguous").otherwise(
            identity_mode(F.col("d_identity_conflict"), F.col("d_identity_verified"),
                          F.col("retailer_sku_name"), F.col("d_retailer_sku_name"))),
    )
    mode = F.col("identity_mode")
    changes = {}
    for f in fields:
        mine, theirs = F.col(f), F.col(f"d_{f}")
        verified = F.when(present(theirs), theirs).otherwise(mine)
        if f in audited and f"has_{f}" in detail.columns:
            flag = F.coalesce(F.col(f"d_has_{f}"), F.lit(False))
            verified = F.when(flag, as_text(theirs)).otherwise(mine)
        same = mine if f in verified_only else F.when(blank(mine) & present(theirs), theirs).otherwise(mine)
        changes[f] = F.when(mode == "verified", verified).when(mode == "same_name", same).otherwise(mine)
    return out.withColumns(changes).drop(*[c for c in out.columns if c.startswith("d_")])


def fill_missing(rows: DataFrame, detail: DataFrame, keys: list[str], fields: list[str],
                 method: str, prefix: str) -> DataFrame:
    """Fill only fields that were missing before; says which were filled.

    ``detail`` additionally has ``success`` and ``error``.
    """
    out = _with_detail(rows, detail, keys)
    ok = F.coalesce(F.col("d_success"), F.lit(False))
    before = F.array_compact(F.array(*[F.when(blank(F.col(f)), F.lit(f)) for f in fields]))
    take = {f: ok & blank(F.col(f)) & present(F.col(f"d_{f}")) for f in fields}
    filled = {f: F.when(take[f], F.col(f"d_{f}")).otherwise(F.col(f)) for f in fields}
    out = out.withColumns({"missing_before": before}).withColumns(filled)
    after = F.array_compact(F.array(*[F.when(blank(F.col(f)), F.lit(f)) for f in fields]))
    out = out.withColumn("filled", F.array_except("missing_before", after))
    got = F.size("filled") > 0
    token = (
        F.when(F.col("d_success").isNull(), None)
        .when(~ok, F.concat(F.lit(f"{prefix}_failed:"), first_present(F.col("d_error"), F.lit("unknown"))))
        .when(got, F.concat(F.lit(f"{prefix}_recovered:"), F.array_join("filled", ",")))
        .otherwise(f"{prefix}_no_target_values")
    )
    return out.withColumns({
        "parse_status": F.when(token.isNotNull(), append_token(F.col("parse_status"), token))
        .otherwise(F.col("parse_status")),
        "fetch_method": F.when(got, append_token(F.col("fetch_method"), method))
        .otherwise(F.col("fetch_method")),
    }).drop(*[c for c in out.columns if c.startswith("d_")])


# Overwrite rules of the page backfill, by field; other fields overwrite when non-blank.
PAGE_RULES = {
    "retailer_sku_name": "truncated",
    "original_sku_price": "keep",
    "final_sku_price": "keep",
    "savings": "keep",
    "retailer_sku_name_similar": "keep",
    "sku": "model",
}


def page_backfill(rows: DataFrame, detail: DataFrame, keys: list[str], fields: list[str],
                  line: Column, rules: dict[str, str] = PAGE_RULES) -> DataFrame:
    """Detail page values over a row, with per-field exceptions.

    A title is replaced only when blank or cut off; existing prices stay; TV takes a
    model only when the page proves it and no source-verified model is present; LDY
    takes no model.  ``detail`` additionally has ``exact_model`` (bool).
    """
    out = _with_detail(rows, detail, keys).withColumn(
        "identity_mode",
        identity_mode(F.col("d_identity_conflict"), F.col("d_identity_verified"),
                      F.col("retailer_sku_name"), F.col("d_retailer_sku_name")),
    )
    usable = F.col("identity_mode").isin("verified", "same_name")
    url_item = F.lower(squash(sku_from_url(F.col("product_url"))))
    model = F.lower(squash(F.col("d_sku")))
    proven = (
        (F.col("identity_mode") == "verified") & F.coalesce(F.col("d_exact_model"), F.lit(False))
        & (url_item != "") & (model != "") & (model != url_item)
        & ~has_token(F.col("parse_status"), TV_VERIFIED[0])
    )
    changes = {}
    for f in fields:
        mine, theirs = F.col(f), F.col(f"d_{f}")
        rule = rules.get(f, "overwrite")
        take = usable & present(theirs)
        if rule == "truncated":
            take = take & (blank(mine) | as_text(mine).endswith("..."))
        elif rule == "keep":
            take = take & blank(mine)
        elif rule == "model":
            take = take & F.when(line == "TV", proven).otherwise(line != "LDY")
        changes[f] = F.when(take, theirs).otherwise(mine)
    seen = F.col("d_identity_verified").isNotNull()
    reason = F.when(F.col("identity_mode") == "conflict", "identity_conflict").otherwise(
        "missing_product_identity"
    )
    status = append_token(
        F.col("parse_status"),
        F.when(usable, F.lit("detail_casas_bahia_html")).otherwise(
            F.concat(F.lit("casas_html_backfill_"), reason)),
    )
    if "sku" in fields:
        unverified = F.filter(tokens(status), lambda t: ~t.isin(*TV_VERIFIED))
        page_model = F.array_join(F.array_append(unverified, F.lit(TV_VERIFIED[1])), "+")
        status = F.when(usable & (line == "TV") & proven, page_model).otherwise(status)
    changes["parse_status"] = F.when(seen, status).otherwise(F.col("parse_status"))
    return out.withColumns(changes).drop(*[c for c in out.columns if c.startswith("d_")])


def jsonld_merge(rows: DataFrame, blocks: DataFrame, keys: list[str], with_review_count: bool) -> DataFrame:
    """Fill blanks from the first product block that matches by name or SKU.

    ``blocks``: keys, pos, block_type, name, sku, price, rating_value, rating_count,
    review_count.  A block that contradicts the row's name or id is skipped.
    """
    left = rows.select(*keys, F.col("retailer_sku_name").alias("r_name"), F.col("product_url").alias("r_url"))
    joined = blocks.filter(F.col("block_type") == "Product").join(left, keys)
    mine, theirs = key_text(F.col("r_name")), key_text(F.col("name"))
    want, have = F.lower(squash(sku_from_url(F.col("r_url")))), F.lower(squash(F.col("sku")))
    contradicts = ((mine != "") & (theirs != "") & (mine != theirs)) | (
        (want != "") & (have != "") & (want != have)
    )
    matches = ((theirs != "") & ((mine == "") | (mine == theirs))) | ((want != "") & (want == have))
    chosen = first_rows(joined.filter(~contradicts & matches), keys, ["pos"])
    out = _with_detail(rows, chosen.drop("r_name", "r_url", "pos", "block_type"), keys)
    pairs = {
        "retailer_sku_name": "name", "sku": "sku", "final_sku_price": "price",
        "star_rating": "rating_value", "count_of_star_ratings": "rating_count",
    }
    if with_review_count:
        pairs["count_of_reviews"] = "review_count"
    filled = {f: first_present(F.col(f), squash(F.col(f"d_{src}"))) for f, src in pairs.items()}
    return out.withColumns(filled).drop(*[c for c in out.columns if c.startswith("d_")])


def merge_reviews_c(rows: DataFrame, reviews: DataFrame, keys: list[str], method: str) -> DataFrame:
    """Layout C: reviews overwrite when there are some, the summary fills a blank only.

    ``reviews``: success, error, reviews (array), seen, summary, rating, rating_count,
    recommendation_percent.
    """
    out = _with_detail(rows, reviews, keys)
    ok, known = F.coalesce(F.col("d_success"), F.lit(False)), F.col("d_success").isNotNull()
    some = ok & (F.coalesce(F.size("d_reviews"), F.lit(0)) > 0)
    n = F.size("d_reviews").cast("string")
    seen = F.coalesce(F.col("d_seen"), F.size("d_reviews")).cast("string")
    token = F.when(n != seen, F.concat(F.lit("reviews_"), n, F.lit("/"), seen)).otherwise(
        F.concat(F.lit("reviews_"), n)
    )
    metric = lambda src, f: F.when(
        ok & (as_text(F.col(src)) != ""), zero_preserving(F.col(src))
    ).otherwise(F.col(f))
    percent = as_text(F.col("d_recommendation_percent"))
    status = F.col("parse_status")
    return out.withColumns({
        "summarized_review_content": F.when(
            ok & blank(F.col("summarized_review_content")) & (as_text(F.col("d_summary")) != ""),
            F.col("d_summary")).otherwise(F.col("summarized_review_content")),
        "detailed_review_content": F.when(some, F.col("d_reviews")).otherwise(F.col("detailed_review_content")),
        "fetch_method": F.when(some, append_token(F.col("fetch_method"), method)).otherwise(F.col("fetch_method")),
        "star_rating": metric("d_rating", "star_rating"),
        "count_of_star_ratings": metric("d_rating_count", "count_of_star_ratings"),
        "count_of_reviews": metric("d_rating_count", "count_of_reviews"),
        "recommendation_intent": F.when(
            ok & (percent != ""), F.concat(percent, F.lit("% dos clientes recomendam esse produto"))
        ).otherwise(F.col("recommendation_intent")),
        "parse_status": F.when(some, append_token(status, token)).when(
            known & ~ok,
            append_token(status, F.concat(F.lit("reviews_api_failed:"),
                                          first_present(F.col("d_error"), F.lit("unknown")))),
        ).otherwise(status),
    }).drop(*[c for c in out.columns if c.startswith("d_")])


def merge_reviews_m(rows: DataFrame, reviews: DataFrame, keys: list[str], method: str) -> DataFrame:
    """Layout M: comment count, else page total; a blank rating keeps the old one.

    ``reviews``: failure (reason or ''), reviews (array), rating, review_count,
    comment_count, page_total.
    """
    out = _with_detail(rows, reviews, keys)
    known = F.col("d_failure").isNotNull()
    some = F.coalesce(F.size("d_reviews"), F.lit(0)) > 0
    status = F.col("parse_status")
    failed = F.when(
        present(F.col("d_failure")),
        append_token(status, F.concat(F.lit("reviews_graphql_failed:"), F.col("d_failure"))),
    ).otherwise(status)
    counted = F.when(
        some, append_token(failed, F.concat(F.lit("reviews_"), F.size("d_reviews").cast("string")))
    ).otherwise(failed)
    keep = lambda src, f: first_present(F.col(src), F.col(f))
    return out.withColumns({
        "parse_status": F.when(known, counted).otherwise(status),
        "detailed_review_content": F.when(some, F.col("d_reviews")).otherwise(F.col("detailed_review_content")),
        "fetch_method": F.when(some, append_token(F.col("fetch_method"), method)).otherwise(F.col("fetch_method")),
        "star_rating": keep("d_rating", "star_rating"),
        "count_of_star_ratings": keep("d_review_count", "count_of_star_ratings"),
        "count_of_reviews": first_present(
            F.col("d_comment_count"), F.col("d_page_total"), F.col("count_of_reviews")),
    }).drop(*[c for c in out.columns if c.startswith("d_")])


def compare_positions(target: DataFrame, candidate: DataFrame, keys: list[str],
                      identity: list[str], position: str = "position") -> DataFrame:
    """Row counts and the first position where the identities differ, per run."""
    left = target.select(*keys, position, F.struct(*[as_text(F.col(c)).alias(c) for c in identity]).alias("expected"))
    right = candidate.select(*keys, position, F.struct(*[as_text(F.col(c)).alias(c) for c in identity]).alias("actual"))
    both = left.join(right, [*keys, position], "full_outer")
    differs = ~F.col("expected").eqNullSafe(F.col("actual"))
    return both.groupBy(*keys).agg(
        F.count("expected").alias("expected_rows"),
        F.count("actual").alias("actual_rows"),
        F.min(F.when(differs, F.col(position))).alias("first_mismatch"),
    ).withColumn(
        "error",
        F.when(F.col("actual_rows") == 0, "empty")
        .when(F.col("actual_rows") != F.col("expected_rows"), "row_count")
        .when(F.col("first_mismatch").isNotNull(), "identity")
        .otherwise(""),
    )


def trace_coverage(trace: DataFrame, expected: DataFrame, keys: list[str], first: int, last: int,
                   identity: list[str] = ["item", "product_url"]) -> DataFrame:
    """Violations of a trace: bad or foreign index, disagreeing identity, uncovered row.

    ``expected`` is keyed by ``row_index``; ``first``..``last`` is the slice.
    """
    index = F.col("row_index").try_cast("long")
    rows = trace.withColumn("index", index)
    outside = rows.filter(index.isNull() | ~index.between(first, last)).select(
        *keys, "index",
        F.when(index.isNull(), "row_index_invalid").otherwise("row_index_out_of_slice").alias("violation"),
    )
    inside = rows.filter(index.between(first, last))
    want = expected.filter(F.col("row_index").between(first, last)).select(
        *keys, F.col("row_index").cast("long").alias("index"),
        *[as_text(F.col(c)).alias(f"w_{c}") for c in identity],
    )
    joined = inside.join(want, [*keys, "index"])
    kind = F.lit(None).cast("string")
    for c in reversed(identity):
        kind = F.when(as_text(F.col(c)) != F.col(f"w_{c}"), f"{c}_identity").otherwise(kind)
    wrong = joined.withColumn("violation", kind).filter("violation IS NOT NULL").select(*keys, "index", "violation")
    missing = want.join(inside.select(*keys, "index"), [*keys, "index"], "left_anti").select(
        *keys, "index", F.lit("coverage_missing").alias("violation"))
    return outside.unionByName(wrong.distinct()).unionByName(missing)
