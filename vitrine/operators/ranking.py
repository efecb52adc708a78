"""Occurrence ranks, first-seen deduplication, top targets, merging two rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.text import as_text, present
from vitrine.functions.urls import identity_of, with_normalized_url
from vitrine.operators.numbering import FANOUT, first_rows, prefix_sums, running_rank, spread_blank
from vitrine.session import materialize

RUN = ["retailer", "product_line", "run_date"]
ORDER = ["page", "pos"]
MAIN_TARGETS, BSR_TARGETS = 300, 100


def with_identity(df: DataFrame) -> DataFrame:
    """Adds ``url_key`` (normalized URL, '' if none) and ``identity``."""
    out = with_normalized_url(df, "product_url", "url_key")
    return out.withColumn("identity", identity_of(F.col("url_key"), F.col("retailer"), F.col("sku")))


def occurrence_rank(df: DataFrame, keys: list[str] = [*RUN, "run_id"],
                    within: list[str] = ["pos"], wanted: DataFrame | None = None) -> DataFrame:
    """Rank of every kept occurrence in page order, duplicates included.

    ``wanted``: distinct identities of runs; only their occurrences come back, with the same ranks.
    """
    return running_rank(df, keys, "page", within, "occurrence_rank", wanted)


def first_seen(df: DataFrame, keys: list[str] = RUN, order: list[str] = ORDER) -> DataFrame:
    """First occurrence of every identity of a run."""
    return first_rows(df, [*keys, "identity"], order)


def top_targets(df: DataFrame, n: int, rank: str, keys: list[str] = RUN,
                order: list[str] = ORDER) -> DataFrame:
    """Deduplicate, rank the survivors 1..n in first-seen order, cut at ``n``."""
    return first_rows(first_seen(df, keys, order), keys, order, n, rank)


def rank_map(bsr: DataFrame, n: int = BSR_TARGETS, order: list[str] = ORDER) -> DataFrame:
    """Best-seller rank by identity; one row per ranked product of a run."""
    ranked = top_targets(bsr, n, "bsr_rank", order=order)
    return ranked.select(*RUN, "identity", "url_key", "bsr_rank")


def final_targets(main: DataFrame, bsr: DataFrame, ranks: DataFrame,
                  order: list[str] = ORDER) -> DataFrame:
    """Main targets with best-seller ranks, then the best-sellers main does not list.

    ``main`` holds ``main_rank``; ``bsr`` are all best-seller occurrences with their
    occurrence rank in ``bsr_rank``; ``ranks`` comes from :func:`rank_map`.
    """
    by_url = (
        ranks.filter(F.col("url_key") != "")
        .groupBy(*RUN, "url_key")
        .agg(F.min("bsr_rank").alias("mapped_rank"))
    )
    by_url = by_url.withColumnRenamed("url_key", "ask")
    asking = lambda rows: rows.withColumn("ask", spread_blank(F.col("url_key"))).join(by_url, [*RUN, "ask"], "left").drop("ask")
    kept = (
        asking(first_seen(main, order=["main_rank"]))
        .withColumn("bsr_rank", F.coalesce(F.col("bsr_rank").cast("int"), F.col("mapped_rank")))
        .drop("mapped_rank")
    )
    ranked_ids = ranks.select(*RUN, "identity").distinct()
    extra = (
        asking(first_seen(bsr.join(ranked_ids, [*RUN, "identity"], "left_semi"), order=order)
               .join(main.select(*RUN, "identity").distinct(), [*RUN, "identity"], "left_anti"))
        .withColumn("bsr_rank", F.coalesce(F.col("mapped_rank"), F.col("bsr_rank").cast("int")))
        .withColumn("main_rank", F.lit(None).cast("int"))
        .drop("mapped_rank")
    )
    return kept.unionByName(extra)


def page_type(main_rank: Column, bsr_rank: Column, given: Column) -> Column:
    return (
        F.when(present(main_rank), "main").when(present(bsr_rank), "bsr").otherwise(as_text(given))
    )


def page_growth(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and newly seen identities of every page, with running totals and page order."""
    rows = df.groupBy(*keys, "page").agg(F.count(F.lit(1)).alias("rows"))
    # an identity is new on its first page; min() combines map-side
    fresh = (
        df.groupBy(*keys, "identity").agg(F.min("page").alias("page"))
        .groupBy(*keys, "page").agg(F.count(F.lit(1)).alias("new_ids"))
    )
    pages = (
        rows.join(fresh, [*keys, "page"], "left")
        .withColumn("new_ids", F.coalesce("new_ids", F.lit(0)))
        .withColumn("one", F.lit(1))
    )
    # a page table is small beside its listing; what follows reads it several times
    pages = materialize(pages, "pages")
    return (
        prefix_sums(pages, keys, "page", ["new_ids", "one"])
        .withColumn("unique_ids", F.col("new_ids_before") + F.col("new_ids"))
        .withColumn("page_no", F.col("one_before") + 1)
        .drop("one", "one_before", "new_ids_before")
    )


def page_cutoff(df: DataFrame, keys: list[str], target: int, no_growth: int = 5) -> DataFrame:
    """Pages a collector would have read: up to the unique target or the dry streak.

    A streak of ``no_growth`` pages ends at page p when the running unique count of p equals the one ``no_growth`` pages
    earlier.  Pages are looked at in blocks, and the last pages of a block go along with the next one.
    """
    pages = page_growth(df, keys).withColumn("block", F.floor(F.col("page_no") / FANOUT)).withColumn("carried", F.lit(False))
    edge = pages.filter(F.col("page_no") % FANOUT >= FANOUT - no_growth).withColumns({"block": F.col("block") + 1, "carried": F.lit(True)})
    earlier = F.lag("unique_ids", no_growth).over(Window.partitionBy(*keys, "block").orderBy("page_no"))
    stops = (F.col("unique_ids") >= target) | F.coalesce(F.col("unique_ids") == F.col("unique_then"), F.lit(False))
    marked = materialize(
        pages.unionByName(edge).withColumn("unique_then", earlier).filter("NOT carried").withColumn("stops", stops).drop("block", "carried", "unique_then"),
        "page-marks")
    stop = marked.filter("stops").groupBy(*keys).agg(F.min("page_no").alias("stop_no"))
    return (
        marked.join(stop, keys, "left")
        .filter(F.col("stop_no").isNull() | (F.col("page_no") <= F.col("stop_no")))
        .select(*keys, "page", "page_no", "rows", "new_ids", "unique_ids", "stops")
    )


def threshold_gate(unique_counts: DataFrame, failures: DataFrame, keys: list[str],
                   tolerated: str, minimum: dict[str, int] | None = None) -> DataFrame:
    """Accept an incomplete listing once enough unique products were kept.

    ``unique_counts`` has one row per run (``unique_ids``, ``run_id``); ``failures``
    one row per failed page with its ``retailer_name``.
    """
    minimum = minimum or {"main": MAIN_TARGETS, "bsr": BSR_TARGETS}
    need = F.create_map(*[F.lit(x) for kv in minimum.items() for x in kv])
    failed = failures.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("failures"),
        F.bool_and(F.lower(F.trim(as_text(F.col("retailer_name")))) == tolerated).alias("only_tolerated"),
    )
    out = unique_counts.join(failed, keys, "left").withColumns({
        "failures": F.coalesce("failures", F.lit(0)),
        "minimum": F.try_element_at(need, F.lower(F.trim("run_id"))),
    })
    met = F.coalesce(F.col("unique_ids") >= F.col("minimum"), F.lit(False))
    return out.select(
        *keys, "unique_ids", "minimum", "failures", met.alias("threshold_met"),
        (met & F.coalesce("only_tolerated", F.lit(False))).alias("accepted"),
        ((F.col("failures") == 0) | (met & F.coalesce("only_tolerated", F.lit(False))))
        .alias("downstream_allowed"),
    )
