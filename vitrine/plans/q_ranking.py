"""Queries over listing occurrences: ranks, targets, cutoffs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators import ranking as R
from vitrine.plans import inputs as I
from vitrine.plans.final import manifest_counts
from vitrine.plans.registry import query
from vitrine.session import materialize

RUN = ", ".join(R.RUN)
_OCC = f"WITH occ AS ({I.LISTING_SQL})"
_BASE = f"""{_OCC},
ranked AS (SELECT *, row_number() OVER (PARTITION BY {RUN}, run_id ORDER BY page, pos) AS occ_rank FROM occ),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {RUN}, run_id, identity ORDER BY page, pos) AS k
  FROM ranked) WHERE k = 1),
dense AS (SELECT *, row_number() OVER (PARTITION BY {RUN}, run_id ORDER BY page, pos) AS rnk FROM firsts),
main AS (SELECT * FROM dense WHERE run_id = 'main' AND rnk <= 300),
rmap AS (SELECT * FROM dense WHERE run_id = 'bsr' AND rnk <= 100)"""


def occurrences(spark: SparkSession, sf: str) -> DataFrame:
    return R.with_identity(I.listing(spark, sf))


def split_runs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    occ = occurrences(spark, sf)
    return occ.filter("run_id = 'main'"), occ.filter("run_id = 'bsr'")


@query("identity_keys", f"""{_OCC} SELECT {RUN}, run_id, page, pos, url_key, identity FROM occ""")
def identity_keys(spark, sf):
    return occurrences(spark, sf).select(*R.RUN, "run_id", "page", "pos", "url_key", "identity")


@query("occurrence_rank", f"""{_OCC} SELECT {RUN}, run_id, page, pos, item,
row_number() OVER (PARTITION BY {RUN}, run_id ORDER BY page, pos) AS occurrence_rank FROM occ""")
def occurrence_rank(spark, sf):
    ranked = R.occurrence_rank(I.listing(spark, sf))
    return ranked.select(*R.RUN, "run_id", "page", "pos", "item", "occurrence_rank")


@query("first_seen_dedup", f"""{_BASE} SELECT {RUN}, run_id, identity, page, pos, item FROM firsts""")
def first_seen_dedup(spark, sf):
    out = R.first_seen(occurrences(spark, sf), [*R.RUN, "run_id"])
    return out.select(*R.RUN, "run_id", "identity", "page", "pos", "item")


@query("top_targets", f"""{_BASE} SELECT {RUN}, identity, item, page, pos, rnk AS main_rank FROM main""")
def top_targets(spark, sf):
    main, _ = split_runs(spark, sf)
    out = R.top_targets(main, R.MAIN_TARGETS, "main_rank")
    return out.select(*R.RUN, "identity", "item", "page", "pos", "main_rank")


@query("bsr_rank_map", f"""{_BASE} SELECT {RUN}, identity, url_key, rnk AS bsr_rank FROM rmap""")
def bsr_rank_map(spark, sf):
    return R.rank_map(split_runs(spark, sf)[1])


_FINAL = f"""{_BASE},
by_url AS (SELECT {RUN}, url_key, min(rnk) AS mapped FROM rmap WHERE url_key <> '' GROUP BY {RUN}, url_key),
bsr AS (SELECT * FROM firsts f WHERE run_id = 'bsr'
  AND EXISTS (SELECT 1 FROM rmap r WHERE r.retailer = f.retailer AND r.product_line = f.product_line
    AND r.run_date = f.run_date AND r.identity = f.identity)
  AND NOT EXISTS (SELECT 1 FROM main m WHERE m.retailer = f.retailer AND m.product_line = f.product_line
    AND m.run_date = f.run_date AND m.identity = f.identity)),
targets AS (
SELECT m.retailer, m.product_line, m.run_date, m.identity, m.item, m.product_url, m.rnk AS main_rank, u.mapped AS bsr_rank
FROM main m LEFT JOIN by_url u ON m.retailer = u.retailer AND m.product_line = u.product_line
  AND m.run_date = u.run_date AND m.url_key = u.url_key
UNION ALL
SELECT b.retailer, b.product_line, b.run_date, b.identity, b.item, b.product_url, NULL, coalesce(u.mapped, b.occ_rank)
FROM bsr b LEFT JOIN by_url u ON b.retailer = u.retailer AND b.product_line = u.product_line
  AND b.run_date = u.run_date AND b.url_key = u.url_key)"""


def targets(spark, sf) -> DataFrame:
    # occurrences are read several times: their URLs are taken apart and joined once; rankings are a few rows of a run
    occ = occurrences(spark, sf).select(*R.RUN, "run_id", "page", "pos", "item", "url_key", "identity")
    occ = materialize(occ, "occurrences")
    main, bsr = occ.filter("run_id = 'main'"), occ.filter("run_id = 'bsr'")
    ranked = materialize(R.top_targets(main, R.MAIN_TARGETS, "main_rank"), "main-targets").withColumn(
        "bsr_rank", F.lit(None).cast("int"))
    ranks = materialize(R.rank_map(bsr), "bsr-ranks")
    counted = R.occurrence_rank(bsr, R.RUN, wanted=ranks.select(*R.RUN, "identity").distinct())
    return R.final_targets(ranked, counted.withColumnRenamed("occurrence_rank", "bsr_rank"), ranks)


@query("final_targets", f"""{_FINAL} SELECT {RUN}, identity, item,
CASE WHEN main_rank IS NOT NULL THEN 'main' ELSE 'bsr' END AS page_type, main_rank, bsr_rank FROM targets""")
def final_targets(spark, sf):
    kind = R.page_type(F.col("main_rank"), F.col("bsr_rank"), F.lit(""))
    return targets(spark, sf).select(
        *R.RUN, "identity", "item", kind.alias("page_type"), "main_rank", "bsr_rank")


@query("final_target_counts", f"""{_FINAL} SELECT {RUN}, count(*) AS row_count,
count(main_rank) AS main_rank_rows, count(bsr_rank) AS bsr_rank_rows FROM targets GROUP BY {RUN}""")
def final_target_counts(spark, sf):
    return manifest_counts(targets(spark, sf), R.RUN)


_GROWTH = f"""{_OCC},
fresh AS (SELECT {RUN}, run_id, identity, min(page) AS page FROM occ GROUP BY {RUN}, run_id, identity),
rws AS (SELECT {RUN}, run_id, page, count(*) AS n_rows FROM occ GROUP BY {RUN}, run_id, page),
nw AS (SELECT {RUN}, run_id, page, count(*) AS new_ids FROM fresh GROUP BY {RUN}, run_id, page),
pages AS (SELECT r.*, coalesce(n.new_ids, 0) AS new_ids FROM rws r LEFT JOIN nw n USING ({RUN}, run_id, page)),
grown AS (SELECT *, row_number() OVER w AS page_no, sum(new_ids) OVER w AS unique_ids FROM pages
  WINDOW w AS (PARTITION BY {RUN}, run_id ORDER BY page)),
lagged AS (SELECT *, lag(unique_ids, 5) OVER (PARTITION BY {RUN}, run_id ORDER BY page) AS earlier FROM grown),
marked AS (SELECT *, (unique_ids >= 300 OR coalesce(unique_ids = earlier, false)) AS stops FROM lagged)"""


@query("page_cutoff", f"""{_GROWTH}, cut AS (SELECT {RUN}, run_id, min(page_no) AS stop_no FROM marked WHERE stops
  GROUP BY {RUN}, run_id)
SELECT {RUN}, run_id, page, page_no, n_rows, new_ids, cast(unique_ids AS bigint) AS unique_ids,
  CASE WHEN stops THEN 1 ELSE 0 END AS stops
FROM marked LEFT JOIN cut USING ({RUN}, run_id) WHERE stop_no IS NULL OR page_no <= stop_no""")
def page_cutoff(spark, sf):
    out = R.page_cutoff(occurrences(spark, sf), [*R.RUN, "run_id"], 300)
    return out.withColumnRenamed("rows", "n_rows").withColumn("stops", F.col("stops").cast("int"))


@query("threshold_gate", f"""{_OCC},
u AS (SELECT {RUN}, run_id, count(DISTINCT identity) AS unique_ids FROM occ GROUP BY {RUN}, run_id),
f AS (SELECT {RUN}, run_id, count(*) AS failures, bool_and(retailer = 'South Shop') AS tol FROM occ
  WHERE product_url = '' GROUP BY {RUN}, run_id),
j AS (SELECT u.*, CASE WHEN run_id = 'main' THEN 300 ELSE 100 END AS minimum, coalesce(failures, 0) AS failures,
  coalesce(tol, false) AS tol FROM u LEFT JOIN f USING ({RUN}, run_id))
SELECT {RUN}, run_id, unique_ids, minimum, failures,
 CASE WHEN unique_ids >= minimum THEN 1 ELSE 0 END AS threshold_met,
 CASE WHEN unique_ids >= minimum AND tol THEN 1 ELSE 0 END AS accepted,
 CASE WHEN failures = 0 OR (unique_ids >= minimum AND tol) THEN 1 ELSE 0 END AS downstream_allowed FROM j""")
def threshold_gate(spark, sf):
    keys = [*R.RUN, "run_id"]
    occ = occurrences(spark, sf)
    counts = occ.groupBy(*keys).agg(F.countDistinct("identity").alias("unique_ids"))
    failed = occ.filter("product_url = ''").withColumn("retailer_name", F.col("retailer"))
    out = R.threshold_gate(counts, failed, keys, "south shop")
    flags = ("threshold_met", "accepted", "downstream_allowed")
    return out.withColumns({c: F.col(c).cast("int") for c in flags})
