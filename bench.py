"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (names).

The driver's tables are one row group each, which one task would read.  They are first dealt into
as many files as there are cores, as a table at scale has; that is not timed.
"""

import json
import os
import time

from vitrine.plans import load_queries
from vitrine.plans.inputs import TABLES
from vitrine.session import build, work_dir

HEADLINE = [
    "occurrence_rank", "first_seen_dedup", "final_targets", "page_cutoff", "offer_map", "optional_price_attach",
    "verify_price_fields", "history_backfill", "detail_merge", "suspicious_rows", "suspicious_provenance",
    "field_stats", "labelled_evidence", "resolve_attributes", "detail_row_layout_m", "final_projection",
    "normalized_url", "normalize_key", "capture_operations", "listing_layout_m",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build(f"local[{cpus}]", "vitrine-bench", **{
        "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": str(4 * int(cpus)),
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_queries()
    dealt = work_dir(spark, "bench")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(int(cpus)).write.parquet(f"{dealt}/{name}.parquet")
    times = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, dealt).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
