"""The queries of this folder with production parameters, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import (
    curriculum,
    fingerprint,
    license_scan,
    near_dup,
    neighbour_graph,
    packing,
    prefix_trie,
    quality_fm,
    repetition,
    secret_scan,
    token_counts,
    url_filter,
    whitening,
)
from vitrine.llm.common import documents

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            CHECKS[name] = sql
        return fn

    return keep


@query("op1_improbable_features")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.neighbours(documents(spark, sf_dir))


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


@query("op3_factorisation_machine")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_fm.score(docs, quality_fm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query("op4_suffix_array_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_covered", "longest_repeat", "n_repeats",
    )


@query("op5_odd_sketches", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), sizes AS (
  SELECT d.doc_id, count(s) AS n_shingles FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN shingles USING (doc_id) GROUP BY 1
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id > b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * n >= 75 * (p.n_shingles + q.n_shingles - n)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN (SELECT x AS a, y AS b FROM links UNION ALL SELECT y, x FROM links) l ON l.a = r.other
), components AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1
)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN components USING (doc_id)
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir))


@query("op6_curriculum_mix", r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, text, '')) AS h
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM sized GROUP BY source
), filled AS (
  SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY (3 * source_size)::DOUBLE / w, source NULLS LAST) AS k FROM totals
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS one FROM filled
), goals AS (
  SELECT source, source_size, least(cap::DOUBLE, max(one) OVER () * w) AS target FROM levels
), rates AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM goals
), offs AS (
  SELECT *, rate - coalesce(sum(rate * target) OVER () / nullif(sum(target) OVER (), 0), 0) AS off FROM rates
), tilts AS (
  SELECT source, source_size, target, CASE WHEN max(abs(off)) OVER () > 0 THEN 0.5::DOUBLE * off / max(abs(off)) OVER () ELSE 0 END AS tilt FROM offs
), placed AS (
  SELECT doc_id, size, source_size, target, tilt, floor(target + 0.5)::BIGINT AS goal,
    (sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM sized s JOIN tilts g ON s.source IS NOT DISTINCT FROM g.source
), passes AS (
  SELECT *, greatest(0, least(size, goal - start)) AS t1, greatest(0, least(size, goal - source_size - start)) AS t2,
    greatest(0, least(size, goal - 2 * source_size - start)) AS t3 FROM placed
), shares AS (
  SELECT *, (start + t1 / 2.0::DOUBLE) / target AS y1, (start + source_size + t2 / 2.0::DOUBLE) / target AS y2,
    (start + 2 * source_size + t3 / 2.0::DOUBLE) / target AS y3 FROM passes
)
SELECT doc_id, size, source_size, target, (t1 + t2 + t3)::BIGINT AS taken,
  CASE WHEN t1 > 0 THEN round(least(2 * y1 / (1 - tilt + sqrt((1 - tilt) * (1 - tilt) + 4 * y1 * tilt)), 1), 9) END AS position_1,
  CASE WHEN t2 > 0 THEN round(least(2 * y2 / (1 - tilt + sqrt((1 - tilt) * (1 - tilt) + 4 * y2 * tilt)), 1), 9) END AS position_2,
  CASE WHEN t3 > 0 THEN round(least(2 * y3 / (1 - tilt + sqrt((1 - tilt) * (1 - tilt) + 4 * y3 * tilt)), 1), 9) END AS position_3
FROM shares
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = curriculum.assign(documents(spark, sf_dir), carry=["doc_id"])
    place = lambda k: F.round(F.get("mix_passes", F.lit(k))["position"], 9)
    ordered = plan.withColumn("at", place(0)).repartitionByRange("at", "mix_order").sortWithinPartitions("at", "mix_order")
    return ordered.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_total").alias("source_size"), F.col("mix_target").alias("target"),
        F.col("mix_taken").alias("taken"), *[place(k).alias(f"position_{k + 1}") for k in range(curriculum.MOST)])


@query("op7_license_automaton")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.size("spans").cast("long").alias("n_spans"),
    )


@query("op8_vector_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op9_structural_secrets")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(documents(spark, sf_dir))


@query("op10_digest_array_urls", r"""
WITH parts AS (
  SELECT page_id, regexp_extract(url, '^.*?://(.*)$', 1, 's') AS rest FROM pages
), places AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(regexp_replace(rest, '^[^/?#]*', '', 's'), '^[^?#]*', 0) AS path
  FROM (SELECT page_id, coalesce(rest, '') AS rest FROM parts)
), rules(verdict, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), ranked AS (
  SELECT page_id, host, path, verdict, rhost || rpath AS rule,
    row_number() OVER (PARTITION BY p.row ORDER BY length(rhost || rpath) DESC NULLS LAST) AS k
  FROM (SELECT *, row_number() OVER () AS row FROM places) p
  LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE k = 1
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op11_rank_one_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op12_neighbour_descent")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_graph.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op13_prefix_trie", r"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS head,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, len(conv_id::VARCHAR) + 1), lambda i: unicode(substr(conv_id::VARCHAR, i, 1))::UBIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: 0::UBIGINT)),
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)), 4294967295::UBIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own)
), parts AS (
  SELECT c.conv_id, 0 AS part, o.p, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.head AND o.p <= c.h
  UNION ALL SELECT c.conv_id, 1, o.p, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.p > c.h
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS d, sha256(strlen(role) || ':' || role || text) AS token, length(text) AS size FROM parts
), paths AS (
  SELECT conv_id, 0 AS d, '' AS path, 0 AS size FROM convs
  UNION ALL SELECT conv_id, d, string_agg(token, '') OVER (PARTITION BY conv_id ORDER BY d), size FROM turns
), lengths AS (
  SELECT conv_id, max(d) AS n FROM paths GROUP BY 1
), nodes AS (
  SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS own_saved,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = n), '') AS ends
  FROM paths JOIN lengths USING (conv_id) GROUP BY path
), kin AS (
  SELECT n.*, p.conv_id AS parent_conv_id, p.path AS parent_path
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[:64 * (n.depth - 1)]
), counted AS (
  SELECT k.*, coalesce(c.n, 0) AS n_children FROM kin k LEFT JOIN (SELECT parent_path, count(*) AS n FROM kin GROUP BY 1) c ON c.parent_path = k.path
), sums AS (
  SELECT a.path, sum((c.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(c.own_saved)::BIGINT AS saved_tokens
  FROM counted c JOIN paths a ON a.conv_id = c.conv_id AND a.d <= c.depth GROUP BY 1
)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM counted JOIN sums USING (path)
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
