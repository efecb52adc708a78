"""Work is shared out, read once and kept small: what the plans and folders of large tables rest on."""

import contextlib
import io
import json
import os

from pyspark.sql import functions as F

from vitrine.functions import variants as V
from vitrine.operators import evidence as E
from vitrine.plans import inputs as I
from vitrine.plans import load_queries
from vitrine.sources import capture as C
from vitrine.sources import pages as P


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("extended")
    return out.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]


def test_rows_of_a_narrow_table_in_one_file_are_dealt_out(spark, tmp_path):
    part = spark.range(3000).selectExpr(
        "id AS p_partkey", "'x' AS p_name", "'Brand' AS p_brand", "'PROMO' AS p_type", "cast(id % 50 AS int) AS p_size", "1.0D AS p_retailprice")
    part.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    assert I.dealt(spark, str(tmp_path), "part", 100).rdd.getNumPartitions() == 31
    for name in ("tv_slug_model", "tv_title_model_loose", "tv_sku_recovery", "fact_evidence"):
        df = load_queries()[0][name](spark, str(tmp_path))
        sizes = df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(sizes) > 2


def test_pages_are_stored_many_to_a_file(spark, tmp_path):
    rows = [("North Shop", f"run:{i % 3}", i, f"<p>{i}\n", "4" if i % 2 else None, "u") for i in range(200)]
    pages = spark.createDataFrame(rows, "retailer string, run_id string, page int, html string, listing_mode string, source_url string")
    P.write_pages(pages, str(tmp_path / "made"))
    assert sum(len(files) for _, _, files in os.walk(tmp_path)) < 40
    back = P.read_pages(spark, str(tmp_path / "made"), side=True).select(*pages.columns)
    assert sorted(tuple(r)[:5] for r in back.collect()) == sorted(r[:5] for r in rows)
    assert {r.source_url for r in back.filter("listing_mode IS NULL").collect()} == {None}


def test_evidence_is_read_once_to_be_combined(spark, tmp_path):
    rows = [("i", "f", 2, "01", "Late", "fact"), ("i", "f", 1, "03", "b", "fact"), ("i", "f", 1, "02", "C", "fact"),
            ("i", "f", 1, "04", "B", "fact"), ("i", "g", 5, "01", "x", "fact"), (None, "g", 5, "01", "y", "fact"), (None, None, 5, "02", "z", "fact")]
    made = spark.createDataFrame(rows, "item string, field string, level int, ordinal string, raw string, source string")
    made.write.parquet(str(tmp_path / "e"))
    out = E.combine_distinct(spark.read.parquet(str(tmp_path / "e")), ["item"])
    got = {(r.item, r.field): (r.value, r.level) for r in out.collect()}
    assert got == {("i", "f"): ("C,b", 1), ("i", "g"): ("x", 5)}
    assert plan(out).count("Relation [") == 1


def test_request_bodies_are_parsed_once(spark):
    bodies = ["", "no json", "7", '"query"', "{broken", "\n [{\"query\": \"query A { x }\"}, 1, {\"z\": 1}]", '{"operationName": " B "}']
    rows = [(1, i, "POST", "https://h/graphql", "h/graphql", 200, b) for i, b in enumerate(bodies)]
    entries = spark.createDataFrame(rows, "k int, index int, method string, url string, endpoint string, status int, body string")
    out = C.capture_requests(entries, ["k"])
    assert sorted((r["index"], r.batch, r.operation) for r in out.collect()) == [
        (0, False, ""), (1, False, ""), (2, False, ""), (3, False, ""), (4, False, ""), (5, True, "A"), (6, False, "B")]
    assert "__body" in plan(out)


def test_found_nodes_are_those_kept_and_single_values_have_kinds(spark):
    doc = {"a": [{"summary": {"b": [1, "a summary", "{x", None, True, 1.5]}}, []], "summary": "", "z": {}}
    docs = spark.createDataFrame([(1, json.dumps(doc)), (2, '"summary"'), (3, "broken"), (4, None)], "k int, t string").select(
        "k", F.try_parse_json("t").alias("doc"))
    kept = V.find(docs, V.root(F.col("doc")), "n", lambda n: n["entries"].isNotNull())
    assert {r.k: r.p for r in kept.select("k", F.transform("n", lambda n: n["path"]).alias("p")).collect()} == {
        1: ["", "z", "a[0]", "a[0].summary"], 2: [], 3: [], 4: []}
    got = C.term_paths(docs, ["k"], "(?i)summary").select("path", "kind", "sample").collect()
    assert sorted(tuple(r) for r in got) == [
        ("a[0].summary", "OBJECT", ""), ("a[0].summary.b[1]", "STRING", "a summary"), ("summary", "STRING", "")]
    every = C.term_paths(docs, ["k"], "^").collect()
    assert {r.path: r.kind for r in every} == {
        "a": "ARRAY", "summary": "STRING", "z": "OBJECT", "a[0]": "OBJECT", "a[1]": "ARRAY", "a[0].summary": "OBJECT", "a[0].summary.b": "ARRAY",
        "a[0].summary.b[0]": "BIGINT", "a[0].summary.b[1]": "STRING", "a[0].summary.b[2]": "STRING", "a[0].summary.b[3]": "VOID",
        "a[0].summary.b[4]": "BOOLEAN", "a[0].summary.b[5]": "DECIMAL"}


def test_values_of_a_list_are_read_once(spark):
    from vitrine.functions import measures as S
    from vitrine.functions.text import collapse_repeated_range
    from vitrine.functions.validators import measure_key

    texts = ["até 7 L", "7 litros", "acima de 8 L", "8 ml", "até 9 L", " 14 - 14 ", "10-12", "> 5 L", "Aprox. 3", None, ""]
    values = spark.createDataFrame([(texts,)], "v array<string>").select(F.transform(
        "v", lambda v, i: F.struct(i.alias("level"), F.lit("0").alias("ordinal"), v.alias("raw"))).alias("v"))
    kept = values.select(S.exact_over_qualified(F.col("v")).alias("k"))
    assert [r.raw for r in kept.first().k] == ["7 litros", "acima de 8 L", "8 ml", "até 9 L", " 14 - 14 ", "10-12", "> 5 L", "Aprox. 3", None, ""]
    # the list is parsed in one place; the check against exact values does not parse it again for each value
    assert plan(kept).count("transform(v#") == 1
    keys = values.select(F.explode("v.raw").alias("t")).select(measure_key(F.col("t")).alias("k"), collapse_repeated_range(F.col("t")).alias("c")).collect()
    assert [r.k for r in keys] == ["ate:ate 7 l", "7 litros", "acima de:acima de 8 l", "8 ml", "ate:ate 9 l", "14 14", "10 12", ">:5 l", "aprox:aprox 3", "", ""]
    assert [r.c for r in keys] == ["até 7 L", "7 litros", "acima de 8 L", "8 ml", "até 9 L", "14", "10-12", "> 5 L", "Aprox. 3", "", ""]


def test_rules_of_listing_rows_are_compiled(spark):
    from vitrine.operators import reports as R

    made = "k int, retailer string, product_line string, item string, retailer_sku_name string, product_url string, source_url string"
    good = ("North", "TV", "7", "n", "https://shop.example/x/p/7", "u")
    odd = [{}, {0: "Other"}, {1: None}, {2: " "}, {3: None}, {4: "https://x.example/p/7"}, {4: None}, {4: "https://a.shop.example/?skuId=8"}, {5: "v"}, {0: None, 2: None, 5: None}]
    rows = spark.createDataFrame([(i, *[o.get(j, v) for j, v in enumerate(good)]) for i, o in enumerate(odd)], made)
    out = R.row_violations(rows, ["k"], "North", "TV", ["shop.example"], F.lit("u"))
    assert sorted(tuple(r) for r in out.collect()) == [
        (1, "retailer"), (2, "product_line"), (3, "item_missing"), (3, "url_item_mismatch"), (4, "name_missing"), (5, "product_url_invalid"),
        (6, "product_url_invalid"), (7, "url_item_mismatch"), (8, "source_url_mismatch"), (9, "item_missing"), (9, "retailer"), (9, "source_url_mismatch"),
        (9, "url_item_mismatch")]
    # functions with a lambda are interpreted with all that is inside them
    assert "lambdafunction" not in plan(out)


def test_value_rules_are_compiled(spark):
    from vitrine.functions import validators as V

    texts = ["12 kg", "12,5kg", "120", "99", "120 kg", "12 L", "frontal 3", "220 V", "45 kWh/mês", "0,5 W", "classe A 3 W", "baixo consumo", "baixo consumo de água",
             "standby bivolt", "de 3 a 5 V", "1 2", "55\"", "55,5.", "9.99", "200", "201", "50%", "1/2", "60 cm", "x٣", "\u00a070\u00a0pol", "", " ", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = rows.select("i", *[f(F.col("t")).alias(n) for n, f in (
        ("r", V.is_refrigerator_capacity), ("w", V.is_washer_capacity), ("e", V.is_energy_use), ("s", V.is_screen_size))])
    got = {n: [texts[r.i] for r in sorted(out.collect()) if r[n]] for n in "rwes"}
    assert got == {
        "r": ["120", "99", "12 L", "frontal 3", "1 2", "55\"", "55,5.", "9.99", "200", "201", "50%", "1/2", "\u00a070\u00a0pol"],
        "w": ["12 kg", "12,5kg", "99", "120 kg", "1 2", "55\"", "55,5.", "9.99", "50%", "1/2", "\u00a070\u00a0pol"],
        "e": ["45 kWh/mês", "0,5 W", "classe A 3 W", "baixo consumo"], "s": ["120", "99", "55\"", "55,5.", "200", "\u00a070\u00a0pol"]}
    assert "lambdafunction" not in plan(out)


def test_ids_of_offers_are_cleaned_once(spark):
    from vitrine.operators import offers as O

    base = {"product_id": "07", "sku_id": "70", "seller_id": "", **{c: "" for c in O.QUOTE}, "current_price": "9", "avail_seller": "3"}
    odd = [{}, {}, {"product_id": "x"}, {"seller_id": "4"}, {"sku_id": "0"}, {"sku_id": "71", "avail_sku": "70"}, {"sku_id": "72", "avail_sku": "072"},
           {"sku_id": "73"}, {"sku_id": "73", "current_price": "8"}, {"sku_id": "74", "product_id": None}, {"sku_id": "74", "product_id": "zz"}]
    offers = spark.createDataFrame([{**base, **o} for o in odd], ", ".join(f"{c} string" for c in base))
    out = O.offer_map(offers)
    assert sorted((r.product_id, r.sku_id, r.seller_id) for r in out.collect()) == [("", "74", "3"), ("7", "70", "3"), ("7", "72", "3")]
    assert plan(out).count("RLIKE") == 5


def test_ranks_of_wanted_rows_are_those_of_all_rows(spark):
    from vitrine.operators import ranking as R

    rows = [(f"r{i % 2}", "TV", "d", None if i % 23 == 0 else i // 7, i * 37 % 11 * 100 + i, f"i{i % 13}") for i in range(200)]
    occ = spark.createDataFrame(rows, "retailer string, product_line string, run_date string, page long, pos long, identity string")
    wanted = spark.createDataFrame([("r0", "TV", "d", "i3"), ("r1", "TV", "d", "i3"), ("r1", "TV", "d", "i5")], [*R.RUN, "identity"])
    every = R.occurrence_rank(occ, R.RUN).join(wanted, wanted.columns, "left_semi")
    some = R.occurrence_rank(occ, R.RUN, wanted=wanted)
    shown = lambda df: sorted(tuple(r) for r in df.select(*occ.columns, "occurrence_rank").collect())
    assert len(shown(some)) > 20 and shown(some) == shown(every)


def test_urls_of_occurrences_are_read_once_for_targets(spark):
    counts = load_queries()[0]["final_target_counts"](spark, "/root/testdata/sf0.001")
    assert "parquet" in plan(counts) and "p_name" not in plan(counts) and "l_orderkey" not in plan(counts)


def test_cards_and_price_rows_are_dealt_out(spark, tmp_path):
    spark.range(3000).selectExpr("id AS p_partkey", "cast(id % 50 AS int) AS p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    for rows in (I.cards(spark, str(tmp_path)), I.price_rows(spark, str(tmp_path))):
        assert rows.count() == 3000 and rows.rdd.getNumPartitions() > 2


def test_card_phrases_keep_their_rules_and_are_tried_where_their_words_stand(spark):
    from vitrine.functions import money as M

    texts = ["Full TV 7 4,5 (1.234) R$ 9.000,00 ou R$ 50,90 no  pix 12,5% de  desconto Cupom\tR$ 50 OFF 12,5% de desconto",
             "baixou -3,5% xFull full  A 1.2.3% off use o cupom ABC-1", "R$ 1,00 Full", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    c = F.col("t")
    out = rows.select("i", M.card_savings(c).alias("s"), M.card_discounts(c).alias("d"), M.card_name(c).alias("n"),
                      M.card_prices(c)["final"].alias("f"), M.card_rating(c)["rating"].alias("r"))
    assert [tuple(r)[1:] for r in sorted(out.collect())] == [
        ("12.5%", "Cupom R$ 50 OFF; 12,5% de desconto", "TV 7", "R$ 50,90", "4.5"),
        ("Baixou -3.5%", "use o cupom ABC-1", "baixou -3,5% xFull A 1.2.3% off use o cupom ABC-1", "", ""),
        ("", "", "R$ 1,00", "R$ 1,00", ""), ("", "", "", "", "")]
    # a text without a phrase's word is not searched for it, and no pattern is run only to ask whether it occurs
    assert "baixou" in plan(out) and "Baixou\\s+(-?\\d+(?:[.,]\\d+)?)% AS" not in plan(out) and "RLIKE (?i)" not in plan(out)
