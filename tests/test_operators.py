"""Properties and brute-force comparisons on small fixtures."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from vitrine.operators import attributes as AT
from vitrine.operators import history as H
from vitrine.operators import merge as MG
from vitrine.operators import offers as O
from vitrine.operators import ranking as R
from vitrine.operators.numbering import prefix_sums, running_rank
from vitrine.sources import snapshot as SN
from vitrine.sources import tables as TB


def test_prefix_sums_match_a_plain_window(spark):
    rng = random.Random(1)
    rows = [("a" if rng.random() < .7 else "b", p, rng.randint(0, 5)) for p in rng.sample(range(100000), 300)]
    df = spark.createDataFrame(rows, "k string, page long, n long")
    for levels, fanout in ((1, 7), (2, 5), (3, 3)):
        got = {(r.k, r.page): r.n_before for r in prefix_sums(df, ["k"], "page", ["n"], levels, fanout).collect()}
        for k in ("a", "b"):
            total = 0
            for _, page, n in sorted(r for r in rows if r[0] == k):
                assert got[(k, page)] == total
                total += n


def test_running_rank_with_a_hot_run(spark):
    rows = [("hot" if i % 3 else "cold", i % 40, i) for i in range(600)]
    df = spark.createDataFrame(rows, "run string, page int, pos int")
    got = sorted((r.run, r.rank, r.page, r.pos) for r in running_rank(df, ["run"], "page", ["pos"], "rank").collect())
    want = []
    for run in ("cold", "hot"):
        ordered = sorted((p, q) for r, p, q in rows if r == run)
        want += [(run, i + 1, p, q) for i, (p, q) in enumerate(ordered)]
    assert got == want


def _listing(spark, seed, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        item = rng.randint(1, 40)
        url = "" if item % 7 == 0 else f"https://Shop.example/x/p/{item}/?utm_source={i}"
        rows.append(("s", "TV", "d", i // 10, i % 10, str(item), f"SKU{item}", url))
    return spark.createDataFrame(
        rows, "retailer string, product_line string, run_date string, page int, pos int, item string, sku string, product_url string")


def test_first_seen_is_idempotent_and_ordered(spark):
    occ = R.with_identity(_listing(spark, 2))
    once = R.first_seen(occ)
    assert sorted(once.collect()) == sorted(R.first_seen(once).collect())
    top = R.top_targets(occ, 5, "main_rank").orderBy("main_rank").collect()
    assert [r.main_rank for r in top] == [1, 2, 3, 4, 5]
    assert [(r.page, r.pos) for r in top] == sorted((r.page, r.pos) for r in top)


def test_final_targets_is_the_union(spark):
    main, bsr = R.with_identity(_listing(spark, 3)), R.with_identity(_listing(spark, 4))
    ranked = R.top_targets(main, 10, "main_rank").withColumn("bsr_rank", F.lit(None).cast("int"))
    ranks = R.rank_map(bsr, 12)
    occ = R.occurrence_rank(bsr, R.RUN).withColumnRenamed("occurrence_rank", "bsr_rank")
    out = R.final_targets(ranked, occ, ranks).collect()
    ids = [r.identity for r in out]
    want = {r.identity for r in ranked.collect()} | {r.identity for r in ranks.collect()}
    assert len(ids) == len(set(ids)) and set(ids) == want
    by_url = {r.url_key: r.bsr_rank for r in ranks.collect() if r.url_key}
    for r in out:
        if r.main_rank is None and not r.url_key:
            assert r.bsr_rank is not None  # no URL: the occurrence rank
        elif r.url_key:
            assert r.bsr_rank == by_url.get(r.url_key)


@pytest.mark.parametrize("unique,run,ok", [(299, "main", False), (300, "main", True), (99, "bsr", False), (100, "bsr", True)])
def test_threshold_boundaries(spark, unique, run, ok):
    counts = spark.createDataFrame([("k", run, unique)], "k string, run_id string, unique_ids int")
    failed = spark.createDataFrame([("k", "South Shop ")], "k string, retailer_name string")
    row = R.threshold_gate(counts, failed, ["k"], "south shop").first()
    assert row.accepted is ok and row.downstream_allowed is ok


def test_page_cutoff_stops_after_five_dry_pages(spark):
    rows = [("r", p, str(p if p <= 3 or p > 20 else 1)) for p in range(1, 30)]
    occ = spark.createDataFrame(rows, "run string, page int, identity string")
    pages = [r.page for r in R.page_cutoff(occ, ["run"], 100).orderBy("page").collect()]
    assert pages == list(range(1, 9))


OFFER = {c: "" for c in ("product_id", "sku_id", "seller_id", *O.QUOTE)}


def _offers(spark, *rows):
    data = [{**OFFER, **r} for r in rows]
    schema = ", ".join(f"{c} string" for c in OFFER)
    return spark.createDataFrame([tuple(d[c] for c in OFFER) for d in data], schema)


def test_offer_map_conflicts(spark):
    base = {"product_id": "1", "sku_id": "2", "seller_id": "3", "current_price": "9"}
    got = O.offer_map(_offers(spark, base, base, {**base, "seller_id": "4"}, {**base, "seller_id": "4", "current_price": "8"},
                              {**base, "seller_id": "x"}, {**base, "avail_sku": "7"}, {**base, "sku_id": "0"}))
    assert [(r.seller_id, r.current_price) for r in got.collect()] == [("3", "9")]


def test_optional_offers_equal_brute_force(spark):
    rng = random.Random(5)
    pick = lambda *v: rng.choice(v)
    offers = {(pick("", "1", "2"), pick("5", "6"), pick("", "8", "9")): pick("", "10", "20") for _ in range(12)}
    cards = [(i, pick("", "1", "2"), pick("5", "6", ""), pick("", "8", "9"), rng.random() < .2, pick("", "99")) for i in range(60)]
    o = spark.createDataFrame([(*k, v) for k, v in offers.items()], "product_id string, sku_id string, seller_id string, current_price string")
    c = spark.createDataFrame(cards, "card int, product_id string, sku_id string, seller_id string, quarantined boolean, own_price string")
    got = {r.card: r for r in O.optional_offers(c, o, ["card"]).collect()}
    for card, product, sku, seller, quarantined, own in cards:
        match = [(k, v) for k, v in offers.items() if sku and k[1] == sku and (not product or k[0] in ("", product)) and (not seller or k[2] in ("", seller))]
        price = None
        if not quarantined:
            price = (match[0][1] or None) if len(match) == 1 else (own or None) if not match else None
        who = (match[0][0][2] if len(match) == 1 else "") or seller
        assert got[card].n_offers == len(match)
        assert got[card].price == price
        assert got[card].seller_id == (None if quarantined else who or None)


def test_price_recovery_reasons(spark):
    row = ("https://www.shop.example/x/p/20", "1", "", "", "", "", "")
    names = "product_url string, retailer_product_id string, seller_id string, final_sku_price string, original_sku_price string, savings string, discount_type string"
    rows = spark.createDataFrame([row], names)
    good = {"product_id": "1", "sku_id": "20", "seller_id": "7", "current_price": "90", "old_price": "100", "standard_price": "95"}
    run = lambda *offers, base=rows: O.recover_missing_price(base, _offers(spark, *offers), ["shop.example"]).first()
    ok = run(good)
    assert (ok.price_reason, ok.final_sku_price, ok.original_sku_price, ok.savings, ok.seller_id) == ("", "R$90,00", "R$100,00", "Baixou 5%", "7")
    assert run({**good, "sku_id": "21"}).price_reason == "no_matching_price_offer"
    assert run(good, {**good, "seller_id": "8"}).price_reason == "ambiguous_price_offers"
    assert run({**good, "avail_sku": "9"}).price_reason == "price_availability_identity_conflict"
    assert run({**good, "current_price": "0"}).price_reason == "invalid_current_price"
    other = rows.withColumn("original_sku_price", F.lit("R$101,00"))
    assert run(good, base=other).price_reason == "existing_price_quote_conflict"


def test_backfill_never_changes_values_and_reads_the_whole_history(spark):
    rows = spark.createDataFrame([("a", "", "old"), ("b", "kept", "")], "item_key string, x string, y string")
    hist = spark.createDataFrame(
        [("a", "zz", "2024-03", "new", "n1"), ("a", "a", "2024-02", "", "n2"), ("a", "a", "2024-01", "x1", "n3"), ("b", "b", "2024-01", "hx", " ")],
        "item_key string, item string, at string, x string, y string")
    needs = {f: F.col(f) == "" for f in ("x", "y")}
    values = {f: F.nullif(F.trim(F.col(f)), F.lit("")) for f in ("x", "y")}
    valid = F.col("item") == F.col("item_key")
    old = spark.createDataFrame([("a", "zz", f"2024-04-{i:04}", "new", "n1") for i in range(300)], hist.schema)
    out = {r.item_key: r for r in H.backfill(rows, hist.unionByName(old), ["item_key"], ["x", "y"], needs, values, ["at"], valid).collect()}
    assert (out["a"].x, out["a"].y, out["a"].recovered) == ("x1", "old", ["x"])
    assert (out["b"].x, out["b"].y, out["b"].recovered) == ("kept", "", [])


def test_detail_merge_blank_versus_absent(spark):
    rows = spark.createDataFrame([(i, "A b", "50", "2020") for i in range(4)], "k int, retailer_sku_name string, screen_size string, model_year string")
    detail = spark.createDataFrame(
        [(0, "x", "", True, "", False, True), (1, "x", "", False, "2024", False, True), (2, "a  B", "60", True, "2024", False, False), (3, "a b", "60", True, "1", True, True)],
        "k int, retailer_sku_name string, screen_size string, has_screen_size boolean, model_year string, identity_conflict boolean, identity_verified boolean")
    out = {r.k: r for r in MG.merge_detail(rows, detail, ["k"], ["screen_size", "model_year"]).collect()}
    assert (out[0].screen_size, out[0].model_year) == ("", "2020")  # evaluated blank clears
    assert (out[1].screen_size, out[1].model_year) == ("50", "2024")  # absent leaves alone
    assert (out[2].identity_mode, out[2].screen_size, out[2].model_year) == ("same_name", "50", "2020")
    assert (out[3].identity_mode, out[3].screen_size) == ("conflict", "50")


def test_merges_return_every_row_once(spark):
    rows = spark.createDataFrame([(i, "A b", "50") for i in range(3)], "k int, retailer_sku_name string, screen_size string")
    names = "k int, retailer_sku_name string, screen_size string, has_screen_size boolean, identity_conflict boolean, identity_verified boolean"
    detail = spark.createDataFrame(
        [(0, "x", "60", True, False, True), (0, "x", "60", True, False, True), (1, "x", "60", True, False, True), (1, "x", "61", True, False, True)], names)
    out = {r.k: r for r in MG.merge_detail(rows, detail, ["k"], ["screen_size"]).collect()}
    assert len(out) == 3 and (out[0].identity_mode, out[0].screen_size) == ("verified", "60")
    assert (out[1].identity_mode, out[1].screen_size) == ("ambiguous", "50") and out[2].screen_size == "50"
    assert MG.merge_detail(rows, detail, ["k"], ["screen_size"]).count() == 3


def test_snapshot_round_trip_and_missing_path(spark, tmp_path):
    df = spark.createDataFrame([("Patrocinado", "a, \"q\"\nline", None)], "sku_status string, item string, sku string")
    path = str(tmp_path / "snap")
    SN.write_snapshot(df, path, ["item", "sku", "sku_status", "country"])
    row = SN.read_snapshot(spark, path, ["sku_status", "item", "sku", "country", "extra"]).first()
    assert tuple(row) == ("Sponsored", "a, \"q\"\nline", "", "", "")
    assert SN.read_snapshot(spark, str(tmp_path / "none"), ["item"]).count() == 0


def _published(spark, account, line, items):
    columns = SN.final_columns(line)
    rows = [tuple({"account_name": account, "product": line, "item": i, "main_rank": "1", "bsr_rank": "x"}.get(c, "v") for c in columns) for i in items]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def test_output_table_routing():
    assert TB.output_table(" tv ") == "tv_retail_com"
    assert TB.output_table("REF", {"REF": "other"}) == "other"
    assert TB.output_table("LDY", pattern="{line}_rows") == "ldy_rows"


def test_load_modes(spark):
    table = "vitrine_load_test"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    TB.prepare_table(spark, table, "TV")
    TB.prepare_table(spark, table, "TV")
    assert TB.load(_published(spark, "Magalu", "TV", "ab"), table, "TV")["inserted"] == 2
    assert TB.load(_published(spark, "Casas Bahia", "TV", "c"), table, "TV")["inserted"] == 1
    TB.load(_published(spark, "Magazine Luiza", "TV", "z"), table, "TV", "replace_slice", "magalu")
    rows = {(r.account_key, r.item_key, r.main_rank, r.bsr_rank) for r in spark.table(table).collect()}
    assert rows == {("magalu", "z", 1, None), ("casas_bahia", "c", 1, None)}
    TB.load(_published(spark, "Magalu", "TV", "q"), table, "TV", "overwrite")
    assert [r.item_key for r in spark.table(table).collect()] == ["q"]
    with pytest.raises(ValueError):
        TB.load(_published(spark, "Magalu", "TV", "q"), table, "TV", "both")
    spark.sql(f"DROP TABLE {table}")


def test_publish_points_only_at_accepted_data(spark, tmp_path):
    live = str(tmp_path / "live")
    assert TB.published(spark, live) is None
    assert TB.publish(spark.range(3), live, lambda df: df.count() == 3) is True
    assert TB.publish(spark.range(5), live, lambda df: df.count() == 99) is False
    assert TB.published(spark, live).count() == 3
    before = TB.published(spark, live)  # a reader that opened the old version goes on with it
    assert TB.publish(spark.range(5), live, lambda df: df.count() == 5) is True
    assert TB.published(spark, live).count() == 5 and before.count() == 3


def test_readers_see_a_whole_version_while_it_is_switched(spark, tmp_path):
    import threading

    live, seen, stop = str(tmp_path / "live"), set(), threading.Event()
    TB.publish(spark.range(1), live, lambda df: True)

    def read():
        while not stop.is_set():
            seen.add(TB.published(spark, live).count())

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 8):
        TB.publish(spark.range(n), live, lambda df: True)
    stop.set()
    reader.join()
    assert seen <= set(range(1, 8)) and len(seen) > 1


def test_load_leaves_the_session_setting(spark):
    table, setting = "vitrine_setting_test", "spark.sql.sources.partitionOverwriteMode"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    TB.prepare_table(spark, table, "TV")
    before = spark.conf.get(setting)
    for other in ("static", "dynamic"):
        spark.conf.set(setting, other)
        try:
            TB.load(_published(spark, "Magalu", "TV", "ab"), table, "TV")
            TB.load(_published(spark, "Casas Bahia", "TV", "c"), table, "TV")
            TB.load(_published(spark, "Magalu", "TV", "z"), table, "TV", "replace_slice", "magalu")
            assert {(r.account_key, r.item_key) for r in spark.table(table).collect()} == {("magalu", "z"), ("casas_bahia", "c")}
            TB.load(_published(spark, "Magalu", "TV", "q"), table, "TV", "overwrite")
            assert [r.item_key for r in spark.table(table).collect()] == ["q"]
            assert spark.conf.get(setting) == other
        finally:
            spark.conf.set(setting, before)
    spark.sql(f"DROP TABLE {table}")


def test_page_and_capture_readers(spark, tmp_path):
    from vitrine.sources.capture import read_capture
    from vitrine.sources.pages import read_pages
    from vitrine.sources.usage import read_usage_ledger

    folder = tmp_path / "raw" / "shop" / "main"
    folder.mkdir(parents=True)
    (folder / "page_007.html").write_text("<html>\nx</html>")
    page = read_pages(spark, str(tmp_path / "raw")).first()
    assert (page.retailer, page.run_id, page.page, page.html) == ("shop", "main", 7, "<html>\nx</html>")
    (tmp_path / "c.har").write_text(json.dumps({"log": {"entries": [
        {"request": {"method": "GET", "url": "https://h/x?y"}, "response": {"status": 200, "content": {"text": "ok"}}}]}}))
    entry = read_capture(spark, str(tmp_path / "c.har")).first()
    assert (entry.endpoint, entry.status, entry.text) == ("h/x", 200, "ok")
    (tmp_path / "u.jsonl").write_text('{"event":"zenrows_http_request_attempt","retailer":"A b"}\nnope\n')
    assert sorted((r.error, r.retailer) for r in read_usage_ledger(spark, str(tmp_path / "u.jsonl")).collect()) == [
        ("", "a_b"), ("invalid_ledger_json", None)]


def test_page_folders_and_side_files(spark, tmp_path):
    from vitrine.sources import pages as P

    rows = [("North Shop", "run:1", 7, "<p>\na\n\n", "4", "https://h/7"), ("s+t", "m", 12, "", None, None), ("s+t", "m", 13, None, "1", None)]
    pages = spark.createDataFrame(rows, "retailer string, run_id string, page int, html string, listing_mode string, source_url string")
    P.write_pages(pages, str(tmp_path / "made"))
    made = P.read_pages(spark, str(tmp_path / "made"), side=True)
    error = P.side_error(F.lit("4"), F.col("listing_mode"), F.lit("https://h/7"), F.col("source_url")).alias("error")
    got = sorted(tuple(r) for r in made.select("retailer", "run_id", "page", "html", error).collect())
    assert got == [("North Shop", "run:1", 7, "<p>\na\n\n", ""), ("s+t", "m", 12, "", "raw_listing_mode_unverified"),
                   ("s+t", "m", 13, "", "raw_listing_mode_mismatch")]
    assert P.read_pages(spark, str(tmp_path / "made")).count() == 3

    folder = tmp_path / "given" / "s" / "main"
    folder.mkdir(parents=True)
    for n, side in ((1, '{"listing_mode": "4", "source_url": "https://h/8"}'), (2, "broken"), (3, None)):
        (folder / f"page_{n:03d}.html").write_text(f"p{n}\n")
        if side:
            (folder / f"page_{n:03d}.mode.json").write_text(side)
    given = P.read_pages(spark, str(tmp_path / "given"), side=True)
    assert sorted(tuple(r) for r in given.select("page", "html", error).collect()) == [
        (1, "p1\n", "raw_listing_source_mismatch"), (2, "p2\n", "raw_listing_mode_unverified"), (3, "p3\n", "raw_listing_mode_unverified")]


def test_snapshot_keeps_texts_as_they_are(spark, tmp_path):
    texts = ["", " lead", "tail ", 'a "b", c', "two\nlines", "\\", '"', ",", "é"]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "item string, sku string")
    SN.write_snapshot(rows, str(tmp_path / "s"), ["sku", "item"], translate=False)
    back = {r.item: r.sku for r in SN.read_snapshot(spark, str(tmp_path / "s"), ["item", "sku"]).collect()}
    assert [back[str(i)] for i in range(len(texts))] == texts


def test_operations_are_listed_by_calls_endpoint_and_name(spark):
    from vitrine.sources.capture import operations_report

    rows = [("e2", "a", 3), ("e1", "b", 3), ("e1", "a", 3), ("e9", "", 70000), ("e0", "z", 1)]
    ops = spark.createDataFrame(rows, "endpoint string, operation string, calls long")
    for keys, df in (([], ops), (["run"], ops.withColumn("run", F.lit("r")))):
        got = operations_report(df, keys).collect()
        assert [r.place for r in got] == [1, 2, 3, 4, 5]
        assert [(r.endpoint, r.operation, r.calls) for r in got] == sorted(rows, key=lambda r: (-r[2], r[0], r[1]))


def test_final_rows_do_not_depend_on_partitioning(spark):
    from vitrine.plans.final import final_rows

    rows = [{c: "" for c in SN.SNAPSHOT_COLUMNS} | {"item": str(i), "retailer": "Magalu", "sku": f"UN{i}A", "star_rating": "4,5",
            "main_rank": str(i), "product_url": f"https://www.magazineluiza.com.br/x/p/{i}/"} for i in range(20)]
    df = spark.createDataFrame([tuple(r[c] for c in SN.SNAPSHOT_COLUMNS) for r in rows], ", ".join(f"{c} string" for c in SN.SNAPSHOT_COLUMNS))
    make = lambda d: sorted(map(tuple, final_rows(d, [], "M", "TV", "BR", [], F.lit("2024-01-01").cast("timestamp")).collect()))
    assert make(df) == make(df.repartition(7))
    assert list(final_rows(df, [], "M", "TV", "BR", [], F.lit("2024-01-01").cast("timestamp")).columns) == SN.final_columns("TV")


def test_maximal_candidates_equal_brute_force(spark):
    from vitrine.functions.models import maximal_candidate

    words = ["AB12", "AB12C", "XAB12", "Z9Y8", "B1-2C"]
    cases = [list(c) for n in range(1, 4) for c in itertools.permutations(words, n)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c array<string>")
    got = {r.i: r.v for r in df.select("i", maximal_candidate(F.col("c")).alias("v")).collect()}
    bare = lambda v: v.replace("-", "")
    for i, c in enumerate(cases):
        kept = [v for v in c if not any(len(bare(o)) > len(bare(v)) and bare(v) in bare(o) for o in c)]
        assert got[i] == (kept[0] if len(kept) == 1 else "")


def _detail_m(spark, line, **doc):
    import json

    base = {"id": "1", "title": {"TV": "Smart TV LED", "REF": "Geladeira Frost Free", "LDY": "Lavadora de Roupas"}[line], "description": ""}
    rows = spark.createDataFrame([(1, json.dumps({**base, **doc}))], "k int, j string").selectExpr("k", "try_parse_json(j) AS doc", "'' AS seller_id")
    return AT.detail_layout_m(rows, ["k"], line).first()


def _fact(label, value):
    return {"keyName": label, "value": value}


def test_screen_sources_by_level(spark):
    attribute = [{"label": "Polegadas", "current": "50 polegadas"}]
    own, bundle = [_fact("Polegadas", "55 polegadas")], [{"factsheet": [_fact("Polegadas", "43 polegadas")]}]
    assert _detail_m(spark, "TV", attributes=attribute, factsheet=own, bundles=bundle).screen_size == "50 polegadas"
    assert _detail_m(spark, "TV", factsheet=own, bundles=bundle).screen_size == "55 polegadas"
    assert _detail_m(spark, "TV", factsheet=[_fact("Cor", "Preto")], bundles=bundle).screen_size == "43 polegadas"


def test_values_under_other_labels(spark):
    got = _detail_m(spark, "REF", factsheet=[_fact("Outros", "Freezer: 84 L; Refrigerador: 305 L"), _fact("Detalhes", "Consumo 45 kWh/mes")])
    assert "305" in got.ref_capacity and "45" in got.estimated_annual_electricity_use
    assert _detail_m(spark, "LDY", factsheet=[_fact("Outros", "Abertura superior")]).ldy_loading_type != ""


def test_every_entity_is_resolved(value):
    texts = ["a&apos;b &nbsp;&hellip; &Aacute; &#9731; &#x1F600; &unknown; &amp;lt; &NotEqualTilde;"]
    from html import unescape

    from vitrine.functions.text import unescape_entities

    assert value(unescape_entities, *texts) == [unescape(t) for t in texts]


def test_usage_counts_survive_restarts_and_late_rows(spark, tmp_path):
    from vitrine.streaming import jobs as J

    folder, base = tmp_path / "in", str(tmp_path / "run")
    def add(name, *rows):
        spark.createDataFrame(rows, "retailer string, ts string").coalesce(1).write.parquet(str(folder / name / "events.parquet"))
    add("a", ("x", "2024-01-01 10:00:00"), ("x", "2024-01-01 11:00:00"), ("y", "2024-01-02 09:00:00"))

    def run():
        stream = spark.readStream.schema("retailer string, ts string").option("recursiveFileLookup", "true").parquet(str(folder))
        J.run_available(J.usage_counts(stream, ["retailer"]), f"{base}/checkpoint", J.write_batches(f"{base}/out"), "update")
        out = J.latest(spark, f"{base}/out", ["window_start", "retailer"], ["calls"])
        return {(str(r.window_start)[:10], r.retailer): r.calls for r in out.collect()}

    assert run() == {("2024-01-01", "x"): 2, ("2024-01-02", "y"): 1}
    add("b", ("x", "2024-01-01 23:00:00"), ("y", "2024-03-01 00:00:00"))  # late, but inside the watermark
    assert run()[("2024-01-01", "x")] == 3
    add("c", ("x", "2024-01-01 12:00:00"))  # behind the watermark: the window is closed
    assert run() == {("2024-01-01", "x"): 3, ("2024-01-02", "y"): 1, ("2024-03-01", "y"): 1}


def test_a_run_leaves_the_stream_when_a_later_one_starts(spark, tmp_path):
    from vitrine.streaming import jobs as J

    batches = [
        [("2024-01-01", "a"), ("2024-01-01", "a"), ("2024-01-01", "b"), (None, "x")], [("2024-01-01", "b"), ("2024-01-01", "c")],
        [("2024-01-05", "a"), ("2024-01-05", "d")], [("2024-01-01", "late"), ("2024-01-05", "d")],
    ]
    seen, kept = [], []
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, "run string, id string").coalesce(1).write.parquet(f"{tmp_path}/in/batch={n}")
        stream = spark.readStream.schema("run string, id string").parquet(f"{tmp_path}/in/batch=*")
        query = J.run_available(J.first_seen(stream, "run", ["id"]), f"{tmp_path}/checkpoint", J.write_batches(f"{tmp_path}/out"))
        seen.append(sorted((str(r.run)[:10], r.id) for r in spark.read.parquet(f"{tmp_path}/out").collect()))
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    first = [("2024-01-01", "a"), ("2024-01-01", "b")]
    assert seen[0] == first and seen[1] == [*first, ("2024-01-01", "c")]
    # the closed run has no state left, and what comes late for it is dropped
    assert seen[2] == seen[3] == [*first, ("2024-01-01", "c"), ("2024-01-05", "a"), ("2024-01-05", "d")]
    assert kept == [2, 3, 2, 2]
