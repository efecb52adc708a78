"""Markup, character references, deep documents and evidence in the row, each against a plain version."""

import html as standard
import json
import random
from html.entities import html5
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from vitrine.functions import markup as M
from vitrine.functions import measures as S
from vitrine.functions import text as T
from vitrine.functions import validators as V
from vitrine.functions import variants
from vitrine.operators import attributes as A
from vitrine.operators import evidence as E
from vitrine.operators import row_evidence as R
from vitrine.operators.labels import label_dictionary


def test_entities_as_the_standard_has_them(value):
    rng = random.Random(1)
    names = list(html5)
    odd = ["&copy b", "&amp y", "&#39 z", "a &gt", "&notit;", "&#150;", "&#x80;", "&#0;", "&amp;lt;", "&", "&&amp;&", "&#;", "&#x;", "&NewLine;x", "&bne;", "&#11;a", "&#xFFFE;b"]
    parts = lambda: rng.choice([f"&{rng.choice(names)}", f"&#{rng.choice([0, 5, 38, 129, 150, 233, 8364, 55296, 1114111, 99999999999])}{rng.choice(['', ';'])}", "text", " ", "&", ";"])
    texts = odd + ["".join(parts() for _ in range(rng.randint(1, 5))) for _ in range(300)]
    assert value(T.unescape_entities, *texts) == [standard.unescape(t) for t in texts]
    assert value(T.unescape_entities, None, "") == ["", ""]


def test_walk_goes_to_the_ground(spark):
    doc = {"x": 1}
    for k in range(50):
        doc = {"a": [doc, k]} if k % 2 else {"b": doc}
    df = spark.createDataFrame([(1, json.dumps(doc)), (2, '{"q": "[[[["}'), (3, None), (4, "7")], "i int, t string").select("i", F.try_parse_json("t").alias("doc"))
    walked = variants.walk(df, variants.root(F.col("doc")), "nodes", variants.children)
    paths = {r.i: r.p for r in walked.select("i", F.transform("nodes", lambda n: n["path"]).alias("p")).collect()}

    def plain(d, path=""):
        yield path
        for k, c in d.items() if isinstance(d, dict) else enumerate(d) if isinstance(d, list) else ():
            yield from plain(c, f"{path}[{k}]" if isinstance(d, list) else f"{path}.{k}" if path else k)

    assert sorted(paths[1]) == sorted(plain(doc)) and paths[2] == ["", "q"] and paths[3] == [""] and paths[4] == [""]


class Plain(HTMLParser):
    """Texts outside elements that are asides or carry a marked class, for markup whose tags are balanced."""

    def __init__(self):
        super().__init__()
        self.open, self.texts = [], []

    def handle_starttag(self, tag, attrs):
        self.open.append(tag == "aside" or "shelf" in dict(attrs).get("class", ""))

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        if not any(self.open) and data.strip():
            self.texts.append(data.strip())


def test_side_regions_nest(spark):
    rng = random.Random(2)

    def some(depth):
        if depth == 0 or rng.random() < 0.2:
            return f"t{rng.randrange(1000)} "
        tag = rng.choice(["div", "div", "section", "aside", "ul", "p", "span"])
        mark = ' class="x shelf-2"' if rng.random() < 0.15 else ""
        return f"<{tag}{mark}>" + "".join(some(depth - 1) for _ in range(rng.randint(1, 3))) + f"</{tag}>"

    pages = ["".join(some(6) for _ in range(4)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    tags = df.withColumn("tags", M.tags_of(F.col("html"))).withColumn("spans", M.side_spans(F.col("tags")))
    got = tags.select("i", F.filter(F.transform(M.main_tags(F.col("tags"), F.col("spans")), lambda t: F.trim(t["text"])), lambda t: t != "").alias("texts"))
    for row in got.collect():
        plain = Plain()
        plain.feed(pages[row.i])
        assert row.texts == plain.texts


@pytest.mark.parametrize("page, want", [
    ("<section><div>Cor: A</div><header><h2>Similares</h2></header></section>", [("cor", "A")]),  # the heading is not the section's own
    ("<section><div>Cor: A</div><h3><b>Itens</b> <i>patrocinados</i></h3></section><p>Cor: B</p>", [("cor", "B")]),
    ("<article><a href='/x'>a</a><a href='/x/p/1'>b</a><p>Cor: C</p></article>", [("cor", "C")]),  # the first link goes elsewhere
    ("<li><article><a href='/x/p/1'>b</a></article><p>Cor: D</p></li><p>Cor: E</p>", [("cor", "E")]),
    ("<img class='carousel'><p>Cor: F | Modelo G</p>", [("cor", "F")]),
    ("<p>Cor</p><p>Modelo</p><p>Z9 Peso: 3 kg</p>", [("modelo", "Z9")]),
    ("<div aria-label='Compare com'><p>Cor: I</p>", []),
    ("<p>Cor: J<p>Cor: J</p><table><tr><td>Modelo<td>K</table>", [("cor", "J"), ("modelo", "K")]),
    ("<script>'<div class=shelf>'</script><!-- <aside> --><p>Consumo: a 1 W; b: 2 W</p>", [("consumo", "a 1 W; b: 2 W")]),
    (None, []), ("", []), ("<aside>Cor: L", []),
])
def test_page_pairs(spark, page, want):
    df = spark.createDataFrame([(page,)], "html string")
    row = M.with_page_pairs(df, "html", "pairs", ["cor", "modelo", "consumo"]).first()
    assert [tuple(p) for p in row.pairs] == want


def test_row_and_table_resolve_alike(spark):
    """The same labels, description and title give the same values in the row as in the evidence table."""
    rng = random.Random(3)
    labels = ["Capacidade total", "Capacidade do freezer", "Consumo", "Capacidade", "Tipo de porta", "Cor", "Ano do modelo", "Referência"]
    values = ["310 litros", "até 310 L", "90 L", "45 kWh/mês, Voltagem: 220V", "12 kg", "de 300 a 400 litros", "Inverse", "branca", "2023", "AB123", "Freezer: 80 L; Refrigerador: 220 L", "310"]
    rows = [(i, "Geladeira Duplex " + rng.choice(["410 litros", "", "400/420L", "com 90 latas"]), rng.choice(["Capacidade total: 300 L; Consumo: 40 kWh", "Ano 2022; cor: preta", ""]),
             [(rng.choice(labels), rng.choice(values)) for _ in range(rng.randint(0, 6))]) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, title string, description string, specs array<struct<name:string,value:string>>")
    df = df.withColumn("spec_groups", F.array(F.struct(F.lit("g").alias("name"), F.col("specs").alias("specs"))))
    wanted = [*A.LINE_FIELDS["REF"], "reference", "model"]
    own = R.with_fields(R.with_evidence(df.withColumn("labels", E.spec_labels(F.col("spec_groups"))), "C", wanted), wanted)
    table = df.withColumn("l", F.explode(E.spec_labels(F.col("spec_groups")))).select("i", "l.label_key", "l.order_key", "l.value")
    words = label_dictionary(spark, "C").filter(F.col("field").isin(*wanted))
    entry = lambda f, lv, src, c: F.struct(F.lit(f).alias("field"), F.lit(lv).alias("level"), F.lit("0").alias("ordinal"), F.lit(src).alias("source"), c.alias("raw"))
    title_words = df.select("i", F.explode(F.array(
        entry("model_year", 90, "title", T.model_year(F.col("title"))), entry("ref_refrigerator_type", 0, "title", V.refrigerator_type(F.col("title"))),
        entry("model_year", 40, "description", F.regexp_extract("description", r"Ano (\d{4})", 1)))).alias("f")).select("i", "f.*").filter("raw <> ''")
    ev = E.union_all([
        E.labelled_evidence(table, words, ["i"], "spec"), E.description_evidence(df, ["i"], "C", fields=wanted), E.title_evidence(df, ["i"], fields=wanted), title_words])
    far = E.pivot_fields(E.resolve(ev.filter(F.col("field").isin(*wanted)), ["i"]), ["i"], wanted)
    a = {r.i: {f: r[f] for f in wanted} for r in own.collect()}
    b = {r.i: {f: r[f] for f in wanted} for r in far.collect()}
    assert all(a[i] == b.get(i, dict.fromkeys(wanted, "")) for i in a) and len({str(v) for v in a.values()}) > 20


def test_detail_rows_do_not_shuffle(spark):
    docs = spark.createDataFrame([(1, '{"title": "Geladeira", "factsheet": []}')], "i int, t string").select("i", F.try_parse_json("t").alias("doc"), F.lit("a").alias("seller_id"))
    for plan in (A.detail_layout_m(docs, ["i"], "REF"), A.detail_layout_c(docs, ["i"], "LDY")):
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_compact_volume(value):
    assert value(S.is_compact_volume, "3 litros", "de 3 a 4,5 L", "3 kg", "3 L de água", "até 9 lts", "") == [True, True, False, False, True, False]
    titles = ["Mini lavadora 3 litros", "Mini lavadora 3L 3 l azul", "Mini 3 L e 4 L", "Mini lavadora consumo de água 9 litros", "Mini 5 litros água de 8 litros", "Mini"]
    assert value(S.compact_title_volume, *titles) == ["3 litros", "3L", "", "", "", ""]


def test_values_by_the_kinds_of_their_words(value):
    assert value(V.word_kinds, "220V 60Hz", "12,5kg", "300 litros", "HDR10 4K", "2 latas de 350ml", "azul", None) == [
        ["electric"], ["mass"], ["volume"], ["size"], ["container", "volume"], [], []]
    assert value(V.is_refrigerator_capacity, "300 litros", "300", "12 pés cúbicos", "12 kg", "90 W", "20 latas", "sim", "", None) == [
        True, True, True, False, False, False, False, False, False]
    assert value(V.is_washer_capacity, "12 kg", "12", "120", "120 kg", "12 L", "frontal 3", "sim", "12 kWh") == [True, True, False, True, False, False, False, False]
    assert value(V.is_capacity_band, "de 300 a 400 litros", "300 - 400 L", "300 L a 400 L", "acima de 400 litros", "até 400 litros", "400 litros", "300/400") == [
        True, True, True, True, False, False, False]


def test_blank_keys_are_dealt_out(spark):
    """Rows without a key meet no answer and do not stand in one partition; all others meet theirs."""
    from vitrine.operators.numbering import lookup

    rows = spark.range(4000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN '' WHEN id % 3 = 1 THEN NULL ELSE cast(id % 7 AS string) END AS k", "'b' AS l")
    table = spark.createDataFrame([(str(i), "b", i) for i in range(7)] + [("", "b", 99)], "k string, l string, v int")
    for strategy in ("1", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m" if strategy == "1" else "-1")
        try:
            out = lookup(rows, table, ["k", "l"])
            assert out.count() == 4000
            assert out.where("v IS NOT NULL").selectExpr("bool_and(k = v)", "count(*)").first()[:] == (True, rows.where("k <> ''").count())
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_page_cutoff_over_block_borders(spark, monkeypatch):
    from vitrine.operators import ranking

    monkeypatch.setattr(ranking, "FANOUT", 8)
    rng = random.Random(4)
    rows, want = [], {}
    for run in range(6):
        seen, counts = set(), []
        for page in range(40):
            ids = [rng.randrange(25 if run % 2 else 400) for _ in range(rng.randint(1, 3))]
            rows += [(run, page * 3, str(i)) for i in ids]
            seen |= set(ids)
            counts.append(len(seen))
        ends = [p for p in range(40) if counts[p] >= 60 or (p >= 5 and counts[p] == counts[p - 5])]
        want[run] = (ends[0] if ends else 39) + 1
    out = ranking.page_cutoff(spark.createDataFrame(rows, "run int, page long, identity string"), ["run"], 60)
    assert {r.run: r.n for r in out.groupBy("run").agg(F.count("*").alias("n")).collect()} == want
