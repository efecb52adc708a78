"""Queries of the evidence table; every order line is one labelled value of its part."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import measures as S
from vitrine.functions.text import key_text
from vitrine.functions.validators import is_capacity_band
from vitrine.operators import evidence as E
from vitrine.operators.labels import label_dictionary, label_rows
from vitrine.plans import inputs as I
from vitrine.plans.registry import column_query, query

KEYS = ["item"]
Q = I.vc("cast(floor(l_quantity) AS bigint)")
SPECS = {
    "item": "l_partkey",
    "ordinal": "((l_orderkey * 10 + l_linenumber) * 100 + cast(floor(l_quantity) AS bigint)) * 1000 + l_suppkey",
    "label": "CASE l_linenumber WHEN 1 THEN 'Capacidade Total:' WHEN 2 THEN 'Capacidade do Freezer (L)' WHEN 3 THEN 'Consumo de Energia' "
             "WHEN 4 THEN 'CAPACIDADE de lavagem' WHEN 5 THEN 'Tipo de Abertura' WHEN 6 THEN 'Tamanho da tela' ELSE 'Cor' END",
    "value": f"CASE l_linenumber WHEN 1 THEN concat({Q}, ' litros') WHEN 2 THEN concat({Q}, ' L') WHEN 3 THEN concat({Q}, ' kWh/mês') "
             f"WHEN 4 THEN concat({Q}, ' kg') WHEN 5 THEN CASE WHEN l_returnflag = 'R' THEN 'Superior' WHEN l_returnflag = 'A' THEN 'frontal' ELSE 'automática' END "
             f"WHEN 6 THEN concat({Q}, ' polegadas') ELSE l_returnflag END",
    "q": "cast(floor(l_quantity) AS bigint)",
}
_SP = f"sp AS ({I.select_sql(SPECS, 'lineitem')})"
_KEYTXT = "trim(regexp_replace(strip_accents(lower(label)), '[^a-z0-9]+', ' ', 'g'))"
_DICT = "d(label_key, field, level, rule) AS (VALUES " + ", ".join(
    f"('{l}', '{f}', {lv}, '{r}')" for l, f, lv, r in label_rows("M")) + ")"
_EV = f"""{_SP}, {_DICT}, h AS (SELECT item, ordinal, field, level, rule, value, q FROM (SELECT *, {_KEYTXT} AS label_key FROM sp) JOIN d USING (label_key)),
ev AS (SELECT item, field, level, ordinal, value AS raw, q FROM h WHERE CASE rule WHEN 'volume' THEN value LIKE '% litros' OR value LIKE '% L'
  WHEN 'energy' THEN value LIKE '%kWh%' WHEN 'mass' THEN value LIKE '% kg' WHEN 'screen' THEN q BETWEEN 10 AND 200 ELSE rule IN ('text') END
 UNION ALL SELECT item, field, level, ordinal, CASE value WHEN 'Superior' THEN 'Top load' ELSE 'Front load' END, q FROM h WHERE rule = 'loading' AND value IN ('Superior', 'frontal'))"""


def specs(spark, sf):
    rows = I.select(I.table(spark, sf, "lineitem"), SPECS)
    return rows.withColumn("label_key", key_text(F.col("label"))).drop("label", "q")


def evidence(spark, sf):
    return E.labelled_evidence(specs(spark, sf), label_dictionary(spark, "M"), KEYS, "fact")


@query("label_dictionary_join", f"""WITH {_SP}, {_DICT} SELECT item, ordinal, label_key, field, level
FROM (SELECT *, {_KEYTXT} AS label_key FROM sp) JOIN d USING (label_key)""")
def label_dictionary_join(spark, sf):
    rows = specs(spark, sf).join(label_dictionary(spark, "M"), "label_key")
    return rows.select("item", "ordinal", "label_key", "field", "level")


@query("labelled_evidence", f"WITH {_EV} SELECT item, field, level, raw, count(*) AS n FROM ev GROUP BY item, field, level, raw")
def labelled_evidence(spark, sf):
    return evidence(spark, sf).groupBy("item", "field", "level", "raw").agg(F.count(F.lit(1)).alias("n"))


@query("first_level_wins", f"""WITH {_EV}, m AS (SELECT item, field, min(level) AS level FROM ev GROUP BY item, field)
SELECT item, field, level, count(*) AS n_values FROM ev JOIN m USING (item, field, level) GROUP BY item, field, level""")
def first_level_wins(spark, sf):
    return E.first_level(evidence(spark, sf), KEYS).groupBy(*KEYS, "field", "level").agg(
        F.count(F.lit(1)).alias("n_values"))


@query("combine_distinct", f"""WITH {_EV}, m AS (SELECT item, field, min(level) AS level FROM ev GROUP BY item, field),
k AS (SELECT item, field, level, lower(raw) AS k, min(lpad(cast(ordinal AS varchar), 12, '0')) AS o, arg_min(raw, lpad(cast(ordinal AS varchar), 12, '0')) AS raw FROM ev JOIN m USING (item, field, level) GROUP BY item, field, level, lower(raw))
SELECT item, field, string_agg(raw, ',' ORDER BY o, raw) AS value, min(level) AS level FROM k GROUP BY item, field""")
def combine_distinct(spark, sf):
    return E.combine_distinct(evidence(spark, sf), KEYS)


FIELDS = ["ref_capacity", "estimated_annual_electricity_use", "ldy_capacity", "ldy_loading_type"]


@query("resolve_attributes", f"""WITH {_EV}, e AS (SELECT * FROM ev WHERE field IN ({', '.join(repr(f) for f in FIELDS)})),
lo AS (SELECT *, lpad(cast(ordinal AS varchar), 12, '0') AS o FROM e), m AS (SELECT item, field, min(level) AS level FROM lo GROUP BY item, field),
k AS (SELECT item, field, level, CASE WHEN field = 'ldy_loading_type' THEN raw ELSE cast(q AS varchar) END AS k, min(o) AS o, arg_min(raw, o) AS raw FROM lo JOIN m USING (item, field, level) GROUP BY 1, 2, 3, 4)
SELECT item, field, string_agg(raw, ',' ORDER BY o, raw) AS value, min(level) AS level FROM k GROUP BY item, field""")
def resolve_attributes(spark, sf):
    ev = evidence(spark, sf).filter(F.col("field").isin(*FIELDS))
    return E.resolve(ev, KEYS).drop("candidates")


# ---- text evidence over documents -----------------------------------------------------------------

_DOCTEXT = {
    "text": "concat(text, '; Capacidade Total: ', cast(n_chars AS varchar(20)), ' litros; Consumo de energia: ', cast(100 + doc_id % 50 AS varchar(20)), ' kWh - Cor: ', lang)",
    "n": "n_chars",
}


@query("description_pairs", """SELECT doc_id, 'capacidade total' AS label_key, concat(n_chars, ' litros') AS value FROM documents
UNION ALL SELECT doc_id, 'consumo de energia', concat(100 + doc_id % 50, ' kWh') FROM documents
UNION ALL SELECT doc_id, 'cor', lang FROM documents""")
def description_pairs(spark, sf):
    docs = I.table(spark, sf, "documents").selectExpr("doc_id", *[f"{e} AS {n}" for n, e in _DOCTEXT.items()])
    pairs = E.description_pairs(docs, ["doc_id"])
    return pairs.filter(F.col("label_key").isin("capacidade total", "consumo de energia", "cor")).select(
        "doc_id", "label_key", "value")


column_query("description_energy", "documents", ["doc_id"], _DOCTEXT, {
    "energy": (lambda c: F.array_join(S.description_energy(c["text"]), "#"), "concat(100 + doc_id % 50, ' kWh')")})
column_query("description_capacity", "documents", ["doc_id"], _DOCTEXT, {
    "total": (lambda c: F.array_join(S.phrase_capacities(c["text"], "total"), "#"), "concat(n, ' litros')")})

_LI = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
column_query("category_bands", "lineitem", _LI,
             {"q": Q, "value": f"CASE l_linenumber WHEN 1 THEN concat('de ', {Q}, ' a ', {Q}, ' litros') WHEN 2 THEN concat({Q}, ' - ', {Q}, ' L') WHEN 3 THEN concat('acima de ', {Q}, ' litros') WHEN 4 THEN concat('até ', {Q}, ' litros') ELSE concat({Q}, ' litros') END"},
             {"band": (lambda c: is_capacity_band(c["value"]).cast("int"), "CASE WHEN l_linenumber <= 3 THEN 1 ELSE 0 END")})
column_query("distinct_measurements", "lineitem", _LI,
             {"a": Q, "b": I.vc("l_linenumber"), "values_text": f"concat({Q}, ' kg#', {Q}, '#', cast(l_linenumber AS varchar(10)), '#', cast(l_linenumber AS varchar(10)), ' kg#', {Q}, ' lbs')"},
             {"joined": (lambda c: S.join_measurements(F.split(c["values_text"], "#")),
                         "CASE WHEN a = b THEN concat(a, ' kg,', a, ' lbs') ELSE concat(a, ' kg,', b, ',', a, ' lbs') END")})
column_query("exact_over_qualified", "lineitem", _LI,
             {"a": Q, "b": I.vc("l_linenumber * 10"), "values_text": f"concat('até ', {Q}, ' L#', cast(l_linenumber * 10 AS varchar(10)), ' litros#acima de 7 L')"},
             {"kept": (lambda c: F.array_join(F.transform(S.exact_over_qualified(F.transform(
                 F.split(c["values_text"], "#"), lambda v, i: F.struct(i.alias("level"), F.lit("0").alias("ordinal"), v.alias("raw")))), lambda v: v["raw"]), "#"),
                 "concat(CASE WHEN a = b THEN '' ELSE concat('até ', a, ' L#') END, b, ' litros#acima de 7 L')")})
column_query("loading_candidates", "documents", ["doc_id"],
             {"text": "concat(text, CASE doc_id % 3 WHEN 0 THEN ', Lavadora com abertura superior' WHEN 1 THEN ', sem carga frontal' ELSE ', Front Load, nada' END)"},
             {"loading": (lambda c: F.array_join(F.array_distinct(S.description_loadings(c["text"])), ","),
                          "CASE doc_id % 3 WHEN 0 THEN 'Top load' WHEN 1 THEN '' ELSE 'Front load' END")})
column_query("title_screen_size", "part", ["p_partkey"],
             {"n": I.vc("10 + p_size"), "title": "concat(CASE p_size % 5 WHEN 0 THEN 'Suporte para TV de ' WHEN 1 THEN 'Smart TV ' WHEN 2 THEN 'Smart TV LED ' WHEN 3 THEN 'TV até ' ELSE 'Televisor 99 polegadas e ' END, "
                                                  + I.vc("10 + p_size") + ", CASE p_size % 5 WHEN 2 THEN ' 4K UHD ' ELSE '\" ' END, p_name)", "k": "p_size % 5"},
             {"screen": (lambda c: S.title_screen_size(c["title"]),
                         "CASE k WHEN 1 THEN concat(n, '\"') WHEN 2 THEN concat(n, '\"') ELSE '' END")})
column_query("title_wash_mass", "part", ["p_partkey"],
             {"n": I.vc("1 + p_size"), "k": "p_size % 5", "title": "concat(CASE p_size % 5 WHEN 0 THEN 'Lava e Seca ' ELSE 'Lavadora ' END, p_name, ' ', " + I.vc("1 + p_size")
                + ", CASE p_size % 5 WHEN 0 THEN 'kg/7kg' WHEN 1 THEN ' kg' WHEN 2 THEN ' kg peso 99 kg' WHEN 3 THEN ' kg ou 98 kg' ELSE ' kg / 97 kg' END)"},
             {"mass": (lambda c: S.exact_title_mass(c["title"]),
                       "CASE k WHEN 0 THEN concat(n, 'kg') WHEN 1 THEN concat(n, ' kg') WHEN 2 THEN concat(n, ' kg') ELSE '' END")})
column_query("capacity_components", "part", ["p_partkey"],
             {"a": I.vc("100 + p_size"), "b": I.vc("50 + p_size"), "k": "p_size % 3",
              "text": "concat('Freezer: ', " + I.vc("50 + p_size") + ", ' L; Refrigerador: ', " + I.vc("100 + p_size") + ", ' litros', CASE p_size % 3 WHEN 0 THEN '; reservatório de água 3 litros' WHEN 1 THEN '; 500 L de capacidade total' ELSE '' END)"},
             {"parts": (lambda c: F.array_join(F.transform(S.capacity_components(c["text"]), lambda p: F.concat(p["kind"], F.lit("="), p["raw"])), "#"),
                        "concat('freezer=', b, ' L#refrigerator=', a, ' litros', CASE k WHEN 1 THEN '#total=500 L' ELSE '' END)")})


@query("table_pairs", """SELECT page_id, 'modelo' AS label_key, concat('M', page_id) AS value FROM pages UNION ALL SELECT page_id, 'cor', 'Preto & Branco' FROM pages""")
def table_pairs(spark, sf):
    pages = I.table(spark, sf, "pages").selectExpr(
        "page_id", "concat(html, '<aside><dl><dt>Cor</dt><dd>x</dd></dl></aside><table><tr><th>Modelo</th><td><b>M', page_id, '</b></td></tr></table><dl><dt>Cor:</dt><dd>Preto &amp; Branco</dd></dl>') AS html")
    out = E.table_pairs(pages, ["page_id"])
    return out.filter(F.col("label_key").isin("modelo", "cor")).select("page_id", "label_key", "value")


# other products' regions nest, say so in a class, a label or a heading, or are cards; what is left are the page's own pairs
_PAGE = (
    "'<div class=\"spec\"><table><tr><th>Modelo</th><td><b>M', page_id, '</b></td><th>Cor</th><td>Preto &amp Branco</td></tr></table></div>"
    "<div class=\"recommend-list\"><div><div><dl><dt>Cor</dt><dd>Azul</dd></dl></div></div><dl><dt>Cor</dt><dd>Verde</dd></dl></div>"
    "<section><h2><span>Produtos similares</span></h2><div><section>x</section><p>Cor: Rosa</p></div></section>"
    "<ul><li><div><a href=\"/x/p/1\">t</a><span>Cor</span><span>Roxo</span></div></li></ul>"
    "<p>Capacidade total: ', 300 + page_id % 7, ' litros; Voltagem: 220V</p><span>Consumo</span><span>', 30 + page_id % 5, ' kWh</span><aside><p>Cor: x'"
)


@query("page_pairs", """SELECT page_id, 'modelo' AS label_key, concat('M', page_id) AS value FROM pages UNION ALL SELECT page_id, 'cor', 'Preto & Branco' FROM pages
UNION ALL SELECT page_id, 'capacidade total', concat(300 + page_id % 7, ' litros') FROM pages UNION ALL SELECT page_id, 'consumo', concat(30 + page_id % 5, ' kWh') FROM pages""")
def page_pairs(spark, sf):
    from vitrine.functions.markup import with_page_pairs

    pages = I.table(spark, sf, "pages").selectExpr("page_id", f"concat(html, {_PAGE}) AS html")
    out = with_page_pairs(pages, "html", "pairs", ["modelo", "cor", "capacidade total", "consumo"])
    return out.select("page_id", F.explode_outer("pairs").alias("p")).select("page_id", "p.label_key", "p.value")
