"""Stored page markup: regions that do not describe the main product, and the label / value pairs of the rest.

A page is cut once into tags with the text behind each.  One walk over the tags counts depth, so a region ends at the closing
tag that belongs to its opening one, however deep it is nested; only the regions' borders are kept on the way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.text import as_text, clean_text, fold_accents, key_text, let

HIDDEN = r"(?is)<!--.*?-->|<(script|style|noscript|template)\b[^>]*>.*?</\1\s*>"
TAG = r"""</?[A-Za-z][A-Za-z0-9-]*+(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""
# Words that mark a region as one of other products.
SIDE_WORDS = (
    r"(?:recommend|recomend|similar|showcase|vitrine|carousel|carrossel|shelf|cross\s*sell|related|sponsor|patrocin|"
    r"product\s*card|compare|compar)"
)
MARKED = r"""(?i)\s(?:id|class|data-testid|data-component|data-name|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
#: tags that are followed on the way down; others neither hold a region's heading nor end one
HOLDERS = (
    "div", "section", "article", "aside", "main", "header", "footer", "nav", "ul", "ol", "li", "table", "tbody", "thead", "tr", "td", "th",
    "dl", "form", "figure", "fieldset", "details",
)


def _side_words(text: Column) -> Column:
    return F.regexp_replace(F.lower(fold_accents(text)), r"[^a-z0-9]+", " ").rlike(SIDE_WORDS)


def tags_of(html: Column) -> Column:
    """``array<struct<tag,text,name,opens,void,side,says,link,product>>``: every tag and the text behind it, hidden parts left out.

    The first entry has no tag; it holds the text in front.
    """
    body = F.regexp_replace(as_text(html), HIDDEN, " ")

    def cut(b: Column) -> Column:
        tags = F.concat(F.array(F.lit("")), F.regexp_extract_all(b, F.lit(f"({TAG})"), F.lit(1)))
        return F.zip_with(tags, F.split(b, TAG, -1), described)

    def described(tag: Column, text: Column) -> Column:
        name = F.lower(F.regexp_extract(tag, r"^</?([A-Za-z][A-Za-z0-9-]*)", 1))
        marks = F.array_join(F.regexp_extract_all(tag, F.lit(MARKED), F.lit(1)), " ")
        href = F.regexp_extract(tag, r"""(?i)\shref\s*=\s*["']?([^"'\s>]*)""", 1)
        return F.struct(
            tag.alias("tag"), text.alias("text"), name.alias("name"), (~tag.startswith("</") & (tag != "")).alias("opens"),
            (name.isin(*VOID) | tag.endswith("/>")).alias("void"), ((name == "aside") | ((marks != "") & _side_words(marks))).alias("side"),
            _side_words(text).alias("says"), ((name == "a") & (href != "")).alias("link"), F.contains(href, F.lit("/p/")).alias("product"))

    return let(body, cut)


_OPEN = "array<struct<name:string,at:int,linked:boolean>>"
_SPANS = "array<struct<a:int,b:int>>"


def side_spans(tags: Column) -> Column:
    """``array<struct<a,b>>``: numbers of the tags that open and close regions of other products (b: none, to the end).

    Such a region is an ``aside``, a tag whose id, class or label says so, a section, article or div with a heading of its own
    that says so, or an article or list item whose first link goes to a product.
    """
    holders = F.array(*[F.lit(h) for h in HOLDERS])
    parts = ("at", "open", "first", "depth", "region", "heading", "spans")
    state = lambda **c: F.struct(*[c[k].alias(k) for k in parts])
    zero = state(at=F.lit(0), open=F.array().cast(_OPEN), first=F.lit(-1), depth=F.lit(0), region=F.lit(""), heading=F.lit(False), spans=F.array().cast(_SPANS))

    def step(s: Column, t: Column) -> Column:
        name, at, held = t["name"], s["at"], s["open"]
        keep = lambda **c: state(**{k: c.get(k, s[k]) for k in parts} | {"at": at + 1})
        opens = t["opens"] & ~t["void"]
        closes = ~t["opens"] & (t["tag"] != "")
        # inside a region only its own kind of tag counts
        depth = s["depth"] + F.when(name != s["region"], 0).when(opens, 1).when(closes, -1).otherwise(0)
        inside = F.when(depth > 0, keep(depth=depth)).otherwise(keep(
            depth=F.lit(0), first=F.lit(-1), spans=F.array_append(s["spans"], F.struct(s["first"].alias("a"), at.alias("b")))))

        def begin(first: Column, region: Column, depth: Column, rest: Column) -> Column:
            return keep(first=first, region=region, depth=depth, open=rest, heading=F.lit(False))

        last = F.try_element_at(held, F.lit(-1))
        upto = lambda n: F.slice(held, 1, F.greatest(n, F.lit(0)))
        cards = F.filter(F.transform(held, lambda o, i: F.struct(o["name"].alias("name"), o["at"].alias("at"), o["linked"].alias("linked"), i.alias("i"))),
                         lambda o: ~o["linked"] & o["name"].isin("article", "li"))
        card = F.get(cards, F.lit(0))
        same = F.array_max(F.transform(held, lambda o, i: F.when(o["name"] == name, i + 1)))
        title = name.rlike("^h[1-6]$")
        moved = (
            F.when(opens & t["side"], begin(at, name, F.lit(1), held))
            .when(t["opens"] & t["link"] & t["product"] & (F.size(cards) > 0), begin(
                card["at"], card["name"], F.size(F.filter(F.slice(held, card["i"] + 1, F.size(held)), lambda o: o["name"] == card["name"])), upto(card["i"])))
            .when(t["opens"] & t["link"], keep(open=F.transform(held, lambda o: F.struct(o["name"].alias("name"), o["at"].alias("at"), F.lit(True).alias("linked")))))
            .when(opens & F.array_contains(holders, name), keep(open=F.array_append(held, F.struct(name.alias("name"), at.alias("at"), F.lit(False).alias("linked")))))
            .when(opens & title, keep(heading=F.coalesce(last["name"].isin("section", "article", "div"), F.lit(False))))
            .when(closes & title, keep(heading=F.lit(False)))
            .when(closes & same.isNotNull(), keep(open=upto(same - 1)))
            .otherwise(keep()))
        # a heading says it with the text behind any tag that stands in it
        said = let(moved, lambda m: F.when(
            m["heading"] & t["says"] & (m["first"] < 0), state(
                at=m["at"], open=F.slice(m["open"], 1, F.greatest(F.size(m["open"]) - 1, F.lit(0))), first=F.element_at(m["open"], -1)["at"], depth=F.lit(1),
                region=F.element_at(m["open"], -1)["name"], heading=F.lit(False), spans=m["spans"])).otherwise(m))
        return F.when(s["first"] >= 0, inside).otherwise(said)

    return F.aggregate(tags, zero, step, lambda s: F.when(
        s["first"] >= 0, F.array_append(s["spans"], F.struct(s["first"].alias("a"), F.lit(None).cast("int").alias("b")))).otherwise(s["spans"]))


def main_tags(tags: Column, spans: Column) -> Column:
    """The tags outside all regions; a closing tag keeps the text behind it."""
    out = lambda i: F.exists(spans, lambda r: (r["a"] <= i) & F.coalesce(i < r["b"], F.lit(True)))
    return F.when(F.size(spans) == 0, tags).otherwise(F.filter(tags, lambda t, i: ~out(i)))


PAIR = "array<struct<label_key:string,value:string>>"


def _bare(c: Column) -> Column:
    return clean_text(F.regexp_replace(c, r"<[^>]+>", " "))


def _pair(label: Column, value: Column) -> Column:
    return F.struct(key_text(label).alias("label_key"), value.alias("value"))


def cell_pairs(html: Column) -> Column:
    """Every table cell with the next one of its row, and every term of a definition list with its definition."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]\s*>"), F.lit(1)), _bare))
    beside = F.flatten(F.transform(cells, lambda c: F.transform(
        F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))), lambda v, i: _pair(F.get(c, i), v))))
    item = r"(?is)<dt\b[^>]*>(.*?)</dt\s*>\s*<dd\b[^>]*>(.*?)</dd\s*>"
    terms = F.zip_with(
        F.regexp_extract_all(html, F.lit(item), F.lit(1)), F.regexp_extract_all(html, F.lit(item), F.lit(2)), lambda t, d: _pair(_bare(t), _bare(d)))
    return F.concat(beside, terms)


INLINE = r"^([^:=]+?)\s*[:=]\s*(\S.*)$"
# a text that begins with a label of its own is no value of the label in front
LABELLED = r"^[^\d:=]+?\s*[:=]\s*\S.*$"


def text_pairs(texts: Column, wanted: Column) -> Column:
    """Pairs of the cleaned texts of a page: ``label: value`` in one text, and a text that is a label with the text behind it.

    ``wanted`` are the keys of all labels; a text that is a label itself is no value.
    """
    inline = F.transform(texts, lambda t: F.when(t.rlike(INLINE), _pair(F.regexp_extract(t, INLINE, 1), F.regexp_extract(t, INLINE, 2))))
    keys = F.transform(texts, lambda t: key_text(F.regexp_replace(t, r"[\s:=-]+$", "")))

    def follows(k: Column) -> Column:
        taken = lambda i: F.array_contains(wanted, F.get(k, i))
        return F.transform(texts, lambda t, i: F.when(
            F.array_contains(wanted, F.get(k, i)) & F.get(texts, i + 1).isNotNull() & ~F.coalesce(taken(i + 1), F.lit(True))
            & ~F.get(texts, i + 1).rlike(LABELLED), _pair(F.get(k, i), F.get(texts, i + 1))))

    return F.array_compact(F.concat(inline, let(keys, follows)))


# a label that begins inside a value: words and a colon, but no unit of measure
NEXT_LABEL = r"\s+(?!(?i:polegadas?|pol\.?|litros?|lts?|kgs?|kwh|wh|kw|watts?|w)\b)[\p{L}][\p{L}\p{N} /()_-]*?\s*[:=]\s*\S.*$"


def bounded(pairs: Column, wanted: Column) -> Column:
    """The pairs with a wanted label, once each, their values cut at ``;``, ``|`` and at the next label; parts of an energy value stay."""
    def ended(p: Column) -> Column:
        value = F.regexp_replace(p["value"], r"\s*[;|].*$", "")
        whole = p["label_key"].rlike(r"\b(?:consumo|stand ?by)\b")
        return F.struct(p["label_key"].alias("label_key"), F.regexp_replace(F.when(whole, p["value"]).otherwise(F.regexp_replace(value, NEXT_LABEL, "")), r"[\s,;|]+$", "").alias("value"))

    known = F.filter(pairs, lambda p: F.array_contains(wanted, p["label_key"]) & (p["value"] != ""))
    cut = F.transform(known, ended)
    return F.array_distinct(F.filter(cut, lambda p: (p["value"] != "") & ~F.array_contains(wanted, key_text(p["value"]))))


def with_page_pairs(pages, html: str, out: str, labels: list[str] | None = None):
    """Adds ``out``: the label / value pairs of the main part of a page; with ``labels`` (keys), only theirs, from texts as well."""
    df = pages.withColumn("__tags", tags_of(F.col(html)))
    df = df.withColumn("__spans", side_spans(F.col("__tags")))
    df = df.withColumn("__tags", main_tags(F.col("__tags"), F.col("__spans")))
    df = df.withColumn("__main", F.array_join(F.transform("__tags", lambda t: F.concat(t["tag"], t["text"])), ""))
    pairs = cell_pairs(F.col("__main"))
    if labels is not None:
        wanted = F.array(*[F.lit(x) for x in sorted(set(labels))])
        df = df.withColumn("__texts", F.filter(F.transform("__tags", lambda t: clean_text(t["text"])), lambda t: t != ""))
        pairs = bounded(F.concat(pairs, text_pairs(F.col("__texts"), wanted)), wanted)
    else:
        pairs = F.filter(pairs, lambda p: (p["label_key"] != "") & (p["value"] != ""))
    return df.withColumn(out, pairs).drop("__tags", "__spans", "__main", "__texts")
