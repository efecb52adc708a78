"""Prices, savings, discounts and coupon texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.text import as_text, distinct_join, group1, present, squash, trim_decimal

BRL_PATTERN = r"^R\$\d{1,3}(?:\.\d{3})*,\d{2}$"
BRL_ANYWHERE = r"R\$\s*[\d.]+,\d{2}"


def to_number(c: Column) -> Column:
    """Text or number with decimal comma or point; NULL when it is neither."""
    return F.replace(F.trim(c.cast("string")), F.lit(","), F.lit(".")).try_cast("decimal(20,6)")


def _brl(number: Column) -> Column:
    return F.concat(F.lit("R$"), F.translate(F.format_number(number, 2), ",.", ".,"))


def format_brl(c: Column) -> Column:
    """1234.5 -> R$1.234,50; text that is no number stays as it is."""
    number = to_number(c).cast("decimal(18,2)")
    return F.when(blank_like(c), "").when(number.isNotNull(), _brl(number)).otherwise(as_text(c))


def blank_like(c: Column) -> Column:
    return as_text(c) == ""


def price_number(c: Column) -> Column:
    """Number of a Brazilian price text, two decimals, NULL when there is none."""
    kept = F.regexp_replace(F.trim(as_text(c)), r"[^\d,.\-]", "")
    plain = F.when(
        F.contains(kept, F.lit(",")),
        F.replace(F.replace(kept, F.lit("."), F.lit("")), F.lit(","), F.lit(".")),
    ).otherwise(kept)
    return plain.try_cast("decimal(20,6)").cast("decimal(18,2)")


def price_for_output(c: Column) -> Column:
    text = F.trim(as_text(c))
    return (
        F.when(text.rlike(BRL_PATTERN), text)
        .when(text.rlike(r"^\d+(?:\.\d{1,2})?$"), format_brl(text))
        .otherwise(text)
    )


def prices_equal(a: Column, b: Column) -> Column:
    na, nb = price_number(a), price_number(b)
    return F.when(na.isNotNull() & nb.isNotNull(), na == nb).otherwise(
        F.trim(as_text(a)) == F.trim(as_text(b))
    )


def original_for_output(original: Column, final: Column) -> Column:
    """The original price, blank when it says the same as the final one."""
    same = present(original) & present(final) & prices_equal(original, final)
    return F.when(same, "").otherwise(as_text(original))


def discount_percent(old: Column, final: Column) -> Column:
    """Whole percent of a real reduction (ties to even), NULL otherwise."""
    o, f = to_number(old), to_number(final)
    ratio = (o - f).cast("decimal(20,6)") * F.lit(100).cast("decimal(5,0)") / o
    return F.when((o > 0) & (f > 0) & (f < o), F.bround(ratio, 0).cast("int"))


def offer_discount_rate(explicit: Column, old: Column, current: Column) -> Column:
    """A stated absolute rate, else the computed one; below one percent gives NULL."""
    stated = F.abs(to_number(explicit))
    o, c = to_number(old), to_number(current)
    hundred = F.lit(100).cast("decimal(5,0)")
    made = F.when(
        (o > 0) & (c < o) & ((o - c) * hundred >= o), F.round((o - c) * hundred / o, 0)
    )
    return (
        F.when(stated.isNotNull(), F.when(stated >= 1, F.round(stated, 0)))
        .otherwise(made)
        .cast("int")
    )


def percent_text(c: Column) -> Column:
    """12.50 -> 12.5%; blank and zero give ''."""
    number = to_number(c)
    text = as_text(c)
    shown = F.regexp_replace(F.regexp_replace(number.cast("string"), r"0+$", ""), r"\.$", "")
    return (
        F.when(text.isin("", "0"), "")
        .when(number.isNotNull(), F.concat(shown, F.lit("%")))
        .otherwise(squash(c))
    )


def lowered_text(c: Column) -> Column:
    """``Baixou n%``, the listing's spelling of a price reduction."""
    p = percent_text(c)
    return F.when(p != "", F.concat(F.lit("Baixou "), p)).otherwise("")


def listing_savings(explicit: Column, old: Column, standard: Column, fallback: Column) -> Column:
    computed = discount_percent(old, standard)
    return (
        F.when(present(explicit), squash(explicit))
        .when(F.coalesce(computed, F.lit(0)) > 0, lowered_text(computed))
        .otherwise(lowered_text(fallback))
    )


def savings_for_output(c: Column, layout: Column) -> Column:
    """Layout M shows none; layout C turns a bare percent into ``Baixou n%``."""
    text = F.trim(as_text(c))
    dot = lambda x: F.replace(x, F.lit(","), F.lit("."))
    lowered = group1(text, r"(?i)baixou\s+(-?\d+(?:[.,]\d+)?)%")
    bare = group1(text, r"^(\d+(?:[.,]\d+)?)%$")
    return (
        F.when(layout == "M", "")
        .when(lowered.isNotNull(), F.concat(F.lit("Baixou "), dot(lowered), F.lit("%")))
        .when(bare.isNotNull() & (layout == "C"), F.concat(F.lit("Baixou "), dot(bare), F.lit("%")))
        .otherwise(text)
    )


def discount_type_for_output(c: Column) -> Column:
    text = F.trim(as_text(c))
    hit = F.coalesce(
        group1(text, r"(?i)^(\d+(?:[.,]\d+)?)%\s*(?:OFF|discount(?:\s+off)?)$"),
        group1(text, r"(?i)^(\d+(?:[.,]\d+)?)%\s*(?:de\s+)?desconto$"),
    )
    return F.when(
        hit.isNotNull(), F.concat(F.replace(hit, F.lit(","), F.lit(".")), F.lit("% discount off"))
    ).otherwise(text)


def coupon_text(tags: Column) -> Column:
    """Coupon tags (``array<struct<type,discountValue,message>>``) as one text."""

    def one(t: Column) -> Column:
        amount = to_number(t["discountValue"])
        plain = F.regexp_replace(F.regexp_replace(amount.cast("string"), r"0+$", ""), r"\.$", "")
        shown = F.concat(F.lit("Cupom R$ "), F.replace(plain, F.lit("."), F.lit(",")), F.lit(" OFF"))
        return F.when(amount.isNotNull(), shown).otherwise(squash(t["message"]))

    coupons = F.filter(tags, lambda t: F.lower(squash(t["type"])) == "coupon")
    return F.coalesce(distinct_join(F.transform(coupons, one), "; "), F.lit(""))


def coupon_result(tags: Column, seller: Column, wanted_seller: Column) -> Column:
    """(text, checked): a tag list, even an empty one, counts as checked."""
    wanted = F.lower(squash(wanted_seller))
    agrees = (wanted == "") | (wanted == F.lower(squash(seller)))
    ok = F.coalesce(tags.isNotNull() & agrees, F.lit(False))
    return F.struct(F.when(ok, coupon_text(tags)).otherwise("").alias("text"), ok.alias("checked"))


def badge_discounts(badges: Column) -> Column:
    """Badges (``array<struct<flag,title,text>>``) as one discount text.

    The first coupon badge that states a percent wins alone; a coupon without one
    is ignored; otherwise the distinct percents of the other badges are listed.
    """
    texts = F.transform(
        badges,
        lambda b: F.filter(
            F.transform(F.array(b["flag"], b["title"], b["text"]), lambda t: F.trim(as_text(t))),
            lambda t: t != "",
        ),
    )
    is_coupon = lambda ts: F.exists(ts, lambda t: t.rlike(r"(?i)\bcupom\b"))
    percent = r"(?<!\d)(\d+(?:[,.]\d+)?)\s*%"
    coupon_texts = F.filter(
        F.flatten(F.filter(texts, is_coupon)), lambda t: t.rlike(percent)
    )
    first = F.regexp_extract(F.try_element_at(coupon_texts, F.lit(1)), percent, 1)
    stated = F.flatten(F.transform(
        F.flatten(F.filter(texts, lambda ts: ~is_coupon(ts))),
        lambda t: F.regexp_extract_all(
            t, F.lit(r"(?i)(\d+(?:[,.]\d+)?)\s*%\s*de\s+desconto\b"), F.lit(1)),
    ))
    dotted = lambda p: trim_decimal(F.replace(p, F.lit(","), F.lit(".")))
    others = F.transform(stated, lambda p: F.concat(dotted(p), F.lit("% de desconto")))
    return (
        F.when(badges.isNull(), "")
        .when(F.size(coupon_texts) > 0,
              F.concat(F.lit("USE O CUPOM DESCONTO "), dotted(first), F.lit("%")))
        .otherwise(F.array_join(F.array_distinct(others), "; "))
    )


def discount_is_ambiguous(c: Column) -> Column:
    """Blank, or coupon / percent text that is not the canonical coupon."""
    text = F.trim(as_text(c))
    canonical = r"(?i)^USE\s+O\s+CUPOM\s+DESCONTO\s+\d+(?:[.,]\d+)?\s*%$"
    unclear = (
        r"(?i)\bcupom\b|\bcoupon\b|"
        r"\d+(?:[.,]\d+)?\s*%\s*(?:de\s+desconto|discount(?:\s+off)?|off)\b"
    )
    return (text == "") | (~text.rlike(canonical) & text.rlike(unclear))


# ---- phrases in the text of one product card ------------------------------------------


def _first_found(text: Column, pattern: str) -> Column:
    """Group 1 of the first match or NULL; the text is gone through once."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0))


def _plain_blanks(text: Column) -> Column:
    """True for ASCII text whose white space is single blanks, which :func:`squash` would only trim."""
    return (F.octet_length(text) == F.length(text)) & ~text.rlike(r"[^\S ]|  ")


def card_prices(text: Column) -> Column:
    """(original, final) of a card text: first and last price, the pix price overrides."""
    prices = F.regexp_extract_all(as_text(text), F.lit(BRL_ANYWHERE), F.lit(0))
    pix = _first_found(as_text(text), r"(?i)(R\$\s*[\d.]+,\d{2})\s*no\s*pix")
    return F.struct(
        F.regexp_extract(as_text(text), BRL_ANYWHERE, 0).alias("original"),
        F.coalesce(pix, F.try_element_at(prices, F.lit(-1)), F.lit("")).alias("final"),
    )


def card_rating(text: Column) -> Column:
    pattern = r"([1-5](?<=\b[1-5])[,.]\d)\s*\(([\d.]+)\)"
    return F.struct(
        F.replace(F.regexp_extract(as_text(text), pattern, 1), F.lit(","), F.lit(".")).alias("rating"),
        F.regexp_extract(as_text(text), pattern, 2).alias("count"),
    )


# a percentage, looked for only where its digits begin: no other start of theirs can match
_PERCENT = r"(?<!\d)(\d++(?:[.,]\d++)?+)%"


def card_savings(text: Column) -> Column:
    dot = lambda x: F.replace(x, F.lit(","), F.lit("."))
    t = as_text(text)
    # patterns are tried only on texts that hold their fixed word
    lowered = F.when(F.contains(F.lower(t), F.lit("baixou")), _first_found(t, r"(?i)Baixou\s+(-?\d+(?:[.,]\d+)?)%"))
    off = F.when(F.contains(t, F.lit("%")), _first_found(t, rf"(?i){_PERCENT}\s+(?:OFF|de\s+desconto)"))
    return F.coalesce(
        F.concat(F.lit("Baixou "), dot(lowered), F.lit("%")),
        F.concat(dot(off), F.lit("%")),
        F.lit(""),
    )


# Discount phrases of a card, in the order they are reported, each with a word that its texts hold.
CARD_DISCOUNT_PATTERNS = (
    ("cupom", r"(?i)Cupom\s+R\$\s*[\d.]+(?:,\d{2})?\s*OFF"),
    ("use", r"(?i)Use\s+o\s+cupom\s+[A-Za-z0-9_-]+"),
    ("pix", rf"(?i){_PERCENT}\s+de\s+desconto\s+no\s+pix"),
    ("desconto", rf"(?i){_PERCENT}\s+(?:de\s+)?desconto"),
)


def card_discounts(text: Column) -> Column:
    t, none = as_text(text), F.array().cast("array<string>")
    low = F.lower(t)
    found = F.concat(*[
        F.when(F.contains(low, F.lit(word)), F.regexp_extract_all(t, F.lit(p), F.lit(0))).otherwise(none)
        for word, p in CARD_DISCOUNT_PATTERNS
    ])
    # a phrase has the white space of its text, and none is blank
    return F.array_join(F.array_distinct(F.when(_plain_blanks(t), found).otherwise(F.transform(found, squash))), "; ")


def card_name(text: Column) -> Column:
    """Card text before the first price, without the rating tail."""
    rest = F.regexp_replace(as_text(text), r"(?i)Full(?<=\bFull)\b(?U:\s*)", "")
    t = F.when(_plain_blanks(rest), F.trim(rest)).otherwise(squash(rest))
    head = F.when(F.startswith(t, F.lit("R$")), t).otherwise(F.substring_index(t, "R$", 1))
    return F.trim(F.regexp_replace(head, r"[1-5](?<=\b[1-5])[,.]\d\s*\([\d.]+\)\s*$", ""))
