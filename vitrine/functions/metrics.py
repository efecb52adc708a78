"""Ratings, counts and other short numeric texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.money import to_number
from vitrine.functions.text import as_text, group1, squash

MISSING_WORDS = ("none", "null", "nan")


def _missing(text: Column) -> Column:
    return (text == "") | F.lower(text).isin(*MISSING_WORDS)


def short_number(number: Column) -> Column:
    """Six significant digits without trailing zeros (the C ``%g`` form)."""
    raw = F.format_string("%g", number.cast("double"))
    no_zeros = F.regexp_replace(raw, r"(\.\d*?)0+($|e)", "$1$2")
    shown = F.regexp_replace(no_zeros, r"\.($|e)", "$1")
    return F.when(number == 0, "0").otherwise(shown)


def star_rating(c: Column) -> Column:
    """One decimal, half up on the text's decimal value; missing gives 0."""
    text = F.trim(as_text(c))
    number = F.round(to_number(text), 1)
    shown = F.regexp_replace(number.cast("decimal(18,1)").cast("string"), r"\.0$", "")
    return F.when(_missing(text), "0").when(number.isNull(), text).otherwise(shown)


def count_metric(c: Column, keep_blank: Column | None = None) -> Column:
    """Counts with thousands or decimal marks; missing gives 0 unless kept blank."""
    keep = F.lit(False) if keep_blank is None else keep_blank
    text = F.trim(as_text(c))
    kept = F.regexp_replace(text, r"[^\d,.-]", "")
    plain = (
        F.when(
            F.contains(kept, F.lit(",")),
            F.replace(F.replace(kept, F.lit("."), F.lit("")), F.lit(","), F.lit(".")),
        )
        .when(kept.rlike(r"^\d{1,3}(?:\.\d{3})+$"), F.replace(kept, F.lit("."), F.lit("")))
        .otherwise(kept)
    )
    number = plain.try_cast("decimal(24,6)")
    whole = number == F.floor(number)
    zero = F.when(keep, "").otherwise("0")
    return (
        F.when(_missing(text) | (kept == ""), zero)
        .when(number.isNull(), F.when(keep, "").otherwise(text))
        .when(keep & (number < 0), "")
        .when(whole, F.floor(number).cast("string"))
        .otherwise(short_number(number))
    )


def digits_int(c: Column) -> Column:
    """All non-digits removed; no digit gives 0."""
    digits = F.regexp_replace(as_text(c), r"\D+", "")
    return F.coalesce(digits.try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))


def zero_preserving(c: Column) -> Column:
    text = squash(c)
    number = to_number(text)
    return F.when(text == "", "").when(number.isNull(), text).otherwise(short_number(number))


def recommendation_percent(c: Column) -> Column:
    """``97.6% recommend`` -> ``97% recommend``; other texts stay."""
    text = F.trim(as_text(c))
    pattern = r"^(\d+(?:[.,]\d+)?)%(.*)$"
    whole = F.floor(to_number(F.regexp_extract(text, pattern, 1))).cast("string")
    return F.when(
        text.rlike(pattern), F.concat(whole, F.lit("%"), F.regexp_extract(text, pattern, 2))
    ).otherwise(text)


def screen_size_for_output(c: Column) -> Column:
    text = F.trim(as_text(c))
    size = group1(text, r"""(?i)^(\d{2,3})\s*(?:"|''|polegadas?|pol\.?)?$""")
    return F.when(text == "", "").when(
        size.isNotNull(), F.concat(size, F.lit(" inches"))
    ).otherwise(as_text(c))


def delivery_for_output(c: Column, layout: Column) -> Column:
    """Blank the shipping calculator's error message of layout C."""
    from vitrine.functions.text import ascii_fold

    text = F.trim(as_text(c))
    failed = F.contains(F.lower(ascii_fold(text)), F.lit("calculo de frete apresentou problemas"))
    return F.when((layout == "C") & failed, "").otherwise(text)


def energy_class(c: Column) -> Column:
    text = F.lower(F.trim(as_text(c)))
    return (
        F.when(text == "", "blank")
        .when(F.contains(text, F.lit("kwh")), "kWh")
        .when(text.rlike(r"(?:^|[\d\s,.;(<])w(?:$|[\s).;,])") | text.rlike(r"\bwatts?\b"), "W")
        .when(text.rlike(r"^\d+(?:[,.]\d+)?$"), "number_only")
        .otherwise("other")
    )


def cost_class(mode: Column, rendered: Column, premium: Column) -> Column:
    """Cost multiplier of a request profile."""
    r, p = F.lower(as_text(rendered)) == "true", F.lower(as_text(premium)) == "true"
    return (
        F.when(as_text(mode) == "auto", "auto:1x/5x/10x/25x_success_only")
        .when(r & p, "25x")
        .when(p, "10x")
        .when(r, "5x")
        .otherwise("1x")
    )


def pickup_deadline(formatted: Column, hours: Column, days: Column) -> Column:
    """Formatted deadline, else hours, else days, as one pickup phrase."""
    h, d = as_text(hours), as_text(days)
    shown = (
        F.when(F.trim(as_text(formatted)) != "", F.trim(as_text(formatted)))
        .when(h != "", F.concat(h, F.lit("h")))
        .when(d != "", F.concat(d, F.lit(" dias")))
    )
    return F.coalesce(F.concat(F.lit("Retira Rapido Retirar em "), shown), F.lit(""))


def iso_week(ts: Column) -> Column:
    return F.concat(F.lit("w"), F.weekofyear(ts).cast("string"))


def batch_id(ts: Column, layout: Column) -> Column:
    prefix = F.when(layout == "M", "m").otherwise("c")
    return F.concat(prefix, F.lit("_"), F.date_format(ts, "yyyyMMdd_HHmmss"))


def crawl_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
