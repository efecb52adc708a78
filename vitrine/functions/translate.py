"""Translation of coded Portuguese texts, driven by ordered rule tables.

A rule is (pattern on the folded text, template); ``$1`` in a template is the
first capture, ``{date}`` and ``{duration}`` are the capture after the date or
duration rules.  The first rule that matches wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.text import as_text, loose_key, lookup
from vitrine.functions.validators import loading_directions, refrigerator_type

# Weekday and month names.
WEEKDAYS = {
    "segunda": "Monday", "segunda-feira": "Monday",
    "terca": "Tuesday", "terca-feira": "Tuesday",
    "quarta": "Wednesday", "quarta-feira": "Wednesday",
    "quinta": "Thursday", "quinta-feira": "Thursday",
    "sexta": "Friday", "sexta-feira": "Friday",
    "sabado": "Saturday", "domingo": "Sunday",
}
MONTHS = {
    "janeiro": "January", "fevereiro": "February", "marco": "March", "abril": "April",
    "maio": "May", "junho": "June", "julho": "July", "agosto": "August",
    "setembro": "September", "outubro": "October", "novembro": "November",
    "dezembro": "December",
}

# Delivery phrases.
DELIVERY_RULES = (
    (r"^receba em casa$", "Receive at home"),
    (r"\breceba\s+hoje\b", "Receive today"),
    (r"\breceba\s+amanh", "Receive tomorrow"),
    (r"^entrega rapida$", "Fast delivery"),
    (r"^frete gratis$", "Free shipping"),
    (r"agendada\s+a\s+partir\s+de\s+(.+)", "Scheduled from {date}"),
    (r"entrega indisponivel para este cep", "Delivery unavailable for this ZIP code"),
    (r"entrega indisponivel|produto indisponivel",
     "Delivery unavailable for your region at the moment. Try another ZIP code?"),
    (r"expressa\s+ate\s+(.+)", "Express delivery by {date}"),
    (r"economica\s+ate\s+(.+)", "Economy delivery by {date}"),
    (r"normal\s+ate\s+(.+)", "Normal by {date}"),
    (r"receba\s+em\s+ate\s+(1)\s+dias?\s+ut(?:il|eis)", "Receive within $1 business day"),
    (r"receba\s+em\s+ate\s+(\d+)\s+dias?\s+ut(?:il|eis)", "Receive within $1 business days"),
    (r"receba\s+ate\s+(.+)", "Receive by {date}"),
)

# Pickup phrases.
PICKUP_RULES = (
    (r"retira\s+rapido\s+retirar\s+em\s+(.+)", "Fast pickup in {duration}"),
    (r"fast\s+pickup\s+in\s+(.+)", "Fast pickup in {duration}"),
    (r"retire.*amanh", "Pick up in store starting tomorrow"),
    (r"retire|retira", "Pick up in store"),
)

# Refrigerator types, first by canonical name, then by phrase.
TYPE_NAMES = {
    "Side by Side": "Side by Side", "French Door": "French Door", "Multidoor": "Multidoor",
    "Inverse": "Freezer-on-Bottom", "Top Freezer": "Freezer-on-Top", "1 porta": "Single Door",
    "3 portas": "Three Door", "4 portas": "Four Door", "Duplex": "Freezer-on-Top",
    "2 portas": "Two Door",
}
TYPE_RULES = (
    (r"^(?:sim|nao|1|2|02|3|4)$", ""),
    (r"\b\d+(?:[,.]\d+)?\s*(?:cm|mm|m)\b", ""),
    (r"\b1\s*portas?\b|uma\s+porta|porta unica", "Single Door"),
    (r"\b2\s*portas\b|duas\s+portas", "Two Door"),
    (r"\b3\s*portas\b|tres\s+portas", "Three Door"),
    (r"\b4\s*portas\b|quatro\s+portas", "Four Door"),
    (r"porta francesa|^french", "French Door"),
    (r"side by side", "Side by Side"),
    (r"multidoor|multi door", "Multidoor"),
    (r"bottom freezer|freezer inferior", "Freezer-on-Bottom"),
    (r"top freezer|^duplex", "Freezer-on-Top"),
    (r"^invers[eo]", "Freezer-on-Bottom"),
    (r"^(?:inverter|aco|inox look|flat|reversivel)$", ""),
    (r"\b(?:chapa|metalica|pintada|black inox)\b", ""),
)

TRANSLATED_FIELDS = (
    "sku_status", "discount_type", "delivery_availability", "pick_up_availability",
    "recommendation_intent", "ref_refrigerator_type", "ldy_loading_type",
)


def date_text(folded: Column) -> Column:
    """Dates with weekday first, weekday last, or any mix of known words."""
    first, last = r"([a-z-]+),\s*(\d{1,2})\s+de\s+([a-z]+)", r"(\d{1,2})\s+de\s+([a-z]+),\s*([a-z-]+)"
    part = lambda pattern, i: F.regexp_extract(folded, pattern, i)
    day = lambda c: lookup(c, WEEKDAYS, c)
    month = lambda c: lookup(c, MONTHS, c)
    shape = lambda wd, m, d: F.concat(day(wd), F.lit(", "), month(m), F.lit(" "), d)
    pieces = F.transform(F.split(folded, ","), lambda p: F.trim(p))
    lead = F.element_at(pieces, 1)
    rest = F.slice(pieces, F.lit(2), F.size(pieces))
    loose = F.array_join(F.concat(F.array(day(lead)), rest), ", ")
    for src, dst in MONTHS.items():
        loose = F.regexp_replace(loose, rf"(?i)\b{src}\b", dst)
    loose = F.regexp_replace(loose, r"(?i)\bde\s+", "")
    return (
        F.when(folded.rlike(first), shape(part(first, 1), part(first, 3), part(first, 2)))
        .when(folded.rlike(last), shape(part(last, 3), part(last, 2), part(last, 1)))
        .otherwise(loose)
    )


def duration_text(text: Column) -> Column:
    folded = loose_key(text)
    pattern = r"^(\d+)\s+dias?(?:\s+(ut(?:il|eis)))?$"
    count = F.regexp_extract(folded, pattern, 1)
    business = F.regexp_extract(folded, pattern, 2) != ""
    unit = F.concat(
        F.when(business, "business day").otherwise("day"), F.when(count == "1", "").otherwise("s")
    )
    return F.when(folded.rlike(pattern), F.concat(count, F.lit(" "), unit)).otherwise(F.trim(text))


def apply_rules(folded: Column, rules, otherwise: Column) -> Column:
    out = None
    for pattern, template in rules:
        if "{" in template:
            head = template[: template.index("{")]
            captured = F.trim(F.regexp_extract(folded, pattern, 1))
            tail = date_text(captured) if "{date}" in template else duration_text(captured)
            value = F.concat(F.lit(head), tail)
        elif "$1" in template:
            head, tail = template.split("$1")
            value = F.concat(F.lit(head), F.regexp_extract(folded, pattern, 1), F.lit(tail))
        else:
            value = F.lit(template)
        hit = folded.rlike(pattern)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(otherwise)


def _sku_status(text: Column) -> Column:
    return F.when(loose_key(text).rlike("patrocinado|sponsored"), "Sponsored").otherwise(text)


def _discount_type(text: Column) -> Column:
    folded = loose_key(text)
    number = r"(\d+(?:[.,]\d+)?)"
    coupon = rf"^use\s+o\s+cupom\s+desconto\s+{number}\s*%$"
    dotted = lambda p: F.replace(F.regexp_extract(folded, p, 1), F.lit(","), F.lit("."))
    trimmed = F.regexp_replace(F.regexp_replace(dotted(coupon), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    out = F.when(
        folded.rlike(coupon), F.concat(F.lit("USE O CUPOM DESCONTO "), trimmed, F.lit("%"))
    )
    amount = r"cupom\s+r\$\s*([\d.,]+)\s*off"
    out = out.when(
        folded.rlike(amount),
        F.concat(F.lit("Coupon R$ "), F.regexp_extract(folded, amount, 1), F.lit(" off")),
    )
    code = r"(?i)use?\s+o\s+cupom\s+(.+)"
    out = out.when(
        text.rlike(code), F.concat(F.lit("Use coupon "), F.trim(F.regexp_extract(text, code, 1)))
    )
    for p in (rf"{number}%\s+(?:de\s+)?desconto", rf"{number}%\s*off",
              rf"{number}%\s*discount(?:\s+off)?"):
        out = out.when(folded.rlike(p), F.concat(dotted(p), F.lit("% discount off")))
    return (
        out.when(folded.rlike("desconto.*carne|carne.*desconto"),
                 "Discount with digital payment booklet")
        .when(F.contains(folded, F.lit("desconto")), F.regexp_replace(text, "(?i)desconto", "discount"))
        .otherwise(text)
    )


def _delivery(text: Column) -> Column:
    folded = loose_key(text)
    generic = F.when(
        folded.startswith("receba"), F.regexp_replace(text, "(?i)^receba", "Receive")
    ).otherwise(text)
    return apply_rules(folded, DELIVERY_RULES, generic)


def _pickup(text: Column) -> Column:
    folded = loose_key(text)
    fast = r"(?i)fast\s+pickup\s+in\s+(.+)"
    kept_case = F.concat(
        F.lit("Fast pickup in "), duration_text(F.trim(F.regexp_extract(text, fast, 1)))
    )
    already = text.rlike(fast) & ~folded.rlike(PICKUP_RULES[0][0])
    return F.when(already, kept_case).otherwise(apply_rules(folded, PICKUP_RULES, text))


def _recommendation(text: Column) -> Column:
    pattern = r"(\d+(?:[.,]\d+)?)%\s+dos\s+clientes\s+recomendam"
    folded = loose_key(text)
    whole = F.regexp_extract(F.regexp_extract(folded, pattern, 1), r"^0*(\d+)", 1)
    return F.when(
        folded.rlike(pattern), F.concat(whole, F.lit("% recommend this product"))
    ).otherwise(text)


def _refrigerator_type(text: Column) -> Column:
    folded = loose_key(text)
    by_rule = apply_rules(folded, TYPE_RULES, text)
    return F.when(folded == "", "").otherwise(
        F.coalesce(lookup(refrigerator_type(text), TYPE_NAMES), by_rule)
    )


_TRANSLATORS = {
    "sku_status": _sku_status,
    "discount_type": _discount_type,
    "delivery_availability": _delivery,
    "pick_up_availability": _pickup,
    "recommendation_intent": _recommendation,
    "ref_refrigerator_type": _refrigerator_type,
    "ldy_loading_type": loading_directions,
}


def translate_value(field: str, c: Column) -> Column:
    """Translate each ``;`` part, keep the first spelling of each, rejoin."""
    rule = _TRANSLATORS.get(field)
    parts = F.filter(
        F.transform(F.split(F.trim(as_text(c)), ";"), lambda p: F.trim(p)), lambda p: p != ""
    )
    if rule is not None:
        parts = F.transform(parts, rule)
    return F.array_join(F.array_distinct(F.filter(parts, lambda p: p != "")), "; ")


def translate_columns(df, fields=TRANSLATED_FIELDS, preserve: Column | None = None):
    """Translate the coded columns; ``preserve`` is an array of field names to skip."""
    changes = {}
    for field in fields:
        if field in df.columns:
            value = translate_value(field, F.col(field))
            if preserve is not None:
                keep = F.coalesce(F.array_contains(preserve, field), F.lit(False))
                value = F.when(keep, F.col(field)).otherwise(value)
            changes[field] = value
    return df.withColumns(changes)
