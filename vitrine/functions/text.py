"""Text normalisation.

Blank (NULL or only white space) is the engine's "missing" for text columns.
Rule functions elsewhere expect text that went through ``clean_text`` once at
the edge and use the cheaper ``squash`` inside.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

BAR = " ||| "


def lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def let(value: Column, fn) -> Column:
    """Bind a value once: ``fn`` may use it many times without evaluating it again.

    Top-level expressions get common subexpressions from code generation; inside a
    lambda nothing is shared, so rules there bind what they reuse.
    """
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def as_text(c: Column) -> Column:
    """NULL-free text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def squash(c: Column) -> Column:
    """Collapse every run of white space (NBSP included) and trim."""
    return F.trim(F.regexp_replace(as_text(c), r"(?U)\s+", " "))


def present(c: Column) -> Column:
    """True when the text holds something besides white space."""
    return F.coalesce(F.trim(c.cast("string")) != "", F.lit(False))


def blank(c: Column) -> Column:
    return ~present(c)


def null_if_blank(c: Column) -> Column:
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def first_present(*cols: Column) -> Column:
    """First non-blank text, '' when all are blank."""
    return F.coalesce(*[F.when(present(c), c.cast("string")) for c in cols], F.lit(""))


@lru_cache(maxsize=1)
def _fold_pairs() -> tuple[str, str]:
    """Letters whose compatibility decomposition is one base character."""
    src, dst = [], []
    for start, stop in ((0xA0, 0x250), (0x1E00, 0x1F00), (0x2070, 0x20A0), (0xFF01, 0xFF5F)):
        for code in range(start, stop):
            char = chr(code)
            base = "".join(
                x for x in unicodedata.normalize("NFKD", char) if not unicodedata.combining(x)
            )
            if len(base) == 1 and base != char:
                src.append(char)
                dst.append(base)
    return "".join(src), "".join(dst)


def fold_accents(c: Column) -> Column:
    """Strip accents; other characters stay."""
    src, dst = _fold_pairs()
    text = as_text(c)
    folded = F.regexp_replace(F.translate(text, src, dst), r"\p{Mn}", "")
    # pure ASCII needs no folding
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(folded)


def ascii_fold(c: Column) -> Column:
    """Strip accents, then drop whatever is still outside ASCII."""
    return F.regexp_replace(fold_accents(c), r"[^\x00-\x7F]", "")


def key_text(c: Column) -> Column:
    """Comparison key: folded, lower-case, runs of other characters as one space."""
    folded = F.lower(fold_accents(F.replace(as_text(c), F.lit("ß"), F.lit("ss"))))
    return F.trim(F.regexp_replace(folded, r"[^a-z0-9]+", " "))


def loose_key(c: Column) -> Column:
    """Folded, lower-case text that keeps punctuation (rule tables match on it)."""
    return F.trim(F.regexp_replace(F.lower(fold_accents(F.trim(as_text(c)))), r"(?U)\s+", " "))


# Names of character references come from Python's own table of the HTML5 standard. All that end in a semicolon are one
# text literal ("\0name=value\0..."), so that a plan holds one node for them; those that may stand without it are a pattern.
_NAMED = "\0" + "\0".join(f"{name[:-1]}={value}" for name, value in sorted(html5.items()) if name.endswith(";")) + "\0"
_BARE = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
_BARE_PATTERN = f"^({'|'.join(_BARE)})"
# what the standard puts in place of numbers 128 to 159: the characters of Windows-1252, where it has one
_C1 = "".join(bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160))
_NUMERIC = r"^#(?:[xX]([0-9A-Fa-f]+)|([0-9]+));?"


def _of_name(name: Column) -> Column:
    """Value of a name that ends in a semicolon, NULL if there is none."""
    key = F.concat(F.lit("\0"), name, F.lit("="))
    at = F.instr(F.lit(_NAMED), key)
    common = F.when(name == "amp", "&").when(name == "quot", '"').when(name == "lt", "<").when(name == "gt", ">").when(name == "nbsp", "\u00a0")
    return F.coalesce(common, F.when(at > 0, F.substring_index(F.substring(F.lit(_NAMED), at + F.length(key), F.lit(4)), "\0", 1)))


def _of_number(part: Column) -> Column:
    """Character of a decimal or hexadecimal reference at the start of a text."""
    hexadecimal = F.regexp_extract(part, _NUMERIC, 1)
    digits = F.regexp_replace(F.concat(hexadecimal, F.regexp_extract(part, _NUMERIC, 2)), "^0+(?=.)", "")
    code = F.when(F.length(digits) > 8, F.lit(0x7FFFFFFF).cast("long")).when(
        hexadecimal != "", F.conv(digits, 16, 10).cast("long")).otherwise(digits.cast("long"))

    def character(c: Column) -> Column:
        silent = (
            c.between(1, 8) | (c == 11) | c.between(14, 31) | (c == 127) | c.between(0xFDD0, 0xFDEF) | (c.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
        return (
            F.when((c == 0) | (c > 0x10FFFF) | c.between(0xD800, 0xDFFF), "\ufffd")
            .when(silent, "")
            .when(c.between(128, 159), F.substring(F.lit(_C1), (c - 127).cast("int"), F.lit(1)))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32")))

    return let(code, character)


def unescape_entities(c: Column) -> Column:
    """Resolve character references as HTML5 does, once and from left to right.

    A name without its semicolon counts if the standard has it so, the longest one that fits. Numbers 128 to 159 are read as
    Windows-1252, zero, surrogates and numbers that are no character become U+FFFD, and control characters and
    noncharacters vanish.  Texts without ``&`` are left as they are.
    """
    text = as_text(c)

    def resolved(part: Column) -> Column:
        whole = F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]*);", 1)
        # a name with its semicolon, else the longest that stands without one; none has itself and takes nothing
        names = F.array(F.struct(whole.alias("name"), F.lit(1).alias("more")), F.struct(F.regexp_extract(part, _BARE_PATTERN, 1).alias("name"), F.lit(0).alias("more")))
        found = F.filter(F.transform(F.filter(names, lambda n: n["name"] != ""), lambda n: F.struct(
            _of_name(n["name"]).alias("value"), (F.length(n["name"]) + n["more"]).alias("size"))), lambda n: n["value"].isNotNull())
        by_name = let(F.get(found, F.lit(0)), lambda x: F.coalesce(
            F.concat(x["value"], F.substring(part, x["size"] + 1, F.length(part))), F.concat(F.lit("&"), part)))
        return F.when(part.rlike(_NUMERIC), F.concat(_of_number(part), F.regexp_replace(part, _NUMERIC, ""))).otherwise(by_name)

    parts = F.split(text, "&", -1)
    joined = let(parts, lambda p: F.concat(F.get(p, F.lit(0)), F.array_join(F.transform(F.slice(p, 2, F.size(p)), resolved), "")))
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def clean_text(c: Column) -> Column:
    """Entities resolved, white space collapsed, trimmed."""
    return squash(unescape_entities(c))


def straight_quotes(c: Column) -> Column:
    return F.translate(c, "“”", '""')


def contains_any(c: Column, words) -> Column:
    """True when one of a short fixed list of fragments occurs."""
    out = F.lit(False)
    for word in words:
        out = out | F.contains(c, F.lit(word))
    return out


def lookup(c: Column, table: dict[str, str], default: Column | None = None) -> Column:
    """Constant map lookup for short fixed tables."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    hit = F.try_element_at(pairs, c)
    return hit if default is None else F.coalesce(hit, default)


def group1(c: Column, pattern: str, group: int = 1) -> Column:
    """Capture group or NULL when the pattern does not occur."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def distinct_join(values: Column, sep: str) -> Column:
    """Order-preserving distinct join of the non-blank values."""
    return F.array_join(F.array_distinct(F.filter(values, lambda v: present(v))), sep)


def trim_decimal(c: Column) -> Column:
    """Drop trailing zeros of a decimal text: 12.50 -> 12.5, 12.0 -> 12."""
    return F.when(
        F.contains(c, F.lit(".")), F.regexp_replace(F.regexp_replace(c, r"0+$", ""), r"\.$", "")
    ).otherwise(c)


# ---- text columns that carry lists ------------------------------------------------


def split_bar(c: Column) -> Column:
    return F.transform(F.split(c, r" \|\|\| "), lambda v: F.trim(v))


def _json_items(c: Column) -> Column:
    """JSON array, object or scalar as an array of texts; NULL for anything else."""
    doc = F.try_parse_json(c)
    items = F.try_variant_get(doc, "$", "array<variant>")
    one = F.array(doc)

    def shown(v: Column) -> Column:
        named = F.coalesce(*[
            F.nullif(F.try_variant_get(v, f"$.{k}", "string"), F.lit(""))
            for k in ("name", "title", "description", "text", "reviewBody", "summary")
        ])
        whole = F.when(~F.is_variant_null(v), F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))
        return F.trim(F.coalesce(named, whole, F.lit("")))

    return F.when(doc.isNotNull(), F.transform(F.coalesce(items, one), shown))


def as_list(c: Column) -> Column:
    """Barred text, JSON text or single text as an array without blanks."""
    text = F.trim(as_text(c))
    empty = F.array().cast("array<string>")
    out = (
        F.when(text == "", empty)
        .when(F.contains(text, F.lit(BAR)), split_bar(text))
        .when(text.rlike(r'^[\[{"0-9tfn-]'), F.coalesce(_json_items(text), F.array(text)))
        .otherwise(F.array(text))
    )
    return F.filter(out, lambda v: present(v))


# Fragments of site chrome that are not product names.
NOISE_FRAGMENTS = ("boas vindas", "entre ou cadastre", "cadastre-se", "digite seu cep", "atendimento")


def join_values(c: Column, drop_noise: bool = False) -> Column:
    values = as_list(c)
    if drop_noise:
        values = F.filter(values, lambda v: ~contains_any(F.lower(v), NOISE_FRAGMENTS))
    return F.array_join(values, BAR)


def join_reviews(values: Column) -> Column:
    """Number the non-empty review bodies of an array: ``review1 - ...``."""
    bodies = F.filter(
        F.transform(values, lambda v: F.trim(as_text(v))),
        lambda v: present(v) & ~v.rlike(r"(?i)^review\d+\s*-\s*$"),
    )
    numbered = F.transform(
        bodies, lambda v, i: F.concat(F.lit("review"), (i + 1).cast("string"), F.lit(" - "), v)
    )
    single = (F.size(bodies) == 1) & F.lower(F.try_element_at(bodies, F.lit(1))).startswith("review1 -")
    return F.when(single, F.element_at(bodies, 1)).otherwise(F.array_join(numbered, BAR))


def summary_text(c: Column) -> Column:
    """Joined summary, blank when it is a machine-made metrics line."""
    text = join_values(c)
    made = r"(?i)(?:^|\s\|\|\|\s)(?:Average rating|Star ratings|Comments):"
    return F.when(text.rlike(made), "").otherwise(text)


# ---- provenance tokens --------------------------------------------------------------


def tokens(c: Column) -> Column:
    return F.filter(F.split(as_text(c), r"\+"), lambda t: t != "")


def append_token(c: Column, token) -> Column:
    """Append-unique on a ``+``-joined token text."""
    return F.array_join(F.array_union(tokens(c), F.array(lit(token))), "+")


def replace_token_family(c: Column, prefix: str, token) -> Column:
    """Drop every token of a family (same prefix), then add one."""
    kept = F.filter(tokens(c), lambda t: ~t.startswith(prefix))
    return F.array_join(F.array_union(kept, F.array(lit(token))), "+")


def has_token(c: Column, token) -> Column:
    return F.array_contains(tokens(c), lit(token))


def has_token_prefix(c: Column, prefix: str) -> Column:
    return F.exists(tokens(c), lambda t: t.startswith(prefix))


def collapse_repeated_range(c: Column) -> Column:
    """``14-14`` -> ``14``; a real range stays."""
    return let(squash(c), _collapsed)


def _collapsed(text: Column) -> Column:
    parts = F.transform(F.split(text, r"\s*[-–—]\s*"), lambda p: F.trim(p))
    same = let(parts, lambda arr: (F.size(arr) >= 2) & F.forall(arr, lambda p: p != "") & (
        F.size(F.array_distinct(F.transform(arr, key_text))) == 1
    ))
    first = F.trim(F.regexp_extract(text, r"^(.*?)\s*[-–—]", 1))
    return F.when(text.rlike("[-–—]"), F.when(same, first).otherwise(text)).otherwise(text)


def model_year(c: Column) -> Column:
    """Largest 2010-2039 year token, '' when none occurs."""
    years = F.regexp_extract_all(as_text(c), F.lit(r"\b(20[1-3][0-9])\b"), F.lit(1))
    return F.coalesce(F.array_max(years), F.lit(""))


# Colour words a title may carry.
COLOUR_PATTERN = (
    r"(?i)\b(Inox|Black|Branca|Branco|Preta|Preto|Prata|Cinza|Grafite|Titanium|Tit[aâ]nio)\b"
)


def colour_word(c: Column) -> Column:
    return F.regexp_extract(as_text(c), COLOUR_PATTERN, 1)


# ---- words around a value -----------------------------------------------------------------


def words_before(before: Column, fillers: tuple[str, ...]) -> Column:
    """Words of the clause in front of a value, without fillers; the nearest one is the last.

    A clause ends at ``, ; | +`` or a line break.
    """
    clause = F.regexp_extract(before, r"([^,;|+\n]*)$", 1)
    return F.filter(F.split(key_text(clause), " "), lambda w: (w != "") & ~w.isin(*fillers))


def words_after(after: Column, fillers: tuple[str, ...]) -> Column:
    """Words of the clause behind a value, without fillers; none when a separator follows at once."""
    clause = F.regexp_extract(after, r"^\s*([^+;,|:\n]*)", 1)
    return F.filter(F.split(key_text(clause), " "), lambda w: (w != "") & ~w.isin(*fillers))


# ---- values of a text with their surroundings ---------------------------------------------


def cut_at(text: Column, pattern: str) -> Column:
    """A text cut once at its values: ``struct<words,gaps>``, value ``i`` standing between gaps ``i`` and ``i + 1``.

    ``pattern`` must not contain capturing groups.
    """
    return F.struct(
        F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)).alias("words"), F.split(text, pattern, -1).alias("gaps"))


def values_of(pieces: Column) -> Column:
    """Values of :func:`cut_at` as ``array<struct<at,word,gap,before,after>>``, ``at`` counting from 0.

    ``gap`` is the text since the value in front, ``before`` that text with that value, ``after`` the text up to the next
    value with that value.  Each text is copied a fixed number of times, so time grows with the text.
    """
    piece = lambda arr, i: as_text(F.get(arr, i))
    return let(pieces, lambda x: F.transform(x["words"], lambda w, i: F.struct(
        i.alias("at"), w.alias("word"), F.get(x["gaps"], i).alias("gap"),
        F.concat(piece(x["words"], i - 1), F.get(x["gaps"], i)).alias("before"),
        F.concat(F.get(x["gaps"], i + 1), piece(x["words"], i + 1)).alias("after"))))


def values_in(text: Column, pattern: str) -> Column:
    return values_of(cut_at(text, pattern))


def text_before(pieces: Column, at: Column, values: Column | int) -> Column:
    """Text in front of a value, back over as many values."""
    first = F.greatest(at - values, F.lit(0))
    parts = F.arrays_zip(F.slice(pieces["gaps"], first + 1, at - first).alias("gap"), F.slice(pieces["words"], first + 1, at - first).alias("word"))
    return F.concat(F.array_join(F.transform(parts, lambda p: F.concat(p["gap"], p["word"])), ""), F.get(pieces["gaps"], at))


def first_gap(pieces: Column, rule) -> Column:
    """Index of the first gap that ``rule`` accepts, NULL for none; a value of that index or behind has it in front."""
    found = F.array_position(F.transform(pieces["gaps"], lambda g: F.coalesce(rule(g), F.lit(False))), F.lit(True))
    return F.when(found > 0, found - 1)


def ends_with_sentence(text: Column) -> Column:
    """The text up to the end of its first sentence: a full stop, ``!`` or ``?`` in front of a capital letter."""
    return F.get(F.split(text, r"(?<=[.!?])\s+(?=\p{Lu})", 2), F.lit(0))


# ---- occurrences with their surroundings -------------------------------------------------


def starts(text: Column, term: str) -> Column:
    """Positions (from 1) of every occurrence of a plain term, left to right without overlap."""
    sizes = F.transform(F.split(text, f"\\Q{term}\\E", -1), lambda g: F.length(g))
    before = F.slice(sizes, 1, F.greatest(F.size(sizes) - 1, F.lit(0)))
    # running sums by positions: each start is the gaps before it and the terms between them
    placed = F.aggregate(
        before, F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("found")),
        lambda acc, n: F.struct((acc["at"] + n + len(term)).alias("at"), F.concat(acc["found"], F.array(acc["at"] + n)).alias("found")))
    return placed["found"]


def occurrences(text: Column, pattern: str, before: int = 1 << 20, after: int = 1 << 20) -> Column:
    """Every match as ``struct<word,start,stop,before,after>`` in source order.

    ``pattern`` must not contain capturing groups.  ``start`` counts from 1 and
    ``stop`` is the first position behind the match.
    """
    words = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    gaps = F.split(text, pattern, -1)
    pairs = F.transform(words, lambda w, i: F.struct(w.alias("w"), F.get(gaps, i).alias("g")))
    empty = F.array().cast("array<struct<word:string,start:int,stop:int>>")
    zero = F.struct(F.lit(1).alias("at"), empty.alias("items"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["g"])
        stop = start + F.length(p["w"])
        item = F.struct(p["w"].alias("word"), start.alias("start"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.concat(acc["items"], F.array(item)).alias("items"))

    placed = F.aggregate(pairs, zero, step, lambda acc: acc["items"])

    def dress(m: Column) -> Column:
        head = F.greatest(m["start"] - F.lit(before), F.lit(1))
        return F.struct(
            m["word"].alias("word"), m["start"].alias("start"), m["stop"].alias("stop"),
            F.substring(text, head, m["start"] - head).alias("before"),
            F.substring(text, m["stop"], F.lit(after)).alias("after"),
        )

    return F.transform(placed, dress)
