"""Which occurrences belong to a product line, and which pages are usable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.text import as_text, ascii_fold, key_text, present, squash
from vitrine.functions.validators import screen_digits

# Listing words of layout M.
M_TV_CATEGORIES = ("TVES", "TV4K", "ELIT", "TLED", "TVIA")
M_TV_PATH = r"(?i)/et/(?:tves|tv4k|elit|tled|tvia)(?:/|$)"
M_ACCESSORY_PATH = r"(?i)/et/(?:suar|sufx|cttv|easc|racm|rcpt|eace)(?:/|$)"
M_ACCESSORY_TITLE = (
    r"(?i)^\s*(?:suporte|controle\s+remoto|rack|painel|receptor|moldura|fixador|tubo\s+fixo|base|"
    r"cabo|pedestal)\b|\b(?:suporte\s+(?:tv|para\s+tv|de\s+tv)|controle\s+remoto|rack\s+para\s+tv|"
    r"painel\s+para\s+tv|moldura\s+samsung|fixador\s+suporte|base\s+para\s+tv)\b"
)
M_STRONG_TV_TITLE = (
    r"(?i)^\s*(?:smart\s+tv|tv|televisor)\b|"
    r"\b(?:smart\s+tv|google\s+tv|roku\s+tv|qled|oled|nanocell|crystal\s+uhd)\b"
)
M_TV_WORDS = r"(?i)\b(?:tv|smart|led|qled|oled|uhd|4k|8k|full\s*hd|google\s+tv|roku)\b"
M_REF_OUT = (
    r"(?i)\b(?:filtro|refil|prateleira|gaveta|puxador|borracha|termostato|organizador|adesivo|capa)\b"
)
M_REF_IN = (
    r"(?i)\b(?:geladeira|refrigerador(?:a)?|freezer|frigobar|side\s+by\s+side|frost\s+free|duplex)\b"
)
M_LDY_OUT = (
    r"(?i)\b(?:tanquinho|centrifuga|centr[ií]fuga|lava\s+jato|pe[çc]a|mangueira|filtro|suporte|capa|kit)\b"
)
M_LDY_IN = (
    r"(?i)\b(?:lavadora|lava\s+e\s+seca|secadora|m[aá]quina\s+de\s+lavar|maquina\s+de\s+lavar|washer)\b"
)

# Listing words of layout C (matched on the folded haystack).
C_REF_OUT = r"\b(?:filtro|refil|prateleira|gaveta|puxador|borracha|termostato|organizador)\b"
C_REF_IN = r"\b(?:geladeira|refrigerador(?:a)?|freezer|frigobar|side\s+by\s+side|frost\s+free|duplex)\b"
C_LDY_OUT = r"\b(?:lava[\s-]+loucas|mangueira|filtro|suporte|capa|sabao)\b"
C_LDY_IN = r"\b(?:maquina\s+de\s+lavar|lavadora|lava\s+e\s+seca|secadora|tanquinho)\b"
C_TV_OUT = (
    r"\b(?:suporte|rack|painel\s+home|home\s+suspenso|comod[ao]|instala\s*tv|"
    r"servico\s+de\s+instalacao|mesa|estante)\b"
)


def relevant_layout_m(title: Column, path: Column, category: Column, line: Column) -> Column:
    t, p = squash(title), as_text(path)
    hay = F.concat_ws(" ", t, squash(path))
    strong = t.rlike(M_STRONG_TV_TITLE) | (screen_digits(t).isNotNull() & t.rlike(M_TV_WORDS))
    tv = (
        F.when(t.rlike(M_ACCESSORY_TITLE), False)
        .when(F.upper(squash(category)).isin(*M_TV_CATEGORIES) | p.rlike(M_TV_PATH), True)
        .when(p.rlike(M_ACCESSORY_PATH) & ~strong, False)
        .otherwise(strong)
    )
    return (
        F.when(line == "REF", ~hay.rlike(M_REF_OUT) & hay.rlike(M_REF_IN))
        .when(line == "LDY", ~hay.rlike(M_LDY_OUT) & hay.rlike(M_LDY_IN))
        .otherwise(tv)
    )


def relevant_layout_c(title: Column, haystack: Column, categories: Column, line: Column) -> Column:
    """``haystack`` is title plus all category names, ``categories`` the names alone."""
    hay, key = key_text(haystack), key_text(title)
    panel_only = key.rlike(r"\bpainel\b") & ~key.rlike(r"\bsmart\s+tv\b|televisor")
    tv = ~(panel_only | key.rlike(C_TV_OUT)) & (
        squash(title).rlike(r"(?i)\b(?:smart\s*)?tv\b|televisor")
        | F.exists(categories, lambda n: squash(n).rlike(r"(?i)\bTV\b|televis"))
    )
    return (
        F.when(line == "REF", ~hay.rlike(C_REF_OUT) & hay.rlike(C_REF_IN))
        .when(line == "LDY", ~hay.rlike(C_LDY_OUT) & hay.rlike(C_LDY_IN))
        .when(line == "TV", tv)
        .otherwise(True)
    )


def similar_title_relevant(title: Column, line: Column) -> Column:
    low = F.lower(as_text(title))
    return (
        F.when(line == "REF", low.rlike(r"\b(?:geladeira|refrigerador|refrigeradora|freezer|frigobar)\b"))
        .when(line == "LDY", low.rlike(r"\b(?:lavadora|lava\s+e\s+seca|secadora|m[aá]quina\s+de\s+lavar)\b"))
        .otherwise(F.concat(F.lit(" "), low, F.lit(" ")).rlike(r" tv |smart tv|televisor"))
    )


def similar_titles(titles: Column, line: Column, limit: int | None = None) -> Column:
    """Distinct recommended titles of the same line; with ``limit``, the first ones."""
    kept = F.filter(titles, lambda t: present(t) & similar_title_relevant(t, line))
    distinct = F.array_distinct(kept)
    return distinct if limit is None else F.slice(distinct, 1, limit)


# ---- "product word before any accessory word" -----------------------------------------------

# Product words, accessory words, and phrases that rule a title out.
PRODUCT_WORDS = {
    "TV": r"(?:\bsmart\s*tv(?=\d|\b)|\btv(?=\d|\b)|\b(?:televisor|qled|oled|crystal uhd)\b)",
    "REF": r"\b(?:geladeira|refrigerador|refrigeradora|freezer|frigobar|cervejeira|adega|cooler|minibar)\b",
    "LDY": r"\b(?:lavadora|maquina de lavar|lava e seca|tanquinho|secadora)\b",
}
ACCESSORY_WORDS = {
    "TV": (
        r"\b(?:suportes?|capas?|(?:controles?|controlos?)(?:\s+remotos?)?|antenas?|(?:painel|paineis)|"
        r"racks?|bases?|(?:pedestal|pedestais)|placas?|pecas?|cabos?|conversor(?:es)?|adaptador(?:es)?|"
        r"fontes?|barras?\s+de\s+led|displays?|telas?\s+de\s+reposicao)\b"
        r"|\bcr\b(?=\s+(?:para\s+)?(?:smart\s+)?tv\b)"
    ),
    "REF": (
        r"\b(?:sensor(?:es)?|suportes?|prateleiras?|gavetas?|portas?|placas?|pecas?|organizador(?:es)?|"
        r"marmitas?|motor(?:es)?|bases?|pes?|carrinhos?|recipientes?|dobradicas?|almofadas?|"
        r"restaurador(?:es)?|termostatos?|compressor(?:es)?|filtros?|puxador(?:es)?|antivibracao|imas?|"
        r"cestos?|resistencias?|cabos?|ventoinhas?|valvulas?|termistor(?:es)?|painel\s+de\s+controle|"
        r"formas?(?:\s+bandeja)?(?:\s+de)?\s+gelo|buchas?|lampadas?|emblemas?|carro\s+para|reles?|"
        r"gaxetas?|tampas?|moto\s+ventilador|restaura\s+desempenho|unidade\s+refrigeradora)\b"
    ),
    "LDY": (
        r"\b(?:(?:painel|paineis)|placas?|tampas?|vidros?|(?:anel|aneis)|atuador(?:es)?|"
        r"interruptor(?:es)?|vedac(?:ao|oes)|tirantes?|travas?|capas?|suportes?|coletor(?:es)?|"
        r"desembaracador(?:es)?|rodinhas?|bases?|aparador(?:es)?|agitador(?:es)?|batedor(?:es)?|tubos?|"
        r"caixas?\s+mecanicas?|mecanismos?|motor(?:es)?|correias?|mangueiras?|filtros?|dispensers?|"
        r"puxador(?:es)?|almofadas?|limpador(?:es)?|refil|mop|pes?|guarnic(?:ao|oes)|tanque|"
        r"sensor\s+(?:termistor|temperatura)|ajustador(?:es)?|prateleiras?|polias?|valvulas?|portas?)\b"
    ),
}
NOT_PRODUCT = {
    "TV": (
        r"\btv\s+box\b|\b(?:smart\s+)?tv\s+stick\b|\bstick\s+(?:smart\s+)?tv\b|\bcontrole\s+r\s*tv\b"
    ),
    "LDY": (
        r"\b(?:(?:lava(?:r|dora)?)(?:\s+de)?|maquina\s+de\s+lavar)\s+loucas?\b"
        r"|lavadora(?:\s+de)?\s+(?:alta\s+)?pressao"
        r"|\b(?:secadora|lavadora)\s+de\s+cabelo\b|\bescova\s+secadora\b"
    ),
}
DISPLAY_PANEL_TITLE = (
    r"(?i)^\s*(?:painel|pain[eé]is)\s+(?:(?:mini\s+)?led|oled|qled|lcd|va|ips)"
    r"(?:\s+(?!(?:para|de|racks?|suportes?|parede|sala)\b)[\p{L}\p{N}]+){0,3}\s+"
    r"""\d{2,3}(?:[.,]\d+)?\s*(?:polegadas?|pol\.?|inches?|in|["”″]|'')?\s+(?:smart\s*)?tv\b"""
)


def _product_first(key: Column, line: str) -> Column:
    product = F.regexp_instr(key, F.lit(f"({PRODUCT_WORDS[line]})"))
    accessory = F.regexp_instr(key, F.lit(f"({ACCESSORY_WORDS[line]})"))
    return (product > 0) & ((accessory == 0) | (product < accessory))


def is_line_title(title: Column, line: str) -> Column:
    """The product word occurs before any accessory word."""
    text, key = squash(title), key_text(title)
    out = _product_first(key, line)
    if line == "TV":
        out = text.rlike(DISPLAY_PANEL_TITLE) | out
    if line in NOT_PRODUCT:
        out = ~key.rlike(NOT_PRODUCT[line]) & out
    return out


def is_product_title(title: Column, line: Column) -> Column:
    return (
        F.when(line == "TV", is_line_title(title, "TV"))
        .when(line == "REF", is_line_title(title, "REF"))
        .when(line == "LDY", is_line_title(title, "LDY"))
        .otherwise(True)
    )


def is_standalone_dryer(title: Column) -> Column:
    """A dryer with no washer word: capacity and loading stay blank by design."""
    key = key_text(title)
    return key.rlike(r"\bsecadora\b") & ~key.rlike(
        r"\b(?:lava\s+e\s+seca|lavadora|maquina\s+de\s+lavar|tanquinho)\b"
    )


# ---- page usability -------------------------------------------------------------------------

# Marker texts of refused pages, in order of report.
BLOCK_MARKERS = (
    "akamai-bot", "customdeny", 'error-code">403', "ops! algo deu errado", "oops",
    "nao e possivel acessar a pagina", "alguma coisa deu errado", "erro 403", "access denied",
    "captcha", "bot detection", "robot",
)


def blocked_reason(html: Column, status: Column) -> Column:
    """Why a stored page is unusable; '' when it carries a data island or no marker."""
    low = F.lower(ascii_fold(html))
    island = F.contains(low, F.lit("__next_data__")) & F.contains(low, F.lit("pageprops"))
    out = F.when(island, "").when(
        status.isin(401, 403, 429), F.concat(F.lit("status_"), status.cast("string"))
    )
    for marker in BLOCK_MARKERS:
        out = out.when(F.contains(low, F.lit(marker)), marker)
    return out.otherwise("")


def sku_status(layout: Column, flagged: Column, ad_label: Column, ad_seller: Column) -> Column:
    """Sponsored status; ``flagged`` is the layout's own sponsored flag or event list."""
    label = squash(ad_label)
    named = label.rlike(r"(?i)patrocinado|sponsored")
    on = F.coalesce(flagged, F.lit(False))
    layout_m = (
        F.when(on, F.when(label != "", label).otherwise("Patrocinado"))
        .when(named, label)
        .when(present(ad_seller), "Patrocinado")
        .otherwise("")
    )
    layout_c = F.when(on | named, "Sponsored").otherwise("")
    return F.when(layout == "M", layout_m).otherwise(layout_c)
