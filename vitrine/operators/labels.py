"""Label dictionaries: which field a labelled value speaks for, and how much it counts.

The dictionaries are data; pass your own DataFrame with the same columns to extend
them.  They are a few hundred rows at most, so Spark broadcasts them by their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Labels of both layouts (comparison-key form), grouped by meaning.
ENERGY_WORDS = (
    "consumo maximo", "consumo energetico", "consumo medio", "consumo medio w", "consumo w",
    "consumo de energia w", "consumo kwh", "consumo em standby", "consumo no modo de espera",
    "consumo de energia agua fria", "consumo de energia agua quente",
)
REF_LIQUID_TOTAL = ("capacidade liquida total", "capacidade total liquida")
REF_STORAGE_TOTAL = ("capacidade de armazenagem total l", "capacidade de armazenagem total")
REF_PLAIN_TOTAL = ("capacidade total", "capacidade total de", "capacidade l", "capacidades")
REF_FRIDGE = (
    "capacidade do refrigerador l", "capacidade do refrigerador", "capacidade liquida do refrigerador",
    "capacidade de armazenagem do refrigerador", "capacidade de armazenagem do refrigerador l",
    "capacidade da geladeira",
)
REF_FREEZER = (
    "capacidade do freezer l", "capacidade do freezer", "capacidade liquida do freezer",
    "capacidade de armazenagem do freezer", "capacidade de armazenagem do freezer l",
    "capacidade do congelador", "capacidade do congelador l", "capacidade de armazenagem do congelador",
    "capacidade de armazenagem do congelador l",
)
OPENING_WORDS = ("abertura da tampa", "abertura", "tipo de abertura", "tipo de carga", "tipo")

LABELS = {
    "M": (
        ("screen_size", 10, "screen", ("polegada", "polegadas", "tamanho da tela")),
        ("estimated_annual_electricity_use", 10, "energy", ("consumo aproximado de energia",)),
        ("estimated_annual_electricity_use", 20, "energy", ENERGY_WORDS + (
            "consumo de energia em funcionamento", "consumo de energia", "consumo mensal de energia", "consumo")),
        ("ref_capacity", 10, "volume", REF_LIQUID_TOTAL),
        ("ref_capacity", 20, "volume", REF_STORAGE_TOTAL + REF_PLAIN_TOTAL),
        ("ref_capacity", 30, "volume", ("capacidade",)),
        ("ref_capacity", 40, "volume", REF_FRIDGE + ("capacidade refrigerador", "capacidade geladeira")),
        ("ref_capacity", 50, "volume", REF_FREEZER + ("capacidade freezer", "capacidade congelador")),
        ("ldy_capacity", 10, "mass", (
            "capacidade de lavagem", "capacidade de lavagem kg", "capacidade kg de roupas")),
        ("ldy_capacity", 20, "mass", (
            "capacidade kg", "capacidade maxima de lavagem", "capacidade para", "capacidade de lavar",
            "capacidade da maquina de lavar", "capacidade de roupa seca", "capacidade total", "capacidade")),
        ("ldy_loading_type", 10, "loading", ("acesso ao cesto",)),
        ("ldy_loading_type", 20, "loading", OPENING_WORDS + (
            "tipo de abertura eletrodomestico", "tipo de abertura do eletrodomestico")),
        ("ref_refrigerator_type", 10, "door", ("porta", "portas", "tipo", "tipo de porta")),
        ("ref_refrigerator_type", 90, "door_count", ("quantidade de portas", "numero de portas")),
        ("ldy_color", 10, "text", ("cor", "cor do produto")),
        ("model_year", 10, "text", ("ano de lancamento", "ano do modelo")),
        ("reference", 10, "text", ("referencia",)),
        ("model", 10, "text", ("modelo",)),
    ),
    "C": (
        ("screen_size", 10, "screen", ("tamanho da tela",)),
        ("estimated_annual_electricity_use", 10, "energy", ("consumo de energia",)),
        ("estimated_annual_electricity_use", 20, "energy", ENERGY_WORDS + (
            "consumo aproximado de energia", "consumo com tv ligada")),
        ("ref_capacity", 10, "volume", REF_LIQUID_TOTAL),
        ("ref_capacity", 20, "volume", REF_STORAGE_TOTAL),
        ("ref_capacity", 21, "volume", REF_PLAIN_TOTAL),
        ("ref_capacity", 30, "volume", ("capacidade",)),
        ("ref_capacity", 40, "volume", REF_FRIDGE),
        ("ref_capacity", 50, "volume", REF_FREEZER),
        ("ldy_capacity", 10, "mass", ("capacidade kg de roupas",)),
        ("ldy_capacity", 20, "mass", (
            "capacidade de lavagem", "capacidade de lavagem kg", "capacidade maxima de lavagem",
            "capacidade total", "capacidade de lavar", "capacidade de roupa seca", "capacidade de roupas",
            "capacidade kg", "capacidade")),
        ("ldy_loading_type", 10, "loading", ("acesso ao cesto",)),
        ("ldy_loading_type", 20, "loading", OPENING_WORDS),
        ("ref_refrigerator_type", 10, "door", ("quantidade de portas",)),
        ("ldy_color", 10, "text", ("cor", "cor do produto")),
        ("model_year", 10, "text", ("ano de lancamento",)),
        ("reference", 10, "text", ("modelo", "modelos", "referencia", "ref", "codigo do modelo")),
        ("model", 10, "text", ("modelo",)),
    ),
}
SCHEMA = "label_key string, field string, level int, rule string"


def label_rows(layout: str) -> list[tuple]:
    return [(label, field, level, rule) for field, level, rule, labels in LABELS[layout] for label in labels]


def label_dictionary(spark: SparkSession, layout: str) -> DataFrame:
    return spark.createDataFrame(label_rows(layout), SCHEMA)


def labels_of(layout: str, field: str, level: int) -> tuple:
    return tuple(l for l, f, lv, _ in label_rows(layout) if f == field and lv == level)
