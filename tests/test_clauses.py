"""Values decided by their clause: far labels, many values, statements of any length."""

import time

import pytest
from pyspark.sql import functions as F

from vitrine.functions import measures as S
from vitrine.functions import text as T

FAR = "cinza com acabamento escovado e cantos arredondados " * 8


def joined(fn):
    return lambda c: F.array_join(fn(c), "#")


def test_values_keep_their_neighbours(value):
    shown = lambda c: F.array_join(F.transform(T.values_in(c, r"\d+"), lambda m: F.concat_ws("/", m["before"], m["word"], m["after"])), "#")
    assert value(shown, "a1b22c", "7", "", "x") == ["a/1/b22#1b/22/c", "/7/", "", ""]
    assert value(lambda c: T.ends_with_sentence(c), "Um. Dois", "aprox. 5 W", "1.5 W", "") == ["Um.", "aprox. 5 W", "1.5 W", ""]


def test_a_holder_far_in_front_owns_the_size(value):
    texts = {
        f"Painel {FAR}para sala de TV 50 polegadas": "", f"Suporte {FAR}para TV 50 polegadas": "", f'Smart TV {FAR}50"': '50"',
        f"Smart TV {FAR}50 4K": '50"', "Painel LED Smart TV 50 polegadas": "50 polegadas", "Painel para sala LED 50 polegadas": "",
        "Suporte 32\" 40\" 50\"": "", "Roku TV 55 Full HD": '55"', "Roku TV 55 lindo": "", "Smart TV 55\" HDMI 20": '55"',
        "Smart TV entre 50 e 55 polegadas": "", "Smart TV 50 a 55 polegadas": "", "TV 55 polegadas no máximo": "",
    }
    assert value(S.title_screen_size, *texts) == list(texts.values())


def test_statements_of_energy(value):
    texts = {
        f"Consumo {FAR}: 30 kWh": "30 kWh", f"Consumo: 30 kWh {FAR}": f"30 kWh {FAR.strip()}", "Consumo - 30 kWh - eco": "30 kWh",
        "Consumo em stand-by: 0,5 W; Consumo: 45 kWh/mês": "0,5 W#45 kWh/mês", "Consumo (kWh/mês) 45": "45",
        "Consumo: 45 kWh/mês - Consumo em stand by: 1 W": "45 kWh/mês#1 W", "Consumo (aprox.) ideal (30 kWh)": "30 kWh",
        "Consumo de água: 30 L": "", "Consumo reduzido. Tela: 50": "", "Consumo do motor 500 W": "", "Baixo consumo de energia": "Baixo consumo de energia",
        "Consumo 30 kWh, stand by 2 W": "30 kWh#2 W", "": "",
    }
    assert value(joined(S.description_energy), *texts) == list(texts.values())
    assert value(S.trim_energy, "130 W, Voltagem: 220V", "100 Peso: 3", "Motor 500 W Cor: x", "5 W") == ["130 W", "100", "Motor 500 W", "5 W"]


def test_a_total_far_behind_its_list(value):
    texts = {
        f"Capacidade líquida: freezer 90 {FAR} Total: 400 litros": "400 litros",
        f"Capacidade líquida freezer 90 Capacidade bruta {FAR} total: 420 litros": "",
    }
    found = lambda c: F.array_join(F.filter(S.phrase_capacities(c, "liquid_total"), lambda v: F.contains(v, F.lit("litros"))), "#")
    assert value(found, *texts) == list(texts.values())


def test_qualified_and_drying_masses(value):
    texts = {
        "Lavadora 12kg aproximadamente": "", "Lavadora cerca de 12kg": "", "Lavadora 10 a 12kg": "", "Lavadora 12kg": "12kg",
        "Lavadora 12kg mais ou menos": "", f"Lava e Seca {FAR}lava 11kg e seca 7kg": "11kg", "Lavadora de 12kg no maximo": "",
    }
    assert value(S.exact_title_mass, *texts) == list(texts.values())


RULES = {
    "screen": (S.title_screen_size, 'Smart TV 50" tela 50 4K '), "mass": (S.exact_title_mass, "Lava e Seca lava 11kg e seca 7kg "),
    "volumes": (lambda c: F.size(S.volumes(c)), "geladeira 400 L com água 2 L "), "energy": (joined(S.description_energy), "consumo medio 30 kWh "),
    "labels": (joined(S.description_energy), "consumo: 30 kWh cor x; "), "words": (joined(S.description_energy), "consumo "),
    "total": (joined(lambda c: S.phrase_capacities(c, "liquid_total")), "capacidade líquida 90 "), "trim": (S.trim_energy, "30 kWh motor "),
}


@pytest.mark.parametrize("name", RULES)
def test_time_grows_with_the_text(spark, name):
    """Ten times the values take about ten times the time (a quadratic rule a hundred times)."""
    rule, unit = RULES[name]

    def seconds(n: int) -> float:
        rows = spark.createDataFrame([(unit * n,)], "t string").select(rule(F.col("t")).alias("v"))
        rows.collect()
        start = time.perf_counter()
        rows.collect()
        return time.perf_counter() - start

    small, large = seconds(300), seconds(3000)
    assert large < 25 * small + 2, (name, small, large)
    print(name, round(small, 2), round(large, 2))
