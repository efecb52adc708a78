"""Hand-written rows for the text, money, URL and value rules."""

from pyspark.sql import functions as F

from vitrine.functions import measures as S
from vitrine.functions import metrics as X
from vitrine.functions import models as D
from vitrine.functions import money as M
from vitrine.functions import text as T
from vitrine.functions import translate as R
from vitrine.functions import urls as U
from vitrine.functions import validators as V
from vitrine.operators import relevance as RL


def test_entities(value):
    assert value(T.clean_text, "a&amp;lt;b", "&#39;x&#x41; &eacute;  y", "a &unknown; b", None) == [
        "a&lt;b", "'xA é y", "a &unknown; b", ""]


def test_keys(value):
    assert value(T.key_text, "Máquina  de-Lavar 10KG", "Straße", " º ") == ["maquina de lavar 10kg", "strasse", "o"]
    assert value(T.ascii_fold, "Ção €") == ["Cao "]


def test_lists(value):
    joined = lambda c: F.array_join(T.as_list(c), "|")
    assert value(joined, "a ||| b", '["x",{"name":"y"},null]', "plain", "", '"q"', "[broken") == [
        "a|b", "x|y", "plain", "", "q", "[broken"]
    reviews = lambda c: T.join_reviews(T.as_list(c))
    assert value(reviews, '["a","review2 - ","b"]', "review1 - kept") == ["review1 - a ||| review2 - b", "review1 - kept"]


def test_tokens(value):
    assert value(lambda c: T.append_token(c, "x"), "a+x", "a", "", None) == ["a+x", "a+x", "x", "x"]
    assert value(lambda c: T.replace_token_family(c, "m_", "m_new"), "a+m_old+b") == ["a+b+m_new"]


def test_urls(value):
    assert value(U.normalized_url, "HTTPS://Shop.EX/a/?utm_source=x&q=a b&k#f", "", "//x/y/", "http://h?a=1&utm_x=2") == [
        "https://shop.ex/a?q=a+b&k=", "", "//x/y", "http://h?a=1"]
    assert value(U.item_from_url, "https://x/p/9/p/8", "https://x/p") == ["9", ""]
    assert value(U.sku_from_url, "https://x/a/p/77/?z", "https://x/a?produto=5&b=1", "nothing") == ["77", "5", ""]
    key = lambda c: U.url_item_key(c, F.lit(""), ["shop.ex"])
    assert value(key, "https://www.shop.ex/a/p/AB/", "https://shop.ex.evil/a/p/AB/", "https://shop.ex:443/p/x") == ["ab", "", "x"]


def test_money(value):
    assert value(M.format_brl, "1234567.5", "0", "sob consulta", "", "10,5") == [
        "R$1.234.567,50", "R$0,00", "sob consulta", "", "R$10,50"]
    half = lambda c: M.discount_percent(F.split(c, "/")[0], F.split(c, "/")[1])
    # ties go to the even percent
    assert value(half, "200/195", "200/193", "200/0", "100/100", "x/1") == [2, 4, None, None, None]
    rate = lambda c: M.offer_discount_rate(F.split(c, "/")[0], F.split(c, "/")[1], F.split(c, "/")[2])
    assert value(rate, "-12.5/1/1", "0.4/100/50", "/200/195", "/100/99.5", "/100/98.5") == [13, None, 3, None, 2]
    assert value(lambda c: M.savings_for_output(c, F.lit("C")), "5,5%", "baixou 3% hoje", "x") == ["Baixou 5.5%", "Baixou 3%", "x"]


def test_metrics(value):
    assert value(X.star_rating, "4,55", "5.0", "nan", "bom", None) == ["4.6", "5", "0", "bom", "0"]
    assert value(X.count_metric, "1.234", "1.234,5", "12.5", "", "abc", "(7)") == ["1234", "1234.5", "12.5", "0", "0", "7"]
    assert value(X.zero_preserving, "0,0", "4.50", "1234567", "x") == ["0", "4.5", "1.23457e+06", "x"]
    assert value(X.energy_class, "12 kWh", "(100 W)", "5", "bivolt", "") == ["kWh", "W", "number_only", "other", "blank"]


def test_translation(value):
    tr = lambda field: lambda c: R.translate_value(field, c)
    assert value(tr("delivery_availability"), "Agendada a partir de sábado, 3 de março", "Receba na loja", "Frete grátis; Frete grátis") == [
        "Scheduled from Saturday, March 3", "Receive na loja", "Free shipping"]
    assert value(tr("ref_refrigerator_type"), "Duplex 2 portas", "90 cm", "Portátil", "3 portas") == [
        "Freezer-on-Top", "", "Portátil", "Three Door"]
    assert value(tr("recommendation_intent"), "97,8% dos clientes recomendam esse produto") == ["97% recommend this product"]


def test_loading_negation(value):
    assert value(V.loading_directions, "sem abertura frontal, carga superior", "painel frontal", "não possui front load",
                 "não tem frontal mas superior", "Top Load e Front Load") == [
        "Top load", "", "", "Top load", "Top load,Front load"]


def test_capacity_values(value):
    flag = lambda f: lambda c: f(c).cast("int")
    assert value(flag(V.is_refrigerator_capacity), "300 litros", "12 garrafas", "127 V", "sim", "80 kg") == [1, 0, 0, 0, 0]
    assert value(flag(V.is_screen_size), '55"', "8", "50 a 60", "1920x1080", "120 cm", "100%") == [1, 0, 0, 0, 0, 0]
    assert value(flag(V.is_capacity_band), "de 300 a 400 litros", "até 260 litros", "acima de 400 L", "300 litros") == [1, 0, 1, 0]
    assert value(flag(V.is_energy_use), "45 kWh/mês", "classe A", "bivolt 220V", "baixo consumo", "consumo de água 3 L") == [1, 0, 0, 1, 0]


def test_distinct_measurements(value):
    joined = lambda c: S.join_measurements(F.split(c, "#"))
    assert value(joined, "14#14 kg#14 lbs", "14 kg#14", "53 Quartos#53L", "55#55 polegadas", "14-14", "até 300#300") == [
        "14,14 lbs", "14 kg", "53 Quartos,53L", "55", "14", "até 300,300"]


def test_components(value):
    shown = lambda c: F.array_join(F.transform(S.capacity_components(c), lambda p: F.concat(p["kind"], F.lit("="), p["raw"])), "#")
    assert value(shown, "Freezer: 84 L; Refrigerador: 305 L", "394 L de capacidade total e 90 litros de freezer",
                 "geladeira com reservatório de água de 3 litros", "nada") == [
        "freezer=84 L#refrigerator=305 L", "total=394 L#freezer=90 litros", "", ""]


def test_title_sizes(value):
    assert value(S.title_screen_size, 'Smart TV 55" 4K', "Suporte para TV de 32 polegadas", "TV 50 polegadas ou 55 polegadas",
                 "Google TV 55 4K", "Painel para TV 60\"", "Smart TV LED 43 UHD 60 Hz") == ['55"', "", "", '55"', "", '43"']
    assert value(S.exact_title_mass, "Lava e Seca 11kg/7kg", "Lavadora 12kg/8kg", "Lavadora 12 kg peso 40 kg",
                 "Lavadora até 9 kg", "Lavadora 9 kg 10 kg") == ["11kg", "", "12 kg", "", ""]


def test_washer_walk(spark):
    rows = spark.createDataFrame([
        (1, [(1, "0,5"), (2, "12 kg")]), (2, [(1, "10 a 12 kg"), (2, "11 kg")]), (3, [(1, "0,5"), (1, "0,5 kg")]),
        (4, [(1, "de 8 a 9 kg")]), (5, [(1, "12 kg"), (1, "12")]),
    ], "i int, ev array<struct<level:int,raw:string>>")
    out = [r.v for r in rows.select("i", S.washer_choice(F.col("ev")).alias("v")).orderBy("i").collect()]
    assert out == ["12 kg", "11 kg", "0,5", "de 8 a 9 kg", "12 kg"]


def test_energy_texts(value):
    label = lambda c: S.labelled_energy(S.energy_text(c))
    assert value(label, "130 W, Voltagem: 220V", "bivolt", "Classe A", "12 litros", "100", "Motor 500 W") == [
        "130 W", "", "", "", "100", ""]


def test_models(value):
    assert value(lambda c: D.strict_tv_model(c, F.lit("")), "Smart TV 50 polegadas UN50TU8000 4K", "Suporte TV 50 polegadas UN50TU8000",
                 "TV 50 polegadas UN50A1 QN50B2", "TV UN50TU8000") == ["UN50TU8000", "", "", ""]
    flag = lambda f: lambda c: f(c).cast("int")
    assert value(flag(D.is_spec_token), "12,5KG", "127/220V", "10X20X30CM", "220V60HZ", "BRM44") == [1, 1, 1, 1, 0]
    assert value(flag(D.is_valid_washer_sku), "LWA12", "12KG", "TURBO-12", "ABC220V", "ww11t") == [1, 0, 0, 0, 1]
    assert value(D.tv_listing_model, "Smart TV 4K HDR10 AB-12 X1", "sem modelo", "TV-50 QN90") == ["AB-12", "", "QN90"]


def test_title_classes(value):
    flag = lambda line: lambda c: RL.is_line_title(c, line).cast("int")
    assert value(flag("TV"), "Smart TV 50", "Suporte para TV", "TV Box 4K", "Painel LED 50 polegadas Smart TV") == [1, 0, 0, 1]
    assert value(flag("REF"), "Geladeira com prateleira", "Prateleira de geladeira", "Fogão") == [1, 0, 0]
    assert value(flag("LDY"), "Lavadora de louças", "Máquina de lavar com tampa", "Escova secadora") == [0, 1, 0]


def test_loading_clauses(value):
    texts = {
        "Superior": "Top load", "Front-Load": "Front load", "sem abertura frontal": "", "nao e uma maquina de lavar frontal": "",
        "nao e Front Load, mas Front Load": "Front load", "Nao possui abertura frontal e tem carga superior": "Top load",
        "nao frontal e superior": "", "nao frontal e sim superior": "Top load", "painel frontal": "", "Frontal ou superior": "Front load,Top load",
    }
    assert value(V.loading_directions, *texts) == list(texts.values())


def test_water_is_no_capacity(value):
    from pyspark.sql import functions as F

    words = lambda c: F.array_join(F.transform(S.volumes(c), lambda m: m["word"]), ",")
    texts = {
        "Geladeira com Dispenser de Agua 2,5L": "", "Geladeira com Reservatorio 3L para Agua": "", "Geladeira com tanque 5L": "",
        "Geladeira 400L com Dispenser de Agua 2,5L": "400L", "Geladeira 400L com Dispenser 2,5L de Agua": "400L",
    }
    assert value(words, *texts) == list(texts.values())
    parts = lambda c: F.array_join(F.transform(S.capacity_components(c), lambda p: F.concat(p["kind"], F.lit("="), p["raw"])), ",")
    texts = {"Tanque de agua da geladeira:5L": "", "Capacidade do Refrigerador:305L; Freezer:84L": "refrigerator=305L,freezer=84L"}
    assert value(parts, *texts) == list(texts.values())


def test_quantities_and_features_are_no_models(value):
    texts = {"400L": False, "220 V": False, "3PORTAS": False, "PORTAS2": False, "FROSTFREE": False, "BRM54": True, "AB1": False, "RT38K": True}
    assert value(D.is_valid_refrigerator_sku, *texts) == list(texts.values())
