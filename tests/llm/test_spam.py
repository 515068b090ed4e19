import pytest
from pyspark.sql import functions as F

from almazara.llm import spam

PROSE = "Aunque los contadores quedaron pendientes, la carretera sigue siendo estable. El gobierno examinó prudentemente el marco jurídico sobre la conservación forestal. Cerca de Lemuranca, el taller sustituye a otro depósito. "
NAMES = "Votaron sí:\n" + "\n".join(f"Gal{a}riz Nel{b}gui, Pel{a}na" for a in ("de", "lo", "mi", "ta") for b in ("mu", "co", "ra", "si"))
HOURS = "Hora Precio\n" + "\n".join(f"{h:02d}:00 {40 + 7 * h % 90},{h:02d}" for h in range(24))
RECIPE = "Composición: povidona (10 mg), almidón (11 mg), gelatina (25 mg), talco (26 mg), lactosa (76 mg), sacarosa (76 mg). "
CITED = "\n".join(f"{i}.\nLos ensayos resultaron ilegibles por encima de lo previsto en la región.\nVéase https://archivo{i}.example/{i}." for i in range(1, 8))
CLEAN = [PROSE * 3, PROSE + NAMES, PROSE + HOURS, RECIPE + PROSE, CITED, "", "   \n ", "Una frase sola.", "x", "Título", PROSE + "\nVer más (https://a.example/x)"]

SPAM = [
    "\n".join(f"detector geiger, comprar | REF {i}7946 | €{i}48 | pack x{i}" for i in range(1, 6)),
    " ".join(f"#tasacióngratis #online_Lugar{i} #seguro_de_hogar" for i in range(9)),
    "\n".join(f"- Ver Sitio{i} (https://blog{i}.test/p/{i})" for i in range(8)) + "\n- Ir a Monares\n> Más Urdereda",
    "piso barato, préstamo rápido, piso barato, PISO BARATO, préstamo rápido, piso barato, préstamo rápido",
    "c.o.n.tador inteligente / medicámentos sin receta / contador  inteligente / medicamentos*sin*receta / contador inteligente​ / Medicamentos Sin Receta",
    "Mudanzas mudanzas y más mudanzas online. Con mudanzas ahorra en piso barato; pida mudanzas gratis. Mudanzas? piso barato! mudanzas online ya. Si busca mudanzas, nuestro piso barato es el mejor mudanzas oferta.",
    "gratis catastro online gratis en Calfalona. barato catastro online oferta en Zarbra. comprar catastro online gratis en Monares. oferta catastro online barato en Urdera.",
    '<a href="https://a.invalid/x">abogado herencias gratis</a> [detector geiger](tienda.example/) www.mon.example/ Mudanzas – blog.ros.test/nel',
]


@pytest.mark.parametrize("text", CLEAN)
def test_pages_left_alone(text):
    spammy, chars, *_ = spam.page_shapes(text)
    assert spammy <= 0.5 * chars


@pytest.mark.parametrize("text", SPAM)
def test_pages_flagged(text):
    spammy, chars, *_ = spam.page_shapes(text)
    assert spammy > 0.5 * chars


@pytest.mark.parametrize("text", SPAM[:4])
def test_share_decides(text):
    more = PROSE * (2 + 2 * len(text) // len(PROSE))
    spammy, chars, *_ = spam.page_shapes(more + "\n" + text)
    assert 0 < spammy <= 0.5 * chars
    spammy, chars, *_ = spam.page_shapes(PROSE + "\n" + "\n".join([text] * 6))
    assert spammy > 0.5 * chars


@pytest.mark.parametrize("text", ["A" + "a" * 300_000, "a-" * 150_000 + ".x", "." * 300_000, "<a " * 100_000 + ".com", "[" * 300_000 + "a.com", "[x](" * 80_000 + "a.com", "a.b" * 100_000, "Aa! " * 80_000, "a" + " " * 300_000 + "b", ":)" * 150_000, "http://" * 50_000, "#" * 300_000, "|" * 300_000])
def test_very_long_lines_take_no_long_time(text):
    import time

    started = time.perf_counter()
    spam.page_shapes(text)
    assert time.perf_counter() - started < 5


def test_frame(spark):
    data = [(1, SPAM[0]), (2, PROSE), (3, None), (4, ""), (5, SPAM[0]), (None, SPAM[0]), (6, "a" * 300_000), (7, SPAM[3] * 3000)]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("flagged", F.lit("clash")).withColumn("spam_chars", F.lit(1))
    out = {r.doc_id: r for r in spam.page_scores(df).collect()}
    assert {i for i, r in out.items() if r.flagged} == {1, 5, 7} and len(out) == 7 and out[3].text_chars == 0
    assert spam.page_scores(df.limit(0)).count() == 0


def test_few_shapes_must_hold_the_share():
    repeated = "\n".join(f"detector geiger, comprar | REF {i}7946 | €{i}48 | pack x{i}" for i in range(12))
    spammy, chars, shapes, largest = spam.page_shapes(repeated)
    assert spammy == chars and shapes == 1 and largest.startswith("tag/")
    # The same kind of units in ever new shapes: none of them repeats enough.
    marks = [",", ";", "/", "·", "•", "|"]
    various = []
    for i, m in enumerate(marks):
        for word in ("aviso", "AVISO"):
            for extra in (3, 9):
                various.append(f" {m} ".join([word, "barato", *["oferta"] * extra]) + f" {m}")
    spammy, chars, shapes, _ = spam.page_shapes("\n".join(various))
    assert shapes > 2 * spam.FEW_SHAPES and spammy <= 0.5 * chars
