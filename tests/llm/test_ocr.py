import random

import pytest
from pyspark.sql import functions as F

from almazara.llm import ocr

WORDS = "el gobierno examinó prudentemente marco jurídico-económico sobre la conservación forestal los investigadores públicos necesitan financiación estable durante semestre anterior cuando recursos resultan insuficientes consejería publicó documentación justificativa nadie duda de que mercado acompaña a otra ribera hemeroteca municipal autónomos reclaman inversiones concretas desde hace veinte meses provincia torno tomo".split()
NOISE = [("e", "c"), ("i", "!"), ("r", "f"), ("a", "@"), ("o", "0"), ("s", "5"), ("c", "e"), ("m", "rn"), ("l", "1"), ("d", "cl"), ("u", "ii"), ("t", "i"), ("ó", "6"), ("b", "6"), ("h", "li"), ("fi", "ﬁ"), ("í", "l"), ("ñ", "n~")]


def scan(rng, sentences, page):
    """A scanned speech and its true cases."""
    truth, lines, line = set(), [], ""
    words = [w for s in sentences for w in s]
    for k, w in enumerate(words):
        shown = w
        if rng.random() < 0.04 and len(w) > 4:
            a, b = rng.choice([p for p in NOISE if p[0] in w] or [("", "")])
            if a:
                at = rng.choice([i for i in range(len(w)) if w.startswith(a, i)])
                shown = w[:at] + b + w[at + len(a) :]
                truth.add(("char", w))
        if len(line) + len(shown) > 60:
            if len(shown) > 6 and rng.random() < 0.5 and "-" not in shown and not set(shown) & set("@!~0156ﬁ"):
                cut = rng.randrange(3, len(shown) - 2)
                lines.append(line + " " + shown[:cut] + rng.choice("-­¬") + rng.choice(["", " "]))
                truth.add(("join", w))
                line = shown[cut:]
                continue
            lines.append(line)
            line = shown
        else:
            line = (line + " " + shown).strip()
        if len(lines) % 9 == 8 and not lines[-1].startswith(("Diario", "—")) and rng.random() < 0.5:
            for f in ("Diario de la Cámara", f"— {page} —"):
                lines.append(f)
                truth.add(("furniture", f))
            page += 1
    lines.append(line + ".")
    return "\n".join(lines), truth


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    data, truth = [], {}
    for i in range(300):
        text, cases = scan(rng, [[rng.choice(WORDS) for _ in range(12)] for _ in range(10)], i)
        data.append((i, text))
        truth[i] = cases
    return data, truth


def test_accuracy_on_noise_of_our_own(spark, corpus):
    data, truth = corpus
    df = spark.createDataFrame(data + [(900, None), (901, ""), (902, "  \n "), (903, "una frase limpia."), (None, "otra frase limpia.")], "intervention_id int, speech_text string").withColumn("words", F.lit("clash")).withColumn("kind", F.lit(1))
    found = {(r.intervention_id, r.kind, r.fix) for r in ocr.find_repairs(df).select("intervention_id", "kind", "fix").collect()}
    true = {(i, k, f) for i, cases in truth.items() for k, f in cases}
    for kind in ("join", "char", "furniture"):
        a, b = {x for x in found if x[1] == kind}, {x for x in true if x[1] == kind}
        assert len(a & b) >= 0.95 * len(b), (kind, "recall", sorted(b - a)[:9])
        assert len(a & b) >= 0.95 * len(a), (kind, "precision", sorted(a - b)[:9])
    fixed = {r.intervention_id: r.repaired_text for r in ocr.repair_texts(df).collect()}
    assert len(fixed) == 305 and fixed[900] is None and fixed[903] == "una frase limpia." and "Diario" not in fixed[0] and "\n" not in fixed[0]


def test_empty(spark):
    df = spark.createDataFrame([], "intervention_id int, speech_text string")
    assert ocr.find_repairs(df).count() == 0 and ocr.repair_texts(df).count() == 0


@pytest.mark.parametrize("seen,right", [("favorablcmente", "favorablemente"), ("autónornos", "autónomos"), ("mediaclos", "mediados"), ("reqiiieren", "requieren"), ("liasta", "hasta"), ("conﬁrman", "confirman"), ("oton~o", "otoño"), ("documentaci6n", "documentación"), ("a6astece", "abastece"), ("físico-qulmica", "físico-química"), ("c@ud@l", "caudal")])
def test_plausible_edits(seen, right):
    assert ocr.skeleton(seen) == ocr.skeleton(right) and ocr.edit_cost(seen, right) >= 1


@pytest.mark.parametrize("a,b", [("que", "qué"), ("publico", "publicó"), ("casa", "mesa"), ("si", "sí")])
def test_other_words_stay(a, b):
    assert ocr.edit_cost(a, b) is None


@pytest.mark.parametrize("text", ["a" * 300_000, "a\n" * 100_000, "a-\n" * 50_000, "a-" * 150_000 + "\nb", " " * 300_000 + "\nx", "5\n" * 50_000, "@!" * 100_000])
def test_very_long_texts_take_no_long_time(text):
    import time

    started = time.perf_counter()
    ocr.reflow(text, {}, set())
    assert time.perf_counter() - started < 5


def test_page_break_in_mid_sentence_and_decoys():
    shapes = {ocr.shape_key("— 26 —"), ocr.shape_key("Diario de la Cámara de Valdoria")}
    text = "Como el taller depende de otro alma-\n\n— 27 —\nDiario de la Cámara de Valdoria\n\ncén, si\n\n— 28 —\n\nlos envases llegan.\n\nPunto 5 del orden del día.\n"
    lines, paragraphs = ocr.read_page(text, shapes)
    assert lines == ["— 27 —", "Diario de la Cámara de Valdoria", "— 28 —"] and [t for p in paragraphs for t in p if "\x1f" in t] == ["alma\x1fcén,"]
    assert len(paragraphs) == 2 and paragraphs[1] == ["Punto", "5", "del", "orden", "del", "día."]
    assert ocr.reflow(text, {"alma\x1fcén": "almacén"}, set(lines)).startswith("Como el taller depende de otro almacén, si los envases llegan.")


def test_each_occurrence_takes_its_own_context(spark, monkeypatch):
    import numpy as np

    axes = {"agua": 0, "barro": 0, "lodo": 0, "gente": 1, "siempre": 1, "todo": 1}
    monkeypatch.setattr(ocr, "learn_vectors", lambda *_: ocr.Vectors(list(axes), np.eye(2)[list(axes.values())]))
    far = "nadie " * 10
    texts = ["gente todo siempre"] * 40 + ["agua lodo barro"] * 10 + [f"agua 1odo barro {far}gente 1odo siempre", "gente gente lo-\ndo siempre siempre"]
    df = spark.createDataFrame(list(enumerate(texts)), "intervention_id int, speech_text string")
    found = {(r.intervention_id, r.kind, r.fix) for r in ocr.find_repairs(df).collect()}
    assert found == {(50, "char", "lodo"), (50, "char", "todo"), (51, "join", "todo"), (51, "char", "todo")}
    fixed = {r.intervention_id: r.repaired_text for r in ocr.repair_texts(df).collect()}
    assert fixed[50] == f"agua lodo barro {far}gente todo siempre" and fixed[51] == "gente gente todo siempre siempre" and fixed[45] == texts[45]


def test_vectors_decide(spark, monkeypatch):
    rng = random.Random(2)
    wet, people = "agua barro charco río lluvia orilla pantano cieno".split(), "gente siempre vecinos plaza fiesta calle pueblo mercado".split()
    texts = []
    for _ in range(400):
        texts.append(" ".join(w for _ in range(12) for w in (rng.choice(wet), "lodo" if rng.random() < 0.3 else rng.choice(wet))))
        texts.append(" ".join(w for _ in range(12) for w in (rng.choice(people), "todo" if rng.random() < 0.5 else rng.choice(people))))
    texts += ["agua barro lluvia 1odo charco río pantano", "gente vecinos plaza 1odo siempre calle fiesta"]
    df = spark.createDataFrame(list(enumerate(texts)), "intervention_id int, speech_text string")
    run = lambda: {(r.intervention_id, r.fix) for r in ocr.find_repairs(df).where("kind = 'char'").collect()}
    assert run() == {(800, "lodo"), (801, "todo")}
    import numpy as np

    monkeypatch.setattr(ocr, "learn_vectors", lambda *_: ocr.Vectors([], np.zeros((0, ocr.VECTOR_SIZE))))
    assert run() == {(800, "todo"), (801, "todo")}


def test_vectors_of_all_texts(spark, monkeypatch):
    rng = random.Random(4)
    wet, people = "agua barro charco río lluvia orilla pantano cieno".split(), "gente siempre vecinos plaza fiesta calle pueblo mercado".split()
    texts = [" ".join(w for _ in range(12) for w in (rng.choice(topic), fix if rng.random() < 0.4 else rng.choice(topic))) for _ in range(1200) for topic, fix in ((wet, "lodo"), (people, "todo"))]
    # Words of five texts only, one text of each word: a sample of texts would miss some.
    texts += [f"agua barro {'único' + chr(97 + k) * 3} lluvia" for k in range(20) for _ in range(5)]
    texts += ["agua barro lluvia 1odo charco río pantano", "gente vecinos plaza 1odo siempre calle fiesta"]
    df = spark.createDataFrame(list(enumerate(texts)), "intervention_id int, speech_text string")
    learn, seen = ocr.learn_vectors, []
    monkeypatch.setattr(ocr, "learn_vectors", lambda *a: seen.append(learn(*a)) or seen[-1])
    monkeypatch.setattr(ocr, "VECTOR_WORDS", 12_000)
    found = {(r.intervention_id, r.fix) for r in ocr.find_repairs(df).where("kind = 'char'").collect()}
    assert found == {(2500, "lodo"), (2501, "todo")}
    assert set(seen[0].index) == {*wet, *people, "lodo", "todo", *("único" + chr(97 + k) * 3 for k in range(20))}


def test_rare_misreadings_need_the_context(spark, monkeypatch):
    rng = random.Random(3)
    talk = "gobierno marco mercado consejo materia lectura ponencia recursos".split()
    texts = [" ".join(rng.choice(talk) for _ in range(20)) for _ in range(300)] + ["gobierno marco eonsejo materia lectura ponencia"]
    df = spark.createDataFrame(list(enumerate(texts)), "intervention_id int, speech_text string")
    run = lambda: {(r.intervention_id, r.fix) for r in ocr.find_repairs(df).where("kind = 'char'").collect()}
    assert run() == {(300, "consejo")}
    import numpy as np

    monkeypatch.setattr(ocr, "learn_vectors", lambda *_: ocr.Vectors([], np.zeros((0, ocr.VECTOR_SIZE))))
    assert run() == set()


def test_headers_of_a_rare_publication_and_long_lines(spark):
    rng = random.Random(5)
    talk = "gobierno marco mercado consejo materia lectura ponencia recursos presupuesto ley".split()
    body = lambda: "\n".join(" ".join(rng.choice(talk) for _ in range(8)) for _ in range(6))
    long_head = "Boletín " + "de la muy noble villa " * 8 + "folio"
    data = [(i, "Pleno", body() + ".") for i in range(2400)] + [(5000 + i, "Comisión de Faros", body() + f"\n\nBoletín de Faros\n\n{long_head} {i + 7}\n" + body() + ".") for i in range(12)]
    df = spark.createDataFrame(data, "intervention_id int, organo string, speech_text string")
    found = {(r.intervention_id, r.fix) for r in ocr.find_repairs(df).where("kind = 'furniture'").collect()}
    assert found == {(5000 + i, line) for i in range(12) for line in ("Boletín de Faros", f"{long_head} {i + 7}")}


def test_words_of_any_length(spark):
    long = "otorrinolaringólogo" * 5
    df = spark.createDataFrame([(i, f"habla el {long} de siempre") for i in range(40)] + [(90, f"habla el {long[:50]}-\n{long[50:]} de siempre")], "intervention_id int, speech_text string")
    assert [tuple(r) for r in ocr.find_repairs(df).select("intervention_id", "kind", "fix").collect()] == [(90, "join", long)]


def test_a_few_short_texts(spark):
    df = spark.createDataFrame([(1, "una frase con agua-\ncero"), (2, "0tra"), (3, "-"), (4, "\n\n5\n")], "intervention_id int, speech_text string")
    assert {(r.intervention_id, r.kind, r.fix) for r in ocr.find_repairs(df).collect()} == {(1, "join", "aguacero"), (2, "char", "otra")}
    assert ocr.repair_texts(df).count() == 4
