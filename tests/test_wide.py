import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from almazara.operators import wide

BASE = "http://catalogo.example/def/"
CATALOG = [(BASE + "pages", "pages", "integer", False), (BASE + "height_cm", "height_cm", "decimal", False), (BASE + "acquired_on", "acquired_on", "date", False), (BASE + "digitised", "digitised", "boolean", False), (BASE + "title", "title", "string", False), (BASE + "topic", "topic", "iri", True)]
TRIPLE = "record_id string, subject string, predicate string, object string, source_line long"

INTEGERS = {"13": "13", "14 p.": "14", "29 unidades": "29", "36 ": "36", "49.0": "49", "+267": "267", "-5": "-5", "[73]": "73", "c1527": "1527", "1869.": "1869", "1.234": "1234", "doce": "12", "treinta y cinco": "35", "mil doscientos": "1200", "3?2": None, "1-2 v.": None, "xii": None, "sin datos": None, "s.a.": None, "": None, "¿?": None, "49.5": None, "9" * 30: "9" * 30, "9" * 39: None, "1.111" * 30_000: None, "(" * 90_000: None, " " * 300 + "12" + " " * 300: "12", "0" * 300 + "42": "42", "hojas " * 60 + "7": "7", "doce páginas": "12", "una obra": None, "una": "1", "dos o tres": None, ")" * 90_000 + "x": None, "mil doscientos -": "1200"}
DECIMALS = {"972.92": "972.92", "774,79": "774.79", "+989.00": "989.00", "1.234,5": "1234.50", "2.28E2": "228.00", "12 cm": "12.00", "922.630": "922.63", "70.730": "70.73", "-5.820": "-5.82", "0191.21": "191.21", "1.234.567": "1234567.00", "1 234,5": "1234.50", "1.234.567,891": "1234567.89", "9" * 400: None, "peso " * 60 + "1,5 kg": "1.50", "23,,5": None, "aprox.": None, "n/d": None}
DATES = {"1915-12-16": "1915-12-16", "1922-11-18Z": "1922-11-18", "09/01/1971": "1971-01-09", "20130528": "2013-05-28", "1949-09-18T00:00:00": "1949-09-18", "7 de noviembre de 1909": "1909-11-07", "15-10-2013": "2013-10-15", "31/02/1950": None, "[1915-12-16]": "1915-12-16", "adquirido el 09/01/1971 en Madrid": "1971-01-09", "entre 1915-12-16 y 1915-12-17": None, " " * 400 + "1915-12-16": "1915-12-16", "x-" * 50_000: None, "1915-02-30": None, "1950?": None, "desconocido": None, "12": None}
BOOLEANS = {"true": "true", " TRUE": "true", "Sí": "true", "S": "true", "1": "true", "verdadero": "true", "No": "false", "0": "false", "falso": "false", "N": "false", "quizá": None, "2": None, "": None}


@pytest.mark.parametrize("kind,cases", [("integer", INTEGERS), ("decimal", DECIMALS), ("date", DATES), ("boolean", BOOLEANS)])
def test_readable_values(spark, kind, cases):
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", wide.read_value(F.col("t"), F.lit(kind)).alias("v"))
    found = {r.t: r.v for r in df.collect()}
    assert {k[:60]: v for k, v in found.items() if v != cases[k]} == {}


def test_iris(spark):
    texts = [BASE + "pages", "https://CATALOGO.example/def/pages/", "cat:pages", f"<{BASE}pages>", " " + BASE + "pages "]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(wide.canonical_iri(F.col("t"), {"cat": BASE}).alias("v"))
    assert {r.v for r in df.collect()} == {BASE + "pages"}


def make(spark, data):
    return spark.createDataFrame(data, TRIPLE), spark.createDataFrame(CATALOG, "predicate string, column_name string, column_type string, multi_valued boolean")


def test_wide_rows(spark):
    data = [("1", "a", BASE + "pages", "10", 1), ("2", "a", "cat:pages", "11", 5), ("3", "a", BASE + "pages/", "nada", 9), ("4", "a", BASE + "topic", "x", 2), ("5", "a", BASE + "topic", "x", 3), ("6", "a", BASE + "topic", "y", 4), ("7", "b", BASE + "digitised", "Sí", 1), ("8", "c", BASE + "title", "T", 1), ("9", None, BASE + "title", "T", 1), ("10", "d", BASE + "ink", "blue", 1), ("11", "e", None, "x", 1), ("12", "f", BASE + "pages", None, 1), ("13", "a", BASE + "height_cm", "1,5", None), ("14", "a", BASE + "pages", "12", 5)]
    triples, catalog = make(spark, data)
    out = {r.subject: r.asDict() for r in wide.wide_entities(triples.withColumn("value", F.lit(1)).withColumn("cells", F.lit(2)), catalog, prefixes={"cat": BASE}).collect()}
    assert set(out) == {"a", "b", "c"}
    assert out["a"]["pages"] == 11 and out["a"]["topic"] == ["x", "y"] and out["a"]["topic_count"] == 2 and str(out["a"]["height_cm"]) == "1.50"
    assert out["b"]["digitised"] is True and out["b"]["pages"] is None and out["b"]["topic_count"] == 0


def test_long_cells_stand_in_the_long_form(spark):
    data = [(str(i), "hot", BASE + "topic", f"t{i}", i) for i in range(wide.MAX_CELL_VALUES + 1)]
    triples, catalog = make(spark, data)
    row = wide.wide_entities(triples, catalog, prefixes={}).collect()[0]
    assert row.topic is None and row.topic_count == wide.MAX_CELL_VALUES + 1
    assert wide.multi_values(triples, catalog, prefixes={}).count() == wide.MAX_CELL_VALUES + 1


def test_cells_and_empty(spark, rows):
    triples, catalog = make(spark, [("1", "a", BASE + "acquired_on", "09/01/1971", 1), ("2", "a", BASE + "title", "x", 1)])
    found = wide.cells_of(wide.wide_entities(triples, catalog, prefixes={}, with_multi=False), catalog, ["integer", "decimal", "date", "boolean"])
    assert rows(found) == [("a", "acquired_on", "1971-01-09")]
    assert wide.wide_entities(triples.limit(0), catalog, prefixes={}).count() == 0


def test_every_value_of_a_long_cell_has_a_query(spark, tmp_path):
    from almazara.plans import problems

    triples, catalog = make(spark, [(str(i), "hot", BASE + "topic", f"t{i}", i) for i in range(wide.MAX_CELL_VALUES + 1)] + [("x", "cold", "cat:topic", "t", 1)])
    triples.write.parquet(f"{tmp_path}/triples.parquet")
    catalog.write.parquet(f"{tmp_path}/attribute_catalog.parquet")
    found = {tuple(r) for r in problems.QUERIES["p4_multi_values"](spark, str(tmp_path)).collect()}
    assert found == {("hot", "topic", f"t{i}") for i in range(wide.MAX_CELL_VALUES + 1)} | {("cold", "topic", "t")}


def test_every_characteristic_set_has_a_dense_table(spark):
    names = [c[1] for c in CATALOG]
    values = {"pages": "7", "height_cm": "1,5", "acquired_on": "1915-12-16", "digitised": "no", "title": "T", "topic": "x"}
    typed = {"pages": "7", "height_cm": "1.50", "acquired_on": "1915-12-16", "digitised": "False", "title": "T", "topic": "['x']"}
    sets = {f"s{k}-{i}": [n for j, n in enumerate(names) if k >> j & 1] for k in range(1, 64) for i in range(3)}
    data = [(f"{s}{n}", s, BASE + n, values[n], 1) for s, has in sets.items() for n in has]
    triples, catalog = make(spark, data)
    rows = {r.subject: r.asDict() for r in wide.wide_entities(triples.repartition(5), catalog, prefixes={}).collect()}
    assert set(rows) == set(sets)
    for s, has in sets.items():
        assert rows[s]["signature"] == sorted(has)
        assert {n: str(rows[s][n]) for n in names if rows[s][n] is not None} == {n: typed[n] for n in has}
    counted = wide.characteristic_sets(triples, catalog, prefixes={}).collect()
    assert len(counted) == 63 and all(r.subjects == 3 for r in counted)
    schema = pa.schema([("subject", pa.string()), ("signature", pa.list_(pa.string())), ("pages", pa.string()), ("title", pa.string())])
    cell = lambda n, v: {"column_name": n, "value": v, "values": None, "n": 1}
    batch = pa.RecordBatch.from_pylist([{"subject": "a", "signature": ["pages"], "cells": [cell("pages", "1")]}, {"subject": "b", "signature": ["pages"], "cells": [cell("pages", "2")]}, {"subject": "c", "signature": ["title"], "cells": [cell("title", "T")]}])
    seen = []
    original = pa.concat_tables
    try:
        pa.concat_tables = lambda tables, **k: seen.extend(t.column_names for t in tables) or original(tables, **k)
        out = [r for b in wide._dense_tables(schema, frozenset())([batch]) for r in b.to_pylist()]
    finally:
        pa.concat_tables = original
    assert seen[1:] == [["subject", "signature", "pages"], ["subject", "signature", "title"]]
    assert [(r["subject"], r["pages"], r["title"]) for r in out] == [("a", "1", None), ("b", "2", None), ("c", None, "T")]
