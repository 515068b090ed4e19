import json

import pytest

from almazara import cli, schemas
from almazara.config import RunConfig
from almazara.plans import pipelines
from almazara.sources import pdf


def test_every_table_has_facts():
    assert set(pipelines.FACTS) == set(schemas.DDL)
    for name, facts in pipelines.FACTS.items():
        have = set(schemas.columns(name))
        assert set(facts.keys + facts.times + facts.numbers + facts.groups) <= have and {c for pair in facts.coordinates for c in pair} <= have, name


def test_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"kind": "observations", "inputs": ["a.dly"], "output": "out"}))
    c = RunConfig.load(tmp_path / "c.json")
    assert c.inputs == (str(tmp_path / "a.dly"),) and c.output == str(tmp_path / "out") and c.rows_per_file == 1_000_000
    for bad in ({"kind": "x", "inputs": ["a"], "output": "o", "extra": 1}, {"kind": "x", "inputs": [], "output": "o"}, {"kind": "x", "inputs": ["a"], "output": "o", "rows_per_file": 0}):
        (tmp_path / "b.json").write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            RunConfig.load(tmp_path / "b.json")


def test_command_line_from_source_to_report(spark, tmp_path, monkeypatch):
    line = "TEST0000001202402TMAX" + "  123   " + "-9999   " + "  456 Q " + "-9999   " * 28
    (tmp_path / "a.dly").write_text(line + "\n" + line.replace("TMAX", "TMIN") + "\n")
    (tmp_path / "c.json").write_text(json.dumps({"kind": "observations", "inputs": ["a.dly"], "output": "out"}))
    assert cli.main(["run", str(tmp_path / "c.json")]) == 0
    table = str(tmp_path / "out" / "observations")
    assert spark.read.parquet(table).count() == 4
    assert cli.main(["report", "noaa.observations", table, "--artifacts", str(tmp_path / "art")]) == 0
    checks = {c["check_name"]: c["passed"] for c in json.loads((tmp_path / "art" / "quality.json").read_text())}
    assert checks == {"min_rows": True, "unique_key": True}
    assert {x["value"]: x["n"] for x in json.loads((tmp_path / "art" / "top_element.json").read_text())} == {"TMAX": 2, "TMIN": 2}
    assert cli.main(["analyze", table, "--keys", "station_id", "date", "element", "--artifacts", str(tmp_path / "a2")]) == 0
    assert cli.main(["stage", table, str(tmp_path / "staged"), "--keys", "station_id", "date", "element", "--artifacts", str(tmp_path / "a2")]) == 0
    assert (tmp_path / "staged" / "UPLOAD_MANIFEST.json").exists()


def test_reports_of_coordinates_and_labels(spark):
    df = schemas.conform(spark.createDataFrame([("a", 95.0, 0.0, -1.0), ("a", None, 1.0, 2.0)], "event_id string, latitude double, longitude double, depth_km double"), "ign.earthquakes")
    report = {r.check_name: r.failing for r in pipelines.quality_report(df, "ign.earthquakes", min_rows=3).collect()}
    assert report["latitude_longitude_in_range"] == 2 and report["unique_key"] == 1 and report["depth_km_not_negative"] == 1 and report["min_rows"] == 1
    events = schemas.conform(spark.createDataFrame([(1, 1), (2, 1), (3, 4), (4, 9)], "global_event_id long, quad_class int"), "gdelt.events")
    shares = {r.value: (r.label, r.percent) for r in pipelines.analysis(events, "gdelt.events")["shares_quad_class"].collect()}
    assert shares == {1: ("verbal cooperation", 50.0), 4: ("material conflict", 25.0), 9: ("unknown", 25.0)}


def test_small_relations(spark, rows):
    tasks = spark.createDataFrame([("02001", "ABENGIBRE", "02", "parcels", "p"), ("02001", "ABENGIBRE", "02", "buildings", "b")], "municipality_code string, municipality_name string, province_code string, collection string, url string")
    assert rows(pipelines.municipality_table(tasks)) == [("02001", "ABENGIBRE", "02", "p", None, "b")]
    assert rows(pipelines.with_master_names(spark.createDataFrame([(1, "x"), (2, "y")], "master_id int, nombre string")), "master_name", "nombre") == [("active_ingredients", "x")]
    assert pipelines.checkpoint_is_whole(tasks, 2, "province_code", "02") and not pipelines.checkpoint_is_whole(tasks, 3) and not pipelines.checkpoint_is_whole(tasks, 2, "url", "p")


def test_pdf_pages(spark, tmp_path, rows):
    import zlib

    packed = zlib.compress(b"BT /F1 12 Tf 10 10 Td (Se\\361or\\355as, s\\355) Tj T* [(me) -20 (sa)] TJ ET")
    body = b"%PDF-1.4\n1 0 obj<</Type /Page /Contents 2 0 R>>endobj\n2 0 obj<</Length 5>>stream\nBT (uno \\(1\\)) Tj ET\nendstream endobj\n3 0 obj<</Type/Page/Contents [4 0 R]>>endobj\n4 0 obj<</Filter /FlateDecode>>stream\n" + packed + b"\nendstream endobj\n5 0 obj<</Type /Pages>>endobj\n"
    (tmp_path / "DS-1.PDF").write_bytes(body)
    if pdf.pypdf is None:
        assert pdf.simple_pages(body) == ["uno (1)", "Señorías, sí\nmesa"]
        files = spark.read.format("binaryFile").load(str(tmp_path / "DS-1.PDF"))
        needed = spark.createDataFrame([("DS-1.PDF", 2), ("DS-1.PDF", 2), ("DS-1.PDF", 9), ("other", 1)], "pdf_name string, page int")
        assert rows(pdf.read_pages(files, needed)) == [("DS-1.PDF", 2, "Señorías, sí\nmesa")]


def test_tasks_are_estimated_and_verified(spark, tmp_path, capsys):
    import hashlib
    import json
    import zipfile

    from almazara import cli

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x", "y")
    data = (tmp_path / "a.zip").read_bytes()
    tasks = [{"name": "a.zip", "url": "u", "bytes": len(data), "md5": hashlib.md5(data).hexdigest()}, {"name": "b.zip", "url": "u", "bytes": 5, "md5": None}, {"name": "c.zip", "url": "u", "bytes": None, "md5": None}]
    (tmp_path / "tasks.jsonl").write_text("\n".join(map(json.dumps, tasks)))
    df = spark.read.schema("name string, url string, bytes long, md5 string").json(str(tmp_path / "tasks.jsonl"))
    assert cli.estimate(df, 10.0) == {"files": 3, "bytes": len(data) + 5, "unknown_sizes": 1, "seconds": round((len(data) + 5) / 10, 1)}
    assert cli.main(["estimate", str(tmp_path / "tasks.jsonl"), "--max-files", "2"]) == 0 and "'files': 2" in capsys.readouterr().out
    (tmp_path / "b.zip").write_bytes(data[:-9])
    assert {r.name: r.status for r in cli.verified(df, str(tmp_path)).collect()} == {"a.zip": "sound", "b.zip": "unsound", "c.zip": "missing"}
    assert cli.main(["verify", str(tmp_path / "tasks.jsonl"), str(tmp_path)]) == 1
