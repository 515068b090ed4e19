import bz2
import gzip
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from almazara import schemas
from almazara.sources import archives, delimited, markup, nested, ntriples


def text_frame(spark, lines, **columns):
    df = spark.createDataFrame([("/x/a.zip", "m", i + 1, v) for i, v in enumerate(lines)], "archive string, member string, line_number long, value string")
    return df


def test_archive_lines_of_every_kind(spark, tmp_path, rows):
    body = "uno\ndos\r\ntres"
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", body)
        z.writestr("x.txt", "no")
    (tmp_path / "p.txt").write_text(body)
    with gzip.open(tmp_path / "g.txt.gz", "wt") as f:
        f.write(body)
    with bz2.open(tmp_path / "b.nt.bz2", "wt") as f:
        f.write(body)
    with tarfile.open(tmp_path / "t.tar.gz", "w:gz") as t:
        t.add(tmp_path / "p.txt", "in/p.txt")
    for name, suffix in (("a.zip", ".csv"), ("p.txt", ""), ("g.txt.gz", ""), ("b.nt.bz2", ""), ("t.tar.gz", ".txt")):
        got = rows(archives.archive_lines(spark, [str(tmp_path / name)], suffix=suffix), "line_number", "value")
        assert got == [(1, "uno"), (2, "dos"), (3, "tres")], name
    assert archives.member_texts(spark, [str(tmp_path / "a.zip")], suffix=".txt").collect()[0].text == "no"
    assert archives.is_sound_archive(str(tmp_path / "a.zip")) and not archives.is_sound_archive(str(tmp_path / "none.zip")) and not archives.is_sound_archive(str(tmp_path / "a.zip"), size=1)


def test_manifests(spark, rows):
    lines = text_frame(spark, ["0123456789abcdef0123456789ABCDEF  a.zip", "zz  b.zip", "12 a.zip", "x y", ""])
    assert rows(archives.manifest_checksums(lines)) == [("a.zip", "0123456789abcdef0123456789abcdef")]
    assert rows(archives.manifest_sizes(lines)) == [("a.zip", 12)]


def test_events_of_both_widths(spark):
    fields = {i: "" for i in range(58)}
    fields |= {0: "7", 1: "20200102", 2: "202001", 3: "2020", 4: "2020.1", 25: "1", 26: "010", 29: "1", 30: "-2.5", 31: "4", 39: "95", 56: "20200102030405", 57: "http://x"}
    whole = "\t".join(fields[i] for i in range(58))
    short = "\t".join({**fields, 31: "x1", 1: "2020013"}[i] for i in range(57))
    out = delimited.event_rows(text_frame(spark, [whole, short, ""]), lenient=True).orderBy("num_mentions").collect()
    assert len(out) == 2 and out[0].num_mentions is None and out[0].event_date is None and out[0].source_url is None
    assert out[1].num_mentions == 4 and str(out[1].event_date) == "2020-01-02" and str(out[1].date_added) == "2020-01-02 03:04:05" and out[1].source_archive == "a.zip" and abs(out[1].goldstein_scale + 2.5) < 1e-6
    assert out[1].asDict().keys() == set(schemas.columns("gdelt.events"))
    with pytest.raises(Exception):
        delimited.event_rows(text_frame(spark, [short])).collect()


def test_earthquakes(spark, tmp_path):
    head = "Evento;Fecha;Hora;Latitud;Longitud;Prof.;Inten.;Mag.;Tipo;Lugar\n"
    (tmp_path / "e.csv").write_text(head + " es2026a;01/08/2026;02:52:42;36,5;-4.5;10;;2.1;mbLg;N MAZALEÃ\x93N.TE\n\n es2;2/8/2026;1:02:03;1;2;3;VIII-IX;;;X.POR;extra\n", encoding="utf-8")
    out = {r.event_id: r for r in delimited.read_earthquake_csv(spark, str(tmp_path / "e.csv")).collect()}
    a = out["es2026a"]
    assert str(a.occurred_at_utc) == "2026-08-01 02:52:42" and a.latitude == 36.5 and a.maximum_intensity is None and a.location == "N MAZALEÓN.TE" and a.country_code == "ES"
    assert out["es2"].maximum_intensity_numeric == 8.5 and out["es2"].country_name == "Portugal"
    (tmp_path / "bad.csv").write_text(head + "a;b\n")
    with pytest.raises(Exception):
        delimited.read_earthquake_csv(spark, str(tmp_path / "bad.csv")).collect()
    page = "<table><tr><th>x</th></tr><tr>" + "".join(f"<td>{c}</td>" for c in ["es1427aaaaa", "02/02/1427", "00:00:00", "", "41.9833", "2.5", "", "6.0", "null", "-1", "W X.FRA", "z"]) + "</tr><tr><td>short</td></tr></table>"
    (b,) = markup.earthquake_table_rows(spark.createDataFrame([(page,)], "text string")).collect()
    assert b.latitude == 41.9833 and b.maximum_intensity is None and b.maximum_intensity_numeric is None and b.magnitude_type_code is None and b.source_format == "html_fallback" and b.country_code == "FR"


def test_electricity_lines(spark, rows):
    got = delimited.marginal_price_rows(text_frame(spark, ["MARGINALPDBC;", "2024;01;01;1;55,40;56,10;", "2024;13;01;1;1;1;", "2024;01;02;2;7,5;", "*", ""])).orderBy("date").collect()
    assert [(str(r.date), r.hour, r.price_es, r.price_pt) for r in got] == [("2024-01-01", 1, 55.4, 56.1), ("2024-01-02", 2, 7.5, 7.5)]
    got = delimited.bidding_curve_rows(text_frame(spark, ["OMIE x", "Hora;Fecha", "1;02/01/2024;MI;U;V;1.234,5;10,00;C", "1;02/01/2024;MI", "1;31/02/2024;MI;U;V;1;1;C"])).collect()
    assert [(str(r.date), r.year, r.offer_type, r.energy_mwh, r.price_eur_mwh, r.status) for r in got] == [("2024-01-02", 2024, "V", 1234.5, 10.0, "C")]


def test_stations(spark):
    line = "TEST0000001202402TMAX" + "  123   " + "-9999   " + "  456 Q " + "-9999   " * 28
    got = delimited.station_rows(text_frame(spark, [line, "short"])).orderBy("date").collect()
    assert [(str(r.date), r.value, r.quality_flag) for r in got] == [("2024-02-01", 123, ""), ("2024-02-03", 456, "Q")]


def test_measurements(spark, tmp_path):
    (tmp_path / "m.csv").write_text(",".join(delimited.MEASUREMENT_HEADER) + "\n2026-01-02 03:04:05,1.5,2.5,40,cpm,,7,,,,,2026-01-02 04:00:00.293514,1\n")
    (r,) = delimited.read_measurements(spark, str(tmp_path / "m.csv")).collect()
    assert r.captured_at.year == 2026 and r.uploaded_at.microsecond == 293514 and r.unit == "cpm" and r.location_name is None and r.height is None
    with tarfile.open(tmp_path / "m.tar.gz", "w:gz") as t:
        t.add(tmp_path / "m.csv", "m.csv")
    assert delimited.read_measurements(spark, str(tmp_path / "m.tar.gz")).collect() == [r]


def test_medicines(spark, tmp_path):
    record = {"nregistro": "1", "nombre": "N", "comerc": True, "estado": {"aut": 5}, "formaFarmaceutica": {"id": 1, "codigo": "c", "nombre": "f"}, "presentaciones": [{"cn": "9", "estado": {"rev": 3}}], "principiosActivos": [{"id": 1}], "excipientes": [{"id": 2, "orden": 1}], "atcs": [{"codigo": "A"}, {"codigo": "B"}], "viasAdministracion": [{"id": 3}], "docs": [{"tipo": 1, "secc": True}], "fotos": [{"tipo": "t"}]}
    (tmp_path / "m.ndjson").write_text(json.dumps(record) + "\n" + json.dumps({"nregistro": "2"}) + "\n")
    t = nested.read_medicines(spark, str(tmp_path / "m.ndjson"))
    assert {k: v.count() for k, v in t.items()} == {"medications": 2, "presentations": 1, "active_ingredients": 1, "excipients": 1, "atc_codes": 2, "administration_routes": 1, "document_links": 1, "photos": 1}
    m = t["medications"].where("registration_number = '1'").collect()[0]
    assert m.authorized_at == 5 and m.pharmaceutical_form_code == "c" and m.non_substitutable_id is None
    assert [r.position for r in t["atc_codes"].orderBy("position").collect()] == [0, 1] and t["presentations"].collect()[0].withdrawn_at == 3


def test_leaflets_and_changes(spark):
    lines = text_frame(spark, [json.dumps({"nregistro": "1", "document_type": 1, "sections": [{"seccion": "4", "titulo": "t", "orden": 7, "contenido": "<p>a&nbsp;b</p>"}, {"seccion": "5"}]}), json.dumps({"nregistro": "2", "document_type": 2, "sections": {"resultados": [{"seccion": "1"}]}}), json.dumps({"nregistro": "3", "sections": None})])
    got = nested.leaflet_sections(lines).orderBy("registration_number", "section").collect()
    assert [(r.registration_number, r.section, r.source_order, r.content_text) for r in got] == [("1", "4", 7, "a b"), ("1", "5", 1, None), ("2", "1", 0, None)]
    lines = text_frame(spark, [json.dumps({"nregistro": "1", "fecha": 3, "tipoCambio": 1, "cambios": ["a", "b"]}), json.dumps({"nregistro": "2", "tipoCambio": 9, "cambio": "estado"}), json.dumps({"nregistro": "3", "cambios": []})])
    got = nested.register_changes(lines).orderBy("registration_number", "changed_field").collect()
    assert [(r.registration_number, r.change_type_name, r.changed_field) for r in got] == [("1", "new", "a"), ("1", "new", "b"), ("2", "unknown", "estado"), ("3", "unknown", None)]


def test_json_lines_repair(spark, rows):
    lines = text_frame(spark, ['{"id":"a","v":1}', "{broken", '{"id":"a","v":2}', '{"id":"b"}', "", '{"v":3}'])
    kept, counts = nested.repaired_lines(lines, "id")
    assert rows(kept, "line_number") == [(1,), (4,), (6,)]
    assert tuple(counts.collect()[0]) == (3, 1, 1)


def test_products_and_entities(spark):
    p = nested.product_rows(text_frame(spark, ['{"code":"1","product_name":"N","nutriments":{"energy-kcal_100g":0}}', "bad"])).collect()
    assert len(p) == 1 and p[0].nutriments_json == '{"energy-kcal_100g":0}' and p[0].brands == "" and '"product_name":"N"' in p[0].source_json
    e = {"id": "Q1", "type": "item", "lastrevid": 3, "labels": {"en": {"value": "Universe"}}, "aliases": {"en": [{"value": "a"}, {"value": "b"}]}, "sitelinks": {"enwiki": {"title": "U"}}, "claims": {"P1": [{"id": "Q1$1", "rank": "normal", "mainsnak": {"snaktype": "value"}}]}}
    t = nested.entity_tables(text_frame(spark, ["[", json.dumps(e) + ",", "]"]))
    assert {k: v.count() for k, v in t.items()} == {"entities": 1, "terms": 3, "sitelinks": 1, "claims": 1}
    c = t["claims"].collect()[0]
    assert (c.property_id, c.mainsnak_json, c.qualifiers_json, c.references_json) == ("P1", '{"snaktype":"value"}', "{}", "[]")


def test_ballots_and_speeches(spark):
    ballot = {"informacion": {"sesion": 15, "numeroVotacion": 10, "fecha": "1/2/2024", "titulo": "t"}, "totales": {"presentes": 2, "afavor": 178}, "votaciones": [{"diputado": "A", "grupo": "G", "asiento": "1", "voto": "Sí"}, {"diputado": "B", "voto": None}]}
    t = nested.ballot_tables(spark.createDataFrame([(json.dumps(ballot),), ("broken",)], "text string"), 15)
    (b,) = t["initiatives"].collect()
    assert (b.legislature, b.session_number, b.vote_number, b.afavor, b.asentimiento, b.expediente) == (15, 15, 10, 178, "No", "")
    assert [(r.deputy_name, r.vote) for r in t["deputy_votes"].orderBy("deputy_name").collect()] == [("A", "Sí"), ("B", "")]
    catalogue = spark.createDataFrame([("https://x/DS-1.PDF#page=3",), (None,)], "enlace_pdf string")
    pages = spark.createDataFrame([("DS-1.PDF", 3, "hola")], "pdf_name string, page int, text string")
    assert sorted((r.speech_text, r.speech_char_count) for r in nested.speeches_with_text(catalogue, pages).collect()) == [("", 0), ("hola", 4)]


def test_statements(spark, rows):
    lines = ['<s:1> <p:1> "Biblioteca \\"Nacional\\"\\nEspa\\u00f1a"@es .', '_:n1 <p:2> "2021"^^<xsd:gYear> .', "# comment", "", "<s:2> <p:3> <o", "ne> .", "<s:3> <p:3> <o:wra", ">  .", "<s:4> <p:4> <o:4>", '<s:5> <p:5> "bad \\q" .', "<s:6> <p:6> _:b ."]
    parsed = ntriples.parsed_statements(ntriples.logical_lines(text_frame(spark, lines)))
    got = {r.source_line: r for r in ntriples.statement_rows(parsed, "c", "2025-01-01").collect()}
    assert sorted(got) == [1, 2, 7, 11]
    assert got[1].object == 'Biblioteca "Nacional"\nEspaña' and got[1].language == "es" and got[2].datatype == "xsd:gYear" and got[2].subject == "_:n1"
    assert got[7].object == "o:wra" and got[11].object_kind == "blank_node" and got[7].record_id == "c:7"
    assert tuple(ntriples.statement_summary(parsed).collect()[0]) == (4, 2, 4, 1)
    assert rows(ntriples.invalid_examples(parsed), "line_number") == [(10,), (5,), (6,), (9,)]


def test_files_in_one_pass_give_what_frames_give(spark, tmp_path, rows):
    lines = ['<s:1> <p:1> "Biblioteca \\"Nacional\\"\\nEspa\\u00f1a"@es .', '_:n1 <p:2> "2021"^^<xsd:gYear> .', "# comment", "", "<s:2> <p:3> <o", "ne> .", "<s:3> <p:3> <o:wra", ">  .", "<s:4> <p:4> <o:4>", '<s:5> <p:5> "bad \\q" .', "<s:6> <p:6> _:b .", "<s:7> <p:7> <open"]
    for name, opener in (("a.nt", open), ("b.nt.bz2", bz2.open), ("c.nt.gz", gzip.open)):
        with opener(tmp_path / name, "wt", encoding="utf-8") as f:
            f.write("\n".join(lines))
    paths = [str(tmp_path / n) for n in ("a.nt", "b.nt.bz2", "c.nt.gz")]
    read = archives.archive_lines(spark, paths)
    a, b = ntriples.ordered_statements(read), ntriples.parsed_statements(ntriples.logical_lines(read))
    columns = ["member", "line_number", "subject", "predicate", "object", "object_kind", "language", "datatype", "error", "repaired"]
    assert rows(a, *columns) == rows(b, *columns) and a.count() == 33
    assert ntriples.read_statements(spark, paths, "c", "2025-01-01").count() == 12


def test_very_long_literals(spark):
    body = 'a\\"b\\n' * 60_000
    lines = [f'<s:1> <p:1> "{body}"@es .', "<" * 50_000]
    parsed = ntriples.parsed_statements(ntriples.logical_lines(text_frame(spark, lines)))
    (r,) = ntriples.statement_rows(parsed, "c", "2025-01-01").collect()
    assert r.object == 'a"b\n' * 60_000 and r.language == "es"


PRICES = """<Publication_MarketDocument xmlns="urn:x"><mRID>d1</mRID><revisionNumber>2</revisionNumber><TimeSeries><mRID>{id}</mRID><businessType>A62</businessType><contract_MarketAgreement.type>{contract}</contract_MarketAgreement.type><currency_Unit.name>EUR</currency_Unit.name><price_Measure_Unit.name>MWH</price_Measure_Unit.name><curveType>A01</curveType><Period><timeInterval><start>2025-01-01T00:00Z</start><end>2025-01-01T02:00Z</end></timeInterval><resolution>{step}</resolution><Point><position>1</position><price.amount>50.5</price.amount></Point><Point><position>2</position><price.amount>-2.0</price.amount></Point><Point><position>3</position></Point></Period></TimeSeries></Publication_MarketDocument>"""
LOAD = """<GL_MarketDocument><mRID>d2</mRID><TimeSeries><mRID>1</mRID><quantity_Measure_Unit.name>MAW</quantity_Measure_Unit.name><Period><timeInterval><start>2025-01-01T00:00Z</start></timeInterval><resolution>PT15M</resolution><Point><position>1</position><quantity>100</quantity></Point><Point><position>2</position><quantity>101</quantity></Point></Period></TimeSeries></GL_MarketDocument>"""


def test_market_documents(spark):
    zones = spark.createDataFrame([("ES", "Spain", "ES", "10Y")], "zone_key string, name string, country_code string, eic_code string")

    def run(text, dataset="day_ahead_prices"):
        return markup.market_rows(spark.createDataFrame([(text, "ES", "f.xml")], "text string, zone_key string, source_file string"), dataset, zones).orderBy("timestamp_utc").collect()

    a = run(PRICES.format(id="1", contract="A01", step="PT60M"))
    assert [(r.price, r.timestamp_utc.hour) for r in a] == [(50.5, 0), (-2.0, 1)] and a[0].currency == "EUR" and a[0].unit == "MWH" and a[0].revision_number == 2 and a[0].zone_name == "Spain" and a[0].document_id == "d1"
    assert run(PRICES.format(id="9", contract="A01", step="PT60M"))[0].record_id == a[0].record_id
    assert run(PRICES.format(id="1", contract="A01", step="PT15M"))[0].record_id != a[0].record_id
    assert run(PRICES.format(id="1", contract="A07", step="PT60M")) == []
    b = run(LOAD, "actual_load")
    assert [(r.load, r.timestamp_utc.minute, r.unit) for r in b] == [(100.0, 0, "MAW"), (101.0, 15, "MAW")]
    assert run("<Acknowledgement_MarketDocument><mRID>x</mRID></Acknowledgement_MarketDocument>") == []


FEED = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:b="urn:b" xmlns:a="urn:a" xmlns:at="urn:t"><entry><id>t/1</id><title>Sample</title><updated>2025-01-02T10:00:00Z</updated><link href="https://e/1"/><content><a:ContractFolderStatus><b:ContractFolderID>EXP-1</b:ContractFolderID><a:LocatedContractingParty><a:Party><a:PartyIdentification><b:ID schemeName="NIF">S1</b:ID></a:PartyIdentification><a:PartyIdentification><b:ID schemeName="ID_PLATAFORMA">42</b:ID></a:PartyIdentification><a:PartyName><b:Name>Authority</b:Name></a:PartyName></a:Party></a:LocatedContractingParty><a:ProcurementProject><b:Name>P</b:Name><a:BudgetAmount><b:EstimatedOverallContractAmount currencyID="EUR">150000</b:EstimatedOverallContractAmount></a:BudgetAmount><a:RequiredCommodityClassification><b:ItemClassificationCode name="Lab">38000000</b:ItemClassificationCode></a:RequiredCommodityClassification></a:ProcurementProject><a:ProcurementProjectLot><a:ProcurementProject><b:Name>M</b:Name><a:RequiredCommodityClassification><b:ItemClassificationCode>38510000</b:ItemClassificationCode></a:RequiredCommodityClassification></a:ProcurementProject></a:ProcurementProjectLot><a:TenderResult><b:AwardDate>2025-02-01</b:AwardDate><b:ReceivedTenderQuantity>3</b:ReceivedTenderQuantity><a:WinningParty><a:PartyIdentification><b:ID schemeName="NIF">B12345678</b:ID></a:PartyIdentification></a:WinningParty><a:AwardedTenderedProject><a:LegalMonetaryTotal><b:TaxExclusiveAmount currencyID="EUR">59000</b:TaxExclusiveAmount></a:LegalMonetaryTotal></a:AwardedTenderedProject></a:TenderResult><a:TenderResult><b:ResultCode>3</b:ResultCode></a:TenderResult></a:ContractFolderStatus></content></entry><at:deleted-entry ref="t/2" when="2025-02-03T12:00:00Z"/></feed>"""


def test_procurement(spark):
    import hashlib

    t = markup.procurement_tables(spark.createDataFrame([("/x/a.zip", "f.atom", FEED)], "archive string, member string, text string"))
    v = {r.atom_id: r for r in t["versions"].collect()}
    assert v["t/1"].estimated_value == 150000 and v["t/1"].contracting_party_nif == "S1" and v["t/1"].contracting_party_platform_id == "42" and v["t/1"].currency == "EUR" and v["t/1"].entry_url == "https://e/1"
    assert v["t/2"].is_deleted and v["t/2"].version_id == hashlib.sha256("t/2\x1f2025-02-03T12:00:00Z\x1f1".encode()).hexdigest()
    assert [r.lot_id for r in t["lots"].collect()] == ["1"]
    assert sorted((r.lot_id or "", r.cpv_code, r.cpv_name) for r in t["cpv_codes"].collect()) == [("", "38000000", "Lab"), ("1", "38510000", None)]
    a = sorted(t["awards"].collect(), key=lambda r: r.result_position)
    assert (a[0].winner_nif, a[0].award_tax_exclusive, str(a[0].award_date), a[0].received_tenders) == ("B12345678", 59000.0, "2025-02-01", 3)
    assert (a[1].result_position, a[1].winner_position, a[1].winner_nif) == (2, 1, None)


def test_map_features(spark):
    import struct

    gml = """<c xmlns:bu="urn:bu" xmlns:gml="http://www.opengis.net/gml/3.2" xmlns:base="urn:base" xmlns:xlink="http://www.w3.org/1999/xlink"><bu:OtherConstruction gml:id="oc-1"><base:Identifier><base:localId>oc-1</base:localId><base:namespace>ES.TEST</base:namespace></base:Identifier><bu:conditionOfConstruction xlink:href="urn:condition:functional"/><bu:cadastralParcels xlink:href="p1"/><bu:geometry><gml:Polygon srsName="urn:ogc:def:crs:EPSG::4326"><gml:exterior><gml:LinearRing><gml:posList srsDimension="2">-1 39 0 39 0 40 -1 39</gml:posList></gml:LinearRing></gml:exterior><gml:interior><gml:LinearRing><gml:posList>0 0 1 1</gml:posList></gml:LinearRing></gml:interior></gml:Polygon></bu:geometry></bu:OtherConstruction></c>"""
    texts = spark.createDataFrame([("/x/a.zip", "a.gml", gml, "02", "02001", "ABENGIBRE")], "archive string, member string, text string, province_code string, municipality_code string, municipality_name string")
    features = markup.read_features(texts)
    (r,) = markup.feature_table(features, "other_constructions").collect()
    assert r.condition_of_construction == "urn:condition:functional" and (r.bbox_min_x, r.bbox_min_y, r.bbox_max_x, r.bbox_max_y) == (-1.0, 39.0, 0.0, 40.0)
    assert struct.unpack("<BII", bytes(r.geometry)[:9]) == (1, 3, 1) and r.cadastral_parcel_refs == ["p1"] and r.address_refs == [] and r.properties_json == '{"localId":"oc-1","namespace":"ES.TEST"}'
    assert markup.feature_table(features, "parcels").count() == 0


def test_elements_of_members_one_by_one(spark, tmp_path):
    entry = FEED[FEED.index("<entry>") : FEED.index("</feed>")]
    head = FEED[: FEED.index("<entry>")]
    many = head + "".join(entry.replace("t/1", f"t/{i}").replace("t/2", f"gone/{i}") for i in range(1200)) + "</feed>"
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("f.atom", many)
        z.writestr("g.txt", "no")
        z.writestr("none.atom", "<feed/>")
    texts = archives.member_elements(spark, [f"file://{tmp_path}/a.zip"], ["entry", "deleted-entry"], suffix=".atom")
    assert texts.count() == 2400
    t, whole = markup.procurement_tables(texts), markup.procurement_tables(archives.member_texts(spark, [str(tmp_path / "a.zip")], suffix="f.atom"))
    for name in t:
        columns = [c for c in t[name].columns if c not in ("source_archive",)]
        a, b = ([tuple(r) for r in x[name].select(*columns).collect()] for x in (t, whole))
        assert sorted(a, key=str) == sorted(b, key=str), name


def test_quoted_earthquake_fields(spark, tmp_path):
    head = "Evento;Fecha;Hora;Latitud;Longitud;Prof.;Inten.;Mag.;Tipo;Lugar\n"
    (tmp_path / "e.csv").write_text(head + 'a;01/08/2026;02:52:42;1;2;3;;2.1;;"N ""X""; B.TE"\nb;01/08/2026;02:52:42;1;2;3;;2.1;;C.TE\n', encoding="utf-8")
    assert sorted((r.event_id, r.location) for r in delimited.read_earthquake_csv(spark, str(tmp_path / "e.csv")).collect()) == [("a", 'N "X"; B.TE'), ("b", "C.TE")]
    (tmp_path / "bad.csv").write_text(head + 'a;"b;c;d;e;f;g;h;i;j;k"\n')
    with pytest.raises(Exception):
        delimited.read_earthquake_csv(spark, str(tmp_path / "bad.csv")).collect()
