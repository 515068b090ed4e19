"""Round trips: the project's tables written in the form of a source or sink and read back by it, with the SQL of what must come out.

Names begin with the class of operator, as in ``reference``; files go to the
application's scratch folder. Every query takes its whole tables.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almazara import files, sinks
from almazara.functions import geo, numbers, temporal, text
from almazara.operators import planning, profile, quality, relational
from almazara.plans.reference import registrar
from almazara.runtime import materialize, scratch_path, table
from almazara.sources import archives, delimited, markup, nested, ntriples, parquet

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = registrar(QUERIES, ORACLES)


def _file_lines(df: DataFrame, value: Column, **options) -> DataFrame:
    """Rows as lines of gzip files, read back by the archive source."""
    spark = df.sparkSession
    path = scratch_path(spark, "lines")
    df.select(value.alias("value")).write.text(path, compression="gzip")
    return archives.archive_lines(spark, spark.read.text(path).inputFiles(), **options)


def _lines(df: DataFrame, value: Column, archive: str = "/in/a.zip") -> DataFrame:
    return df.select(F.lit(archive).alias("archive"), F.lit("m").alias("member"), F.monotonically_increasing_id().alias("line_number"), value.alias("value"))


def _t(column: Column | str) -> Column:
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))


def _event_line(width: int, mentions: Column) -> Column:
    fields = {0: _t("event_id"), 1: F.date_format("ts", "yyyyMMdd"), 2: F.date_format("ts", "yyyyMM"), 3: F.date_format("ts", "yyyy"), 5: F.upper("event_type"), 31: mentions, 56: F.date_format("ts", "yyyyMMddHHmmss"), 57: F.concat(F.lit("http://x/"), _t("user_id"))}
    return F.concat_ws("\t", *[fields.get(i, F.lit("")) for i in range(width)])


_EVENT_SQL = "SELECT event_id AS global_event_id, CAST(ts AS DATE) AS event_date, CAST(year(ts) AS INTEGER) AS y, upper(event_type) AS actor1_code, {m} AS num_mentions, date_trunc('second', ts) AS date_added, {u} AS source_url, 'a.zip' AS source_archive FROM events"


def _events(lines: DataFrame, lenient: bool) -> DataFrame:
    return delimited.event_rows(lines, lenient=lenient).select("global_event_id", "event_date", F.col("year").cast("int").alias("y"), "actor1_code", "num_mentions", "date_added", "source_url", "source_archive")


@query(_EVENT_SQL.format(m="CAST(event_id % 1000 AS INTEGER)", u="'http://x/' || user_id"))
def src01_events(spark: SparkSession, d: str) -> DataFrame:
    """Event records of 58 fields, strict."""
    return _events(_lines(table(spark, d, "events"), _event_line(58, _t(F.col("event_id") % 1000))), False)


@query(_EVENT_SQL.format(m="CAST(event_id % 1000 AS INTEGER)", u="CAST(NULL AS VARCHAR)"))
def src02_short_events(spark: SparkSession, d: str) -> DataFrame:
    """Event records of 57 fields have no source URL."""
    return _events(_lines(table(spark, d, "events"), _event_line(57, _t(F.col("event_id") % 1000))), False)


@query(_EVENT_SQL.format(m="CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 1000 AS INTEGER) END", u="'http://x/' || user_id"))
def src03_lenient_events(spark: SparkSession, d: str) -> DataFrame:
    """Numbers that cannot be read are null in lenient mode."""
    return _events(_lines(table(spark, d, "events"), _event_line(58, F.when(F.col("event_id") % 3 == 0, F.lit("x1")).otherwise(_t(F.col("event_id") % 1000)))), True)


@query("SELECT epoch_us(captured_at) AS captured_us, latitude, longitude, value, nullif(trim(unit), '') AS unit, nullif(trim(location_name), '') AS location_name, device_id, md5sum, height, nullif(trim(surface), '') AS surface, nullif(trim(radiation), '') AS radiation, epoch_us(uploaded_at) AS uploaded_us, loader_id FROM measurements WHERE value IS NULL OR NOT isinf(value)")
def src04_measurement_csv(spark: SparkSession, d: str) -> DataFrame:
    """The radiation export as CSV files, read with canonical names and types (PRJ-01)."""
    m = table(spark, d, "measurements").where(F.col("value").isNull() | (F.abs("value") != float("inf")))
    path = scratch_path(spark, "csv")
    written = m.select(*[(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if c in ("captured_at", "uploaded_at") else F.col(c)).alias(h) for h, c in delimited.MEASUREMENT_HEADER.items()])
    written.write.csv(path, header=True, quote='"', escape='"')
    out = delimited.read_measurements(spark, path)
    return out.select(F.unix_micros(F.col("captured_at").cast("timestamp")).alias("captured_us"), *[c for c in out.columns if c not in ("captured_at", "uploaded_at")], F.unix_micros(F.col("uploaded_at").cast("timestamp")).alias("uploaded_us"))


@query("SELECT lpad(CAST(o_orderkey AS VARCHAR), 11, '0') AS station_id, CAST(s + to_days(CAST(k - 1 AS INTEGER)) AS DATE) AS date, 'TMAX' AS element, CAST((o_orderkey * k) % 500 AS INTEGER) AS value, CASE WHEN (o_orderkey + k) % 5 = 0 THEN 'Q' ELSE '' END AS quality_flag FROM (SELECT o_orderkey, date_trunc('month', o_orderdate) AS s, last_day(o_orderdate) AS e FROM orders), (SELECT unnest(range(1, 32)) AS k) WHERE k <= day(e) AND (o_orderkey + k) % 7 <> 0")
def ns11_station_days(spark: SparkSession, d: str) -> DataFrame:
    """Fixed-width lines of 31 day fields to one row a day; the sentinel gives none (SRC-05, FLT-03)."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    day = lambda i: F.concat(F.lpad(F.when((k + i) % 7 == 0, F.lit("-9999")).otherwise(((k * i) % 500).cast("string")), 5, " "), F.lit(" "), F.when((k + i) % 5 == 0, "Q").otherwise(" "), F.lit(" "))
    line = F.concat(F.lpad(k.cast("string"), 11, "0"), F.date_format("o_orderdate", "yyyyMM"), F.lit("TMAX"), *[day(i) for i in range(1, 32)])
    return delimited.station_rows(_file_lines(o, line)).select("station_id", "date", "element", "value", "quality_flag")


@query("SELECT 'es' || event_id AS event_id, epoch_us(date_trunc('second', ts)) AS at_us, CAST(event_id % 90 AS DOUBLE) AS latitude, CASE WHEN event_id % 2 = 0 THEN 'A; B. C.TE' ELSE 'Norte.POR' END AS location, CASE WHEN event_id % 2 = 0 THEN 'Spain' ELSE 'Portugal' END AS country_name, CASE WHEN event_id % 3 = 0 THEN CAST(4.5 AS DOUBLE) END AS intensity FROM events")
def src06_quoted_earthquakes(spark: SparkSession, d: str) -> DataFrame:
    """Semicolon lines, some fields quoted with separators inside (FN-07, FN-08, FN-09, JN-08)."""
    e = table(spark, d, "events")
    place = F.when(F.col("event_id") % 2 == 0, F.lit('"A; B. C.TE"')).otherwise(F.lit("Norte.POR"))
    line = F.concat_ws(";", F.concat(F.lit(" es"), _t("event_id")), F.date_format("ts", "dd/MM/yyyy"), F.date_format("ts", "HH:mm:ss"), _t(F.col("event_id") % 90), F.lit("1"), F.lit("2"), F.when(F.col("event_id") % 3 == 0, "IV-V").otherwise(""), F.lit("3"), F.lit(""), place)
    path = scratch_path(spark, "quakes")
    e.select(line.alias("value")).unionByName(e.select(F.lit("Evento;Fecha").alias("value")).limit(0)).coalesce(1).write.option("lineSep", "\n").text(path)
    files.put_text(f"{path}-headed/e.csv", "Evento;Fecha;Hora;Latitud;Longitud;Prof.;Inten.;Mag.;Tipo;Lugar\n" + "".join(files.opened(p).read().decode() for p in spark.read.text(path).inputFiles()))
    out = delimited.read_earthquake_csv(spark, f"{path}-headed/e.csv")
    return out.select("event_id", F.unix_micros("occurred_at_utc").alias("at_us"), "latitude", "location", "country_name", F.col("maximum_intensity_numeric").alias("intensity"))


@query("SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_orderkey % 24 + 1 AS INTEGER) AS hour, CAST(o_orderkey % 1000 / 10.0 AS DOUBLE) AS price_es, CAST(o_orderkey % 1000 / 10.0 + 1 AS DOUBLE) AS price_pt FROM orders")
def src08_marginal_prices(spark: SparkSession, d: str) -> DataFrame:
    """Hourly price lines with decimal commas (FLT-04)."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    price = lambda plus: F.concat(F.floor(k % 1000 / 10 + plus).cast("string"), F.lit(","), (k % 10).cast("string"))
    line = F.concat_ws(";", F.date_format("o_orderdate", "yyyy"), F.date_format("o_orderdate", "MM"), F.date_format("o_orderdate", "dd"), _t(k % 24 + 1), price(0), price(1), F.lit(""))
    return delimited.marginal_price_rows(_file_lines(o, line)).select("date", F.col("hour").cast("int").alias("hour"), F.round("price_es", 1).alias("price_es"), F.round("price_pt", 1).alias("price_pt"))


@query("SELECT CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS y, 'MI' AS country, left(o_orderpriority, 1) AS offer_type, CAST(1000 + o_orderkey % 1000 AS DOUBLE) + 0.5 AS energy_mwh, CAST(o_orderkey % 90 AS DOUBLE) AS price_eur_mwh FROM orders")
def src09_bidding_curves(spark: SparkSession, d: str) -> DataFrame:
    """Bid lines with grouped Spanish numbers; headings are left out (PRJ-07)."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    line = F.concat_ws(";", F.lit("7"), F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit("MI"), F.lit("U"), F.substring("o_orderpriority", 1, 1), F.concat(F.lit("1."), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(",5")), F.concat((k % 90).cast("string"), F.lit(",00")), F.lit("C"))
    out = delimited.bidding_curve_rows(_file_lines(o.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("h")), F.when(F.col("h") == 1, F.lit("Hora;Fecha;Pais")).otherwise(line)))
    return out.select("date", F.col("year").cast("int").alias("y"), "country", "offer_type", "energy_mwh", "price_eur_mwh")


@query("SELECT subject, predicate, object, object_kind, coalesce(language, '') AS language, coalesce(datatype, '') AS datatype FROM triples WHERE NOT regexp_matches(subject || predicate || CASE WHEN object_kind = 'iri' THEN object ELSE '' END || coalesce(datatype, ''), '[<>\" {}|^`\\\\]') AND subject LIKE '%:%' AND predicate LIKE '%:%' AND object_kind IN ('iri', 'literal') AND object IS NOT NULL AND (object_kind = 'literal' OR object LIKE '%:%') AND NOT regexp_matches(coalesce(language, 'es'), '[^a-z]') AND (language IS NULL OR datatype IS NULL) AND object_kind = CASE WHEN language IS NULL AND datatype IS NULL THEN object_kind ELSE 'literal' END")
def src10_statements(spark: SparkSession, d: str) -> DataFrame:
    """Statements as N-Triples files, escapes included, parsed in one pass (FLT-05, FN-24, PRJ-02, WN-07)."""
    t = table(spark, d, "triples")
    iri = F.concat("subject", "predicate", F.when(F.col("object_kind") == "iri", F.col("object")).otherwise(""), F.coalesce("datatype", F.lit("")))
    kind = F.col("object_kind")
    good = ~iri.rlike(r'[<>" {}|^`\\]') & F.col("subject").contains(":") & F.col("predicate").contains(":") & kind.isin("iri", "literal") & F.col("object").isNotNull() & ((kind == "literal") | F.col("object").contains(":")) & ~F.coalesce("language", F.lit("es")).rlike("[^a-z]") & (F.col("language").isNull() | F.col("datatype").isNull()) & (kind == F.when(F.col("language").isNull() & F.col("datatype").isNull(), kind).otherwise("literal"))
    escaped = F.replace(F.replace(F.replace(F.replace(F.replace("object", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t"))
    literal = F.concat(F.lit('"'), escaped, F.lit('"'), F.coalesce(F.concat(F.lit("@"), F.col("language")), F.concat(F.lit("^^<"), F.col("datatype"), F.lit(">")), F.lit("")))
    line = F.concat(F.lit("<"), "subject", F.lit("> <"), "predicate", F.lit("> "), F.when(kind == "iri", F.concat(F.lit("<"), "object", F.lit(">"))).otherwise(literal), F.lit(" ."))
    path = scratch_path(spark, "nt")
    t.where(good).select(line.alias("value")).write.text(path, compression="gzip")
    out = ntriples.read_statements(spark, spark.read.text(path).inputFiles(), "c", "2025-01-01")
    return out.select("subject", "predicate", "object", "object_kind", _t("language").alias("language"), _t("datatype").alias("datatype"))


def _wrapped(spark: SparkSession, d: str) -> DataFrame:
    """Statements of nations, the object's IRI of every second one split over two lines, with comments and faults between."""
    n = table(spark, d, "nation").orderBy("n_nationkey").coalesce(1)
    subject = F.concat(F.lit("<http://n/"), _t("n_nationkey"), F.lit("> <http://p/r> "))
    whole = F.array(F.lit("# nation"), F.concat(subject, F.lit("<http://r/"), _t("n_regionkey"), F.lit("> .")), F.lit("<http://n/bad> no"))
    split = F.array(F.concat(subject, F.lit("<http://r/"), _t("n_regionkey")), F.lit("> ."))
    path = scratch_path(spark, "wrapped")
    n.select(F.explode(F.when(F.col("n_nationkey") % 2 == 0, whole).otherwise(split)).alias("value")).write.text(path)
    return archives.archive_lines(spark, spark.read.text(path).inputFiles())


@query("SELECT 'http://n/' || n_nationkey AS subject, 'http://r/' || n_regionkey AS object FROM nation")
def wn06_wrapped_lines(spark: SparkSession, d: str) -> DataFrame:
    """IRIs that were split over two lines are joined again."""
    parsed = ntriples.parsed_statements(ntriples.logical_lines(_wrapped(spark, d)))
    return ntriples.statement_rows(parsed, "c", "2025-01-01").select("subject", "object")


@query("SELECT count(*) AS parsed, count(*) FILTER (WHERE n_nationkey % 2 = 0) AS ignored, count(*) FILTER (WHERE n_nationkey % 2 = 0) AS invalid, count(*) FILTER (WHERE n_nationkey % 2 = 1) AS repaired FROM nation")
def snk16_statement_summary(spark: SparkSession, d: str) -> DataFrame:
    """How many lines were parsed, ignored, invalid and repaired."""
    return ntriples.statement_summary(ntriples.ordered_statements(_wrapped(spark, d)))


def _medicines(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    p, k = table(spark, d, "part"), F.col("p_partkey")
    item = lambda i, n: F.struct((k % 10 + i).alias("id"), F.lit(f"c{i}").alias("codigo"), n.alias("nombre"))
    record = F.struct(k.cast("string").alias("nregistro"), F.col("p_name").alias("nombre"), F.col("p_brand").alias("labtitular"), (k % 2 == 0).alias("comerc"), F.struct((k * 1000).alias("aut")).alias("estado"), item(1, F.col("p_type")).alias("formaFarmaceutica"), F.array(F.struct(F.concat(F.lit("n"), k.cast("string")).alias("cn"), F.col("p_name").alias("nombre"), (k % 3 == 0).alias("comerc"), F.struct((k * 7).alias("rev")).alias("estado"))).alias("presentaciones"), F.array(item(3, F.col("p_brand")), item(4, F.col("p_type"))).alias("principiosActivos"), F.array(F.struct((k % 5).alias("id"), F.lit("x").alias("nombre"), (k % 4).alias("orden"))).alias("excipientes"), F.array(F.struct(F.lit("A").alias("codigo"), F.lit(1).alias("nivel")), F.struct(F.col("p_brand").alias("codigo"), F.lit(2).alias("nivel"))).alias("atcs"), F.array(item(5, F.lit("oral"))).alias("viasAdministracion"), F.array(F.struct(F.lit(1).alias("tipo"), F.lit("u").alias("url"), F.lit(True).alias("secc"))).alias("docs"), F.array(F.struct(F.lit("t").alias("tipo"), F.lit("f").alias("url"))).alias("fotos"))
    path = scratch_path(spark, "medicines")
    p.select(F.to_json(record).alias("value")).write.text(path)
    return nested.read_medicines(spark, path)


@query("SELECT CAST(p_partkey AS VARCHAR) AS registration_number, p_name AS name, p_brand AS holder_laboratory, p_partkey % 2 = 0 AS marketed, p_partkey * 1000 AS authorized_at, p_partkey % 10 + 1 AS pharmaceutical_form_id, 'c1' AS pharmaceutical_form_code, p_type AS pharmaceutical_form_name FROM part")
def src11_medicines(spark: SparkSession, d: str) -> DataFrame:
    """The main table of nested records (PRJ-04, PRJ-05)."""
    return _medicines(spark, d)["medications"].select("registration_number", "name", "holder_laboratory", "marketed", "authorized_at", "pharmaceutical_form_id", "pharmaceutical_form_code", "pharmaceutical_form_name")


@query("SELECT name, registration_number, position, code FROM (SELECT 'presentations' AS name, CAST(p_partkey AS VARCHAR) AS registration_number, 0::BIGINT AS position, 'n' || p_partkey AS code FROM part UNION ALL SELECT 'active_ingredients', CAST(p_partkey AS VARCHAR), 0, 'c3' FROM part UNION ALL SELECT 'active_ingredients', CAST(p_partkey AS VARCHAR), 1, 'c4' FROM part UNION ALL SELECT 'excipients', CAST(p_partkey AS VARCHAR), 0, CAST(p_partkey % 4 AS VARCHAR) FROM part UNION ALL SELECT 'atc_codes', CAST(p_partkey AS VARCHAR), 0, 'A' FROM part UNION ALL SELECT 'atc_codes', CAST(p_partkey AS VARCHAR), 1, p_brand FROM part UNION ALL SELECT 'administration_routes', CAST(p_partkey AS VARCHAR), 0, 'c5' FROM part UNION ALL SELECT 'document_links', CAST(p_partkey AS VARCHAR), 0, 'u' FROM part UNION ALL SELECT 'photos', CAST(p_partkey AS VARCHAR), 0, 'f' FROM part)")
def ns01_medicine_children(spark: SparkSession, d: str) -> DataFrame:
    """One record to its seven child tables, with positions (WN-04)."""
    t = _medicines(spark, d)
    code = {"presentations": "national_code", "active_ingredients": "ingredient_code", "excipients": "source_order", "atc_codes": "atc_code", "administration_routes": "route_code", "document_links": "url", "photos": "url"}
    frames = [t[n].select(F.lit(n).alias("name"), "registration_number", F.col("position").cast("long").alias("position"), F.col(c).cast("string").alias("code")) for n, c in code.items()]
    return relational.tagged_union(dict(enumerate(frames)), "_").drop("_")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS registration_number, CAST(o_orderkey % 2 AS BIGINT) AS document_type, section, source_order, CASE WHEN section = '4' THEN o_orderpriority || ' b' END AS content_text FROM orders, (SELECT unnest(['4', '5']) AS section, unnest([7::BIGINT, 1::BIGINT]) AS source_order)")
def ns02_leaflet_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections listed at the top or under a field, ordered by their own number or their place (FN-01)."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    sections = F.concat(F.lit('[{"seccion":"4","orden":7,"contenido":"<p>'), "o_orderpriority", F.lit('&nbsp;b</p>"},{"seccion":"5"}]'))
    listed = F.when(k % 2 == 0, sections).otherwise(F.concat(F.lit('{"resultados":'), sections, F.lit("}")))
    line = F.concat(F.lit('{"nregistro":"'), k.cast("string"), F.lit('","document_type":'), (k % 2).cast("string"), F.lit(',"sections":'), listed, F.lit("}"))
    return nested.leaflet_sections(_lines(o, line)).select("registration_number", "document_type", "section", "source_order", "content_text")


@query("SELECT CAST(event_id AS VARCHAR) AS registration_number, event_id AS changed_at, CASE event_id % 4 WHEN 1 THEN 'new' ELSE 'other' END AS kind, f AS changed_field FROM events, LATERAL (SELECT unnest(CASE event_id % 3 WHEN 0 THEN ['a', event_type] WHEN 1 THEN [event_type] ELSE [NULL] END) AS f)")
def ns03_register_changes(spark: SparkSession, d: str) -> DataFrame:
    """One row per changed field, one with null where none is named (JN-12)."""
    e, k = table(spark, d, "events"), F.col("event_id")
    field = F.when(k % 3 == 0, F.concat(F.lit(',"cambios":["a","'), "event_type", F.lit('"]'))).when(k % 3 == 1, F.concat(F.lit(',"cambio":"'), "event_type", F.lit('"'))).otherwise(F.lit(',"cambios":[]'))
    line = F.concat(F.lit('{"nregistro":"'), k.cast("string"), F.lit('","fecha":'), k.cast("string"), F.lit(',"tipoCambio":'), (k % 4).cast("string"), field, F.lit("}"))
    return nested.register_changes(_lines(e, line)).select("registration_number", "changed_at", F.when(F.col("change_type_name") == "new", "new").otherwise("other").alias("kind"), "changed_field")


@query("SELECT count(*) FILTER (WHERE event_id % 5 <> 0) - (count(*) FILTER (WHERE event_id % 5 <> 0) - count(DISTINCT CASE WHEN event_id % 5 <> 0 THEN user_id END)) AS valid, count(*) FILTER (WHERE event_id % 5 = 0) AS malformed, count(*) FILTER (WHERE event_id % 5 <> 0) - count(DISTINCT CASE WHEN event_id % 5 <> 0 THEN user_id END) AS duplicates FROM events")
def src12_repaired_lines(spark: SparkSession, d: str) -> DataFrame:
    """Counts of JSON lines kept, malformed and repeated (WN-02)."""
    e = table(spark, d, "events")
    line = F.when(F.col("event_id") % 5 == 0, F.lit("{broken")).otherwise(F.concat(F.lit('{"id":"'), _t("user_id"), F.lit('"}')))
    return nested.repaired_lines(_lines(e, line), "id")[1]


@query("SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS product_name, p_brand AS brands, '' AS labels, '{\"energy-kcal_100g\":' || p_size || '}' AS nutriments_json FROM part")
def ns05_products(spark: SparkSession, d: str) -> DataFrame:
    """Products of JSON lines, nested values kept as JSON, bad lines left out (SRC-13)."""
    p = table(spark, d, "part")
    line = F.concat(F.lit('{"code":"'), _t("p_partkey"), F.lit('","product_name":"'), "p_name", F.lit('","brands":"'), "p_brand", F.lit('","nutriments":{"energy-kcal_100g":'), _t("p_size"), F.lit("}}"))
    both = p.select(F.explode(F.array(line, F.lit("bad"))).alias("v"))
    return nested.product_rows(_lines(both, F.col("v"))).select("code", "product_name", "brands", "labels", "nutriments_json")


def _entities(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    n, k = table(spark, d, "nation"), F.col("n_nationkey").cast("string")
    line = F.concat(F.lit('{"id":"Q'), k, F.lit('","type":"item","lastrevid":'), k, F.lit(',"labels":{"en":{"value":"'), "n_name", F.lit('"}},"descriptions":{"es":{"value":"país '), k, F.lit('"}},"aliases":{"en":[{"value":"a'), k, F.lit('"},{"value":"b"}]},"sitelinks":{"enwiki":{"title":"T'), k, F.lit('"}},"claims":{"P1":[{"id":"Q'), k, F.lit('$1","rank":"normal","mainsnak":{"v":'), _t("n_regionkey"), F.lit("}}]}},"))
    return nested.entity_tables(_lines(n, line))


@query("SELECT 'Q' || n_nationkey AS entity_id, term_type, language, CASE term_type WHEN 'label' THEN n_name WHEN 'description' THEN 'país ' || n_nationkey ELSE v END AS value FROM nation, (SELECT unnest(['label', 'description', 'alias', 'alias']) AS term_type, unnest(['en', 'es', 'en', 'en']) AS language, unnest([1, 2, 3, 4]) AS i), LATERAL (SELECT CASE i WHEN 3 THEN 'a' || n_nationkey ELSE 'b' END AS v)")
def ns04_entity_terms(spark: SparkSession, d: str) -> DataFrame:
    """Labels, descriptions and aliases of entities."""
    return _entities(spark, d)["terms"].select("entity_id", "term_type", "language", "value")


@query("SELECT 'Q' || n_nationkey AS entity_id, 'P1' AS property_id, 'Q' || n_nationkey || '$1' AS statement_id, '{\"v\":' || n_regionkey || '}' AS mainsnak_json, '{}' AS qualifiers_json, CAST(n_nationkey AS BIGINT) AS last_revision_id, 'T' || n_nationkey AS title FROM nation")
def src14_entity_claims(spark: SparkSession, d: str) -> DataFrame:
    """Claims, sitelinks and entities of a JSON array with one entity a line."""
    t = _entities(spark, d)
    out = t["claims"].join(t["entities"].select("entity_id", "last_revision_id"), "entity_id").join(t["sitelinks"].select("entity_id", "title"), "entity_id")
    return out.select("entity_id", "property_id", "statement_id", "mainsnak_json", "qualifiers_json", "last_revision_id", "title")


@query("SELECT CAST(session_number AS INTEGER) AS session_number, CAST(vote_number AS INTEGER) AS vote_number, coalesce(deputy_name, '') AS deputy_name, coalesce(parliamentary_group, '') AS parliamentary_group, coalesce(seat, '') AS seat, coalesce(vote, '') AS vote FROM deputy_votes WHERE session_number IS NOT NULL AND vote_number IS NOT NULL")
def ns12_deputy_votes(spark: SparkSession, d: str) -> DataFrame:
    """Votes of ballots in one JSON document each, nulls to blanks (SRC-15, FN-27)."""
    v = table(spark, d, "deputy_votes").where(F.col("session_number").isNotNull() & F.col("vote_number").isNotNull())
    one = F.struct(F.col("deputy_name").alias("diputado"), F.col("parliamentary_group").alias("grupo"), F.col("seat").alias("asiento"), F.col("vote").alias("voto"))
    # A ballot has a hundred deputies.
    b = v.groupBy("legislature", "session_number", "vote_number").agg(F.collect_list(one).alias("votaciones"))
    doc = F.to_json(F.struct(F.struct(F.col("session_number").alias("sesion"), F.col("vote_number").alias("numeroVotacion")).alias("informacion"), "votaciones"))
    out = nested.ballot_tables(b.select(doc.alias("text")), 15)["deputy_votes"]
    return out.select("session_number", "vote_number", "deputy_name", "parliamentary_group", "seat", "vote")


_PDF = r"regexp_extract(enlace_pdf, '([^/#?]+\.[Pp][Dd][Ff])', 1)"
_PAGE = "coalesce(nullif(regexp_extract(enlace_pdf, 'page=([0-9]{1,9})', 1), ''), '1')"


@query(f"SELECT orador, CASE WHEN coalesce({_PDF}, '') = '' THEN '' ELSE {_PDF} || ' p' || {_PAGE} END AS speech_text FROM intervenciones")
def src16_speech_pages(spark: SparkSession, d: str) -> DataFrame:
    """Speeches take the text of the page that their link points to, blank where there is none (JN-07)."""
    i = table(spark, d, "intervenciones")
    pages = planning.needed_pages(i, "enlace_pdf")
    pages = pages.withColumn("text", F.concat("pdf_name", F.lit(" p"), F.col("page").cast("string")))
    return nested.speeches_with_text(i, pages).select("orador", "speech_text")


_PRICED = "timestamp_utc IS NOT NULL AND zone_key IS NOT NULL AND price IS NOT NULL AND NOT isnan(price) AND resolution IN ('PT15M', 'PT30M', 'PT60M', 'PT1H') AND coalesce(contract_type, 'A01') = 'A01'"


@query(f"SELECT p.zone_key, epoch_us(timestamp_utc) AS at_us, resolution, price, 'EUR' AS currency, coalesce(z.name, '') AS zone_name, CAST(1 AS INTEGER) AS revision_number, sha256('day_ahead_prices|' || p.zone_key || '|' || strftime(timestamp_utc AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S+00:00') || '|' || resolution || '|A62|A01||') AS record_id FROM (SELECT * FROM day_ahead_prices WHERE {_PRICED}) p LEFT JOIN zones z ON z.zone_key = p.zone_key")
def ns06_market_documents(spark: SparkSession, d: str) -> DataFrame:
    """Market documents: three levels exploded with inherited fields, other contracts and empty points left out (SRC-17, FLT-02, FN-14 to FN-16)."""
    p = table(spark, d, "day_ahead_prices").where(F.expr(_PRICED))
    tag = lambda n, v: F.concat(F.lit(f"<{n}>"), v if isinstance(v, Column) else F.lit(v), F.lit(f"</{n}>"))
    series = lambda contract, points: tag("TimeSeries", F.concat(tag("mRID", "1"), tag("businessType", "A62"), tag("contract_MarketAgreement.type", contract), tag("currency_Unit.name", "EUR"), tag("Period", F.concat(tag("timeInterval", tag("start", F.date_format("timestamp_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'"))), tag("resolution", F.col("resolution")), points))))
    point = lambda n, v: tag("Point", F.concat(tag("position", n), tag("price.amount", v)))
    text_ = tag("Publication_MarketDocument", F.concat(tag("mRID", "d"), tag("revisionNumber", "1"), series("A01", F.concat(point("1", F.col("price").cast("string")), tag("Point", tag("position", "2")))), series("A07", point("1", "5"))))
    docs = p.select(text_.alias("text"), "zone_key", F.lit("f.xml").alias("source_file"))
    out = markup.market_rows(docs, "day_ahead_prices", table(spark, d, "zones"))
    return out.select("zone_key", F.unix_micros("timestamp_utc").alias("at_us"), "resolution", "price", "currency", _t("zone_name").alias("zone_name"), "revision_number", "record_id")


def _feeds(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    key = k.cast("string")
    code = lambda v: F.concat(F.lit("<RequiredCommodityClassification><ItemClassificationCode name='n'>"), v, F.lit("</ItemClassificationCode></RequiredCommodityClassification>"))
    lot = lambda i: F.concat(F.lit("<ProcurementProjectLot><ProcurementProject><Name>lot "), key, F.lit(f"</Name>{'' if i else ''}"), code(F.lit("3851")), F.lit("</ProcurementProject></ProcurementProjectLot>"))
    award = F.concat(F.lit("<TenderResult><AwardDate>2025-02-01</AwardDate><ReceivedTenderQuantity>"), (k % 9).cast("string"), F.lit("</ReceivedTenderQuantity><WinningParty><PartyIdentification><ID schemeName='NIF'>B"), key, F.lit("</ID></PartyIdentification></WinningParty><AwardedTenderedProject><LegalMonetaryTotal><TaxExclusiveAmount currencyID='EUR'>"), (k * 10).cast("string"), F.lit("</TaxExclusiveAmount></LegalMonetaryTotal></AwardedTenderedProject></TenderResult><TenderResult><ResultCode>3</ResultCode></TenderResult>"))
    entry = F.concat(F.lit("<entry><id>t/"), key, F.lit("</id><title>"), "c_name", F.lit("</title><updated>2025-01-02T10:00:00Z</updated><content><ContractFolderStatus><ContractFolderID>E"), key, F.lit("</ContractFolderID><LocatedContractingParty><Party><PartyIdentification><ID schemeName='NIF'>S1</ID></PartyIdentification><PartyName><Name>"), "c_mktsegment", F.lit("</Name></PartyName></Party></LocatedContractingParty><ProcurementProject><BudgetAmount><EstimatedOverallContractAmount currencyID='EUR'>"), (k * 100).cast("string"), F.lit("</EstimatedOverallContractAmount></BudgetAmount>"), code(F.concat(F.lit("38"), key)), F.lit("</ProcurementProject>"), lot(0), lot(1), award, F.lit("</ContractFolderStatus></content></entry>"))
    feed = F.concat(F.lit("<feed>"), entry, F.lit("<deleted-entry ref='g/"), key, F.lit("' when='2025-02-03T12:00:00Z'/></feed>"))
    return markup.procurement_tables(materialize(c.select(F.lit("/x/a.zip").alias("archive"), F.lit("f.atom").alias("member"), feed.alias("text")), "feeds"))


@query("SELECT * FROM (SELECT 't/' || c_custkey AS atom_id, false AS is_deleted, epoch_us(TIMESTAMP '2025-01-02 10:00:00') AS updated_us, 'E' || c_custkey AS folder_id, CAST(c_custkey * 100 AS DOUBLE) AS estimated_value, 'EUR' AS currency, c_mktsegment AS contracting_party_name, 'S1' AS contracting_party_nif, sha256('t/' || c_custkey || chr(31) || '2025-01-02T10:00:00Z' || chr(31) || '0') AS version_id FROM customer UNION ALL SELECT 'g/' || c_custkey, true, epoch_us(TIMESTAMP '2025-02-03 12:00:00'), NULL, NULL, NULL, NULL, NULL, sha256('g/' || c_custkey || chr(31) || '2025-02-03T12:00:00Z' || chr(31) || '1') FROM customer)")
def src18_procurement_versions(spark: SparkSession, d: str) -> DataFrame:
    """Versions of contracts, deleted entries as versions of their own (FN-17, FN-26)."""
    return _feeds(spark, d)["versions"].select("atom_id", "is_deleted", F.unix_micros("updated_at").alias("updated_us"), "folder_id", "estimated_value", "currency", "contracting_party_name", "contracting_party_nif", "version_id")


@query("SELECT CAST(i AS VARCHAR) AS lot_id, 'lot ' || c_custkey AS name FROM customer, (SELECT unnest([1, 2]) AS i)")
def ns07_procurement_lots(spark: SparkSession, d: str) -> DataFrame:
    """Lots numbered by their place."""
    return _feeds(spark, d)["lots"].select("lot_id", "name")


@query("SELECT coalesce(lot, '') AS lot_id, CASE WHEN lot IS NULL THEN '38' || c_custkey ELSE '3851' END AS cpv_code, 'n' AS cpv_name FROM customer, (SELECT unnest([NULL, '1', '2']) AS lot)")
def ns08_procurement_codes(spark: SparkSession, d: str) -> DataFrame:
    """Classification codes of contracts and of their lots."""
    return _feeds(spark, d)["cpv_codes"].select(_t("lot_id").alias("lot_id"), "cpv_code", "cpv_name")


@query("SELECT CAST(k AS INTEGER) AS result_position, CAST(1 AS INTEGER) AS winner_position, CASE WHEN k = 1 THEN 'B' || c_custkey ELSE '' END AS winner_nif, CASE WHEN k = 1 THEN CAST(c_custkey * 10 AS DOUBLE) END AS award_tax_exclusive, CASE WHEN k = 1 THEN c_custkey % 9 END AS received_tenders FROM customer, (SELECT unnest([1, 2]) AS k)")
def ns09_procurement_awards(spark: SparkSession, d: str) -> DataFrame:
    """Awards by result and winner, results without a winner kept."""
    return _feeds(spark, d)["awards"].select("result_position", "winner_position", _t("winner_nif").alias("winner_nif"), "award_tax_exclusive", "received_tenders")


@query("SELECT 'oc-' || site_id AS local_id, site_kind AS condition_of_construction, floor(longitude) AS bbox_min_x, floor(latitude) AS bbox_min_y, floor(longitude) + 1 AS bbox_max_x, floor(latitude) + 1 AS bbox_max_y FROM sites")
def src19_map_features(spark: SparkSession, d: str) -> DataFrame:
    """Features of GML documents with geometry and box, element by element (NS-10, FN-29)."""
    s = table(spark, d, "sites")
    x, y = F.floor("longitude"), F.floor("latitude")
    corner = lambda i, j: F.concat((x + i).cast("string"), F.lit(" "), (y + j).cast("string"))
    ring = F.concat_ws(" ", corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 0))
    gml = F.concat(F.lit('<c xmlns:bu="urn:bu" xmlns:gml="http://www.opengis.net/gml/3.2" xmlns:base="urn:base" xmlns:xlink="http://www.w3.org/1999/xlink"><bu:OtherConstruction gml:id="oc-'), _t("site_id"), F.lit('"><base:Identifier><base:localId>oc-'), _t("site_id"), F.lit('</base:localId></base:Identifier><bu:conditionOfConstruction xlink:href="'), "site_kind", F.lit('"/><bu:geometry><gml:Polygon srsName="urn:ogc:def:crs:EPSG::4326"><gml:exterior><gml:LinearRing><gml:posList srsDimension="2">'), ring, F.lit("</gml:posList></gml:LinearRing></gml:exterior></gml:Polygon></bu:geometry></bu:OtherConstruction></c>"))
    texts = s.select(F.lit("/x/a.zip").alias("archive"), F.lit("a.gml").alias("member"), gml.alias("text"), F.lit("02").alias("province_code"), F.lit("02001").alias("municipality_code"), F.lit("A").alias("municipality_name"))
    return markup.feature_table(markup.read_features(texts), "other_constructions").select("local_id", "condition_of_construction", "bbox_min_x", "bbox_min_y", "bbox_max_x", "bbox_max_y")


@query("SELECT 'f' || doc_id AS name, md5(CAST(doc_id AS VARCHAR)) AS md5, doc_id AS bytes FROM documents")
def src27_manifests(spark: SparkSession, d: str) -> DataFrame:
    """Checksum and size manifests, other lines left out."""
    t, k = table(spark, d, "documents"), F.col("doc_id").cast("string")
    sums = _lines(t.select(F.explode(F.array(F.concat(F.md5(k), F.lit("  f"), k), F.lit("not a sum  x"))).alias("v")), F.col("v"))
    sizes = _lines(t.select(F.concat(k, F.lit(" f"), k).alias("v")), F.col("v"))
    return archives.manifest_checksums(sums).join(archives.manifest_sizes(sizes), "name")


@query("SELECT min(event_id) AS least, max(event_id) AS greatest, count(*) AS n FROM events")
def src23_written_extremes(spark: SparkSession, d: str) -> DataFrame:
    """Extremes of a table just written, from its footers (SNK-02)."""
    path = scratch_path(spark, "rolling")
    sinks.write_rolling(table(spark, d, "events"), path, 1000)
    e = parquet.footer_extremes(spark, path, {"id": "event_id"})
    return e.select(F.col("min_id").alias("least"), F.col("max_id").alias("greatest"), F.col("rows").alias("n"))


@query("SELECT (r - 1) // 700 AS shard, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders) GROUP BY 1")
def snk01_exact_shards(spark: SparkSession, d: str) -> DataFrame:
    """Shards of exactly so many rows, written and read back (SNK-03)."""
    path = scratch_path(spark, "shards")
    sinks.write_exact_shards(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), path, ["o_orderkey"], 700)
    return spark.read.parquet(path).groupBy(F.col("shard").cast("long").alias("shard")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))


@query("SELECT true AS within, count(*) AS n FROM lineitem")
def snk02_rolling_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of at most so many rows, without a shuffle (SNK-06, SNK-15)."""
    path = scratch_path(spark, "rolled")
    sinks.write_rolling(table(spark, d, "lineitem"), path, 5000)
    by_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"))
    return by_file.agg((F.max("n") <= 5000).alias("within"), F.sum("n").alias("n"))


@query("SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total, true AS sorted FROM events GROUP BY 1 UNION ALL SELECT '_all', count(*), CAST(sum(event_id) AS BIGINT), true FROM events")
def snk05_tables_by_value(spark: SparkSession, d: str) -> DataFrame:
    """Folders by value, sorted inside, and the table of all beside them (SNK-04, LM-03)."""
    path = scratch_path(spark, "by")
    e = table(spark, d, "events").select("event_type", "event_id")
    sinks.write_by(e, path, ["event_type"], ["event_id"], everything="_all")
    parts = spark.read.parquet(path).withColumn("f", F.input_file_name()).withColumn("at", F.monotonically_increasing_id())
    order = parts.groupBy("f").agg((F.array_sort(F.collect_list(F.struct("at", "event_id")))["event_id"] == F.array_sort(F.collect_list("event_id"))).alias("ok")).agg(F.bool_and("ok").alias("sorted"))
    out = parts.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("total")).unionByName(spark.read.parquet(f"{path}_all").agg(F.lit("_all").alias("event_type"), F.count("*").alias("n"), F.sum("event_id").alias("total")))
    return out.withColumn("sorted", F.lit(order.first().sorted))


@query("SELECT 'region' AS name, count(*) AS counted, count(*) AS n FROM region UNION ALL SELECT 'nation', count(*), count(*) FROM nation UNION ALL SELECT 'none', 0, 0")
def snk07_counted_tables(spark: SparkSession, d: str) -> DataFrame:
    """Several tables, each counted while it is written."""
    path = scratch_path(spark, "tables")
    counts = sinks.write_tables({"region": table(spark, d, "region"), "nation": table(spark, d, "nation"), "none": table(spark, d, "nation").limit(0)}, path, 10)
    frames = {n: spark.read.parquet(f"{path}/{n}").agg(F.lit(n).alias("name"), F.lit(c).cast("long").alias("counted"), F.count("*").alias("n")) for n, c in counts.items()}
    return relational.tagged_union(frames, "_").drop("_")


@query("SELECT min(floor(longitude)) AS xmin, min(floor(latitude)) AS ymin, max(floor(longitude) + 1) AS xmax, max(floor(latitude) + 1) AS ymax, 'WKB' AS encoding, 'Polygon' AS kinds FROM sites")
def snk08_geometry_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Geometry metadata of a written table, worked out from its rows, read back from the sidecar."""
    path = scratch_path(spark, "geo")
    box = [F.floor("longitude").cast("double"), F.floor("latitude").cast("double"), (F.floor("longitude") + 1).cast("double"), (F.floor("latitude") + 1).cast("double")]
    table(spark, d, "sites").select(F.unhex(F.lit("010300000000000000")).alias("geometry"), *[c.alias(n) for c, n in zip(box, sinks.BOX)]).write.parquet(path)
    sinks.geo_metadata(spark, path)
    column = files.read_json(f"{path}/_geo.json")["columns"]["geometry"]
    return spark.createDataFrame([(*column["bbox"], column["encoding"], ",".join(column["geometry_types"]))], "xmin double, ymin double, xmax double, ymax double, encoding string, kinds string")


@query("SELECT n_name AS name, CAST(n_nationkey AS BIGINT) AS k FROM nation")
def snk09_json_artifact(spark: SparkSession, d: str) -> DataFrame:
    """A JSON artifact put in place at once and read back (FN-31)."""
    path = f"{scratch_path(spark, 'artifact')}/profile.json"
    sinks.atomic_json([{"name": r.n_name, "k": r.n_nationkey, "bad": float("nan")} for r in table(spark, d, "nation").collect()], path)
    return spark.createDataFrame([(x["name"], x["k"]) for x in files.read_json(path)], "name string, k long")


@query("SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation")
def snk10_appended_lines(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines appended twice."""
    path = scratch_path(spark, "appended")
    for _ in range(2):
        sinks.append_json_lines(table(spark, d, "nation").select("n_nationkey", "n_name"), path)
    return spark.read.schema("n_nationkey int, n_name string").json(path)


@query("SELECT 'r' || r_regionkey || '.txt' AS name, CAST(strlen(r_name) AS BIGINT) AS bytes, sha256(r_name) AS sha256 FROM region")
def snk11_checksums(spark: SparkSession, d: str) -> DataFrame:
    """Bytes and SHA-256 of files (FN-18)."""
    path = scratch_path(spark, "sums")
    for r in table(spark, d, "region").collect():
        files.put_text(f"{path}/r{r.r_regionkey}.txt", r.r_name)
    return sinks.checksum_manifest(spark.read.format("binaryFile").load(path)).select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "bytes", "sha256")


@query("SELECT r_name, true AS listed, 'refused' AS failing FROM region")
def snk12_staged(spark: SparkSession, d: str) -> DataFrame:
    """Tables copied with a manifest by executors; refused where a check fails (SNK-13, DQ-14)."""
    path, r = scratch_path(spark, "staging"), table(spark, d, "region")
    sinks.write_rolling(r, f"{path}/in", 10)
    listed = sinks.stage(spark, f"{path}/in", f"{path}/none", f"{path}/out", quality.checks(r, {"ok": F.lit(False)}), "# card")
    try:
        sinks.stage(spark, f"{path}/in", f"{path}/none", f"{path}/out2", quality.checks(r, {"bad": F.lit(True)}))
        failing = "passed"
    except ValueError:
        failing = "refused"
    whole = {x["path"] for x in listed} >= {"README.md"} and any(x["path"].startswith("data/") for x in listed)
    return spark.read.parquet(f"{path}/out/data").select("r_name", F.lit(whole).alias("listed"), F.lit(failing).alias("failing"))


@query("SELECT vote_row_id, trim(title) AS title FROM deputy_votes WHERE title IS NOT NULL")
def fn02_mojibake(spark: SparkSession, d: str) -> DataFrame:
    """Titles read once as Latin-1, as they were meant."""
    broken = F.decode(F.encode("title", "UTF-8"), "ISO-8859-1")
    return table(spark, d, "deputy_votes").where(F.col("title").isNotNull()).select("vote_row_id", text.repair_mojibake(broken).alias("title"))


@query("SELECT o_orderkey, CAST(o_orderkey % 1000 + 1000 AS DOUBLE) + 0.25 AS number FROM orders")
def fn04_spanish_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers with grouping points and a decimal comma."""
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", numbers.spanish_double(F.concat(F.lit("1."), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(",25"))).alias("number"))


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN CAST(1.5 AS DOUBLE) WHEN 1 THEN 9 WHEN 2 THEN CAST(event_id % 7 AS DOUBLE) END AS intensity FROM events")
def fn07_intensities(spark: SparkSession, d: str) -> DataFrame:
    """Roman numerals, ranges of them and numbers; others null."""
    k = F.col("event_id")
    said = F.when(k % 5 == 0, "I-II").when(k % 5 == 1, " ix ").when(k % 5 == 2, (k % 7).cast("string")).when(k % 5 == 3, "-1").otherwise("I-Q")
    return table(spark, d, "events").select("event_id", text.intensity_number(said).alias("intensity"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'FR' WHEN 1 THEN 'ES' END AS code, CASE event_id % 3 WHEN 0 THEN 'FRA' WHEN 1 THEN 'LP' END AS suffix FROM events")
def fn08_place_suffixes(spark: SparkSession, d: str) -> DataFrame:
    """Suffix of a location and the country it tells (JN-08)."""
    k = F.col("event_id")
    place = F.when(k % 3 == 0, "N. Tarbes.fra").when(k % 3 == 1, "Mar.LP, Isla").otherwise("W Lisboa")
    return table(spark, d, "events").select("event_id", text.country_of(place, delimited.FOREIGN, delimited.SPANISH)["code"].alias("code"), text.location_suffix(place).alias("suffix"))


@query("SELECT event_id, epoch_us(date_trunc('second', ts)) AS day_time_us, CASE WHEN event_id % 3 = 0 THEN epoch_us(date_trunc('minute', ts)) ELSE epoch_us(date_trunc('second', ts)) - 3600000000 END AS iso_us, CAST(ts AS DATE) AS prefix, CAST(ts AS DATE) AS compact, epoch_us(date_trunc('second', ts)) AS compact_us FROM events")
def fn09_written_times(spark: SparkSession, d: str) -> DataFrame:
    """Days with times, ISO instants, date prefixes, compact dates and times (FN-09 to FN-12)."""
    at = lambda form: F.date_format("ts", form)
    iso = F.when(F.col("event_id") % 3 == 0, at("yyyy-MM-dd'T'HH:mm'Z'")).otherwise(F.concat(at("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00")))
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    return table(spark, d, "events").select("event_id", us(temporal.utc_day_time(at("d/M/yyyy"), at("H:m:s"))).alias("day_time_us"), us(temporal.iso_instant(iso)).alias("iso_us"), temporal.date_prefix(at("yyyy-MM-dd HH:mm")).alias("prefix"), temporal.compact_date(at("yyyyMMdd")).alias("compact"), us(temporal.compact_time(at("yyyyMMddHHmmss"))).alias("compact_us"))


@query("SELECT o_orderkey, CAST(m AS DATE) AS month FROM (SELECT o_orderkey, unnest(generate_series(date_trunc('month', o_orderdate), date_trunc('month', o_orderdate + INTERVAL 69 DAY), INTERVAL 1 MONTH)) AS m FROM orders)")
def fn13_month_starts(spark: SparkSession, d: str) -> DataFrame:
    """First days of the months that an interval meets."""
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", F.explode(planning.month_starts(day, F.date_add(day, 70))).alias("month"))


@query("SELECT intervention_id, 'Señorías ' || intervention_id || chr(10) || 'sí.' AS body FROM intervenciones")
def fn20_gazette_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Page texts without their running lines."""
    k = _t("intervention_id")
    page = F.concat(F.lit("DIARIO DE SESIONES DEL CONGRESO DE LOS DIPUTADOS\nPLENO Y DIPUTACIÓN PERMANENTE\nNúm. 12 2 de mayo de 2024 Pág. "), k, F.lit("\nSeñorías "), k, F.lit("\nsí.\n"))
    return table(spark, d, "intervenciones").select("intervention_id", text.gazette_body(page).alias("body"))


@query("SELECT doc_id, CASE WHEN length(text) > 200 THEN left(text, 200) || '…' ELSE text END AS short, CASE WHEN length(text) > 512 THEN 'sha256:' || sha256(text) || ':' || left(text, 80) ELSE text END AS key FROM documents")
def fn23_shortened(spark: SparkSession, d: str) -> DataFrame:
    """Texts cut with a mark, and digests as keys of long ones."""
    return table(spark, d, "documents").select("doc_id", text.shortened(F.col("text")).alias("short"), text.count_key(F.col("text")).alias("key"))


@query("SELECT site_id, 'https://x/' || replace(replace(site_name, ' ', '%20'), 'ñ', '%C3%B1') AS url FROM sites WHERE regexp_full_match(site_name, '[A-Za-z0-9ñ -]*')")
def fn25_quoted_urls(spark: SparkSession, d: str) -> DataFrame:
    """URLs with blanks and other letters encoded."""
    return table(spark, d, "sites").where(F.col("site_name").rlike("^[A-Za-z0-9ñ -]*$")).select("site_id", text.quoted_url(F.concat(F.lit("https://x/"), "site_name")).alias("url"))


@query("SELECT intervention_id, coalesce(CAST(speech_char_count AS VARCHAR), '') AS said, coalesce(speech_char_count, 0) AS counted, coalesce(nullif(autor, ''), cargo_orador) AS who FROM intervenciones")
def fn27_defaults(spark: SparkSession, d: str) -> DataFrame:
    """Texts or blanks, numbers or 0, the first that says something (FN-21, FN-26)."""
    return table(spark, d, "intervenciones").select("intervention_id", text.text_or_blank(F.col("speech_char_count")).alias("said"), text.number_or_zero(F.col("speech_char_count")).alias("counted"), text.first_truthy(F.col("autor"), F.col("cargo_orador")).alias("who"))


@query("SELECT o_orderkey, CASE WHEN n < 1024 THEN printf('%.1f B', n * 1.0) WHEN n < 1048576 THEN printf('%.1f KiB', n / 1024.0) ELSE printf('%.1f MiB', n / 1048576.0) END AS size FROM (SELECT o_orderkey, o_orderkey * 512 AS n FROM orders)")
def fn33_human_bytes(spark: SparkSession, d: str) -> DataFrame:
    """Bytes in the largest fitting unit."""
    return table(spark, d, "orders").select("o_orderkey", text.human_bytes(F.col("o_orderkey") * 512).alias("size"))


@query("SELECT site_id, true AS near FROM sites WHERE abs(latitude) < 80")
def fn28_utm(spark: SparkSession, d: str) -> DataFrame:
    """Web Mercator coordinates back to degrees, within a millionth."""
    @F.pandas_udf("boolean")
    def back(x: pd.Series, y: pd.Series, lon: pd.Series, lat: pd.Series) -> pd.Series:
        found = geo.to_degrees(list(zip(x, y)), 3857)
        return pd.Series([abs(a - c) < 1e-6 and abs(b - e) < 1e-6 for (a, b), c, e in zip(found, lon, lat)], dtype=bool)

    s = table(spark, d, "sites").where(F.abs("latitude") < 80)
    x, y = F.radians("longitude") * geo.AXIS, F.ln(F.tan(F.radians("latitude") / 2 + 3.141592653589793 / 4)) * geo.AXIS
    return s.select("site_id", back(x, y, F.col("longitude"), F.col("latitude")).alias("near"))


@query("SELECT event_id, CASE length(p) WHEN 4 THEN 'year' WHEN 6 THEN 'month' ELSE 'day' END AS kind, CAST(CASE length(p) WHEN 4 THEN strptime(p || '0101', '%Y%m%d') WHEN 6 THEN strptime(p || '01', '%Y%m%d') ELSE strptime(p, '%Y%m%d') END AS DATE) AS first_day FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(1979 + event_id % 27 AS VARCHAR) WHEN 1 THEN CAST(2006 + event_id % 7 AS VARCHAR) || '05' ELSE strftime(ts, '%Y%m%d') END AS p FROM events)")
def pln04_export_spans(spark: SparkSession, d: str) -> DataFrame:
    """What span of time the file names of exports tell (FLT-06)."""
    k = F.col("event_id")
    name = F.when(k % 3 == 0, F.concat((k % 27 + 1979).cast("string"), F.lit(".zip"))).when(k % 3 == 1, F.concat((k % 7 + 2006).cast("string"), F.lit("05.zip"))).otherwise(F.concat(F.date_format("ts", "yyyyMMdd"), F.lit(".export.CSV.zip")))
    return table(spark, d, "events").withColumn("s", planning.span_named(name)).select("event_id", "s.kind", "s.first_day")


@query("SELECT CAST(d AS DATE) AS day FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)")
def pln05_day_range(spark: SparkSession, d: str) -> DataFrame:
    """Every day between the first and the last order (PLN-02: as shards of one day each)."""
    low, high = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).agg(F.min("day"), F.max("day")).first()
    days, shards = planning.day_range(spark, str(low), str(high)), planning.date_shards(spark, str(low), str(high), coarse_years=5, coarse_until=low.year, daily=[(str(low), str(high))])
    return days.join(shards, (F.col("day") == F.col("shard_start")) & (F.col("day") == F.col("shard_end"))).select("day")


@query("SELECT CAST(y AS VARCHAR) AS period FROM (SELECT unnest(range(1992, 1997)) AS y) UNION ALL SELECT strftime(m, '%Y%m') FROM (SELECT unnest(generate_series(DATE '1997-01-01', DATE '1998-08-01', INTERVAL 1 MONTH)) AS m)")
def pln03_release_periods(spark: SparkSession, d: str) -> DataFrame:
    """Yearly, then monthly periods."""
    return planning.release_periods(spark, 1992, 1996, 1998, 8)


@query("SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS registration_number, CAST(o_orderkey % 4 AS INTEGER) AS document_type FROM orders WHERE o_orderkey % 4 IN (1, 2) AND o_orderkey % 3 <> 0 AND o_custkey % 5 <> 0")
def pln07_document_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Documents of two kinds that are not fetched yet."""
    o = table(spark, d, "orders")
    docs = o.select(F.col("o_custkey").cast("string").alias("registration_number"), (F.col("o_orderkey") % 4).cast("int").alias("document_type"), (F.col("o_orderkey") % 3 != 0).alias("segmented_content_available"))
    done = o.where(F.col("o_custkey") % 5 == 0).select(F.col("o_custkey").cast("string").alias("registration_number"), (F.col("o_orderkey") % 4).cast("int").alias("document_type")).unionByName(o.where(F.col("o_custkey") % 5 == 0).select(F.col("o_custkey").cast("string").alias("registration_number"), F.explode(F.array(F.lit(1), F.lit(2))).alias("document_type")))
    return planning.document_tasks(docs, done)


@query("SELECT zone_key, count(*) AS n FROM day_ahead_prices WHERE timestamp_utc >= TIMESTAMPTZ '2026-05-01 00:00:00+00' AND timestamp_utc < TIMESTAMPTZ '2026-06-01 00:00:00+00' AND zone_key IS NOT NULL GROUP BY 1")
def flt07_date_range(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a range of dates, by an interval table (JN-06)."""
    month = spark.range(1).select(F.lit("2026-05-01T00:00:00Z").cast("timestamp").alias("start"), F.lit("2026-06-01T00:00:00Z").cast("timestamp").alias("end"))
    prices = table(spark, d, "day_ahead_prices").where(F.col("zone_key").isNotNull()).select("zone_key", "timestamp_utc")
    return relational.within(prices, month, "timestamp_utc", "start", "end").groupBy("zone_key").agg(F.count("*").alias("n"))


@query("SELECT fase, organo, count(*) AS n FROM intervenciones WHERE organo = 'Pleno' AND coalesce(speech_text, '') <> '' GROUP BY 1, 2")
def flt09_filtered_counts(spark: SparkSession, d: str) -> DataFrame:
    """Speeches of one body that have a text, by phase."""
    i = table(spark, d, "intervenciones").where((F.col("organo") == "Pleno") & (F.coalesce("speech_text", F.lit("")) != ""))
    return i.groupBy("fase", "organo").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL ORDER BY 1 LIMIT 5")
def lm04_first_distinct(spark: SparkSession, d: str) -> DataFrame:
    """First distinct values in order."""
    return relational.first_distinct(table(spark, d, "part"), "p_brand", 5)


@query("SELECT vec_id, CAST(p AS INTEGER) AS position, embedding[p] AS item FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings)")
def wn05_positions_from_one(spark: SparkSession, d: str) -> DataFrame:
    """Positions counted from 1 (NS-13)."""
    return relational.positions(table(spark, d, "embeddings").select("vec_id", "embedding"), "embedding", start=1)


@query("SELECT 'price_not_null' AS check_name, count(*) FILTER (WHERE price IS NULL) AS failing, count(*) FILTER (WHERE price IS NULL) = 0 AS passed FROM day_ahead_prices UNION ALL SELECT 'zone_key_not_null', count(*) FILTER (WHERE zone_key IS NULL), count(*) FILTER (WHERE zone_key IS NULL) = 0 FROM day_ahead_prices")
def dq05_required(spark: SparkSession, d: str) -> DataFrame:
    """Nulls in required columns (DQ-04)."""
    return quality.required_check(table(spark, d, "day_ahead_prices"), ["price", "zone_key"])


@query("SELECT 'infinite' AS check_name, count(*) FILTER (WHERE isnan(value) OR isinf(value)) AS failing, count(*) FILTER (WHERE isnan(value) OR isinf(value)) = 0 AS passed FROM measurements UNION ALL SELECT 'min_rows', greatest(1000000000 - count(*), 0), count(*) >= 1000000000 FROM measurements")
def dq06_finite_and_rows(spark: SparkSession, d: str) -> DataFrame:
    """Values that are no numbers, and the least number of rows (DQ-10)."""
    return quality.checks(table(spark, d, "measurements"), {"infinite": F.isnan("value") | (F.abs("value") == float("inf"))}, min_rows=1_000_000_000)


@query("SELECT true AS same, false AS other FROM region LIMIT 1")
def dq08_schemas(spark: SparkSession, d: str) -> DataFrame:
    """Whether files have one schema."""
    r, n = table(spark, d, "region"), table(spark, d, "nation")
    return spark.createDataFrame([(quality.same_schema([r, r.limit(1)]), quality.same_schema([r, n]))], "same boolean, other boolean")


@query("SELECT 'record_id_not_null' AS check_name, 0::BIGINT AS failing, true AS passed UNION ALL SELECT 'subject_not_null', count(*) FILTER (WHERE subject IS NULL), count(*) FILTER (WHERE subject IS NULL) = 0 FROM triples")
def dq11_statement_report(spark: SparkSession, d: str) -> DataFrame:
    """Report of what is known of a statement table."""
    return quality.required_check(table(spark, d, "triples").withColumn("record_id", F.coalesce("record_id", F.lit(""))), ["record_id", "subject"])


@query("SELECT r_name AS name, true AS sound, false AS cut FROM region")
def dq12_sound_archives(spark: SparkSession, d: str) -> DataFrame:
    """Archives are sound by size, MD5 and their members; cut ones are not."""
    import hashlib
    import io
    import zipfile

    path, rows = scratch_path(spark, "archives"), []
    for r in table(spark, d, "region").collect():
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            z.writestr("x.csv", r.r_name)
        data, at = packed.getvalue(), f"{path}/{r.r_regionkey}.zip"
        for name, body in ((at, data), (f"{path}/cut-{r.r_regionkey}.zip", data[:-30])):
            system, local = files.located(name)
            system.create_dir(local.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(local) as out:
                out.write(body)
        rows.append((r.r_name, archives.is_sound_archive(at, len(data), hashlib.md5(data).hexdigest()), archives.is_sound_archive(f"{path}/cut-{r.r_regionkey}.zip")))
    return spark.createDataFrame(rows, "name string, sound boolean, cut boolean")


@query("SELECT 'c' || c_custkey AS municipality_code, c_name AS municipality_name, 'p' AS parcels_archive_url, 'a' || c_custkey AS addresses_archive_url FROM customer")
def pln06_municipalities(spark: SparkSession, d: str) -> DataFrame:
    """One row per municipality with the archives of its collections (JN-11)."""
    from almazara.plans import pipelines

    c, key = table(spark, d, "customer"), F.col("c_custkey").cast("string")
    tasks = c.select(F.concat(F.lit("c"), key).alias("municipality_code"), F.col("c_name").alias("municipality_name"), F.lit("02").alias("province_code"), F.explode(F.array(F.struct(F.lit("parcels").alias("collection"), F.lit("p").alias("url")), F.struct(F.lit("addresses").alias("collection"), F.concat(F.lit("a"), key).alias("url")))).alias("t")).select("municipality_code", "municipality_name", "province_code", "t.collection", "t.url")
    return pipelines.municipality_table(tasks).select("municipality_code", "municipality_name", "parcels_archive_url", "addresses_archive_url")
