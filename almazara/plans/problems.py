"""Queries of the core problems: problem N's are named pN_..."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almazara.functions.durations import duration_seconds
from almazara.operators import grid, spatial, spikes, timestamps, units, wide
from almazara.runtime import table

#: How the catalogue's IRIs are abbreviated (a parameter of the data set).
PREFIXES = {"cat": "http://catalogo.example/def/"}


def _price_grid(spark: SparkSession, d: str, **options) -> DataFrame:
    prices = table(spark, d, "day_ahead_prices").select("zone_key", "timestamp_utc", "price", "revision_number", "record_id", duration_seconds(F.col("resolution")).alias("step"))
    newest = [F.coalesce("revision_number", F.lit(-1)), F.coalesce("record_id", F.lit(""))]
    return grid.regular_grid(prices, keys=["zone_key"], ts="timestamp_utc", step="step", value="price", order=newest, **options)


def p1_grid(spark: SparkSession, d: str) -> DataFrame:
    """Every period of every price series, gaps filled with the last average before."""
    return _price_grid(spark, d, fill="previous")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Periods without a price."""
    cells = _price_grid(spark, d)
    return cells.where(F.col("status") == "missing").select("zone_key", (F.col("step_s") / 60).cast("long").alias("step_minutes"), "period_epoch")


#: Seconds for which a price holds beyond its period in ``p1_carried``.
CARRY_S = 7200


def p1_carried(spark: SparkSession, d: str) -> DataFrame:
    """Every period of every price series, each price valid until the next or two hours beyond its period: intervals cut by the cells they meet."""
    cells = _price_grid(spark, d, carry_s=CARRY_S)
    return cells.select("zone_key", (F.col("step_s") / 60).cast("long").alias("step_minutes"), "period_epoch", F.round("covered_fraction", 9).alias("covered_fraction"), F.round("twa", 9).alias("twa"), "readings", "status")


def _with_unit(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    m = table(spark, d, "measurements").select(*dict.fromkeys(["measurement_id", "device_id", "value", "unit", "radiation", "location_name", *columns]))
    return units.with_source_unit(m, unit="unit", texts=["radiation", "location_name"])


def p2_converted(spark: SparkSession, d: str) -> DataFrame:
    """Every measurement in µSv/h, with the unit its value is recorded in."""
    rows = units.convert(_with_unit(spark, d), value="value", factors=table(spark, d, "unit_factors"), devices=table(spark, d, "devices"), device="device_id")
    return rows.select("measurement_id", "value", "unit", "source_unit", "unit_scale", "unit_told_by", "value_usvh")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Measurements whose unit is no code, though it is told."""
    rows = _with_unit(spark, d).where(F.col("value").isNotNull() & ~F.coalesce(F.col("unit").isin(*units.CODES), F.lit(False)))
    return rows.where(F.col("source_unit").isNotNull()).select("measurement_id", "source_unit")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Measurements within the radius of each site."""
    return spatial.near_places(table(spark, d, "measurements"), table(spark, d, "sites"), point_id="measurement_id", place_id="site_id")


def p3_regions(spark: SparkSession, d: str) -> DataFrame:
    """The tile about a site that holds each measurement: four corners a radius and a half away; of several tiles the site with the smallest id."""
    s = table(spark, d, "sites").where(F.abs("latitude") < 89)
    high = F.col("radius_m") * 1.5 / 111_195.0
    wide_ = high / F.cos(F.radians("latitude"))
    corner = lambda side, turn: F.col("latitude") + side * high if turn == "lat" else F.col("longitude") + side * wide_
    s = s.where((F.abs(F.col("longitude")) + wide_ < 180) & (F.abs(F.col("latitude")) + high < 90)).select("site_id", F.array(*[corner(x, "lat") for x in (-1, -1, 1, 1)]).alias("lats"), F.array(*[corner(x, "lon") for x in (-1, 1, 1, -1)]).alias("lons"))
    return spatial.regions_of(table(spark, d, "measurements"), s, point_id="measurement_id", region_id="site_id")


def p4_wide(spark: SparkSession, d: str) -> DataFrame:
    """One row per subject with the catalogue's typed columns."""
    return wide.wide_entities(table(spark, d, "triples"), table(spark, d, "attribute_catalog"), prefixes=PREFIXES)


def p4_multi_values(spark: SparkSession, d: str) -> DataFrame:
    """Every value of the multi-valued columns, those of cells too long for the wide row included."""
    return wide.multi_values(table(spark, d, "triples"), table(spark, d, "attribute_catalog"), prefixes=PREFIXES)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Non-null cells of the wide table in its integer, decimal, date and boolean columns."""
    catalog = table(spark, d, "attribute_catalog")
    rows = wide.wide_entities(table(spark, d, "triples"), catalog, prefixes=PREFIXES, with_multi=False)
    return wide.cells_of(rows, catalog, ["integer", "decimal", "date", "boolean"])


def p4_sets(spark: SparkSession, d: str) -> DataFrame:
    """Characteristic sets: every exact set of columns, with its number of subjects."""
    sets = wide.characteristic_sets(table(spark, d, "triples"), table(spark, d, "attribute_catalog"), prefixes=PREFIXES)
    return sets.select(F.concat_ws(" ", "signature").alias("signature"), "subjects")


#: The zone of session dates.
MADRID = "Europe/Madrid"
#: The form of dates that needs no normalising.
USUAL_DATE = r"^\d{2}/\d{2}/\d{4}$"
USUAL_INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}Z$"


def _instants(spark: SparkSession, d: str) -> DataFrame:
    devices = table(spark, d, "devices").select(F.col("device_id").alias("_id"), "time_zone")
    raw = table(spark, d, "raw_captures").select("raw_id", "device_id", "captured_at")
    rows = raw.join(devices, F.col("device_id") == F.col("_id"), "left").drop("_id")
    return timestamps.to_instants(rows, text="captured_at", zone="time_zone", intervals=timestamps.offset_intervals(spark, timestamps.zones_of(devices, "time_zone"), *timestamps.years_of(raw, "captured_at")))


def p7_instants(spark: SparkSession, d: str) -> DataFrame:
    """captured_at of every raw capture as one instant, with how it was told."""
    return _instants(spark, d).select("raw_id", "captured_at", "time_zone", "time_status", timestamps.utc_text(F.col("instant_us")).alias("captured_utc"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Times and dates that are valid and not in the usual form, normalised."""
    raw = _instants(spark, d).where(F.col("instant_us").isNotNull() & ~F.col("captured_at").rlike(USUAL_INSTANT))
    frames = [raw.select(F.lit("raw_captures").alias("source_table"), F.col("raw_id").alias("row_id"), timestamps.utc_text(F.col("instant_us")).alias("normal_form"))]
    for name, row, text in (("intervenciones", "intervention_id", "sesion_date"), ("deputy_votes", "vote_row_id", "date")):
        t = table(spark, d, name).where(F.col(text).isNotNull() & ~F.col(text).rlike(USUAL_DATE)).select(F.lit(name).alias("source_table"), F.col(row).alias("row_id"), F.col(text).alias("text"))
        t = timestamps.to_dates(t, text="text", zone=MADRID, intervals=timestamps.offset_intervals(spark, [MADRID], *timestamps.years_of(t, "text"), utc=True))
        t = t.select("source_table", "row_id", F.col("date").cast("string").alias("normal_form"))
        frames.append(t.where(F.col("normal_form").isNotNull()))
    return timestamps.union_all(frames)


QUERIES = {f.__name__: f for f in (p1_found, p1_grid, p1_carried, p2_found, p2_converted, p3_found, p3_regions, p4_found, p4_wide, p4_multi_values, p4_sets, p7_found, p7_instants)}


def p6_scored(spark: SparkSession, d: str) -> DataFrame:
    """Every reading with its isolation score and kind of fault."""
    return spikes.flag_readings(table(spark, d, "measurements"), table(spark, d, "unit_factors"), table(spark, d, "devices"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Readings that cannot be true, with the kind of fault."""
    return p6_scored(spark, d).where(F.col("kind").isNotNull()).select("measurement_id", "kind")


QUERIES |= {f.__name__: f for f in (p6_found, p6_scored)}


#: Rows of the catalogue's columns, the predicate's IRI in one form, the object trimmed (problem 4, for SQL).
_CATALOGUED = r"""
    iri AS (SELECT DISTINCT predicate AS way, regexp_replace(rtrim(regexp_replace(trim(predicate, ' <>'), '^(?i)cat:', 'http://catalogo.example/def/'), '/'), '^(?i)https?://catalogo\.example/', 'http://catalogo.example/') AS p FROM triples),
    o AS (SELECT subject, trim(object, chr(9) || chr(10) || chr(13) || chr(32)) AS t, trim(object, ' []()' || chr(9) || chr(10) || chr(13)) AS bare, source_line, record_id, column_name, column_type, multi_valued
          FROM triples JOIN iri ON predicate = way JOIN attribute_catalog a ON a.predicate = p WHERE subject IS NOT NULL AND object IS NOT NULL)
"""

#: Brute-force SQL of the same results, where SQL can say them.
ORACLES = {
    "p1_carried": """
        WITH p AS (
            SELECT zone_key, epoch_us(timestamp_utc) AS us, price, coalesce(revision_number, -1) AS rev, coalesce(record_id, '') AS rec, 60000000::BIGINT * CASE WHEN resolution IN ('PT15M', 'PT0H15M', 'PT900S') THEN 15 WHEN resolution IN ('PT30M', 'PT1800S', 'PT0H30M') THEN 30 WHEN resolution IN ('PT60M', 'PT1H', 'PT1H0M', 'PT3600S') THEN 60 END AS width
            FROM day_ahead_prices WHERE zone_key IS NOT NULL AND timestamp_utc IS NOT NULL),
        r AS (SELECT zone_key, width, us, arg_max(price, (rev, rec, price)) AS v FROM p WHERE width IS NOT NULL AND price IS NOT NULL AND NOT isnan(price) GROUP BY 1, 2, 3),
        i AS (SELECT zone_key, width, us, v, least(coalesce(lead(us) OVER (PARTITION BY zone_key, width ORDER BY us), 9e18::BIGINT), (us // width + 1) * width + 7200000000) AS until FROM r),
        g AS (SELECT zone_key, width, unnest(range(min(us // width), max(us // width) + 1)) AS cell FROM p WHERE width IS NOT NULL GROUP BY 1, 2),
        c AS (SELECT g.zone_key, g.width, g.cell, sum(least(until, (cell + 1) * g.width) - greatest(us, cell * g.width)) AS cover, sum(v * (least(until, (cell + 1) * g.width) - greatest(us, cell * g.width))) AS area, count(*) FILTER (WHERE us // g.width = cell) AS readings
              FROM g JOIN i ON g.zone_key = i.zone_key AND g.width = i.width AND us < (cell + 1) * g.width AND until > cell * g.width GROUP BY 1, 2, 3)
        SELECT zone_key, CAST(width // 60000000 AS BIGINT) AS step_minutes, CAST(cell * width // 1000000 AS BIGINT) AS period_epoch, round(coalesce(CAST(cover AS DOUBLE) / width, 0), 9) AS covered_fraction, round(area / CAST(cover AS DOUBLE), 9) AS twa, CAST(coalesce(readings, 0) AS BIGINT) AS readings, CASE WHEN cover > 0 THEN 'measured' ELSE 'missing' END AS status
        FROM g LEFT JOIN c USING (zone_key, width, cell)
    """,
    "p1_found": """
        WITH p AS (
            SELECT zone_key, timestamp_utc, price, CASE WHEN resolution IN ('PT15M', 'PT0H15M', 'PT900S') THEN 15 WHEN resolution IN ('PT30M', 'PT1800S', 'PT0H30M') THEN 30 WHEN resolution IN ('PT60M', 'PT1H', 'PT1H0M', 'PT3600S') THEN 60 END AS minutes
            FROM day_ahead_prices),
        c AS (SELECT zone_key, minutes, epoch_us(timestamp_utc) // (CAST(minutes AS BIGINT) * 60000000) AS cell, price FROM p WHERE minutes IS NOT NULL AND zone_key IS NOT NULL AND timestamp_utc IS NOT NULL),
        g AS (SELECT zone_key, minutes, unnest(range(min(cell), max(cell) + 1)) AS cell FROM c GROUP BY 1, 2)
        SELECT zone_key, CAST(minutes AS BIGINT) AS step_minutes, CAST(cell * minutes * 60 AS BIGINT) AS period_epoch
        FROM g ANTI JOIN (SELECT zone_key, minutes, cell FROM c WHERE price IS NOT NULL AND NOT isnan(price)) USING (zone_key, minutes, cell)
    """,
    "p3_regions": """
        WITH t AS (SELECT site_id, latitude AS la, longitude AS lo, radius_m * 1.5 / 111195.0 AS h, radius_m * 1.5 / 111195.0 / cos(radians(latitude)) AS w FROM sites WHERE abs(latitude) < 89),
        q AS (SELECT * FROM t WHERE abs(lo) + w < 180 AND abs(la) + h < 90),
        v AS (SELECT *, [cos(radians(a)) * cos(radians(o)), cos(radians(a)) * sin(radians(o)), sin(radians(a))] AS p FROM q, (SELECT unnest([0, 1, 2, 3]) AS k), LATERAL (SELECT la + CASE WHEN k < 2 THEN -h ELSE h END AS a, lo + CASE WHEN k IN (0, 3) THEN -w ELSE w END AS o)),
        c AS (SELECT site_id, any_value(la) AS la, any_value(lo) AS lo, any_value(h) AS h, any_value(w) AS w, list(p ORDER BY k) AS p FROM v GROUP BY site_id),
        n AS (SELECT *, list_transform([1, 2, 3, 4], lambda i: array_cross_product(p[i]::DOUBLE[3], p[i % 4 + 1]::DOUBLE[3])) AS sides FROM c),
        m AS (SELECT measurement_id, latitude, longitude, [cos(radians(latitude)) * cos(radians(longitude)), cos(radians(latitude)) * sin(radians(longitude)), sin(radians(latitude))] AS x FROM measurements WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND NOT isnan(latitude) AND NOT isnan(longitude))
        SELECT measurement_id, min(site_id) AS site_id FROM m JOIN n ON m.latitude BETWEEN n.la - 2 * n.h AND n.la + 2 * n.h AND m.longitude BETWEEN n.lo - 2 * n.w AND n.lo + 2 * n.w
        WHERE array_inner_product(sides[1]::DOUBLE[3], x::DOUBLE[3]) >= -1e-9 * sqrt(array_inner_product(sides[1]::DOUBLE[3], sides[1]::DOUBLE[3])) AND array_inner_product(sides[2]::DOUBLE[3], x::DOUBLE[3]) >= -1e-9 * sqrt(array_inner_product(sides[2]::DOUBLE[3], sides[2]::DOUBLE[3])) AND array_inner_product(sides[3]::DOUBLE[3], x::DOUBLE[3]) >= -1e-9 * sqrt(array_inner_product(sides[3]::DOUBLE[3], sides[3]::DOUBLE[3])) AND array_inner_product(sides[4]::DOUBLE[3], x::DOUBLE[3]) >= -1e-9 * sqrt(array_inner_product(sides[4]::DOUBLE[3], sides[4]::DOUBLE[3]))
        GROUP BY 1
    """,
    "p4_found": rf"""
        WITH {_CATALOGUED},
        n AS (SELECT *, CASE WHEN len(regexp_extract_all(bare, '[0-9]+(?:[.,][0-9]+)*(?:[eE][0-9]+)?')) = 1 AND NOT regexp_matches(bare, '[0-9] *[?]|[.,][.,]|[0-9] *[-/] *[0-9]') THEN (CASE WHEN regexp_matches(bare, '^[-−]') THEN '-' ELSE '' END) || regexp_extract(bare, '[0-9]+(?:[.,][0-9]+)*(?:[eE][0-9]+)?') END AS one FROM o WHERE NOT multi_valued),
        v AS (SELECT *, CASE column_type
            WHEN 'integer' THEN CASE WHEN regexp_matches(one, '^-?[0-9]{{1,3}}([.][0-9]{{3}})+$') THEN CAST(TRY_CAST(replace(one, '.', '') AS HUGEINT) AS VARCHAR) WHEN regexp_matches(one, '^-?[0-9]+([.]0+)?$') THEN CAST(TRY_CAST(split_part(one, '.', 1) AS HUGEINT) AS VARCHAR) END
            WHEN 'decimal' THEN CAST(CAST(TRY_CAST(replace(CASE WHEN regexp_matches(one, ',') THEN replace(one, '.', '') ELSE one END, ',', '.') AS DOUBLE) AS DECIMAL(36, 2)) AS VARCHAR)
            WHEN 'date' THEN CAST(CASE WHEN regexp_matches(bare, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(Z|T.*)?$') THEN TRY_CAST(bare[1:10] AS DATE) WHEN regexp_matches(bare, '^[0-9]{{8}}$') THEN CAST(try_strptime(bare, '%Y%m%d') AS DATE) WHEN regexp_matches(bare, '^[0-9]{{1,2}}[-/][0-9]{{1,2}}[-/][0-9]{{4}}$') THEN CAST(try_strptime(replace(bare, '/', '-'), '%d-%m-%Y') AS DATE)
                WHEN regexp_matches(bare, '^[0-9]+ de [a-z]+ de [0-9]{{4}}$') THEN TRY_CAST(regexp_extract(bare, '[0-9]{{4}}') || '-' || list_position(['enero', 'febrero', 'marzo', 'abril', 'mayo', 'junio', 'julio', 'agosto', 'septiembre', 'octubre', 'noviembre', 'diciembre'], split_part(bare, ' ', 3)) || '-' || split_part(bare, ' ', 1) AS DATE) END AS VARCHAR)
            WHEN 'boolean' THEN CASE WHEN lower(bare) IN ('true', 'verdadero', 'sí', 'si', 's', '1') THEN 'true' WHEN lower(bare) IN ('false', 'falso', 'no', 'n', '0') THEN 'false' END END AS cell FROM n)
        SELECT subject, column_name, arg_max(cell, (coalesce(source_line, -1), record_id)) AS cell_value FROM v WHERE column_type IN ('integer', 'decimal', 'date', 'boolean') AND cell IS NOT NULL GROUP BY 1, 2
    """,
    "p4_multi_values": rf"WITH {_CATALOGUED} SELECT DISTINCT subject, column_name, trim(t, ' ') AS value FROM o WHERE multi_valued AND trim(t, ' ') <> ''",
    "p3_found": """
        SELECT site_id, measurement_id
        FROM (SELECT measurement_id, latitude AS la, longitude AS lo FROM measurements WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND NOT isnan(latitude) AND NOT isnan(longitude)) m
        JOIN sites s ON 2 * 6371008.8 * asin(least(1, sqrt(power(sin(radians(s.latitude - la) / 2), 2) + cos(radians(la)) * cos(radians(s.latitude)) * power(sin(radians(s.longitude - lo) / 2), 2)))) <= s.radius_m
    """,
}
