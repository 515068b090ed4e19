"""Delimited and fixed-width sources to their declared tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almazara import schemas
from almazara.functions import numbers, temporal, text
from almazara.sources.archives import archive_lines

EVENT_COLUMNS = schemas.columns("gdelt.events")[:-1]


def _typed(value: Column, kind: str, lenient: bool) -> Column:
    blank = F.nullif(value, F.lit(""))
    if kind == "string":
        return blank
    if kind == "date":
        return temporal.compact_date(blank)
    if kind == "timestamp_ntz":
        return temporal.compact_time(blank)
    if lenient:
        return numbers.strict_double(blank).cast(kind) if kind in ("double", "float") else numbers.strict_int(blank, kind)
    return blank.cast(kind)


def event_rows(lines: DataFrame, *, lenient: bool = False) -> DataFrame:
    """Event records of tab-separated lines of 57 or 58 fields. SRC-01 to SRC-03.

    ``lines``: archive, value. Dates that cannot be read are null; numbers that
    cannot be read are null in lenient mode and stop the job otherwise. Lines of
    57 fields have no source URL. Quotes have no meaning.
    """
    fields = F.split("value", "\t", -1)
    kinds = {f.split(" ")[0].strip("`"): f.split(" ", 1)[1] for f in schemas.ddl("gdelt.events").split(", ")}
    rows = lines.where(F.col("value") != "").select("archive", fields.alias("f"))
    columns = [_typed(F.get("f", F.lit(i)), kinds[c], lenient).alias(c) for i, c in enumerate(EVENT_COLUMNS)]
    return schemas.conform(rows.select(*columns, F.regexp_extract("archive", r"([^/]+)$", 1).alias("source_archive")), "gdelt.events")


def read_events(spark: SparkSession, paths: list[str], *, lenient: bool = False) -> DataFrame:
    """Event records of zip archives, one task each."""
    return event_rows(archive_lines(spark, paths, errors="replace"), lenient=lenient)


# Header of the radiation export and the canonical names.
MEASUREMENT_HEADER = {"Captured Time": "captured_at", "Latitude": "latitude", "Longitude": "longitude", "Value": "value", "Unit": "unit", "Location Name": "location_name", "Device ID": "device_id", "MD5Sum": "md5sum", "Height": "height", "Surface": "surface", "Radiation": "radiation", "Uploaded Time": "uploaded_at", "Loader ID": "loader_id"}


def measurement_rows(raw: DataFrame) -> DataFrame:
    """Canonical names and types of the radiation export; blank is null. PRJ-01, SRC-04."""
    return schemas.conform(raw.select(*[F.nullif(F.trim(F.col(f"`{old}`").cast("string")), F.lit("")).alias(new) for old, new in MEASUREMENT_HEADER.items()]), "safecast.measurements")


def read_measurements(spark: SparkSession, path: str) -> DataFrame:
    """Radiation readings of a CSV file (or folder of them), split by Spark; of a tar archive, by its one member."""
    if path.lower().endswith((".tar.gz", ".tgz", ".tar")):
        lines = archive_lines(spark, [path], suffix=".csv")
        header = ", ".join(f"`{c}` string" for c in MEASUREMENT_HEADER)
        rows = lines.where(F.col("line_number") > 1).select(F.from_csv("value", F.lit(header)).alias("r"))
        return measurement_rows(rows.select("r.*"))
    return measurement_rows(spark.read.csv(path, header=True, schema=", ".join(f"`{c}` string" for c in MEASUREMENT_HEADER), enforceSchema=False))


#: Places of an earthquake's fields in a semicolon row and in a table row.
CSV_PLACES = {"event_id": 0, "day": 1, "time": 2, "latitude": 3, "longitude": 4, "depth_km": 5, "intensity": 6, "magnitude": 7, "magnitude_type_code": 8, "location": 9}
TABLE_PLACES = {"event_id": 0, "day": 1, "time": 2, "latitude": 4, "longitude": 5, "depth_km": 6, "magnitude": 7, "magnitude_type_code": 8, "intensity": 9, "location": 10}


def earthquake_rows(fields: Column, places: dict[str, int], source_format: str) -> list[Column]:
    """Columns of an earthquake record from its fields as an array of texts; blank, ``null`` and ``-1`` are no value."""
    f = lambda name: F.nullif(F.trim(F.get(fields, F.lit(places[name]))), F.lit(""))
    told = lambda c, none: F.when(~F.lower(c).isin(*none), c)
    intensity, kind = told(f("intensity"), ["-1"]), told(f("magnitude_type_code"), ["null"])
    number = lambda name: numbers.lenient_double(f(name)).alias(name)
    return [f("event_id").alias("event_id"), temporal.utc_day_time(f("day"), f("time")).alias("occurred_at_utc"), number("latitude"), number("longitude"), number("depth_km"), intensity.alias("maximum_intensity"), text.intensity_number(intensity).alias("maximum_intensity_numeric"), number("magnitude"), kind.alias("magnitude_type_code"), text.repair_mojibake(f("location")).alias("location"), F.lit(source_format).alias("source_format")]


# Suffixes of foreign and Spanish places in earthquake lists.
FOREIGN = {"AND": ("AD", "Andorra"), "ARG": ("DZ", "Algeria"), "FR": ("FR", "France"), "FRA": ("FR", "France"), "MAC": ("MA", "Morocco"), "POR": ("PT", "Portugal")}
SPANISH = set("A AB AL AV B BA BI BU C CA CC CE CO CR CS CU F FV G GC GE GI GR GU H HE HU I IB IBZ IFV IG IGC IGM IHI IL ILP ILZ IMA IME ITF J L LE LO LP LU LZ M MA ML MU N NA O OR OU P PM PO S SA SE SG SO SS T TE TF TO V VA VI Z ZA".split())


def with_country(df: DataFrame) -> DataFrame:
    """Earthquakes with country code and name from the location's suffix, as declared."""
    country = text.country_of(F.col("location"), FOREIGN, SPANISH)
    return schemas.conform(df.withColumn("_c", country).withColumn("country_code", F.col("_c.code")).withColumn("country_name", F.col("_c.name")), "ign.earthquakes")


def read_earthquake_csv(spark: SparkSession, path: str) -> DataFrame:
    """Earthquakes of a semicolon file with a header; a row of fewer than ten fields stops the job. SRC-06."""
    lines = archive_lines(spark, [path], errors="replace")
    quoted = F.from_csv("value", ", ".join(f"f{i} string" for i in range(10)), {"sep": ";", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "emptyValue": ""})
    # Separators inside quotes are text; most lines have no quotes and are merely split.
    outside = F.size(F.split(F.regexp_replace("value", '"[^"]*"', ""), ";", -1))
    fields = F.when(~F.col("value").contains('"'), F.split("value", ";", -1)).when(outside >= 10, F.array(*[F.coalesce(quoted[f"f{i}"], F.lit("")) for i in range(10)])).otherwise(F.array())
    rows = lines.where((F.col("line_number") > 1) & (F.trim("value") != "")).select(fields.alias("f"), "line_number")
    sound = F.when(F.size("f") >= 10, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("too few fields in line "), F.col("line_number").cast("string"))))
    return with_country(rows.select(sound.alias("f")).select(*earthquake_rows(F.col("f"), CSV_PLACES, "csv")))


def marginal_price_rows(lines: DataFrame) -> DataFrame:
    """Hourly prices of lines ``year;month;day;hour;price;price;``; one price stands for both, other lines are left out. SRC-08, FLT-04."""
    parts = F.filter(F.transform(F.split("value", ";"), lambda p: F.trim(p)), lambda p: p != "")
    rows = lines.select(parts.alias("p")).where((F.size("p") >= 5) & F.get("p", F.lit(0)).rlike(r"^\d+$"))
    n = lambda i, kind: numbers.strict_int(F.get("p", F.lit(i)), kind)
    rows = rows.select(F.try_make_timestamp_ntz(n(0, "int"), n(1, "int"), n(2, "int"), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)")).cast("date").alias("date"), n(0, "smallint").alias("year"), n(1, "tinyint").alias("month"), n(2, "tinyint").alias("day"), n(3, "tinyint").alias("hour"), numbers.spanish_double(F.get("p", F.lit(4))).alias("price_es"), numbers.spanish_double(F.when(F.size("p") >= 6, F.get("p", F.lit(5))).otherwise(F.get("p", F.lit(4)))).alias("price_pt"))
    whole = F.col("date").isNotNull() & F.col("hour").isNotNull() & F.col("price_es").isNotNull() & F.col("price_pt").isNotNull()
    return schemas.conform(rows.where(whole), "omie.marginal_prices")


def bidding_curve_rows(lines: DataFrame) -> DataFrame:
    """Bids of lines ``hour;d/m/y;country;unit;offer;energy;price;status``; headings and other lines are left out. SRC-09, PRJ-07."""
    p = F.split("value", ";", -1)
    rows = lines.where(~F.col("value").startswith("OMIE") & ~F.col("value").startswith("Hora;")).select(F.transform(p, lambda x: F.trim(x)).alias("p")).where((F.size("p") >= 8) & F.get("p", F.lit(0)).rlike(r"^\d{1,2}$"))
    day = F.when(F.get("p", F.lit(1)).rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(F.get("p", F.lit(1)), "d/M/yyyy"))
    rows = rows.select(day.alias("date"), F.year(day).alias("year"), F.get("p", F.lit(0)).cast("tinyint").alias("hour"), F.get("p", F.lit(2)).alias("country"), F.get("p", F.lit(4)).alias("offer_type"), numbers.spanish_double(F.get("p", F.lit(5))).alias("energy_mwh"), numbers.spanish_double(F.get("p", F.lit(6))).alias("price_eur_mwh"), F.get("p", F.lit(7)).alias("status"))
    return schemas.conform(rows.where(F.col("date").isNotNull() & F.col("energy_mwh").isNotNull() & F.col("price_eur_mwh").isNotNull()), "omie.bidding_curves")


def station_rows(lines: DataFrame) -> DataFrame:
    """Daily observations of fixed-width month lines; days with the sentinel -9999 are left out. SRC-05, NS-11, FLT-03."""
    v = F.col("value")
    month = F.try_make_timestamp_ntz(F.substring(v, 12, 4).cast("int"), F.substring(v, 16, 2).cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)")).cast("date")
    rows = lines.where(F.length("value") >= 21).select(v.alias("value"), F.substring(v, 1, 11).alias("station_id"), month.alias("month"), F.substring(v, 18, 4).alias("element"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.dayofmonth(F.last_day("month")))).alias("day"))
    at = F.lit(22) + (F.col("day") - 1) * 8
    cut = lambda offset, size: F.trim(F.substring(F.col("value"), at + offset, F.lit(size)))
    reading = cut(0, 5)
    out = rows.select("station_id", F.date_add("month", F.col("day") - 1).alias("date"), "element", F.when(reading.rlike(r"^-?\d+$"), reading.cast("int")).alias("value"), cut(5, 1).alias("measurement_flag"), cut(6, 1).alias("quality_flag"), cut(7, 1).alias("source_flag"))
    return schemas.conform(out.where(F.col("value").isNotNull() & (F.col("value") != -9999)), "noaa.observations")
