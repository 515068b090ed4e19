"""Identities by hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def price_record_id(kind: Column, zone: Column, instant: Column, resolution: Column, business: Column, contract: Column, auction: Column, position: Column) -> Column:
    """SHA-256 of the eight parts joined by a bar; null, blank and 0 are blank. FN-16."""
    iso = F.concat(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.unix_micros(instant.cast("timestamp")) % 1_000_000 != 0, F.date_format(instant, ".SSSSSS")).otherwise(""), F.lit("+00:00"))
    place = F.when(position != 0, position.cast("string"))
    return F.sha2(F.array_join(F.array(kind, zone, iso, resolution, business, contract, auction, place), "|", ""), 256)


def version_id(entity: Column, updated: Column, deleted: Column) -> Column:
    """SHA-256 of an entity, its update time as written and whether it is deleted. FN-17."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    return F.sha2(F.concat_ws("\x1f", blank(entity), blank(updated), deleted.cast("int").cast("string")), 256)


def epsg_code(srs: Column) -> Column:
    """Number at the end of a reference system's name, or null. FN-19."""
    return F.nullif(F.regexp_extract(srs, r"([0-9]{4,5})$", 1), F.lit("")).cast("int")
