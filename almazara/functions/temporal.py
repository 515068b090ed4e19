"""Dates and times as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_day_time(day: Column, time: Column) -> Column:
    """Instant of d/M/y and H:m:s texts in UTC. FN-09."""
    return F.try_to_timestamp(F.concat_ws(" ", F.trim(day), F.trim(time)), F.lit("d/M/yyyy H:m:s"))


def iso_instant(value: Column) -> Column:
    """Instant of an ISO text, with or without zone, seconds or fraction; without zone it is UTC. FN-10."""
    t = F.trim(value)
    short = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(Z|[+-]\d{2}:?\d{2})?$"), F.regexp_replace(t, r"^(.{16})(.*)$", "$1:00$2"))
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?$"), F.coalesce(short, t).try_cast("timestamp"))


def date_prefix(value: Column) -> Column:
    """Date of the first ten characters, or null. FN-11."""
    head = F.substring(F.trim(value), 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head.try_cast("date"))


def compact_date(value: Column) -> Column:
    """Date of yyyyMMdd, or null. FN-12."""
    return F.when(value.rlike(r"^\d{8}$"), F.try_to_date(value, "yyyyMMdd"))


def compact_time(value: Column) -> Column:
    """Time without zone of yyyyMMddHHmmss, or null. FN-12."""
    n = lambda i, k: F.substring(value, i, k).cast("int")
    return F.when(value.rlike(r"^\d{14}$"), F.try_make_timestamp_ntz(n(1, 4), n(5, 2), n(7, 2), n(9, 2), n(11, 2), n(13, 2).cast("decimal(16,6)")))


def step_instant(start: Column, step_seconds: Column, position: Column) -> Column:
    """Instant of a position counted from 1 on a grid. FN-15."""
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (step_seconds * (position - 1)).cast("decimal(18,6)"))
