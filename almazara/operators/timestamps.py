"""Problem 7: mixed timestamp formats and time zones to one form.

Texts are parsed by JVM expressions into either an instant (an offset, a zone
abbreviation or an epoch is in the text) or a wall-clock time. Wall-clock times
meet the zone's offset intervals in an as-of join on (zone, month): two matching
intervals mean ambiguous, none means nonexistent, one gives the offset.
"""

from __future__ import annotations

import datetime as dt
import zoneinfo
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almazara.runtime import materialize

# Month names, zone abbreviations with their offsets in minutes.
MONTHS_ES = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"]
MONTHS_SHORT_ES = ["ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic"]
MONTHS_SHORT_EN = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
OTHER_MONTHS = {"setiembre": 9, "sept": 9, "set": 9}
ABBREVIATIONS = {"UTC": 0, "GMT": 0, "Z": 0, "WET": 0, "WEST": 60, "CET": 60, "CEST": 120, "BST": 60, "EET": 120, "EEST": 180, "MSK": 180, "JST": 540, "KST": 540, "AEST": 600, "AEDT": 660, "EST": -300, "EDT": -240, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420}

_TIME = r"(?:(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*([AaPp][Mm])?)"
_ZONE = r"(Z|z|[+-]\d{2}:?\d{2}|[+-]\d{2}|[A-Za-z]{2,5})"
_DAYNAME = r"(?:\p{L}+\.?,?\s+)?"

#: Written forms: pattern, and its groups in the order year, month, day, hour, minute, second, fraction, half of day, zone.
FORMS = {
    "iso": (rf"^(\d{{4}})[-/](\d{{1,2}})[-/](\d{{1,2}})(?:(?:[Tt]|\s+){_TIME}?\s*{_ZONE}?)?$", (1, 2, 3)),
    "day_first": (rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}}|\d{{2}})(?:(?:[Tt]|,?\s+){_TIME}\s*{_ZONE}?)?$", (3, 2, 1)),
    "spanish": (rf"^{_DAYNAME}(\d{{1,2}})\s+de\s+(\p{{L}}+)\s+del?\s+(\d{{4}})(?:,?\s+{_TIME}\s*{_ZONE}?)?$", (3, 2, 1)),
    "mail": (rf"^{_DAYNAME}(\d{{1,2}})[\s-]+(\p{{L}}{{3,10}})\.?[\s-]+(\d{{4}}|\d{{2}})(?:,?\s+{_TIME}\s*{_ZONE}?)?$", (3, 2, 1)),
    "compact": (r"^(\d{4})(\d{2})(\d{2})(?:[Tt]?(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d{1,9}))?)?()\s*(Z|z|[+-]\d{2}:?\d{2})?)?$", (1, 2, 3)),
}
EPOCH = r"^\d{9,10}$|^\d{12,13}$|^\d{15,16}$"


def _month_number(text: Column) -> Column:
    """Number of a month in digits, or of its Spanish or English name or short form."""
    known = {name: i + 1 for names in (MONTHS_SHORT_EN, MONTHS_SHORT_ES, MONTHS_ES) for i, name in enumerate(names)} | OTHER_MONTHS
    named = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.when(text.rlike(r"^\d{1,2}$"), text.cast("int")).otherwise(F.try_element_at(named, F.lower(text)))


def parsed(text: Column) -> Column:
    """struct(instant_us, local, has_time): what a timestamp text says, or null.

    ``instant_us`` is set where the text holds an epoch, an offset or a known
    zone abbreviation; ``local`` (timestamp without zone) is set for every valid
    dated text. Slashed, dotted or dashed dates are day first, month first where
    AM or PM stands; two-digit years are of this century; a date alone is
    midnight. Impossible dates and times, blank and other texts give null.
    """
    squeezed = F.trim(F.regexp_replace(text, r"[\s ]+", " "))
    return let(squeezed, lambda t: let(_parts(t), lambda p: F.when(t.rlike(EPOCH), _epoch(t)).when(F.size(p) == 9, _instant(p))))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _parts(t: Column) -> Column:
    """The nine groups of the first form that a text has, by one replacement; null if it has none."""
    out = F.lit(None).cast("string")
    for pattern, (y, m, d) in reversed(FORMS.values()):
        order = "|".join(f"${i}" for i in (y, m, d, 4, 5, 6, 7, 8, 9))
        out = F.when(t.rlike(pattern), F.regexp_replace(t, pattern, order)).otherwise(out)
    return F.split(out, r"\|", -1)


def _number(text: Column) -> Column:
    """Whole number of up to nine digits; null for an empty part (a failed cast would cost an exception)."""
    return F.when(text != "", text.cast("int"))


def _epoch(t: Column) -> Column:
    scale = F.when(F.length(t) <= 10, 1_000_000).when(F.length(t) <= 13, 1_000).otherwise(1).cast("long")
    us = t.cast("long") * scale
    return F.struct(us.alias("instant_us"), F.timestamp_micros(us).cast("timestamp_ntz").alias("local"), F.lit(True).alias("has_time"))


def _instant(p: Column) -> Column:
    """struct of the nine parts of a written time; null if there is no such time."""
    half, zone = F.upper(p[7]), F.upper(p[8])
    # Month first where AM or PM stands.
    month, day = F.when(half != "", p[2]).otherwise(p[1]), F.when(half != "", p[1]).otherwise(p[2])
    year = _number(p[0]) + F.when(F.length(p[0]) == 2, 2000).otherwise(0)
    clock = F.coalesce(_number(p[3]), F.lit(0))
    good = F.when(half != "", clock.between(1, 12)).otherwise(clock < 24)
    hour = F.when(half == "", clock).otherwise(F.pmod(clock, F.lit(12)) + F.when(half == "PM", 12).otherwise(0))
    second = F.coalesce(_number(p[5]), F.lit(0))
    micros = F.coalesce(F.when(p[6] != "", F.rpad(F.substring(p[6], 1, 6), 6, "0").cast("int")), F.lit(0))
    local = F.try_make_timestamp_ntz(year, _month_number(month), _number(day), hour, F.coalesce(_number(p[4]), F.lit(0)), (second.cast("decimal(8,6)") + micros.cast("decimal(16,6)") / 1_000_000).cast("decimal(16,6)"))
    known = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    digits = F.regexp_replace(zone, "[+:-]", "")
    signed = zone.rlike(r"^[+-]")
    minutes = F.substring(digits, 1, 2).cast("int") * 60 + F.coalesce(_number(F.substring(digits, 3, 2)), F.lit(0))
    offset = F.when(signed, F.when(minutes <= 18 * 60, F.when(zone.startswith("-"), -minutes).otherwise(minutes))).otherwise(F.try_element_at(known, zone))
    # A wall-clock time taken as UTC, less its offset, is the instant.
    as_struct = lambda at: F.when(at.isNotNull() & good & (second < 60) & ((zone == "") | offset.isNotNull()), F.struct(F.when(zone != "", F.unix_micros(at.cast("timestamp")) - offset.cast("long") * 60_000_000).alias("instant_us"), at.alias("local"), (p[3] != "").alias("has_time")))
    return let(local, as_struct)


#: Years between which zone changes are worked out one by one; before the first there was no standard time, and rules repeat beyond.
FIRST_YEAR, LAST_YEAR = 1850, 2400


def offset_intervals(spark: SparkSession, zones: list[str], first_year: int = 1970, last_year: int = 2100, *, utc: bool = False) -> DataFrame:
    """Offset intervals of IANA zones in local time (with ``utc`` in UTC), exploded by month.

    Columns: zone, month (``yyyyMM``), local_from, local_to (microseconds of the
    wall clock), offset_s. The years are those that the texts tell (``years_of``); a
    zone's first offset holds before them and its last after them, as intervals
    open at that end under the months ``before`` and ``after``. Unknown zone names
    are left out. Bounded: there are some 600 zone names, and a zone has at most
    a few changes a year.
    """
    first_year, last_year = max(first_year, FIRST_YEAR), min(last_year, LAST_YEAR)
    rows, ends = [], []
    for name in zones:
        try:
            zone = zoneinfo.ZoneInfo(name)
        except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError):
            continue
        at = lambda s, z=zone: int((dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)).astimezone(z).utcoffset().total_seconds())
        second = lambda year: int((dt.datetime(year, 1, 1) - dt.datetime(1970, 1, 1)).total_seconds())
        # A day more at both ends, so that every local time of the years lies inside.
        start, end, week = second(first_year) - 86400, second(last_year + 1) + 86400, 7 * 86400
        begun, offset = start, at(start)
        ends.append((name, "before", offset))
        for s in range(start, end, week):
            low, high = s, min(s + week, end)
            while at(high) != at(low):  # every change of the week, first to last
                a, b = low, high
                while b - a > 1:
                    mid = (a + b) // 2
                    a, b = (mid, b) if at(mid) == at(low) else (a, mid)
                shift = 0 if utc else offset
                rows.append((name, begun + shift, b + shift, offset))
                begun, offset, low = b, at(b), b
        shift = 0 if utc else offset
        rows.append((name, begun + shift, end + shift, offset))
        ends.append((name, "after", offset))
    base = spark.createDataFrame(rows, "zone string, from_s long, to_s long, offset_s long")
    month_of = lambda c: F.trunc(F.timestamp_seconds(c), "month")
    months = F.sequence(month_of(F.col("from_s")), month_of(F.col("to_s") - 1), F.expr("interval 1 month"))
    base = base.select("*", F.explode(months).alias("month")).where(F.year("month").between(first_year, last_year))
    inside = base.select("zone", F.date_format("month", "yyyyMM").alias("month"), (F.col("from_s") * 1_000_000).alias("local_from"), (F.col("to_s") * 1_000_000).alias("local_to"), "offset_s")
    beyond = spark.createDataFrame(ends, "zone string, month string, offset_s long").select("zone", "month", F.lit(-(2**63)).cast("long").alias("local_from"), F.lit(2**63 - 1).alias("local_to"), "offset_s")
    return inside.unionByName(beyond)


def years_of(df: DataFrame, text: str) -> tuple[int, int]:
    """Least and greatest year that timestamp texts tell (1970 and 2100 if none does): one aggregate without a shuffle of rows."""
    local = parsed(F.col(text))["local"]
    low, high = df.select(F.year(local).alias("y")).agg(F.min("y"), F.max("y")).first()
    return (1970, 2100) if low is None else (low, high)


def _spans(intervals: DataFrame) -> DataFrame:
    """One row per (zone, month) that lists its two or three intervals: a join with it adds no rows. Written down, its size is known to Catalyst."""
    listed = F.collect_list(F.struct("local_from", "local_to", "offset_s")).alias("_spans")
    return materialize(intervals.groupBy(F.col("zone").alias("_zone"), F.col("month").alias("_month")).agg(listed).coalesce(1), "offsets")


def _month_key(spans: DataFrame, at: Column) -> Column:
    """The month under which the intervals of a time are listed."""
    low, high = spans.where(~F.col("_month").isin("before", "after")).agg(F.min("_month"), F.max("_month")).first()
    number, month = F.year(at) * 100 + F.month(at), F.date_format(at, "yyyyMM")
    return month if low is None else F.when(number < int(low), "before").when(number > int(high), "after").otherwise(month)


def to_dates(df: DataFrame, *, text: str, zone: str, intervals: DataFrame) -> DataFrame:
    """``df`` with ``date``: the calendar date of a timestamp text as written, or in ``zone`` where an instant is given; null if invalid.

    ``intervals``: those of the zone in UTC. An instant meets the one interval
    that holds it, which gives its offset.
    """
    rows = df.withColumn("_parsed", parsed(F.col(text)))
    spans = _spans(intervals.where(F.col("zone") == zone)).drop("_zone")
    instant = F.col("_parsed.instant_us")
    out = rows.withColumn("_month", _month_key(spans, F.timestamp_micros(instant))).join(spans, "_month", "left")
    hits = F.filter("_spans", lambda s: (s["local_from"] <= instant) & (instant < s["local_to"]))
    there = F.to_date(F.timestamp_micros(instant + hits[0]["offset_s"] * 1_000_000))
    return out.withColumn("date", F.when(instant.isNotNull(), F.when(F.size(hits) == 1, there)).otherwise(F.to_date(F.col("_parsed.local")))).select(*[c for c in df.columns if c != "date"], "date")


def to_instants(df: DataFrame, *, text: str, zone: str, intervals: DataFrame) -> DataFrame:
    """``df`` with ``instant_us`` and ``time_status`` for a timestamp text and a zone column.

    Status: ``instant`` (the text tells it), ``resolved`` (one offset interval),
    ``ambiguous`` (two), ``nonexistent`` (none), ``unknown_zone`` (no zone or
    none known), ``invalid`` (no valid time), ``null``. The instant is set for
    the first two only. One output row per input row.
    """
    p = F.col("_parsed")
    rows = df.withColumn("_parsed", parsed(F.col(text)))
    local_us = F.unix_micros(p["local"].cast("timestamp"))
    rows = rows.withColumn("_local_us", F.when(p["instant_us"].isNull(), local_us))
    spans = _spans(intervals)
    rows = rows.withColumn("_month", _month_key(spans, p["local"]))
    out = rows.join(spans, (F.col(zone) == F.col("_zone")) & (rows["_month"] == spans["_month"]), "left").drop("_zone", spans["_month"]).drop("_month")
    hits = F.filter("_spans", lambda s: (s["local_from"] <= F.col("_local_us")) & (F.col("_local_us") < s["local_to"]))
    status = F.when(F.col(text).isNull(), "null").when(p.isNull(), "invalid").when(p["instant_us"].isNotNull(), "instant").when(F.col("_spans").isNull(), "unknown_zone").when(F.size(hits) == 1, "resolved").when(F.size(hits) == 0, "nonexistent").otherwise("ambiguous")
    instant = F.when(p["instant_us"].isNotNull(), p["instant_us"]).when(F.size(hits) == 1, F.col("_local_us") - hits[0]["offset_s"] * 1_000_000)
    return out.withColumn("time_status", status).withColumn("instant_us", instant).drop("_parsed", "_spans", "_local_us")


def utc_text(instant_us: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSSSSSZ`` of microseconds since 1970 (in a UTC session)."""
    return F.date_format(F.timestamp_micros(instant_us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def calendar_date(text: Column, zone: str = "Europe/Madrid") -> Column:
    """The calendar date of a text: as written, or in ``zone`` where an instant is given; null if invalid."""
    there = lambda us: F.to_date(F.from_utc_timestamp(F.timestamp_micros(us), zone))
    return let(parsed(text), lambda p: F.when(p["instant_us"].isNotNull(), there(p["instant_us"])).otherwise(F.to_date(p["local"])))


def zones_of(df: DataFrame, column: str, limit: int = 1000) -> list[str]:
    """Distinct zone names of a column; more than ``limit`` (there are some 600 IANA names) is an error."""
    names = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(names) > limit:
        raise ValueError(f"{column} holds more than {limit} distinct zone names")
    return names


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name."""
    return reduce(DataFrame.unionByName, frames)
