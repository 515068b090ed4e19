"""ISO 8601 durations as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weeks, days, hours, minutes and seconds; months and years have no fixed length.
ISO_DURATION = r"^P(?:(\d{1,6})W)?(?:(\d{1,6})D)?(?:T(?:(\d{1,7})H)?(?:(\d{1,9})M)?(?:(\d{1,10})(?:\.0+)?S)?)?$"

#: Seconds of the parts of the pattern (fixed values).
UNITS = (604800, 86400, 3600, 60, 1)


def duration_seconds(text: Column) -> Column:
    """Seconds of an ISO 8601 duration; null where it has no fixed, positive whole length.

    ``PT60M``, ``PT1H0M`` and ``PT3600S`` are one length. Null, blank,
    malformed, zero, monthly and yearly durations give null.
    """
    # One replacement gives all parts; they are then computed once.
    parts = F.split(F.regexp_replace(F.upper(F.trim(text)), ISO_DURATION, "$1|$2|$3|$4|$5"), r"\|", -1)
    total = lambda p: sum((F.when(p[i] != "", p[i].cast("long")).otherwise(0) * unit for i, unit in enumerate(UNITS)), F.lit(0).cast("long"))
    seconds = F.transform(F.array(parts), lambda p: F.when(F.size(p) == len(UNITS), total(p)))[0]
    return F.nullif(seconds, F.lit(0).cast("long"))
