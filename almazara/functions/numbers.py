"""Number parsing as Catalyst expressions; what cannot be read is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DOUBLE = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def _checked(text: Column, pattern: str, kind: str) -> Column:
    # The pattern is tested first: a failed cast would cost an exception, and casts also take "1d" or "NaN".
    return F.when(text.rlike(pattern), text.try_cast(kind))


def lenient_double(value: Column) -> Column:
    """Number with a point or a comma. FN-03."""
    return _checked(F.replace(F.trim(value), F.lit(","), F.lit(".")), _DOUBLE, "double")


def spanish_double(value: Column) -> Column:
    """Number with points between thousands and a comma before decimals. FN-04."""
    return _checked(F.replace(F.replace(F.trim(value), F.lit(".")), F.lit(","), F.lit(".")), _DOUBLE, "double")


def strict_long(value: Column) -> Column:
    """Whole number in digits with an optional sign, nothing else. FN-05."""
    return _checked(F.trim(value), r"^[+-]?[0-9]+$", "long")


def strict_int(value: Column, kind: str = "int") -> Column:
    """Whole number of a type; out of its range is null. FN-05."""
    return _checked(F.trim(value), r"^[+-]?[0-9]+$", kind)


def strict_double(value: Column) -> Column:
    """Number with an optional exponent, nothing else. FN-05."""
    return _checked(F.trim(value), _DOUBLE, "double")


def truncated(value: Column) -> Column:
    """Whole part, toward zero; null for what is not finite. FN-06."""
    d = value.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < 9.2e18), d.cast("long"))
