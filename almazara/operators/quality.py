"""Named quality checks: one row per check, and gates on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bad_coordinates(lat: Column, lon: Column, *, null_is_bad: bool) -> Column:
    """True where coordinates are out of range; nulls as the source has it. FN-30, DQ-02.

    With ``null_is_bad`` false, a row lacking either coordinate is never bad
    (no three-valued OR). NaN is out of range.
    """
    outside = ~lat.between(-90.0, 90.0) | ~lon.between(-180.0, 180.0) | F.isnan(lat) | F.isnan(lon)
    none = lat.isNull() | lon.isNull()
    return F.when(none, F.lit(null_is_bad)).otherwise(outside)


def checks(df: DataFrame, failures: dict[str, Column], *, min_rows: int | None = None) -> DataFrame:
    """(check_name, failing, passed): rows that fail each condition, and the least row count. DQ-03 to DQ-10."""
    one = df.agg(F.count("*").alias("_rows"), *[F.count_if(c).alias(n) for n, c in failures.items()])
    rows = [F.struct(F.lit(n).alias("check_name"), F.col(n).alias("failing"), (F.col(n) == 0).alias("passed")) for n in failures]
    if min_rows is not None:
        short = F.greatest(F.lit(min_rows) - F.col("_rows"), F.lit(0)).cast("long")
        rows.append(F.struct(F.lit("min_rows").alias("check_name"), short.alias("failing"), (short == 0).alias("passed")))
    return one.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def unique_check(df: DataFrame, keys: list[str], name: str = "unique_key") -> DataFrame:
    """(check_name, failing, passed) of duplicate keys. DQ-01."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return counts.agg(extra.alias("failing")).select(F.lit(name).alias("check_name"), "failing", (F.col("failing") == 0).alias("passed"))


def required_check(df: DataFrame, columns: list[str]) -> DataFrame:
    """(check_name, failing, passed) of nulls in required columns, one row per column. DQ-04, DQ-05."""
    return checks(df, {f"{c}_not_null": F.col(c).isNull() for c in columns})


def accounting(parts: DataFrame, totals: DataFrame, key: str, part: str, total: str) -> DataFrame:
    """(key, parts_sum, total, passed): parts must add up to the total. DQ-07, JN-10."""
    sums = parts.groupBy(key).agg(F.sum(part).alias("parts_sum"))
    out = totals.select(key, F.col(total).alias("total")).join(sums, key, "left")
    return out.select(key, F.coalesce("parts_sum", F.lit(0)).alias("parts_sum"), "total", (F.coalesce("parts_sum", F.lit(0)) == F.col("total")).alias("passed"))


def overall(report: DataFrame) -> DataFrame:
    """(checks, failed, status): pass only where every check passed. DQ-13."""
    return report.agg(F.count("*").alias("checks"), F.count_if(~F.col("passed")).alias("failed"), F.when(F.coalesce(F.bool_and("passed"), F.lit(True)), "pass").otherwise("fail").alias("status"))


def gate(report: DataFrame) -> None:
    """Raise where a check has not passed; the report is one row per check. SNK-13, DQ-14."""
    failed = [r.check_name for r in report.where(~F.col("passed")).select("check_name").orderBy("check_name").limit(50).collect()]
    if failed:
        raise ValueError("quality checks failed: " + ", ".join(failed))


def same_schema(frames: list[DataFrame]) -> bool:
    """Whether all frames have one schema, nullability aside. DQ-08."""
    shapes = [[(f.name, f.dataType.simpleString()) for f in df.schema.fields] for df in frames]
    return all(s == shapes[0] for s in shapes)
