"""Planning relations: task grids, spans of exports, date shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_starts(start: Column, end: Column) -> Column:
    """First days of the months that [start, end) meets. FN-13."""
    return F.sequence(F.trunc(start, "month"), F.trunc(F.date_sub(end, 1), "month"), F.expr("interval 1 month"))


def task_grid(zones: DataFrame, kinds: list[str], start: str, end: str, months: int = 1) -> DataFrame:
    """(kind, zone_key, period_start, period_end): periods of some months clipped to each zone's validity. JN-06, PLN-01.

    Zones: zone_key, valid_from, valid_to (dates or text; null is open, the end
    exclusive). Periods begin at ``start``; zones outside it give no task.
    """
    s, e = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    begins = F.sequence(s, F.date_sub(e, 1), F.expr(f"interval {int(months)} month"))
    z = zones.select("zone_key", F.coalesce(F.to_date("valid_from"), s).alias("valid_from"), F.coalesce(F.to_date("valid_to"), e).alias("valid_to"))
    rows = z.select("*", F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind")).select("*", F.explode(begins).alias("begin"))
    lo = F.greatest("begin", "valid_from", s)
    hi = F.least(F.add_months("begin", months), F.col("valid_to"), e)
    return rows.select("kind", "zone_key", lo.alias("period_start"), hi.alias("period_end")).where(F.col("period_start") < F.col("period_end"))


def span_named(name: Column) -> Column:
    """struct(kind, first_day, last_day) that the file name of a yearly, monthly or daily export tells, or null. FLT-06, PLN-04.

    Years 1979 to 2005, months 2006-01 to 2013-03, days from 2013-04-01 on.
    """
    digits = F.regexp_extract(name, r"^(\d{4}|\d{6}|\d{8})(?:\.export)?(?:\.CSV)?\.zip$", 1)
    year = F.when(F.length(digits) == 4, F.to_date(F.concat(digits, F.lit("0101")), "yyyyMMdd"))
    month = F.when((F.length(digits) == 6) & F.substring(digits, 5, 2).between("01", "12"), F.try_to_date(F.concat(digits, F.lit("01")), "yyyyMMdd"))
    day = F.when(F.length(digits) == 8, F.try_to_date(digits, "yyyyMMdd"))
    lit_day = lambda s: F.lit(s).cast("date")
    entry = lambda kind, first, last: F.struct(F.lit(kind).alias("kind"), first.alias("first_day"), last.alias("last_day"))
    return (
        F.when(year.between(lit_day("1979-01-01"), lit_day("2005-01-01")), entry("year", year, F.date_sub(F.add_months(year, 12), 1)))
        .when(month.between(lit_day("2006-01-01"), lit_day("2013-03-01")), entry("month", month, F.last_day(month)))
        .when(day >= lit_day("2013-04-01"), entry("day", day, day))
    )


def date_shards(spark: SparkSession, start: str, end: str, *, coarse_years: int, coarse_until: int, monthly_from: int | None = None, daily: list[tuple[str, str]] | None = None) -> DataFrame:
    """(shard_start, shard_end), inclusive days: blocks of years, then years, months, and days where it is dense. PLN-02.

    Years before ``coarse_until`` come in blocks of ``coarse_years``; years from
    ``monthly_from`` on by month; days of the ``daily`` ranges by themselves.
    The shards partition [start, end].
    """
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("day"))
    year = F.year("day")
    block = F.floor((year - int(start[:4])) / coarse_years)
    key = F.when(year < coarse_until, F.concat(F.lit("b"), block.cast("string")))
    if daily:
        dense = None
        for lo, hi in daily:
            c = F.col("day").between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
            dense = c if dense is None else dense | c
        key = F.when(dense, F.date_format("day", "yyyy-MM-dd")).otherwise(key)
    if monthly_from is not None:
        key = F.coalesce(key, F.when(year >= monthly_from, F.date_format("day", "yyyy-MM")))
    key = F.coalesce(key, year.cast("string"))
    # A range of days inside a longer shard splits it: runs of days with one key.
    from pyspark.sql import Window

    order = Window.partitionBy(F.lit(1)).orderBy("day")
    runs = days.withColumn("key", key)
    runs = runs.withColumn("new", (F.coalesce(F.lag("key").over(order), F.lit("")) != F.col("key")).cast("int")).withColumn("run", F.sum("new").over(order))
    return runs.groupBy("run").agg(F.min("day").alias("shard_start"), F.max("day").alias("shard_end")).drop("run")


def release_periods(spark: SparkSession, first_year: int, yearly_until: int, end_year: int, end_month: int) -> DataFrame:
    """(period): years as yyyy up to ``yearly_until``, then months as yyyyMM to the end month. PLN-03."""
    years = spark.range(first_year, yearly_until + 1).select(F.col("id").cast("string").alias("period"))
    span = F.sequence(F.make_date(F.lit(yearly_until + 1), F.lit(1), F.lit(1)), F.make_date(F.lit(end_year), F.lit(end_month), F.lit(1)), F.expr("interval 1 month"))
    months = spark.range(1).select(F.explode(span).alias("m")).select(F.date_format("m", "yyyyMM").alias("period"))
    return years.unionByName(months)


def day_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(day) of every day from start to end. PLN-05."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("day"))


def needed_pages(df: DataFrame, url: str) -> DataFrame:
    """(pdf_name, page): distinct pages that links point to; page 1 where none is named. PLN-08, FN-19."""
    name = F.regexp_extract(F.col(url), r"([^/#?]+\.[Pp][Dd][Ff])", 1)
    page = F.coalesce(F.nullif(F.regexp_extract(F.col(url), r"page=(\d{1,9})", 1), F.lit("")).cast("int"), F.lit(1))
    return df.where(F.col(url).isNotNull()).select(name.alias("pdf_name"), page.alias("page")).where(F.col("pdf_name") != "").distinct()


def document_tasks(docs: DataFrame, done: DataFrame) -> DataFrame:
    """(registration_number, document_type) of segmented leaflets of types 1 and 2 not yet fetched. PLN-07."""
    wanted = docs.where(F.col("document_type").isin(1, 2) & F.col("segmented_content_available")).select("registration_number", "document_type").distinct()
    return wanted.join(done, ["registration_number", "document_type"], "left_anti")
