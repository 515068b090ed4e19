"""Profiles: column profiles, value counts, numeric and coverage summaries.

Counts, extremes and means of any number of columns are one aggregate. Distinct
and most frequent values come from the columns stacked to (column, value) pairs,
combined on the map side; distinct values travel as hashes.
"""

from __future__ import annotations

from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almazara.operators.relational import numbered_shards


def value_counts(df: DataFrame, column: str, k: int | None = None, *, nulls: bool = False) -> DataFrame:
    """(value, n) of a column, most frequent first, ties by value; nulls only on request. AG-04, AG-05, LM-01."""
    rows = df if nulls else df.where(F.col(column).isNotNull())
    out = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return out if k is None else out.orderBy(F.desc("n"), "value").limit(k)


def stacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) for every row and column, values as text."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.column", "p.value")


def _distinct_up_to(columns: list[str], cap: int):
    """A function for mapInArrow: at most ``cap`` + 1 distinct values of each column of a partition; more would say no more."""

    def run(batches):
        seen: dict[str, set] = {c: set() for c in columns}
        for batch in batches:
            for c, found in seen.items():
                if len(found) <= cap:
                    found.update(pc.unique(batch.column(c).drop_null()).to_pylist())
        rows = [(c, v) for c, found in seen.items() for v in islice(found, cap + 1)]
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.string()), pa.array([v for _, v in rows], pa.string())], names=["column", "value"])

    return run


def column_profile(df: DataFrame, columns: list[str] | None = None, *, distinct_cap: int | None = None) -> DataFrame:
    """One row per column: rows, nulls, null_fraction, distinct, and numeric or length extremes. AG-01, AG-02.

    Numeric columns have min, max and mean; text columns the lengths' min, max
    and mean. All but the distinct counts come from one aggregate without a shuffle
    of rows; distinct values are counted by 128 bits of hash. With ``distinct_cap``
    a larger distinct count is null and ``distinct_lower_bound`` is the cap plus
    one; a partition then gives so many values of a column at most. An empty table
    gives no rows.
    """
    columns = columns or df.columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    facts = {}
    for c in columns:
        number = F.col(c).cast("double") if isinstance(kinds[c], T.NumericType) else F.lit(None).cast("double")
        size = F.length(c) if isinstance(kinds[c], T.StringType) else F.lit(None).cast("int")
        facts[c] = [F.count(F.lit(1)), F.count_if(F.col(c).isNull()), F.min(number), F.max(number), F.avg(number), F.min(size), F.max(size), F.avg(size.cast("double"))]
    names = ["rows", "nulls", "minimum", "maximum", "mean", "min_length", "max_length", "mean_length"]
    one = df.agg(*[part.alias(f"{name}_{i}") for i, parts in enumerate(facts.values()) for name, part in zip(names, parts)])
    plain = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{n}_{i}").alias(n) for n in names]) for i, c in enumerate(facts)])).alias("p")).select("p.*").where(F.col("rows") > 0)
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    if distinct_cap is None:
        each = stacked(texts, columns).where(F.col("value").isNotNull()).select("column", F.xxhash64("value").alias("h1"), F.xxhash64(F.lit("second"), "value").alias("h2"))
    else:
        each = texts.mapInArrow(_distinct_up_to(columns, distinct_cap), "column string, value string")
    distinct = each.distinct().groupBy("column").agg(F.count("*").alias("distinct_values"))
    out = plain.join(distinct, "column", "left").withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0).cast("long")))
    out = out.select("column", "rows", "nulls", "distinct_values", "minimum", "maximum", "mean", "min_length", "max_length", "mean_length")
    out = out.withColumn("null_fraction", F.round(F.col("nulls") / F.when(F.col("rows") > 0, F.col("rows")), 8))
    if distinct_cap is not None:
        over = F.col("distinct_values") > distinct_cap
        out = out.withColumn("distinct_lower_bound", F.when(over, F.lit(distinct_cap + 1).cast("long"))).withColumn("distinct_values", F.when(~over, F.col("distinct_values")))
    return out


def top_values(df: DataFrame, columns: list[str], k: int = 20) -> DataFrame:
    """(column, value, n, place): the k most frequent values of each column, ties by value. AG-01, LM-01.

    The limit per column is taken on both sides of the shuffle, so a column of
    many values does not meet in one task.
    """
    counts = stacked(df, columns).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
    return counts.withColumn("place", place).where(F.col("place") <= k)


def samples(df: DataFrame, column: str, key: str, k: int = 5) -> DataFrame:
    """The first k present values of a column by key. AG-02, LM-07."""
    return df.where(F.col(column).isNotNull()).orderBy(key).limit(k).select(key, column)


def numeric_summary(df: DataFrame, column: str, *, digits: int = 6) -> DataFrame:
    """(n, minimum, maximum, mean, std): population deviation; nulls, NaN and infinities left out. AG-06, AG-07."""
    x = F.col(column).cast("double")
    finite = df.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return finite.agg(F.count("*").alias("n"), F.min(x).alias("minimum"), F.max(x).alias("maximum"), F.round(F.avg(x), digits).alias("mean"), F.round(F.stddev_pop(x), digits).alias("std"))


def year_histogram(df: DataFrame, column: str) -> DataFrame:
    """(year, n) of a date or time column; nulls left out. AG-08."""
    return df.where(F.col(column).isNotNull()).groupBy(F.year(column).alias("year")).agg(F.count("*").alias("n"))


def shares(df: DataFrame, column: str, labels: dict | None = None, digits: int = 4) -> DataFrame:
    """(value, label, n, percent) with percent of all rows. AG-09, JN-12.

    The window runs over the counts, one row per value.
    """
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    label = F.lit("unknown")
    if labels:
        known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
        label = F.coalesce(F.try_element_at(known, F.col("value")), label)
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select("value", label.alias("label"), "n", F.round(F.col("n") * 100.0 / total, digits).alias("percent"))


def field_coverage(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """(field, present, percent) of every column. AG-10."""
    one = df.agg(F.count("*").alias("rows"), *[F.count(c).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("present")) for c in columns])
    return one.select("rows", F.explode(pairs).alias("p")).select("p.field", "p.present", F.round(F.col("p.present") * 100.0 / F.nullif("rows", F.lit(0)), digits).alias("percent"))


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """(rows, keys, duplicates): occurrences of a key after its first; null keys are keys. AG-12."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def extent(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Minimum and maximum of columns as min_<name>, max_<name>. AG-11, AG-13."""
    return df.agg(*[x for name, c in columns.items() for x in (F.min(c).alias(f"min_{name}"), F.max(c).alias(f"max_{name}"))])


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Rows in all and under each condition. AG-03, AG-14."""
    return df.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(name) for name, c in conditions.items()])


def distinct_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of each column, empty texts left out. AG-15."""
    pairs = stacked(df, columns).where(F.col("value") != "").distinct().groupBy("column").agg(F.count("*").alias("distinct_values"))
    return pairs


def floor_mean(df: DataFrame, group: str, column: str) -> DataFrame:
    """(group, rows, total, mean) with a whole-number mean, 0 where there are no values. AG-16."""
    out = df.groupBy(group).agg(F.count(column).alias("rows"), F.coalesce(F.sum(column), F.lit(0)).alias("total"))
    return out.withColumn("mean", F.when(F.col("rows") > 0, F.floor(F.col("total") / F.col("rows"))).otherwise(0).cast("long"))


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    """(position, value): distinct present values in order, position from 0. AG-17.

    As rows, so that no list of all values is gathered.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    return numbered_shards(values, ["value"], 1).select(F.col("shard").alias("position"), "value")


def bucket_counts(df: DataFrame, column: str, missing: str = "unassigned") -> DataFrame:
    """(bucket, n) with nulls under a name. AG-18."""
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(missing)).alias("bucket")).agg(F.count("*").alias("n"))


def cross_tab(df: DataFrame, rows: str, columns: str, values: list) -> DataFrame:
    """Counts of ``rows`` x the given values of ``columns``, 0 where there are none. AG-19."""
    return df.groupBy(rows).pivot(columns, values).agg(F.count(F.lit(1))).na.fill(0)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(rows, required_nulls): nulls over all given columns. AG-20."""
    return df.agg(F.count("*").alias("rows"), sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0)).cast("long").alias("required_nulls"))


def totals(frames: dict[str, DataFrame], column: str = "rows") -> DataFrame:
    """Sum of a count over several one-row profiles, with each table's own. AG-21."""
    union = None
    for name, df in frames.items():
        one = df.select(F.lit(name).alias("table_name"), F.col(column).cast("long").alias("n"))
        union = one if union is None else union.unionByName(one)
    return union.groupBy("table_name").agg(F.sum("n").alias("n")).unionByName(union.agg(F.lit("total").alias("table_name"), F.sum("n").alias("n")))
