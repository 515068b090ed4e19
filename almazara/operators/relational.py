"""Joins, versions, deduplication, sets and ordering on DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almazara.runtime import materialize


def matched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both sides with equal keys. JN-01, JN-04, JN-14."""
    return left.join(right, keys, "inner")


def pending(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted rows whose key is not done. JN-02, JN-09."""
    return wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def overridden(base: DataFrame, overrides: DataFrame, key: str, column: str) -> DataFrame:
    """``base`` with the override of a column where there is one, and ``<column>_from``: override or base. JN-03."""
    o = overrides.select(F.col(key).alias("_key"), F.col(column).alias("_new"))
    out = base.join(o, F.col(key) == F.col("_key"), "left")
    return out.withColumn(f"{column}_from", F.when(F.col("_new").isNotNull(), "override").otherwise("base")).withColumn(column, F.coalesce("_new", column)).drop("_key", "_new")


def with_attributes(facts: DataFrame, dimension: DataFrame, keys: list[str], default: dict | None = None) -> DataFrame:
    """Left join of a dimension, with defaults for what it lacks. JN-05, JN-07, JN-10.

    No broadcast hint: Catalyst sends the dimension to the executors only where
    its size is under the session's threshold.
    """
    out = facts.join(dimension, keys, "left")
    return out.na.fill(default) if default else out


def labelled(df: DataFrame, code: str, labels: dict, name: str, other: str = "unknown") -> DataFrame:
    """``df`` with the label of a code. JN-12."""
    known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return df.withColumn(name, F.coalesce(F.try_element_at(known, F.col(code)), F.lit(other)))


def _number(df: DataFrame, column: str) -> Column:
    """A time or number as a double: microseconds, days or the number itself."""
    kind = dict(df.dtypes)[column]
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.unix_date(column).cast("double") if kind == "date" else F.col(column).cast("double")


def within(df: DataFrame, intervals: DataFrame, at: str, start: str, end: str, on: list[str] | None = None) -> DataFrame:
    """Rows joined with the half-open intervals [start, end) that hold them; null bounds are open. FLT-01, JN-06.

    With ``on`` the intervals are met by an equi-join on these columns. Without, an
    interval lies in the two cells at most of a size no smaller than itself, and a
    row looks into one cell of each size in use: an equi-join as well, whatever the
    lengths of the intervals.
    """
    inside = (F.col(start).isNull() | (F.col(at) >= F.col(start))) & (F.col(end).isNull() | (F.col(at) < F.col(end)))
    if on:
        right = intervals.select(*[F.col(k).alias(f"_{k}") for k in on], *[c for c in intervals.columns if c not in on])
        keys = reduce(Column.__and__, [F.col(k) == F.col(f"_{k}") for k in on])
        return df.join(right, keys & inside).drop(*[f"_{k}" for k in on])
    low, high = df.select(_number(df, at).alias("x")).agg(F.min("x"), F.max("x")).first()
    if low is None:
        low = high = 0.0
    # Open ends reach as far as the rows do.
    lo, hi = F.greatest(F.coalesce(_number(intervals, start), F.lit(low)), F.lit(low)), F.least(F.coalesce(_number(intervals, end), F.lit(high + 1)), F.lit(high + 1))
    sized = intervals.withColumn("_lo", lo).withColumn("_hi", hi).where((F.col("_lo") < F.col("_hi")) & (F.col(start).isNull() | F.col(end).isNull() | (F.col(start) < F.col(end))))
    sized = materialize(sized.withColumn("_size", F.ceil(F.log2(F.col("_hi") - F.col("_lo"))).cast("int")), "intervals")
    # Sizes are powers of two: as many as there are bits in the lengths.
    sizes = sorted(r[0] for r in sized.select("_size").distinct().collect())
    cell = lambda x, size: F.floor(x / F.pow(F.lit(2.0), size))
    right = sized.withColumn("_cell", F.explode(F.sequence(cell(F.col("_lo"), F.col("_size")), cell(F.col("_hi"), F.col("_size"))))).drop("_lo", "_hi")
    x = _number(df, at)
    looks = F.array(*[F.struct(F.lit(n).alias("size"), cell(x, F.lit(n)).alias("cell")) for n in sizes]) if sizes else F.array().cast("array<struct<size:int,cell:bigint>>")
    left = df.withColumn("_look", F.explode(looks))
    return left.join(right, (F.col("_look.size") == F.col("_size")) & (F.col("_look.cell") == F.col("_cell")) & inside).drop("_look", "_size", "_cell")


def two_hop(edges: DataFrame, subject: str = "subject", predicate: str = "predicate", obj: str = "object", leads: Column | None = None) -> DataFrame:
    """(subject, via, object, first_predicate, second_predicate): paths of two edges, the first of those that ``leads`` on. JN-13."""
    first = edges if leads is None else edges.where(leads)
    a = first.select(F.col(subject).alias("subject"), F.col(predicate).alias("first_predicate"), F.col(obj).alias("via"))
    b = edges.select(F.col(subject).alias("via"), F.col(predicate).alias("second_predicate"), F.col(obj).alias("object"))
    return a.join(b, "via").select("subject", "via", "object", "first_predicate", "second_predicate")


def pivot_merge(df: DataFrame, key: str, kind: str, value: str, kinds: list[str]) -> DataFrame:
    """One row per key with the greatest value of each kind. JN-11."""
    return df.groupBy(key).agg(*[F.max(F.when(F.col(kind) == k, F.col(value))).alias(k) for k in kinds])


def boxes_meeting(left: DataFrame, right: DataFrame, cell: float) -> DataFrame:
    """Pairs of boxes that overlap, met on grid cells of a side, each pair once. JN-15.

    Both sides: id, min_x, min_y, max_x, max_y. A pair is kept in the cell that
    holds the lower corner of its overlap.
    """

    def celled(df: DataFrame, tag: str) -> DataFrame:
        span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
        named = df.select(*[F.col(c).alias(f"{tag}_{c}") for c in ("id", "min_x", "min_y", "max_x", "max_y")])
        named = named.withColumn("cell_x", F.explode(span(f"{tag}_min_x", f"{tag}_max_x")))
        return named.withColumn("cell_y", F.explode(span(f"{tag}_min_y", f"{tag}_max_y")))

    pairs = celled(left, "a").join(celled(right, "b"), ["cell_x", "cell_y"])
    low_x, low_y = F.greatest("a_min_x", "b_min_x"), F.greatest("a_min_y", "b_min_y")
    meet = (low_x <= F.least("a_max_x", "b_max_x")) & (low_y <= F.least("a_max_y", "b_max_y"))
    first = (F.floor(low_x / cell) == F.col("cell_x")) & (F.floor(low_y / cell) == F.col("cell_y"))
    return pairs.where(meet & first).select(F.col("a_id").alias("left_id"), F.col("b_id").alias("right_id"))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under a total order. WN-01, WN-02.

    An aggregate with map-side combining, so that a key of very many rows is
    not gathered; null keys are keys.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def latest_version(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key under a total order, tombstones included. WN-03."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def positions(df: DataFrame, array: str, *, start: int = 0, keep: list[str] | None = None) -> DataFrame:
    """One row per element with its position in the array. WN-04, WN-05, NS-13."""
    out = df.select(*(keep or [c for c in df.columns if c != array]), F.posexplode(array).alias("position", "item"))
    return out.withColumn("position", F.col("position") + start)


def numbered_shards(df: DataFrame, order: list[str], rows_per_shard: int) -> DataFrame:
    """``df`` with ``shard``: exactly ``rows_per_shard`` rows each but the last, in order. WN-08, SNK-01, SNK-03.

    Rows are ranged by the order, counted per range, and numbered inside each
    range after the counts of those before it: no global sort in one task. The
    ranges come from a sample, so they are written down before both uses. Rows
    equal in the order are told apart by a hash of their columns, so that very many
    of them make several ranges; full copies may be numbered either way.
    """
    tie = F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind])
    ranged = materialize(df.withColumn("_tie", tie).repartitionByRange(*order, "_tie").withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    number = F.row_number().over(Window.partitionBy("_part").orderBy(*order, "_tie"))
    out = ranged.withColumn("_number", number).join(sizes.select("_part", before.alias("_before")), "_part")
    return out.withColumn("shard", F.floor((F.col("_before") + F.col("_number") - 1) / rows_per_shard)).drop("_part", "_tie", "_number", "_before")


def in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of both. SO-01."""
    return a.intersect(b)


def missing_from(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of the first that the second lacks. SO-02."""
    return a.subtract(b)


def distinct_union(frames: list[DataFrame]) -> DataFrame:
    """Distinct union of frames of one schema. SO-03, SO-06."""
    return reduce(DataFrame.unionByName, frames).distinct()


def tagged_union(frames: dict[str, DataFrame], tag: str = "source_format") -> DataFrame:
    """UNION ALL by name with the origin of each row; columns that a frame lacks are null. SO-04, SO-05."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [df.withColumn(tag, F.lit(name)) for name, df in frames.items()])


def first_distinct(df: DataFrame, column: str, k: int) -> DataFrame:
    """First k distinct values in order. LM-04, LM-06."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).limit(k)
