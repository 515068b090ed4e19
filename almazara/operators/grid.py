"""Problem 1: irregular readings onto a regular grid.

Each reading becomes a step-function validity interval; the intervals are cut
by the cells of the grid, and every cell gets its time-weighted average and the
fraction of it that is covered. All groupings are by (series, cell) or
(series, block of cells), so a series that holds a third of all rows is spread
over as many tasks as it has blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of one series that one task lists or fills at a time.
BLOCK = 1024


def _floor_div(a: Column, b: Column) -> Column:
    """Whole-number floor division, exact for any microsecond count of a timestamp."""
    return F.round((a - F.pmod(a, b)) / b).cast("long")


def series_intervals(df: DataFrame, *, keys: list[str], ts: str, step: str, value: str, order: list[Column] | None = None, carry_s: int = 0) -> DataFrame:
    """Step-function validity intervals of the readings that have a value.

    ``ts``: timestamp column, ``step``: column of whole seconds, ``value``:
    double column. Rows with a null key, time or step, and rows whose value is
    null or NaN, make no interval. Of rows of one series at one time the first
    under ``order`` stands (ties: the greatest value), so copies and superseded
    revisions count once. A reading holds until the next one of its cell, or to
    the end of its cell; with ``carry_s`` > 0 the last reading of a cell holds
    ``carry_s`` seconds beyond the end of that cell or until the next reading.
    Columns: keys, step_s, cell (number of the period since 1970), start_us,
    end_us, value.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    width = F.col(step).cast("long") * 1_000_000
    got = df.where(F.col(step) > 0).where(F.col(ts).isNotNull() & F.col(value).isNotNull() & ~F.isnan(value))
    for k in keys:
        got = got.where(F.col(k).isNotNull())
    # The best row of a time point by a map-side combined aggregate, not by a window over the series.
    rank = F.struct(*(order or []), F.col(value).alias("v"))
    got = got.groupBy(*[F.col(k).alias(k) for k in keys], F.col(step).cast("long").alias("step_s"), us.alias("start_us"), _floor_div(us, width).alias("cell")).agg(F.max(rank)["v"].alias("value"))
    cell_end = (F.col("cell") + 1) * F.col("step_s") * 1_000_000
    inside = Window.partitionBy(*keys, "step_s", "cell").orderBy("start_us")
    got = got.withColumn("end_us", F.coalesce(F.lead("start_us").over(inside), cell_end))
    if carry_s <= 0:
        return got
    # The first reading of the next cell that has one bounds what is carried over: first by block, then across blocks.
    last = got.where(F.col("end_us") == cell_end)
    cells = got.groupBy(*keys, "step_s", "cell").agg(F.min("start_us").alias("first_us")).withColumn("block", F.floor(F.col("cell") / BLOCK))
    by_block = cells.groupBy(*keys, "step_s", "block").agg(F.min("first_us").alias("block_first"))
    by_block = by_block.withColumn("after_us", F.lead("block_first").over(Window.partitionBy(*keys, "step_s").orderBy("block")))
    within = Window.partitionBy(*keys, "step_s", "block").orderBy("cell")
    nxt = cells.withColumn("next_us", F.lead("first_us").over(within)).join(by_block.drop("block_first"), [*keys, "step_s", "block"]).select(*keys, "step_s", "cell", F.coalesce("next_us", "after_us").alias("next_us"))
    bound = F.least(cell_end + carry_s * 1_000_000, F.coalesce("next_us", cell_end + carry_s * 1_000_000))
    last = last.join(nxt, [*keys, "step_s", "cell"]).withColumn("end_us", F.greatest("end_us", bound)).drop("next_us")
    return got.where(F.col("end_us") < cell_end).unionByName(last)


def grid_cells(df: DataFrame, *, keys: list[str], ts: str, step: str) -> DataFrame:
    """Every period of every series, from that of its first row to that of its last.

    A row counts whether or not it has a value. The extent of a series is a
    map-side combined aggregate; its cells are listed in blocks, so that no
    task holds a long series at once.
    """
    cell = _floor_div(F.unix_micros(F.col(ts).cast("timestamp")), F.col(step).cast("long") * 1_000_000)
    rows = df.where((F.col(step) > 0) & F.col(ts).isNotNull())
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    ends = rows.select(*keys, F.col(step).cast("long").alias("step_s"), cell.alias("cell")).groupBy(*keys, "step_s").agg(F.min("cell").alias("lo"), F.max("cell").alias("hi"))
    blocks = ends.select("*", F.explode(F.sequence(F.floor(F.col("lo") / BLOCK), F.floor(F.col("hi") / BLOCK))).alias("block")).repartition(*keys, "step_s", "block")
    return blocks.select(*keys, "step_s", "block", F.explode(F.sequence(F.greatest("lo", F.col("block") * BLOCK), F.least("hi", F.col("block") * BLOCK + (BLOCK - 1)))).alias("cell"))


def regular_grid(df: DataFrame, *, keys: list[str], ts: str, step: str, value: str, order: list[Column] | None = None, carry_s: int = 0, fill: str = "none") -> DataFrame:
    """One row per period of each series: average, coverage, and how it was filled.

    Columns: keys, step_s, period_epoch (seconds), covered_fraction (0 where no
    reading is valid in the period), twa (time-weighted average over the covered
    part, null there), readings, filled_value, status (``measured``,
    ``filled`` or ``missing``). ``fill='previous'`` puts the average of the last
    measured period before into ``filled_value``; a leading gap stays
    ``missing``. An empty input gives no rows; extra columns are ignored.
    """
    us = 1_000_000
    cut = series_intervals(df, keys=keys, ts=ts, step=step, value=value, order=order, carry_s=carry_s)
    width = F.col("step_s") * us
    if carry_s > 0:
        cut = cut.select("*", F.explode(F.sequence(F.col("cell"), _floor_div(F.col("end_us") - 1, width))).alias("at"))
    else:
        cut = cut.withColumn("at", F.col("cell"))
    part = F.least("end_us", (F.col("at") + 1) * width) - F.greatest("start_us", F.col("at") * width)
    cut = cut.select(*keys, "step_s", F.col("at").alias("cell"), part.alias("part_us"), "value", (F.col("at") == F.col("cell")).cast("long").alias("own"))
    cells = cut.groupBy(*keys, "step_s", "cell").agg(F.sum("part_us").alias("cover_us"), F.sum(F.col("value") * F.col("part_us")).alias("area"), F.sum("own").alias("readings"))
    out = grid_cells(df, keys=keys, ts=ts, step=step).join(cells, [*keys, "step_s", "cell"], "left")
    out = out.withColumn("twa", F.col("area") / F.col("cover_us")).withColumn("covered_fraction", F.coalesce(F.col("cover_us") / width, F.lit(0.0)))
    if fill == "previous":
        within = Window.partitionBy(*keys, "step_s", "block").orderBy("cell")
        tails = out.groupBy(*keys, "step_s", "block").agg(F.max_by("twa", F.when(F.col("twa").isNotNull(), F.col("cell"))).alias("tail"))
        before = Window.partitionBy(*keys, "step_s").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        tails = tails.select(*keys, "step_s", "block", F.last("tail", ignorenulls=True).over(before).alias("carried"))
        out = out.join(tails, [*keys, "step_s", "block"]).withColumn("filled_value", F.coalesce(F.last("twa", ignorenulls=True).over(within), "carried"))
    else:
        out = out.withColumn("filled_value", F.col("twa"))
    status = F.when(F.col("covered_fraction") > 0, "measured").when(F.col("filled_value").isNotNull(), "filled").otherwise("missing")
    return out.select(*keys, "step_s", (F.col("cell") * F.col("step_s")).alias("period_epoch"), "covered_fraction", "twa", F.coalesce("readings", F.lit(0).cast("long")).alias("readings"), "filled_value", status.alias("status"))
