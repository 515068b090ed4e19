"""Problem 6: implausible spikes, stuck and impossible readings.

Readings of a source are scored by an isolation forest of that source on level,
difference, seasonal and run-length features. Explicit physical limits and runs
of one value come first; a spike is a reading that the forest isolates at least
as much as a reading that stands just at the stated distance from its level,
and that comes back within the stated number of readings.

Sources of up to ``BLOCK_ROWS`` readings are judged in one group. Longer ones
are numbered by a range sort and cut into blocks of that many readings, each with
a halo of the readings before and after it, so a source that holds a third of all
rows, or a moment at which very many readings lie, becomes many tasks. What the
forest and the features need to know of a long source - spread, floor, seasons and
the pool that trees are grown from - is taken over all its blocks first.
"""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from almazara.operators.units import convert, with_source_unit
from almazara.runtime import materialize

BLOCK_ROWS = 20_000
HALO_ROWS = 64
TREES, SAMPLE, DEPTH = 48, 128, 7
#: Readings of a source, the first by a hash of their id, from which its trees draw their samples.
POOL_ROWS = 2048
STUCK_RUN = 10
SPIKE_RUN = 3
#: Usual spreads off its level at which a reading is a spike: of the level and of the difference; the seasonal feature is a spread less strict.
BOUND = np.array([7.0, 7.0, 6.0])
#: Readings on either side that make the local level.
SIDE = 7
#: Residuals are counted in steps of one part in so many, so that medians of a long source are exact sums of its blocks.
STEPS = 4096


class IsolationForest:
    """Isolation forest of complete trees, grown level by level over all trees at once.

    Each tree sees a random sample of ``SAMPLE`` rows, as the method has it, and
    the rows of ``always``.
    """

    def __init__(self, x: np.ndarray, always: np.ndarray, seed: int) -> None:
        rng = np.random.default_rng(seed)
        n, self.features = len(x), always.shape[1]
        z = x[rng.integers(0, n, (TREES, min(SAMPLE, n)))] if n else np.empty((TREES, 0, self.features))
        z = np.concatenate([z, np.broadcast_to(always, (TREES, *always.shape))], axis=1)
        size = z.shape[1]
        node = np.zeros((TREES, size), np.int64)
        tree = np.arange(TREES)[:, None]
        self.splits = []
        path = np.zeros((TREES, 1))
        for level in range(DEPTH):
            k = 2**level
            gid = (tree * k + node).ravel()
            feature = rng.integers(0, self.features, (TREES, k))
            values = np.take_along_axis(z, feature[tree, node][:, :, None], axis=2)[:, :, 0]
            low, high = np.full(TREES * k, np.inf), np.full(TREES * k, -np.inf)
            np.minimum.at(low, gid, values.ravel())
            np.maximum.at(high, gid, values.ravel())
            held = np.bincount(gid, minlength=TREES * k).reshape(TREES, k)
            with np.errstate(invalid="ignore"):
                cut = np.where(held > 0, low.reshape(TREES, k) + rng.random((TREES, k)) * (high - low).reshape(TREES, k), 0.0)
            path = np.repeat(path + (held > 1), 2, axis=1)
            self.splits.append((feature, cut))
            node = 2 * node + (values > cut[tree, node])
        k = 2**DEPTH
        held = np.bincount((tree * k + node).ravel(), minlength=TREES * k).reshape(TREES, k)
        self.path = path + _expected_path(held)
        self.scale = float(_expected_path(np.array([size]))[0]) or 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score of each row, between 0 and 1; isolated rows are nearer to 1."""
        tree, rows = np.arange(TREES)[:, None], np.arange(len(x))
        node = np.zeros((TREES, len(x)), np.int64)
        for feature, cut in self.splits:
            node = 2 * node + (x[rows, feature[tree, node]] > cut[tree, node])
        return 2.0 ** (-self.path[tree, node].sum(axis=0) / TREES / self.scale)


def _expected_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    m = np.maximum(n, 2)
    return np.where(n > 1, 2 * (np.log(m - 1.0) + 0.5772156649) - 2 * (m - 1.0) / m, 0.0)


def _local_level(y: np.ndarray) -> np.ndarray:
    """Median of the readings about each one; at the ends, of the first or last window."""
    width = min(2 * SIDE + 1, len(y))
    med = np.median(np.lib.stride_tricks.sliding_window_view(y, width), axis=1)
    return med[np.clip(np.arange(len(y)) - width // 2, 0, len(med) - 1)]


def _jump(y: np.ndarray) -> np.ndarray:
    """Distance of each reading from the nearer of the medians of the readings before and after it; 0 where it lies between them or has none on a side."""
    edge = np.full(SIDE, np.nan)
    w = np.lib.stride_tricks.sliding_window_view(np.r_[edge, y, edge], SIDE)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)
        before, after = y - np.nanmedian(w[: len(y)], axis=1), y - np.nanmedian(w[SIDE + 1 : SIDE + 1 + len(y)], axis=1)
    return np.where(before * after > 0, np.minimum(np.abs(before), np.abs(after)), 0.0)


def _spread(middle: float, most: float) -> float:
    """Usual spread of residuals whose absolute steps have these median and 0.9 quantile: from the median, or from the quantile where most are equal."""
    return max(1.4826 * middle / STEPS if middle > 0 else most / STEPS / 1.645, 1e-6)


def _steps(residual: np.ndarray) -> np.ndarray:
    return np.rint(residual * STEPS)


class Series:
    """Readings of a source, or of a block of it, in order of time: runs, copies, and what is left to look for spikes in."""

    def __init__(self, frame: pd.DataFrame) -> None:
        self.frame = frame = frame.sort_values(["at_us", "measurement_id"], kind="stable")
        n = len(frame)
        at, value, code, self.level_value = (frame[c].to_numpy() for c in ("at_us", "value", "code", "usvh"))
        # Runs of one value in one unit, copies included.
        new = np.ones(n, bool)
        new[1:] = (value[1:] != value[:-1]) | (code[1:] != code[:-1])
        run_id = np.cumsum(new) - 1
        run = np.bincount(run_id)[run_id]
        self.stuck = run >= STUCK_RUN
        # The series without copies: one reading of each (time, value, unit).
        self.number, _ = pd.factorize(pd.MultiIndex.from_arrays([at, value, code]))
        first = np.zeros(n, bool)
        first[np.unique(self.number, return_index=True)[1]] = True
        self.use = np.flatnonzero(first & ~self.stuck & np.isfinite(self.level_value))
        self.run = run[self.use]
        self.hour = ((at[self.use] // 3_600_000_000) % 24).astype(np.int64)

    def floor(self) -> float:
        """Half the least level above zero."""
        v = self.level_value[np.isfinite(self.level_value) & (self.level_value > 0)]
        return 0.5 * float(v.min()) if len(v) else 1.0

    def measure(self, floor: float) -> None:
        """Residual from the local level and jump from both sides, on a log scale."""
        y = np.log(np.maximum(self.level_value[self.use], floor))
        self.residual = y - _local_level(y)
        self.jump = _jump(y)


def _features(residual: np.ndarray, jump: np.ndarray, hour: np.ndarray, run: np.ndarray, spread: float, season: np.ndarray) -> np.ndarray:
    """Level, difference, seasonal and run-length features; beyond the bound, distance says no more."""
    off = np.stack([np.abs(residual), jump, np.abs(residual - season[hour])], axis=1) / spread
    return np.column_stack([np.minimum(off, BOUND), np.log(run)])


def _grow(pool: np.ndarray, seed: int) -> tuple[IsolationForest, np.ndarray]:
    """(forest, score of a reading just at the bound, by its run length).

    Readings beyond the bound are one point, which every tree sees once: a source
    with many spikes must not hide each one among the others.
    """
    at_bound = np.column_stack([np.tile(BOUND, (STUCK_RUN, 1)), np.log(np.maximum(np.arange(STUCK_RUN), 1))])
    forest = IsolationForest(pool[(pool[:, :3] < BOUND).any(axis=1)], at_bound[1:2], seed)
    return forest, forest.score(at_bound)


def _seeded(ids: np.ndarray) -> np.ndarray:
    """A hash of whole numbers by which pools are drawn."""
    z = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (z ^ (z >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(16)


def own_facts(series: Series) -> dict:
    """Spread, seasons and pool of a source that is one block."""
    step = _steps(series.residual)
    season = np.zeros(24)
    for h in np.unique(series.hour):
        here = step[series.hour == h]
        if len(here) >= 8:
            season[h] = np.median(here) / STEPS
    pool = np.argsort(_seeded(series.frame["measurement_id"].to_numpy()[series.use]), kind="stable")[:POOL_ROWS]
    return {"spread": _spread(float(np.median(np.abs(step))), float(np.quantile(np.abs(step), 0.9))), "season": season, "pool": (series.residual[pool], series.jump[pool], series.hour[pool], series.run[pool])}


def judge(frame: pd.DataFrame, known: dict | None = None) -> pd.DataFrame:
    """Kinds and scores of one source, or of a block of a source of which the facts are known. Impossible readings are left out before."""
    series = Series(frame)
    n, use = len(frame), series.use
    kind, score = np.full(n, None, object), np.zeros(n)
    kind[series.stuck] = "stuck"
    if len(use) >= 2 * SPIKE_RUN + 2:
        series.measure(known["floor"] if known else series.floor())
        facts = known or own_facts(series)
        forest, bound = _grow(_features(*facts["pool"], facts["spread"], facts["season"]), seed=int(frame["device_id"].iloc[0]) & 0x7FFFFFFF)
        s = forest.score(_features(series.residual, series.jump, series.hour, series.run, facts["spread"], facts["season"]))
        out = s >= bound[series.run] - 1e-9
        sign = np.where(out, np.sign(series.residual), 0)
        begins = np.r_[True, sign[1:] != sign[:-1]]
        group = np.cumsum(begins) - 1
        spike = out & (np.bincount(group)[group] <= SPIKE_RUN)
        hit, scores = np.zeros(series.number.max() + 1, bool), np.zeros(series.number.max() + 1)
        hit[series.number[use[spike]]] = True
        scores[series.number[use]] = s
        score = scores[series.number]
        kind[hit[series.number] & ~series.stuck] = "spike"
    home = series.frame["home"].to_numpy() if "home" in series.frame else np.ones(n, bool)
    return pd.DataFrame({"measurement_id": series.frame["measurement_id"].to_numpy()[home], "score": score[home], "kind": kind[home]})


def in_blocks(rows: DataFrame, source: str, order: list[str], *, block_rows: int = BLOCK_ROWS, halo_rows: int = HALO_ROWS) -> DataFrame:
    """``rows`` with ``block`` and ``home``: each row in its block of its source, and again (home false) in the halo of its neighbours.

    A range sort by source and ``order`` (which must tell rows apart) puts rows of
    one source into as many parts as they need; a row's number in its source is its
    place in its part after the rows of the parts before, so no source and no
    moment of a source comes into one task.
    """
    placed = rows.repartitionByRange(source, *order).sortWithinPartitions(source, *order)
    placed = materialize(placed.withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id().bitwiseAND(2**33 - 1)), "placed")
    parts = placed.groupBy(F.col(source).alias("_source"), F.col("_part").alias("_p")).agg(F.count("*").alias("_k"), F.min("_seq").alias("_first"))
    whole = Window.partitionBy("_source")
    before = F.coalesce(F.sum("_k").over(whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = materialize(parts.select("_source", "_p", (before - F.col("_first")).alias("_base"), F.sum("_k").over(whole).alias("_n")), "parts")
    numbered = placed.join(parts, (F.col(source) == F.col("_source")) & (F.col("_part") == F.col("_p"))).withColumn("_rank", F.col("_seq") + F.col("_base"))
    block = F.floor(F.col("_rank") / block_rows)
    near = F.array_compact(F.array(block, F.when((F.col("_rank") % block_rows < halo_rows) & (block > 0), block - 1), F.when((F.col("_rank") % block_rows >= block_rows - halo_rows) & ((block + 1) * block_rows < F.col("_n")), block + 1)))
    return numbered.select(*rows.columns, block.alias("_b"), F.explode(near).alias("block")).withColumn("home", F.col("block") == F.col("_b")).drop("_b")


def _measured():
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        series = Series(frame)
        if len(series.use) < 2 * SPIKE_RUN + 2:
            return pd.DataFrame({"device_id": [], "hash": [], "residual": [], "jump": [], "hour": [], "run": []})
        series.measure(float(frame["floor"].iloc[0]))
        home = series.frame["home"].to_numpy()[series.use]
        ids = series.frame["measurement_id"].to_numpy()[series.use]
        return pd.DataFrame({"device_id": frame["device_id"].iloc[0], "hash": _seeded(ids).astype(np.int64), "residual": series.residual, "jump": series.jump, "hour": series.hour, "run": series.run})[home]

    return run


def judge_long(rows: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(measurement_id, score, kind) of sources of more than a block.

    The facts of a source are aggregates over all its blocks: exact medians of
    residual steps, which are combined before the shuffle, and the pool, whose
    size is fixed. Each block meets the facts of its source once.
    """
    floor = materialize(rows.groupBy("device_id").agg((F.coalesce(F.min(F.when((F.col("usvh") > 0) & (F.col("usvh") < float("inf")), F.col("usvh"))), F.lit(2.0)) * 0.5).alias("floor"), F.count("*").alias("n")), "floors")
    f = floor.select(F.col("device_id").alias("_d"), "floor")
    blocks = materialize(in_blocks(rows, "device_id", ["at_us", "measurement_id"], block_rows=block_rows).join(f, F.col("device_id") == F.col("_d")).drop("_d"), "blocks")
    measured = blocks.groupBy("device_id", "block").applyInPandas(_measured(), "device_id long, hash long, residual double, jump double, hour int, run int")
    measured = materialize(measured, "measured")
    step = F.rint(F.col("residual") * STEPS)
    spread = measured.groupBy("device_id").agg(F.percentile(F.abs(step), F.array(F.lit(0.5), F.lit(0.9))).alias("spread"))
    season = measured.groupBy("device_id", "hour").agg(F.percentile(step, F.lit(0.5)).alias("season"), F.count("*").alias("n")).where(F.col("n") >= 8).groupBy("device_id").agg(F.map_from_entries(F.collect_list(F.struct("hour", "season"))).alias("season"))
    # Hashes are even: a cut by the source's number of readings leaves some two pools of any source, of which the first pool is kept.
    n = floor.select(F.col("device_id").alias("_d"), "n")
    few = measured.join(n, F.col("device_id") == F.col("_d")).drop("_d").where(F.col("hash") <= F.lit(2.0**48) * F.least(F.lit(1.0), F.lit(2.0 * POOL_ROWS) / F.col("n")))
    pool = few.groupBy("device_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("hash", "residual", "jump", "hour", "run"))), 1, POOL_ROWS).alias("pool"))
    facts = floor.select("device_id", "floor").join(spread, "device_id").join(season, "device_id", "left").join(pool, "device_id")
    listed = blocks.select("device_id", "block").distinct()
    facts = materialize(listed.join(facts, "device_id", "left"), "facts")

    def run(frame: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        row = told.iloc[0]
        if row["pool"] is None:
            return judge(frame, {"floor": 1.0, "spread": 1.0, "season": np.zeros(24), "pool": (np.zeros(0), np.zeros(0), np.zeros(0, np.int64), np.ones(0))})
        season = np.zeros(24)
        for hour, at in (row["season"] or {}).items():
            season[hour] = at / STEPS
        pool = tuple(np.array([p[c] for p in row["pool"]]) for c in ("residual", "jump", "hour", "run"))
        return judge(frame, {"floor": float(row["floor"]), "spread": _spread(*row["spread"]), "season": season, "pool": pool})

    return blocks.groupBy("device_id", "block").cogroup(facts.groupBy("device_id", "block")).applyInPandas(run, "measurement_id long, score double, kind string")


def readings_with_level(measurements: DataFrame, factors: DataFrame, devices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readings with their unit, value in µSv/h and whether they are impossible; readings of each device).

    Where no unit is told, the device's most frequent told unit holds (ties: the
    first by name).
    """
    m = measurements.select("measurement_id", "device_id", F.unix_micros(F.col("captured_at").cast("timestamp")).alias("at_us"), F.year("captured_at").alias("year"), "value", "unit", "radiation", "location_name").where(F.col("value").isNotNull())
    told = with_source_unit(m, unit="unit", texts=["radiation", "location_name"]).drop("unit", "radiation", "location_name", "unit_told_by")
    told = materialize(told, "readings")
    by_unit = told.groupBy("device_id", "source_unit").agg(F.count("*").alias("n"))
    known = F.when(F.col("source_unit").isNotNull(), F.struct(-F.col("n"), "source_unit"))
    facts = materialize(by_unit.groupBy("device_id").agg(F.min_by("source_unit", known).alias("usual"), F.sum("n").alias("n")), "device_facts")
    usual = facts.select(F.col("device_id").alias("_device"), F.col("usual").alias("_usual"))
    rows = told.join(usual, F.col("device_id") == F.col("_device"), "left").drop("_device")
    rows = rows.withColumn("source_unit", F.coalesce("source_unit", "_usual")).drop("_usual")
    rows = convert(rows, value="value", factors=factors, devices=devices, device="device_id")
    limit = devices.select(F.col("device_id").alias("_device"), F.col("max_usvh").alias("_max"))
    rows = rows.join(limit, F.col("device_id") == F.col("_device"), "left").drop("_device")
    infinite = F.isnan("value") | (F.abs("value") == float("inf"))
    bad = infinite | (F.col("value") < 0) | F.coalesce(F.col("value_usvh") > F.col("_max"), F.lit(False))
    return rows.withColumn("impossible", bad).drop("_max"), facts.select("device_id", "n")


def flag_readings(measurements: DataFrame, factors: DataFrame, devices: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(measurement_id, kind, score): every reading with a value, with its kind of fault or null.

    Kinds in order: ``impossible``, ``stuck``, ``spike``. Readings without
    device, without time or outside the years 2000 to 2029 are judged for
    ``impossible`` only (score null), as are those whose value has no level.
    """
    rows, counts = readings_with_level(measurements, factors, devices)
    timed = F.col("year").between(2000, 2029) & F.col("device_id").isNotNull()
    judged = rows.where(~F.col("impossible") & F.coalesce(timed, F.lit(False))).select("measurement_id", "device_id", "at_us", "value", F.coalesce("source_unit", F.lit("")).alias("code"), F.col("value_usvh").alias("usvh"))
    n = counts.select(F.col("device_id").alias("_d"), (F.col("n") > block_rows).alias("_long"))
    judged = judged.join(n, F.col("device_id") == F.col("_d")).drop("_d")
    short = judged.where(~F.col("_long")).drop("_long").groupBy("device_id").applyInPandas(lambda f: judge(f), "measurement_id long, score double, kind string")
    rest = rows.where(F.col("impossible") | ~F.coalesce(timed, F.lit(False))).select("measurement_id", F.lit(None).cast("double").alias("score"), F.when(F.col("impossible"), "impossible").alias("kind"))
    out = short.unionByName(rest)
    if counts.where(F.col("n") > block_rows).isEmpty():
        return out
    return out.unionByName(judge_long(judged.where("_long").drop("_long"), block_rows=block_rows))
