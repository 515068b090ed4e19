import datetime as dt
import random

from pyspark.sql import functions as F

from almazara.functions.durations import duration_seconds
from almazara.operators import grid

UTC = dt.timezone.utc
T0 = dt.datetime(2026, 5, 5, 0, 0, tzinfo=UTC)
SCHEMA = "zone string, ts timestamp, step long, price double, rev int"


def at(minutes, seconds=0):
    return T0 + dt.timedelta(minutes=minutes, seconds=seconds)


def make(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def run(df, **options):
    return grid.regular_grid(df, keys=["zone"], ts="ts", step="step", value="price", order=[F.coalesce("rev", F.lit(-1))], **options)


def test_durations(spark, rows):
    texts = ["PT60M", "pt1h", " PT1H0M ", "PT3600S", "P1D", "P1W", "P1M", "PT0S", "P", "", "x", None, "PT1.5H", "PT15M"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", duration_seconds(F.col("t")).alias("s"))
    found = {r.t: r.s for r in df.collect()}
    assert [found[t] for t in texts] == [3600, 3600, 3600, 3600, 86400, 604800, None, None, None, None, None, None, None, 900]


def test_gaps_copies_revisions_and_off_grid(spark, rows):
    nan = float("nan")
    df = make(spark, [("A", at(1), 900, 10.0, 1), ("A", at(1), 900, 12.0, 2), ("A", at(1), 900, 12.0, 2), ("A", at(20), 900, None, 1), ("A", at(33), 900, nan, 1), ("A", at(59), 900, 5.0, None), ("B", at(0), 3600, 1.0, 1)])
    out = {(r.zone, (r.period_epoch - int(T0.timestamp())) // 60): r for r in run(df).collect()}
    assert sorted(out) == [("A", 0), ("A", 15), ("A", 30), ("A", 45), ("B", 0)]
    assert [out["A", m].status for m in (0, 15, 30, 45)] == ["measured", "missing", "missing", "measured"]
    assert out["A", 0].twa == 12.0 and abs(out["A", 0].covered_fraction - 14 / 15) < 1e-12 and out["A", 0].readings == 1


def test_time_weighted_average_and_fill(spark):
    df = make(spark, [("A", at(0), 900, 10.0, 1), ("A", at(5), 900, 40.0, 1), ("A", at(50), 900, 7.0, 1)])
    out = sorted(run(df, fill="previous").collect(), key=lambda r: r.period_epoch)
    assert out[0].twa == (10 * 5 + 40 * 10) / 15 and out[0].covered_fraction == 1.0
    assert [r.status for r in out] == ["measured", "filled", "filled", "measured"] and out[2].filled_value == out[0].twa


def test_carry_over_cells(spark):
    df = make(spark, [("A", at(0), 900, 10.0, 1), ("A", at(40), 900, 20.0, 1)])
    out = sorted(run(df, carry_s=1200).collect(), key=lambda r: r.period_epoch)
    assert [round(r.covered_fraction, 6) for r in out[:3]] == [1.0, 1.0, 0.666667]
    assert out[2].twa == (10.0 * 5 + 20.0 * 5) / 10


def test_long_series_in_blocks_against_brute_force(spark):
    rng = random.Random(3)
    old, grid.BLOCK = grid.BLOCK, 16
    try:
        data = [("H", at(rng.randrange(0, 15 * 300)), 900, rng.choice([1.0, None, float("nan")]), 1) for _ in range(250)]
        out = {r.period_epoch // 900: r for r in run(make(spark, data), fill="previous").collect()}
    finally:
        grid.BLOCK = old
    cells = [int(t.timestamp()) // 900 for _, t, *_ in data]
    good = {int(t.timestamp()) // 900 for _, t, _, v, _ in data if v == 1.0}
    assert set(out) == set(range(min(cells), max(cells) + 1))
    assert {c for c, r in out.items() if r.status == "measured"} == good
    first = min(good)
    assert all((r.filled_value is None) == (c < first) for c, r in out.items())


def test_nulls_empty_and_extra_columns(spark):
    assert run(make(spark, [])).count() == 0
    df = make(spark, [(None, at(0), 900, 1.0, 1), ("A", None, 900, 1.0, 1), ("A", at(0), None, 1.0, 1), ("A", at(0), -5, 1.0, 1), ("A", at(0), 900, 1.0, 1)])
    df = df.withColumn("cell", F.lit("x")).withColumn("value", F.lit(9)).withColumn("step_s", F.lit(1)).withColumn("block", F.lit(0))
    assert run(df).count() == 1
