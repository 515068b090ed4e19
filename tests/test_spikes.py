import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from almazara.operators import spikes

SCHEMA = "measurement_id long, device_id long, captured_at timestamp_ntz, value double, unit string, radiation string, location_name string"
T0 = dt.datetime(2026, 4, 1)


def tables(spark):
    return spark.createDataFrame([("cpm", None), ("cps", None), ("usvh", 1.0)], "unit_code string, to_usvh double"), spark.createDataFrame([(1, 300.0, 50.0), (2, 300.0, 50.0)], "device_id long, cpm_per_usvh double, max_usvh double")


def series(n=400, device=1, first=0, seed=0):
    rng = np.random.default_rng(seed)
    return [[first + i, device, T0 + dt.timedelta(minutes=5 * i), float(max(1, rng.poisson(60))), "cpm", None, None] for i in range(n)]


def flags(spark, data, **options):
    out = spikes.flag_readings(spark.createDataFrame(data, SCHEMA).withColumn("block", F.lit(1)).withColumn("home", F.lit("x")), *tables(spark), **options)
    return {r.measurement_id: r.kind for r in out.collect()}


def test_kinds(spark):
    data = series()
    data[50][3], data[100][3], data[101][3] = 900.0, 2.0, 2.0
    for i in range(200, 212):
        data[i][3] = 61.0
    for i in range(230, 239):
        data[i][3] = 61.0  # nine in a row are not stuck
    for i in range(300, 340):
        data[i][3] = 60.0 + 40 * min(i - 300, 340 - i)  # a slow rise is no spike
    data[150][3], data[151][3], data[152][3] = -1.0, float("inf"), 300.0 * 50 + 1
    data[160][4], data[160][5] = None, None  # no unit told: the device's usual one
    data[170][3] = None
    copy = [1000, *data[50][1:]]
    undated = [1001, 1, None, 9000.0, "cpm", None, None]
    absurd = [1002, 1, dt.datetime(1850, 1, 1), -3.0, "cpm", None, None]
    orphan = [1003, None, T0, float("nan"), "cpm", None, None]
    found = flags(spark, data + [copy, undated, absurd, orphan])
    assert 170 not in found
    named = {k: v for k, v in found.items() if v}
    assert {k for k, v in named.items() if v == "impossible"} == {150, 151, 152, 1002, 1003}
    assert {k for k, v in named.items() if v == "stuck"} == set(range(200, 212))
    assert {k for k, v in named.items() if v == "spike"} == {50, 100, 101, 1000}


def test_blocks_give_what_one_block_gives(spark):
    data = series(900, seed=2)
    for i in (120, 299, 300, 301, 650):
        data[i][3] = 1500.0
    for i in range(445, 460):
        data[i][3] = 58.0
    for i in range(600, 900):  # a noisy stretch is judged by the spread of the whole source
        data[i][3] = float(np.round(data[i][3] * np.exp(np.random.default_rng(i).normal() * 0.15)))
    data += series(80, device=2, first=5000)
    whole = flags(spark, data)
    assert flags(spark, data, block_rows=150) == whole
    assert {k for k, v in whole.items() if v == "spike"} == {120, 299, 300, 301, 650} and {k for k, v in whole.items() if v == "stuck"} == set(range(445, 460))


def test_readings_of_one_moment_are_split_too(spark):
    rows = spark.createDataFrame([(i, 1, 7) for i in range(1000)] + [(5000 + i, 2, i) for i in range(230)], "measurement_id long, device_id long, at_us long").repartition(4)
    blocks = spikes.in_blocks(rows, "device_id", ["at_us", "measurement_id"], block_rows=100, halo_rows=10)
    counted = {(r.device_id, r.block): (r.home, r.n) for r in blocks.groupBy("device_id", "block").agg(F.sum(F.col("home").cast("int")).alias("home"), F.count("*").alias("n")).collect()}
    assert [counted[1, b] for b in range(10)] == [(100, 110)] + [(100, 120)] * 8 + [(100, 110)] and [counted[2, b] for b in range(3)] == [(100, 110), (100, 120), (30, 40)]


def test_the_forest_decides(spark, monkeypatch):
    data = series()
    for i in (50, 220, 310):
        data[i][3] = 900.0
    assert {k for k, v in flags(spark, data).items() if v} == {50, 220, 310}
    frame = pd.DataFrame([(r[0], r[1], int(r[2].timestamp() * 1e6), r[3], "cpm", r[3] / 300) for r in data], columns=["measurement_id", "device_id", "at_us", "value", "code", "usvh"])
    found = spikes.judge(frame)
    assert set(found.measurement_id[found.kind == "spike"]) == {50, 220, 310} and found.score[found.kind == "spike"].min() > found.score[found.kind != "spike"].max()
    # Without what the forest tells, no reading is a spike, and a forest that isolates all or others finds others.
    for other in (lambda self, x: np.linspace(1, 0, len(x)), lambda self, x: np.full(len(x), 0.5)):
        monkeypatch.setattr(spikes.IsolationForest, "score", other)
        found = spikes.judge(frame)
        assert set(found.measurement_id[found.kind == "spike"]) != {50, 220, 310}


def test_many_spikes_do_not_hide_one_another():
    data = series(2000, seed=5)
    for i in range(20, 1990, 25):
        data[i][3] = 2000.0
    frame = pd.DataFrame([(r[0], r[1], int(r[2].timestamp() * 1e6), r[3], "cpm", r[3] / 300) for r in data], columns=["measurement_id", "device_id", "at_us", "value", "code", "usvh"])
    found = spikes.judge(frame)
    assert set(found.measurement_id[found.kind == "spike"]) == set(range(20, 1990, 25))


def test_forest_isolates_what_stands_apart():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    x[7] = [12, -9, 10]
    score = spikes.IsolationForest(x, x[:1], 1).score(x)
    assert score.argmax() == 7 and score[7] > 0.65 and np.median(score) < 0.5


@pytest.mark.parametrize("n", [0, 1, 5])
def test_small_tables(spark, n):
    assert all(v is None for v in flags(spark, series(n)).values())
