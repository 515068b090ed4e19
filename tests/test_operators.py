import datetime as dt

import pytest
from pyspark.sql import functions as F

from almazara import schemas, sinks
from almazara.operators import planning, profile, quality, relational
from almazara.streaming import events


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert profile.column_profile(df).count() == 0 and profile.numeric_summary(df, "a").collect()[0].n == 0
    assert profile.duplicate_count(df, ["a"]).collect()[0].duplicates == 0


def test_profile_is_the_same_for_any_partitioning(spark, rows):
    df = spark.createDataFrame([(i % 7, None if i % 5 == 0 else f"v{i % 3}", float(i)) for i in range(200)], "a int, b string, c double")
    first = rows(profile.column_profile(df.repartition(1)))
    assert rows(profile.column_profile(df.repartition(8))) == first and len(first) == 3


def test_keep_first_and_latest(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z"), ("b", None, "w")], "k string, v int, t string")
    assert rows(relational.keep_first(df, ["k"], [F.coalesce("v", F.lit(0))]), "k", "t") == [("a", "x"), ("b", "w"), (None, "z")]
    assert rows(relational.latest_version(df, ["k"], [F.coalesce("v", F.lit(0))]), "k", "t") == [("a", "y"), ("b", "w"), (None, "z")]


def test_shards_hold_exactly_n(spark):
    df = spark.range(10).repartition(3)
    counts = relational.numbered_shards(df, ["id"], 4).groupBy("shard").count().orderBy("shard").collect()
    assert [(r.shard, r["count"]) for r in counts] == [(0, 4), (1, 4), (2, 2)]


def test_open_intervals(spark, rows):
    df = spark.createDataFrame([(1,), (5,), (9,)], "t int")
    spans = spark.createDataFrame([("a", None, 5), ("b", 5, None)], "n string, lo int, hi int")
    assert rows(relational.within(df, spans, "t", "lo", "hi"), "t", "n") == [(1, "a"), (5, "b"), (9, "b")]


def test_kleene_coordinates(spark):
    df = spark.createDataFrame([(95.0, None), (95.0, 0.0), (None, None), (0.0, 200.0), (0.0, float("nan"))], "lat double, lon double")
    bad = lambda null: df.where(quality.bad_coordinates(F.col("lat"), F.col("lon"), null_is_bad=null)).count()
    assert bad(False) == 3 and bad(True) == 5


def test_gate(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "k int, v string")
    report = quality.unique_check(df, ["k"]).unionByName(quality.required_check(df, ["v"]))
    assert quality.overall(report).collect()[0].status == "fail"
    with pytest.raises(ValueError, match="unique_key, v_not_null"):
        quality.gate(report)
    quality.gate(quality.checks(df, {"fine": F.lit(False)}, min_rows=2))


def test_archive_periods(spark):
    names = ["1979.zip", "2005.zip", "2006.zip", "200601.zip", "201303.zip", "201304.zip", "20130401.export.CSV.zip", "20130331.export.CSV.zip", "201313.zip", "x.zip"]
    got = [r.p.kind if r.p else None for r in spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").select("i", planning.span_named(F.col("n")).alias("p")).orderBy("i").collect()]
    assert got == ["year", "year", None, "month", "month", None, "day", None, None, None]


def test_date_shards_partition_the_range(spark):
    out = planning.date_shards(spark, "1900-01-01", "2003-03-10", coarse_years=50, coarse_until=2000, monthly_from=2002, daily=[("2003-02-01", "2003-02-03")]).orderBy("shard_start").collect()
    assert [(str(r.shard_start), str(r.shard_end)) for r in out[:3]] == [("1900-01-01", "1949-12-31"), ("1950-01-01", "1999-12-31"), ("2000-01-01", "2000-12-31")]
    assert all(b.shard_start - a.shard_end == dt.timedelta(days=1) for a, b in zip(out, out[1:]))
    assert ("2003-02-01", "2003-02-01") in [(str(r.shard_start), str(r.shard_end)) for r in out]


def test_tasks_do_not_overlap(spark):
    zones = spark.createDataFrame([("DE_AT_LU", None, "2018-10-01"), ("DE_LU", "2018-10-01", None)], "zone_key string, valid_from string, valid_to string")
    out = planning.task_grid(zones, ["p"], "2018-08-15", "2018-12-01").orderBy("period_start").collect()
    assert [(r.zone_key, str(r.period_start), str(r.period_end)) for r in out] == [("DE_AT_LU", "2018-08-15", "2018-09-15"), ("DE_AT_LU", "2018-09-15", "2018-10-01"), ("DE_LU", "2018-10-01", "2018-10-15"), ("DE_LU", "2018-10-15", "2018-11-15"), ("DE_LU", "2018-11-15", "2018-12-01")]
    assert [r.period for r in planning.release_periods(spark, 2012, 2013, 2014, 2).orderBy("period").collect()] == ["2012", "2013", "201401", "201402"]


def test_boxes_once(spark, rows):
    a = spark.createDataFrame([(1, 0.0, 0.0, 5.0, 5.0), (2, 9.0, 9.0, 9.5, 9.5)], "id int, min_x double, min_y double, max_x double, max_y double")
    assert rows(relational.boxes_meeting(a, a, 1.0)) == [(1, 1), (2, 2)]


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("year", (F.col("id") % 2).cast("int"))
    sinks.write_exact_shards(df, str(tmp_path / "s"), ["id"], 4)
    assert sorted(r["count"] for r in spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().collect()) == [2, 4, 4]
    sinks.write_by(df, str(tmp_path / "y"), ["year"], ["id"])
    assert spark.read.parquet(str(tmp_path / "y")).where("year = 1").count() == 5
    assert sinks.write_tables({"a": df, "b": df.limit(0)}, str(tmp_path / "t"), 3) == {"a": 10, "b": 0}
    sinks.atomic_json({"x": float("nan"), "d": dt.date(2020, 1, 2)}, str(tmp_path / "j" / "a.json"))
    assert '"x": null' in (tmp_path / "j" / "a.json").read_text()
    files = sinks.checksum_manifest(spark.read.format("binaryFile").load(str(tmp_path / "j"))).collect()
    assert len(files) == 1 and len(files[0].sha256) == 64
    listed = sinks.stage(spark, str(tmp_path / "s"), str(tmp_path / "j"), str(tmp_path / "out"), quality.checks(df, {"ok": F.lit(False)}), "# card")
    assert any(f["path"].endswith("a.json") for f in listed) and (tmp_path / "out" / "UPLOAD_MANIFEST.json").exists()
    with pytest.raises(ValueError):
        sinks.stage(spark, str(tmp_path / "s"), str(tmp_path / "j"), str(tmp_path / "out2"), quality.checks(df, {"bad": F.lit(True)}))


def test_schemas(spark):
    assert len(schemas.DDL) == 42 and len(schemas.columns("gdelt.events")) == 59 and schemas.required("placsp.lots") == ["version_id", "lot_id"]
    assert all(len(schemas.schema(n)) == len(schemas.columns(n)) for n in schemas.DDL)
    assert schemas.export("omie.marginal_prices")[0] == {"name": "date", "type": "date", "nullable": True}


def test_stream_gives_what_the_batch_gives(spark, tmp_path, rows):
    data = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=13 * i), f"t{i % 2}", float(i)) for i in range(100)]
    df = spark.createDataFrame(data, "id int, ts timestamp, kind string, value double")
    df.write.parquet(str(tmp_path / "in"))
    batch = rows(events.tumbling(df, "ts", "1 hour", ["kind"], "value"))
    stream = events.tumbling(events.read_new_files(spark, str(tmp_path / "in"), "id int, ts timestamp, kind string, value double"), "ts", "1 hour", ["kind"], "value")
    query = stream.writeStream.format("memory").queryName("hours").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination(120)
    assert rows(spark.table("hours")) == batch
    assert events.sessions(df, "ts", "20 minutes", ["kind"]).count() == 100


def test_intervals_of_any_length_against_brute_force(spark):
    import random

    rng = random.Random(6)
    points = [(i, rng.uniform(-50, 50)) for i in range(300)] + [(900, None)]
    spans = [(i, a, a + rng.choice([0.0, 0.01, 1.0, 7.5, 80.0])) for i in range(60) for a in [rng.uniform(-60, 60)]] + [(100, None, 0.0), (101, 10.0, None), (102, None, None), (103, 5.0, 4.0)]
    p, s = spark.createDataFrame(points, "p int, x double"), spark.createDataFrame(spans, "s int, lo double, hi double")
    out = relational.within(p, s, "x", "lo", "hi")
    want = sorted((i, k) for i, x in points if x is not None for k, lo, hi in spans if (lo is None or x >= lo) and (hi is None or x < hi))
    assert sorted((r.p, r.s) for r in out.collect()) == want and out.columns == ["p", "x", "s", "lo", "hi"]
    assert "NestedLoop" not in out._jdf.queryExecution().toString() and "Cartesian" not in out._jdf.queryExecution().toString()
    assert relational.within(p.limit(0), s, "x", "lo", "hi").count() == 0 and relational.within(p, s.limit(0), "x", "lo", "hi").count() == 0


def test_shards_of_rows_equal_in_the_order(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.col("id"))
    out = relational.numbered_shards(df, ["k"], 700)
    assert sorted((r.shard, r.n) for r in out.groupBy("shard").agg(F.count("*").alias("n")).collect()) == [(i, 700) for i in range(7)] + [(7, 100)] and out.columns == ["k", "id", "shard"]
