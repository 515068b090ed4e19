import datetime as dt
import zoneinfo

from pyspark.sql import functions as F

from almazara.operators import timestamps

M = "Europe/Madrid"
CASES = [
    ("2026-03-04T17:44:54Z", M, "instant", "2026-03-04T17:44:54.000000Z"), ("2025-08-01T12:02:11.7Z", M, "instant", "2025-08-01T12:02:11.700000Z"), ("20250706T163719Z", None, "instant", "2025-07-06T16:37:19.000000Z"),
    ("Wed, 30 Jul 2025 13:14:10 -0400", M, "instant", "2025-07-30T17:14:10.000000Z"), ("2026-02-23 06:02:02+0100", M, "instant", "2026-02-23T05:02:02.000000Z"), ("21/03/2026 05:04 UTC", M, "instant", "2026-03-21T05:04:00.000000Z"),
    ("2025-07-21 09:35:41 EDT", M, "instant", "2025-07-21T13:35:41.000000Z"), ("2025-09-14 07:45:40 JST", M, "instant", "2025-09-13T22:45:40.000000Z"), ("1754784667", M, "instant", "2025-08-10T00:11:07.000000Z"), ("1754784667000", M, "instant", "2025-08-10T00:11:07.000000Z"), ("1754784667000001", M, "instant", "2025-08-10T00:11:07.000001Z"),
    ("19.06.2025 05:32:06,458", M, "resolved", "2025-06-19T03:32:06.458000Z"), ("2025-09-07T07:38", M, "resolved", "2025-09-07T05:38:00.000000Z"), (" 21/07/2025 01:16:24 ", M, "resolved", "2025-07-20T23:16:24.000000Z"), ("19 de enero de 2026, 09:49:13", M, "resolved", "2026-01-19T08:49:13.000000Z"),
    ("6/29/2025 8:39:53 PM", M, "resolved", "2025-06-29T18:39:53.000000Z"), ("11/19/2025 12:05:00 AM", "America/New_York", "resolved", "2025-11-19T05:05:00.000000Z"),
    ("2025-10-26 02:30:00", M, "ambiguous", None), ("2026-03-29 02:30:00", M, "nonexistent", None), ("2026-03-29 03:00:00", M, "resolved", "2026-03-29T01:00:00.000000Z"), ("2025-10-26 03:00:00", M, "resolved", "2025-10-26T02:00:00.000000Z"),
    ("2025-09-07T07:38", None, "unknown_zone", None), ("2025-09-07T07:38", "Nowhere/At_all", "unknown_zone", None),
    ("2023-02-30 10:00:00", M, "invalid", None), ("25:61", M, "invalid", None), ("ayer", M, "invalid", None), ("", M, "invalid", None), ("n/a", M, "invalid", None), ("13/13/2025 10:00:00", M, "invalid", None), ("1/2/2025 13:00:00 PM", M, "invalid", None), ("2025-01-01 10:00:61", M, "invalid", None), ("2025-01-01 10:00:00 XYZ", M, "invalid", None), ("x" * 50_000, M, "invalid", None), (None, M, "null", None),
]


def test_instants(spark):
    df = spark.createDataFrame([(i, t, z) for i, (t, z, *_) in enumerate(CASES)], "id int, t string, z string").withColumn("zone", F.lit(1)).withColumn("month", F.lit(2)).withColumn("offset_s", F.lit(3))
    out = timestamps.to_instants(df, text="t", zone="z", intervals=timestamps.offset_intervals(spark, [M, "America/New_York", "Nowhere/At_all"]))
    found = {r.id: (r.time_status, r.u) for r in out.select("id", "time_status", timestamps.utc_text(F.col("instant_us")).alias("u")).collect()}
    assert {CASES[i][0]: v for i, v in found.items()} == {t: (s, u) for t, _, s, u in CASES} and len(found) == len(CASES)
    assert timestamps.to_instants(df.limit(0), text="t", zone="z", intervals=timestamps.offset_intervals(spark, [])).count() == 0


def test_local_times_against_the_zone_rules(spark):
    zones = ["Europe/Madrid", "Asia/Kolkata", "Australia/Sydney", "America/New_York", "Europe/Lisbon", "America/Los_Angeles"]
    start = dt.datetime(2025, 1, 1)
    data = [(z, start + dt.timedelta(minutes=37 * k)) for z in zones for k in range(0, 25_000, 7)]
    for z in zones:
        data += [(z, dt.datetime(2026, m, d, h, 30)) for m in (3, 4, 10, 11) for d in range(1, 32 if m in (3, 10) else 31) for h in (1, 2, 3)]
    df = spark.createDataFrame([(z, t.strftime("%Y-%m-%d %H:%M:%S")) for z, t in data], "z string, t string")
    out = timestamps.to_instants(df, text="t", zone="z", intervals=timestamps.offset_intervals(spark, zones)).collect()
    for r in out:
        zone, t = zoneinfo.ZoneInfo(r.z), dt.datetime.strptime(r.t, "%Y-%m-%d %H:%M:%S")
        fits = sorted({u for fold in (0, 1) if (u := t.replace(tzinfo=zone, fold=fold).astimezone(dt.timezone.utc)).astimezone(zone).replace(tzinfo=None) == t})
        assert r.time_status == {0: "nonexistent", 1: "resolved", 2: "ambiguous"}[len(fits)]
        assert r.instant_us == (int(fits[0].timestamp()) * 1_000_000 if len(fits) == 1 else None)


def test_calendar_dates(spark):
    cases = {"20/05/2026": "2026-05-20", "12.05.26": "2026-05-12", "2026-05-08T22:00:00Z": "2026-05-09", "2026-04-13 00:00:00": "2026-04-13", "20260422": "2026-04-22", "15 de abril de 2026": "2026-04-15", "miércoles, 13 de mayo de 2026": "2026-05-13", "1775858400000": "2026-04-11", "2026-04-10T00:00:00+02:00": "2026-04-10", "03-05-2026": "2026-05-03", "7/4/26": "2026-04-07", "10-ABR-2026": "2026-04-10", "08-MAY-2026": "2026-05-08", "pendiente": None, "": None, "31.02.26": None, "sin fecha": None}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.d for r in df.select("t", timestamps.calendar_date(F.col("t")).cast("string").alias("d")).collect()} == cases
    clash = df.withColumn("date", F.lit(1)).withColumn("_month", F.lit("x")).drop("_month")
    out = timestamps.to_dates(clash, text="t", zone=M, intervals=timestamps.offset_intervals(spark, [M, "Asia/Tokyo"], *timestamps.years_of(df, "t"), utc=True))
    assert {r.t: r.date and r.date.isoformat() for r in out.collect()} == cases
    # Without the intervals no instant has a date: they decide.
    none = timestamps.to_dates(df, text="t", zone=M, intervals=timestamps.offset_intervals(spark, ["Asia/Tokyo"], utc=True))
    assert {r.t for r in none.collect() if r.date is None and cases[r.t]} == {"2026-05-08T22:00:00Z", "1775858400000", "2026-04-10T00:00:00+02:00"}


def test_years_are_those_of_the_texts(spark):
    times = ["1960-07-01 12:00:00", "1901-03-04 05:06:07", "1700-01-01 00:00:00", "2150-07-01 12:00:00", "2999-07-01 12:00:00", "0099-01-01 10:00:00", "9999-12-31 23:59:59"]
    df = spark.createDataFrame([(t, M) for t in times], "t string, z string")
    assert timestamps.years_of(df, "t") == (99, 9999) and timestamps.years_of(df.limit(0), "t") == (1970, 2100)
    out = timestamps.to_instants(df, text="t", zone="z", intervals=timestamps.offset_intervals(spark, [M], *timestamps.years_of(df, "t"))).collect()
    zone = zoneinfo.ZoneInfo(M)
    for r in out:
        t = dt.datetime.strptime(r.t, "%Y-%m-%d %H:%M:%S")
        if 1850 < t.year < 2400:
            want = t.replace(tzinfo=zone).astimezone(dt.timezone.utc)
            assert r.time_status == "resolved" and r.instant_us == (want - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
        else:
            assert r.time_status == "resolved" and r.instant_us is not None
