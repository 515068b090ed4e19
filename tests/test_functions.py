import pytest
from pyspark.sql import functions as F

from almazara.functions import geo, ids, numbers, temporal, text


def values(spark, cases, expression, kind="string"):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], f"i int, c {kind}").select("i", expression(F.col("c")).alias("v"))
    return [r.v for r in df.orderBy("i").collect()]


@pytest.mark.parametrize(
    "function,cases",
    [
        (text.strip_html, {"<p>Dose&nbsp;<strong>once</strong> daily.</p>": "Dose once daily.", "a &amp; b": "a & b", "": "", None: None}),
        (text.repair_mojibake, {"MAZALEÃ“N": "MAZALEÃ“N", "MAZALEÃ\u0093N": "MAZALEÓN", "Ã": "Ã", "Leó�n": "Leóón", "plain": "plain", None: None}),
        (text.intensity_number, {"VIII-IX": 8.5, "V": 5.0, "3": 3.0, "-1": None, "IV-?": None, "": None, None: None}),
        (text.location_suffix, {"NW X.FRA": "FRA", "A.LP,Isla": "LP", "no dot": None, None: None}),
        (numbers.lenient_double, {"1,5": 1.5, " 2.5 ": 2.5, "1d": None, "NaN": None, "": None, None: None}),
        (numbers.spanish_double, {"1.234,5": 1234.5, "55,40": 55.4, "x": None}),
        (numbers.strict_long, {"+12": 12, " 7 ": 7, "1.0": None, "x1": None, "99999999999999999999": None}),
        (numbers.strict_double, {"1e3": 1000.0, ".5": 0.5, "Infinity": None, "1f": None}),
        (temporal.date_prefix, {"2025-02-01T10:00": "2025-02-01", "2025-02-30": None, "x": None}),
        (temporal.compact_date, {"20240229": "2024-02-29", "20230229": None, "2024": None}),
        (temporal.iso_instant, {"2025-01-01T00:00Z": "2025-01-01 00:00:00", "2025-01-01T00:00:00.804+02:00": "2024-12-31 22:00:00.804", "2025-01-01T05:06:07": "2025-01-01 05:06:07", "2025-01-01": "2025-01-01 00:00:00", "x": None}),
        (text.human_bytes, None),
    ],
)
def test_text_functions(spark, function, cases):
    if cases is None:
        assert values(spark, [512, 2048, 5 * 1024**3], function, "long") == ["512.0 B", "2.0 KiB", "5.0 GiB"]
        return
    found = values(spark, list(cases), lambda c: function(c).cast("string") if function.__module__.endswith("temporal") else function(c))
    assert found == list(cases.values())


def test_countries(spark):
    from almazara.sources.delimited import FOREIGN, SPANISH

    found = values(spark, ["N X.FRA", "N X.POR", "N X.GR", "N X.LP,Isla", "W. Lisboa", "none", None], lambda c: text.country_of(c, FOREIGN, SPANISH))
    assert [(r.code, r.name) if r else None for r in found] == [("FR", "France"), ("PT", "Portugal"), ("ES", "Spain"), ("ES", "Spain"), None, None, None]


def test_record_ids_tell_steps_apart(spark):
    import datetime as dt
    import hashlib

    t = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(t, "PT60M", None, 0), (t, "PT15M", "A01", 2)], "t timestamp, r string, c string, p int")
    got = [r.h for r in df.select(ids.price_record_id(F.lit("day_ahead_prices"), F.lit("ES"), F.col("t"), F.col("r"), F.lit("A62"), F.col("c"), F.lit(None).cast("string"), F.col("p")).alias("h")).collect()]
    want = [hashlib.sha256(s.encode()).hexdigest() for s in ("day_ahead_prices|ES|2025-01-01T00:00:00+00:00|PT60M|A62|||", "day_ahead_prices|ES|2025-01-01T00:00:00+00:00|PT15M|A62|A01||2")]
    assert got == want


def test_gazette_and_shortening(spark):
    page = "DIARIO DE SESIONES DEL CONGRESO DE LOS DIPUTADOS 1\nPLENO Y DIPUTACIÓN\nNúm. 5   x   Pág. 7 Señorías, sí.\n"
    assert values(spark, [page], text.gazette_body) == ["Señorías, sí."]
    assert values(spark, ["a" * 5, "a" * 4, None], lambda c: text.shortened(c, 4)) == ["aaaa…", "aaaa", None]
    assert values(spark, ["https://x.es/a b/ñ.zip"], text.quoted_url) == ["https://x.es/a%20b/%C3%B1.zip"]


def test_projection_round_trip():
    # Central meridian and known corner values of zone 30 (Madrid lies near 440000, 4474000).
    (lon, lat), = geo.to_degrees([(500000.0, 0.0)], 25830)
    assert abs(lon + 3) < 1e-9 and abs(lat) < 1e-9
    (lon, lat), = geo.to_degrees([(440290.0, 4474257.0)], 25830)
    assert abs(lon + 3.7037) < 2e-3 and abs(lat - 40.4165) < 2e-3
    assert geo.to_degrees([(1.0, 2.0)], 4326) == [(1.0, 2.0)] and geo.to_degrees([], 25830) == []
    with pytest.raises(ValueError):
        geo.to_degrees([(0.0, 0.0)], 9999)
