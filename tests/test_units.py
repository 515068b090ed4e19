import pytest
from pyspark.sql import functions as F

from almazara.operators import units

TOLD = {
    "cpm": "cpm", " CPM ": "cpm", "c.p.m.": "cpm", "counts/min": "cpm", "counts per minute": "cpm", "cuentas por minuto": "cpm", "cps": "cps", "c/s": "cps", "cuentas/s": "cps", "counts per second": "cps",
    "uSv/h": "usvh", "µSv/h": "usvh", "μSv·h⁻¹": "usvh", "uSv h-1": "usvh", "USV/H": "usvh", "microsievert/hora": "usvh", "usv": "usvh", "nSv·h-1": "nsvh", "nanosieverts per hour": "nsvh", "mSv/h": "msvh", "milisievert por hora": "msvh",
    "uR/h": "urh", "microroentgen per hour": "urh", "mR/hr": "mrh", "milliroentgens per hour": "mrh",
    "1000 nSv/h": "usvh", "0.001 uSv/h": "nsvh", "1e-3 mSv/h": "usvh", "10^-3 µSv/h": "nsvh", "1000 uR/h": "mrh", "0.001 mR/h": "urh", "1000 µSv/h": "msvh", "1." + "0" * 60 + " uSv/h": "usvh", "0." + "0" * 8 + "1e9 uSv/h": "usvh", "   counts      per \t  minute   " + " " * 90: "cpm", "cuentas . . . . . . . . por minuto": "cpm",
}


@pytest.mark.parametrize("text", TOLD)
def test_written_units(text):
    assert units.code_of(text) == (TOLD[text], 1.0)


@pytest.mark.parametrize("text", [None, "", " ", "?", "n/a", "see notes", "banana", "h", "m/s", "x" * 5000, "5", "Sv" * 40, ". " * 2000, "c" + " . " * 5000, "10^999 uSv/h", "1e999 cpm", "9" * 5000])
def test_no_unit(text):
    assert units.code_of(text) is None


def test_scale_that_is_no_unit_stays():
    assert units.code_of("10 cpm") == ("cpm", 10.0)


@pytest.mark.parametrize("text,code", [("gamma; readings in CPM", "cpm"), ("Radiación gamma [µR/h]", "urh"), ("beta+gamma (nanosieverts per hour)", "nsvh"), ("lectura expresada en cuentas por minuto, gamma", "cpm"), ("mR/h gamma", "mrh"), ("la dosis de este aparato está escrita siempre en milliroentgens a la hora y en nada más", "mrh"), ("x " * 3000 + "uSv/h", "usvh"), ("calibrated with a source of 300 cpm", None), ("Salpelares km 9", None), ("gamma", None), ("air", None), ("", None), (None, None), ("a" * 100_000, None), (". " * 50_000, None)])
def test_units_in_texts(text, code):
    assert (units.code_in(text) or (None,))[0] == code


def test_columns_and_conversion(spark):
    data = [(1, 600.0, "cpm", None, None, 5), (2, 10.0, "counts per second", None, None, 5), (3, 2.0, None, "gamma; readings in mR/h", "x [CPM]", 5), (4, 2.0, "?", None, "x [nSv/h]", None), (5, 2.0, None, None, None, 5), (6, None, "uSv/h", None, None, 5), (7, 3.0, "1000 nSv/h", None, None, 99)]
    df = spark.createDataFrame(data, "id int, value double, unit string, radiation string, location_name string, device_id long").withColumn("scale", F.lit("clash")).withColumn("to_usvh", F.lit(0))
    tagged = units.with_source_unit(df, unit="unit", texts=["radiation", "location_name"])
    factors = spark.createDataFrame([("cpm", float("nan")), ("cps", None), ("usvh", 1.0), ("nsvh", 0.001), ("mrh", 10.0)], "unit_code string, to_usvh double")
    devices = spark.createDataFrame([(5, 300.0)], "device_id long, cpm_per_usvh double")
    out = {r.id: r for r in units.convert(tagged, value="value", factors=factors, devices=devices, device="device_id").collect()}
    assert {i: r.source_unit for i, r in out.items()} == {1: "cpm", 2: "cps", 3: "mrh", 4: "nsvh", 5: None, 6: "usvh", 7: "usvh"}
    assert [out[i].value_usvh for i in (1, 2, 3, 5, 6, 7)] == [2.0, 2.0, 20.0, None, None, 3.0] and abs(out[4].value_usvh - 0.002) < 1e-15
    assert out[3].unit_told_by == "radiation" and out[4].unit_told_by == "location_name"
    assert units.with_source_unit(df.limit(0), unit="unit", texts=["radiation"]).count() == 0
