import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martforge.functions import codes as C
from martforge.functions.columns import (
    any_nonzero, fallback_text, is_unset, name_matches_any, not_flagged, safe_div, sap_date, strip_leading_zeros,
)


def test_strip_leading_zeros(spark):
    df = spark.createDataFrame([("0000123",), ("0000",), ("00A1",), ("",), (None,)], "k string")
    out = df.select("k", strip_leading_zeros(F.col("k")).alias("s"),
                    strip_leading_zeros(F.col("k"), keep_zero=True).alias("z")).collect()
    got = {r.k: (r.s, r.z) for r in out}
    assert got["0000123"] == ("123", "123")
    assert got["0000"] == ("", "0")
    assert got["00A1"] == ("00A1", "00A1")
    assert got[""] == ("", "")
    assert got[None] == (None, None)


def test_sap_date_forms(spark):
    df = spark.createDataFrame([("20240131",), ("00000000",), ("",), (None,), ("2024-01-31",)], "d string")
    got = [r.x for r in df.select(sap_date(F.col("d")).alias("x")).collect()]
    assert got == [dt.date(2024, 1, 31), None, None, None, dt.date(2024, 1, 31)]
    typed = spark.createDataFrame([(dt.date(2023, 5, 6),)], "d date")
    assert typed.select(sap_date(F.col("d")).alias("x")).first().x == dt.date(2023, 5, 6)


def test_flags_and_blanks(spark):
    df = spark.createDataFrame([("X",), ("",), (None,), ("Y",)], "f string")
    got = df.select("f", not_flagged("f").alias("n"), is_unset(F.col("f")).alias("u")).collect()
    assert {r.f: (r.n, r.u) for r in got} == {"X": (False, False), "": (True, True), None: (True, True),
                                               "Y": (True, False)}


def test_safe_div_zero_and_null(spark):
    df = spark.createDataFrame([(Decimal("10.00"), Decimal("0")), (Decimal("10.00"), None),
                                (Decimal("10.00"), Decimal("4"))], "n decimal(11,2), d decimal(5,0)")
    got = [r.q for r in df.select(safe_div(F.col("n"), F.col("d")).alias("q")).collect()]
    assert got[0] is None and got[1] is None and got[2] == Decimal("2.5")


def test_fallback_text(spark):
    df = spark.createDataFrame([(None, "free", "master"), ("", "free", "master"), ("M1", "free", None),
                                ("M2", "free", "master")], "k string, f string, m string")
    got = [r.t for r in df.select(fallback_text("k", "f", "m").alias("t")).collect()]
    assert got == ["free", "free", None, "master"]


def test_any_nonzero_and_name_patterns(spark):
    df = spark.createDataFrame([(0, 0, "Acme Corp"), (0, -1, "other"), (None, 0, None)], "a int, b int, n string")
    got = df.select(any_nonzero("a", "b").alias("z"), name_matches_any(F.col("n"), ["acme", "zzz"]).alias("m")).collect()
    assert [(r.z, r.m) for r in got] == [(False, True), (True, False), (None, None)]


def test_decode_codes_default(spark):
    df = spark.createDataFrame([("08",), ("Z5",), ("99",), (None,)], "c string")
    got = [r.s for r in df.select(C.decode_codes("c", C.REJECT_STATUS, C.REJECT_STATUS_DEFAULT).alias("s")).collect()]
    assert got == ["Canceled", "Closed", "none", "none"]
    no_default = [r.s for r in df.select(C.decode_codes("c", C.REJECT_STATUS).alias("s")).collect()]
    assert no_default == ["Canceled", "Closed", None, None]


def test_material_class_table(spark):
    cases = [("ZERT", "F", "Tradable/Resale"), ("ZALB", "F", "Raw"), ("ZALB", "E", "Semi-FG"),
             ("ZALB", "X", "Semi-FG"), ("ZALB", "", "Semi-FG"), ("ZALB", None, "Semi-FG"), ("ZERT", "E", "FG"),
             ("ZERT", None, "FG"), ("ZERP", "F", "Operating/Packing Supplies"), ("ZHMI", None, "Operating/Packing Supplies"),
             ("ZIBE", "E", "Operating/Packing Supplies"), ("ZIEN", "F", "Service"), ("ZLAG", "E", "Non-Stock Material"),
             ("ZROC", None, "Non-Stock Material"), ("ZROH", "F", "Raw"), ("ZAWB", "E", "Tradable/Resale"),
             ("ZAWA", None, "Tradable/Resale"), ("FERT", "F", "Unknown"), ("ZERT", "Z", "Unknown")]
    df = spark.createDataFrame([c[:2] for c in cases], "t string, p string")
    got = [r.c for r in df.select(C.classify("t", "p").alias("c")).collect()]
    assert got == [c[2] for c in cases]


def test_code_tables_consistent():
    assert set(C.MOVEMENT_TYPE_TEXT) == set(C.MOVEMENT_CATEGORY)
    assert len(C.MOVEMENT_TYPE_TEXT) == 81
    assert set(C.MOVEMENT_CATEGORY.values()) == {"Goods Receipt", "Goods Issue", "Transfer", "Scrap", "Adjustment"}
    assert len(C.ORDER_TYPE) == 19 and len(C.BILLING_TYPE) == 101 and len(C.REJECT_STATUS) == 13
