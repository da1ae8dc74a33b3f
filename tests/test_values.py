from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenderlake.functions import calendar as cal
from tenderlake.functions import values as V


def one(spark, column, *values):
    """The column over a row with columns a, b, ..."""
    names = "abcdef"[: len(values)]
    kinds = ", ".join(f"{n} {'string' if v is None or isinstance(v, str) else 'boolean' if isinstance(v, bool) else 'double' if isinstance(v, float) else 'bigint'}" for n, v in zip(names, values))
    return spark.createDataFrame([values], kinds).select(column).first()[0]


A, B = "a", "b"


@pytest.mark.parametrize(("text", "clean", "normal"), [(None, None, None), ("", None, None), (" \t\n", None, None), (" Bogotá,  D.C. ", "Bogotá,  D.C.", "BOGOTA, D.C."), ("Ñandú", "Ñandú", "NANDU"), ("Nariño", "Nariño", "NARINO")])
def test_texts(spark, text, clean, normal):
    assert one(spark, V.clean_text(F.col(A)), text) == clean
    assert one(spark, V.normalized(F.col(A)), text) == normal


def test_dates_numbers_and_truth(spark):
    day = lambda x: one(spark, V.to_date(F.col(A)), x)
    assert day("2026-08-07T00:00:00.000") == date(2026, 8, 7) and day("2026-8-1") is None and day("2026-02-30") is None and day(None) is None
    number = lambda x: one(spark, V.to_decimal(F.col(A)), x)
    assert number(" 8054481856630300 ") == Decimal(8054481856630300) and number("NaN") is None and number("abc") is None and number("0.000000") == 0
    truth = lambda x: one(spark, V.to_boolean(F.col(A)), x)
    assert [truth(x) for x in ("Sí", "SI", "no", "F", "maybe", None)] == [True, True, False, False, None, None]


@pytest.mark.parametrize(("number", "digit"), [("900123456", 8), ("800000001", 1), ("899999999", 1), ("123456789", 6), ("12a", None), ("", None), ("1" * 16, None)])
def test_check_digit(spark, number, digit):
    assert one(spark, V.check_digit(F.col(A)), number) == digit


@pytest.mark.parametrize(
    ("kind", "number", "want"),
    [("NIT", "900.123.456", "900123456"), ("NIT", "900-123-456 ", "900123456"), ("Nit", "9001234568", "900123456"), ("NIT", "9001234567", "9001234567"), ("NIT", "1234567896", "1234567896"),
     ("Cédula de Ciudadanía", "9001234568", "9001234568"), ("NIT", "000000000", None), ("NIT", "11111111", None), ("NIT", "SIN DATO", None), ("NIT", None, None), (None, "A1", "A1")],
)
def test_supplier_number(spark, kind, number, want):
    assert one(spark, V.supplier_number(F.col(A), F.col(B)), kind, number) == want


def test_masks_and_names(spark):
    mask = V.masked(F.col(A), F.col(B))
    assert one(spark, mask, "1234567", "CÉDULA DE CIUDADANÍA") == "••••567" and one(spark, mask, "1234", "PASAPORTE") == "••••" and one(spark, mask, "1234567", "NIT") == "1234567"
    assert one(spark, V.masked(F.col(A), F.col(B), everybody=True), "1234567", "NIT") == "••••567"
    assert [one(spark, V.masked_in_lists(F.col(A)), x) for x in ("1234567", "12")] == ["••••567", "12"]
    name = V.display_name(F.col(A), F.col(B), F.col("c"))
    assert one(spark, name, None, "X", True) == "Unión temporal" and one(spark, name, "Ana", "Pasaporte", False) == "Persona natural" and one(spark, name, None, "NIT", False) == "Sin razón social"


def test_scale_buckets_and_changes(spark):
    wrong = V.out_of_scale(F.col(A))
    assert [one(spark, wrong, x) for x in (8.05e15, 4.3e11, 1e13, -1e15)] == [True, False, False, False]
    assert [one(spark, V.bucket(F.col(A), (1, 10)), x) for x in (0.5, 1.0, 9.9, 10.0)] == [1, 2, 2, 3]
    assert one(spark, V.variation(F.col(A), F.col(B)), 5.0, 4.0) == 25 and one(spark, V.variation(F.col(A), F.col(B)), 5.0, 0.0) is None
    assert [one(spark, V.trend(F.col(A)), x) for x in (4.9, -5.0, 7.0)] == ["flat", "down", "up"]
    assert one(spark, V.colombian(F.col(A), 1), 1234567.9) == "1.234.567,9" and one(spark, V.compact_money(F.col(A)), 2.5e12) == "$2,5 billones"
    assert [one(spark, V.usable(F.col(A)), x) for x in ("x", " ", "No Definido", "0.00", None)] == [True, False, False, False, False]


@pytest.mark.parametrize(("year", "day"), [(2024, date(2024, 3, 31)), (2025, date(2025, 4, 20)), (2026, date(2026, 4, 5)), (2027, date(2027, 3, 28))])
def test_easter(year, day):
    assert cal.easter(year) == day


def test_calendar(spark):
    days = cal.holidays(2026)
    assert date(2026, 8, 7) in days and date(2026, 8, 17) in days and 17 <= len(days) <= 18
    table = cal.calendar(spark, date(2026, 1, 1), date(2026, 12, 31))
    spans = spark.createDataFrame([(date(2026, 8, 3), date(2026, 8, 9)), (date(2026, 8, 9), date(2026, 8, 3)), (date(2026, 8, 15), date(2026, 8, 17))], "s date, e date")
    got = {(r.s, r.e): r.business_days for r in cal.business_days(spans, table, "s", "e").collect()}
    assert list(got.values()).count(0) == 2 and got[(date(2026, 8, 3), date(2026, 8, 9))] == 4
    assert one(spark, cal.per_business_day(F.col(A), F.col(B)), 10.0, 0) is None


@pytest.mark.parametrize("said, want", [("VALLE DEL CAUCA", "Valle del Cauca"), ("la  unión y D.C.", "La Unión y D.C."), ("É", "É"), ("", ""), (None, None)])
def test_title(spark, said, want):
    assert spark.createDataFrame([(said,)], "x string").select(V.title(F.col("x"))).first()[0] == want
