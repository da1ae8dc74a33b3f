"""The Colombian business calendar as a small DataFrame."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Holidays on their day, those moved to the next Monday, and days from Easter Sunday.
FIXED = {(1, 1): "Año Nuevo", (5, 1): "Día del Trabajo", (7, 20): "Independencia", (8, 7): "Batalla de Boyacá", (12, 8): "Inmaculada Concepción", (12, 25): "Navidad"}
MOVED = {(1, 6): "Reyes Magos", (3, 19): "San José", (6, 29): "San Pedro y San Pablo", (8, 15): "Asunción", (10, 12): "Día de la Raza", (11, 1): "Todos los Santos", (11, 11): "Independencia de Cartagena"}
FROM_EASTER = {-3: "Jueves Santo", -2: "Viernes Santo", 43: "Ascensión", 64: "Corpus Christi", 71: "Sagrado Corazón"}


def easter(year: int) -> date:
    """Easter Sunday by the anonymous Gregorian computus."""
    golden, century = year % 19, year // 100
    epact = (19 * golden + century - century // 4 - (century - (century + 8) // 25 + 1) // 3 + 15) % 30
    shift = (32 + 2 * (century % 4) + 2 * (year % 100 // 4) - epact - year % 100 % 4) % 7
    late = (golden + 11 * epact + 22 * shift) // 451
    month, day = divmod(epact + shift - 7 * late + 114, 31)
    return date(year, month, day + 1)


def holidays(year: int) -> dict[date, str]:
    """Names by date; two holidays on one day share it."""
    moved = lambda d: d + timedelta(-d.weekday() % 7)
    out = {date(year, *md): name for md, name in FIXED.items()}
    for d, name in [(moved(date(year, *md)), n) for md, n in MOVED.items()] + [(easter(year) + timedelta(k), n) for k, n in FROM_EASTER.items()]:
        out.setdefault(d, name)
    return out


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """A row a day: day, holiday (name or null), business and upto, the business days from first to it."""
    rows = [(d, n) for y in range(first.year, last.year + 1) for d, n in holidays(y).items()]
    named = spark.createDataFrame(rows, "day date, holiday string")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))
    out = days.join(F.broadcast(named), "day", "left").withColumn("business", F.col("holiday").isNull() & (F.weekday("day") < 5))
    return out.withColumn("upto", F.sum(F.col("business").cast("long")).over(Window.orderBy("day")))


def business_days(df: DataFrame, days: DataFrame, start: str, end: str, out: str = "business_days") -> DataFrame:
    """df with the business days from start to end, both included; 0 where they are reversed.

    days is a calendar(), a row a day of the years in question, hence small.
    """
    small = F.broadcast(days.select("day", "upto", "business"))
    a = small.select(F.col("day").alias(start), (F.col("upto") - F.col("business").cast("long")).alias("__before"))
    b = small.select(F.col("day").alias(end), F.col("upto").alias("__upto"))
    both = df.join(a, start, "left").join(b, end, "left")
    return both.withColumn(out, F.when(F.col(end) < F.col(start), 0).otherwise(F.col("__upto") - F.col("__before"))).drop("__before", "__upto")


def per_business_day(amount: Column, days: Column) -> Column:
    """Null where there is no business day."""
    return F.when(days > 0, amount / days)
