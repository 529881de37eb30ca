"""Finnish public holidays, computed from the year."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOLIDAY = "struct<date:date,name:string,is_eve:boolean>"


def _quotient(a: Column, n: int) -> Column:
    return ((a - a % n) / n).cast("int")


def easter_sunday(year: Column) -> Column:
    """Sunday after the Gregorian paschal full moon."""
    century = _quotient(year, 100)
    shift = (century - _quotient(century, 4) - _quotient(century * 8 + 13, 25) + 15) % 30
    golden = year % 19
    age = (golden * 19 + shift) % 30
    age = age - F.when((age == 29) | ((age == 28) & (golden > 10)), 1).otherwise(0)
    full_moon = F.date_add(F.make_date(year, F.lit(3), F.lit(21)), age)
    return F.next_day(full_moon, "Sun")


def holidays_of_years(years: DataFrame) -> DataFrame:
    """The holidays (``date``, ``name``, ``is_eve``) of each ``year`` in a frame.

    Two holidays may share a date.
    """
    # Easter is a column of its own, so that it is computed once for all days that depend on it.
    dated = years.select(F.col("year").cast("int").alias("year"))
    dated = dated.select("year", easter_sunday(F.col("year")).alias("easter"))
    return dated.select(F.inline(_holidays(F.col("year"), F.col("easter"))))


def _holidays(year: Column, easter: Column) -> Column:
    """Array of (date, name, is_eve).

    Midsummer and All Saints' Day are Saturdays since 1955. From 1973 to 1990 Epiphany and
    Ascension Day were moved to a Saturday.
    """

    def fixed(month: int, day: int) -> Column:
        return F.make_date(year, F.lit(month), F.lit(day))

    def saturday_after(month: int, day: int) -> Column:
        return F.next_day(fixed(month, day), "Sat")

    moved = year.between(1973, 1990)
    saturdays = year >= 1955
    midsummer = F.when(saturdays, saturday_after(6, 19)).otherwise(fixed(6, 24))
    all_saints = F.when(saturdays, saturday_after(10, 30)).otherwise(fixed(11, 1))
    # The holidays by their Finnish names.
    days = [
        ("Uudenvuodenpäivä", fixed(1, 1)),
        ("Loppiainen", F.when(moved, saturday_after(1, 5)).otherwise(fixed(1, 6))),
        ("Pitkäperjantai", F.date_add(easter, -2)),
        ("Pääsiäispäivä", easter),
        ("Toinen pääsiäispäivä", F.date_add(easter, 1)),
        ("Vappu", fixed(5, 1)),
        ("Helatorstai", F.date_add(easter, F.when(moved, 34).otherwise(39))),
        ("Helluntaipäivä", F.date_add(easter, 49)),
        ("Juhannusaatto", F.date_add(midsummer, -1)),
        ("Juhannuspäivä", midsummer),
        ("Pyhäinpäivä", all_saints),
        ("Itsenäisyyspäivä", fixed(12, 6)),
        ("Jouluaatto", fixed(12, 24)),
        ("Joulupäivä", fixed(12, 25)),
        ("Tapaninpäivä", fixed(12, 26)),
    ]
    return F.array(
        *[F.struct(day.alias("date"), F.lit(name).alias("name"), F.lit(name.endswith("aatto")).alias("is_eve")) for name, day in days]
    ).cast(f"array<{HOLIDAY}>")


def _check_years(start_year: int, end_year: int) -> None:
    if start_year > end_year:
        raise ValueError(f"start_year {start_year} is after end_year {end_year}")


def holiday_calendar(spark: SparkSession, end_year: int, start_year: int = 2000) -> DataFrame:
    """The holidays from one year to another, as a table."""
    _check_years(start_year, end_year)
    return holidays_of_years(spark.range(start_year, end_year + 1).toDF("year"))


def get_finnish_holidays(
    spark: SparkSession, end_year: int, start_year: int = 2000, include_eves: bool = True
) -> list[datetime.date]:
    """The holiday dates as a list (some 15 a year), to be given to ``datediff``."""
    calendar = holiday_calendar(spark, end_year, start_year)
    if not include_eves:
        calendar = calendar.where("not is_eve")
    return [row[0] for row in calendar.select("date").distinct().orderBy("date").collect()]
