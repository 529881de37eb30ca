import datetime
import random

import pytest
from dateutil.easter import easter
from pyspark.sql import functions as F

from caretiers.functions import booleans, dates, fhir, holidays
from caretiers.functions.text import normalize_municipality_name

D = datetime.date


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_booleans(spark):
    df = spark.createDataFrame([("Y", 1, "k"), ("N", 0, "yes"), ("?", 2, ""), (None, None, None)], "a string, b int, c string")
    assert values(df, booleans.string_to_boolean(df.a, ["Y"], ["N"])) == [True, False, None, None]
    assert values(df, booleans.map_to_boolean(df.b, "1", ["0"])) == [True, False, None, None]
    converted = booleans.convert_strings_to_boolean(df, ["c", "a", "absent"], ["Y", "yes"], ["N"])
    assert converted.columns == ["a", "b", "c"]
    assert values(converted, "a") == [True, False, None, None] and values(converted, "c") == [None, True, None, None]


def test_municipality_names(spark):
    names = ["MÄNTTÄ-VILPPULA", "turku", "å-ä-", "", None, "KOSKI TL"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert values(df, normalize_municipality_name(df.name)) == ["Mänttä-Vilppula", "Turku", "Å-Ä-", "", None, "Koski Tl"]


def test_int_to_date(spark):
    cases = {20240229: D(2024, 2, 29), 20230229: None, 20241301: None, 2024010: None, 202401010: None, -2024010: None, None: None}
    df = spark.createDataFrame([(n,) for n in cases], "day int")
    assert values(dates.convert_ints_to_dates(df, ["day"]), "day") == list(cases.values())
    text = spark.createDataFrame([("20240229",), ("20240229\n",), ("２０２４０２２９",)], "day string")
    assert values(text, dates.convert_int_expr_to_date(text.day)) == [D(2024, 2, 29), None, None]
    with pytest.raises(Exception, match="absent"):
        dates.convert_ints_to_dates(df, ["absent"])


@pytest.mark.parametrize(
    ("pattern", "text"),
    [
        ("%Y-%m-%d", "2024-3-05"),
        ("%Y%m%d", "20240305"),
        ("%d.%m.%Y %H:%M:%S", "5.3.2024 7:08:09"),
        ("%Y-%m-%dT%H:%M:%S", "2024-03-05T23:59:59"),
        ("day %j of %Y", "day 065 of 2024"),
        ("%d %b %y, %I %p", "5 Mar 24, 7 PM"),
        ("100%% %Y/%m/%d", "100% 2024/03/05"),
    ],
)
def test_timestamp_text_to_date(spark, pattern, text):
    df = spark.createDataFrame([(text,), (None,)], "t string")
    assert values(df, dates.timestamp_to_date(df.t, pattern)) == [D(2024, 3, 5), None]


def test_timestamps_to_dates(spark):
    df = spark.sql("SELECT timestamp'2024-03-05 23:59:59' AS a, timestamp_ntz'2024-03-05 00:00:00' AS b, 1 AS c")
    converted = dates.convert_timestamps_to_dates(df, ["a", "b", "absent"])
    assert tuple(converted.select("a", "b", "c").first()) == (D(2024, 3, 5), D(2024, 3, 5), 1)
    assert dates.convert_timestamps_to_dates(df, ["absent"]) is df
    with pytest.raises(ValueError, match="%Q"):
        dates.java_pattern("%Q")
    bad = spark.createDataFrame([("soon",)], "t string")
    with pytest.raises(Exception, match="(?i)parse"):
        bad.select(dates.timestamp_to_date(bad.t, "%Y-%m-%d")).collect()


def brute_force(start, end, ignored):
    if start is None or end is None:
        return None
    listed = [start + datetime.timedelta(days=i) for i in range((end - start).days + 1)]
    return max(len([day for day in listed if day not in (ignored or [])]) - 1, 0)


def test_datediff_with_ignored_days(spark):
    rng = random.Random(3)
    base = D(2024, 2, 20)

    def day(span=40):
        return None if rng.random() < 0.08 else base + datetime.timedelta(days=rng.randrange(span))

    rows = [(day(), day(), None if rng.random() < 0.1 else [day() for _ in range(rng.randrange(8))]) for _ in range(300)]
    df = spark.createDataFrame(rows, "s date, e date, ignored array<date>")
    assert values(df, dates.datediff(df.s, df.e)) == [None if None in (s, e) else (e - s).days for s, e, _ in rows]
    assert values(df, dates.datediff(df.s, df.e, df.ignored)) == [brute_force(*row) for row in rows]
    listed = [base + datetime.timedelta(days=i) for i in (25, 3, 3, 7, 8, 31)]
    assert values(df, dates.datediff(df.s, df.e, listed)) == [brute_force(s, e, listed) for s, e, _ in rows]
    assert values(df, dates.datediff(df.s, df.e, [])) == [brute_force(s, e, []) for s, e, _ in rows]


def test_easter(spark):
    years = spark.range(1600, 2400).select(F.col("id").cast("int").alias("y"))
    assert all(row.e == easter(row.y) for row in years.select("y", holidays.easter_sunday(F.col("y")).alias("e")).collect())


def test_finnish_holidays(spark):
    # The holidays of 2021 as published.
    of_2021 = ["01-01", "01-06", "04-02", "04-04", "04-05", "05-01", "05-13", "05-23", "06-25", "06-26", "11-06", "12-06", "12-24", "12-25", "12-26"]
    assert holidays.get_finnish_holidays(spark, 2021, 2021) == [D.fromisoformat(f"2021-{day}") for day in of_2021]
    without_eves = holidays.get_finnish_holidays(spark, 2021, 2021, include_eves=False)
    assert D(2021, 6, 25) not in without_eves and D(2021, 12, 24) not in without_eves and len(without_eves) == 13
    # Ascension Day was on May Day in 2008.
    assert len(holidays.get_finnish_holidays(spark, 2008, 2008)) == 14
    assert holidays.holiday_calendar(spark, 2008, 2008).count() == 15
    assert len(holidays.get_finnish_holidays(spark, 2003)) == 60
    # Epiphany and Ascension Day on Saturdays.
    assert {D(1980, 1, 12), D(1980, 5, 10)} <= set(holidays.get_finnish_holidays(spark, 1980, 1980))
    with pytest.raises(ValueError, match="after"):
        holidays.holiday_calendar(spark, 1999)


def test_reference_ids(spark):
    cases = {
        "Patient/123": "123", "urn:uuid:abc-def": "abc-def", "123": "123", "": None, None: None, "urn:uuid:": None, "a/b/c": "c",
        "a/": None, "urn:uuid:a/b": "a/b", "http://x/urn:uuid:y": "urn:uuid:y",
    }
    df = spark.createDataFrame([(c,) for c in cases], "r string")
    assert values(df, fhir.extract_reference_id(df.r)) == list(cases.values())


def test_extension_values(resources):
    text = '{"extension":["x",{"url":"v"},{"url":"u","a":{"b":[{"c":1},{"c":2}]}},{"url":"u","d":5}]}'
    df = resources(text, "{}")
    extensions = fhir.read(df.resource, "extension", "array<variant>")

    def found(*path, ddl="string"):
        return values(df, fhir.extract_extension_value(extensions, "u", path, ddl))

    assert found("a", "b", 1, "c", ddl="bigint") == [2, None]
    assert found("a", "b", 7, "c") == [None, None]
    assert found("a", 0) == [None, None]
    assert found("d") == [None, None]
