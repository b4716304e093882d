"""Column functions on values built the other way round: from known dates, times and texts."""

import datetime as dt
import itertools

from strider.functions.dates import ordinal_date_text, standardize_date
from strider.functions.timecols import slot_text

SUFFIXES = """1st 2nd 3rd 4th 5th 6th 7th 8th 9th 10th 11th 12th 13th 14th 15th 16th 17th 18th 19th 20th
21st 22nd 23rd 24th 25th 26th 27th 28th 29th 30th 31st""".split()


def test_standardize_date_from_known_days(spark):
    made = []
    day = dt.date(1950, 1, 1)
    while day.year < 2050:
        for mark in ("", "-", "/", ". ", "a_"):
            made.append((day.strftime(f"%d{mark}%m{mark}%y"), day.strftime("%m/%d/%Y")))
        day += dt.timedelta(days=37)
    other = ["", "12", "12345", "1234567", "01/02/2017", "no digits", None]
    made += [(text, text) for text in other]
    df = spark.createDataFrame([(text,) for text, _ in made], "d string")
    assert [r[0] for r in df.select(standardize_date("d")).collect()] == [want for _, want in made]


def test_slot_text_all_slots(spark):
    df = spark.range(48).selectExpr("cast(id as int) AS s")
    got = [r[0] for r in df.select(slot_text("s")).collect()]
    clock = itertools.product(range(24), (0, 30))
    assert got == [dt.time(h, m).strftime("%I:%M %p").lstrip("0") for h, m in clock]


def test_ordinal_dates_whole_year(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(366)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(ordinal_date_text("d")).collect()]
    assert got == [d.strftime(f"%B {SUFFIXES[d.day - 1]}, %Y") for d in days]
