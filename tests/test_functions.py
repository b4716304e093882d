import datetime as dt

from pyspark.sql import functions as F

from strider.functions.dates import ordinal_date_text, standardize_date
from strider.functions.durations import duration_text, percentage
from strider.functions.labels import activity_text
from strider.functions.timecols import (day_end_ms, half_hour_slot, iso_weekday, slot_text,
                                        to_epoch_ms)
from strider.functions.vectors import array_sum, magnitude, majority_vote


def col_values(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_duration_text_sql_style(spark):
    ms = [0, 10, 59990, 60000, 3599990, 3600000, 360000000]
    got = col_values(spark, [(m,) for m in ms], "ms long", duration_text("ms", "sql"))
    assert got == ["0.0 seconds", "0.01 seconds", "59.99 seconds", "1.0 minutes",
                   "60.0 minutes", "1.0 hours", "100.0 hours"]


def test_duration_text_python_style(spark):
    got = col_values(spark, [(10,), (60000,), (90600,)], "ms long", duration_text("ms", "python"))
    assert got == ["0.01 seconds", "1.00 minutes", "1.51 minutes"]


def test_percentage_half_up(spark):
    got = col_values(spark, [(2, 6), (1, 6), (1, 8), (0, 5)], "c long, t long", percentage("c", "t"))
    assert got == [33.33, 16.67, 12.5, 0.0]


def test_standardize_date(spark):
    inp = ["010317", "01-03-17", "310549", "310550", "999917", "03/01/2017", "12", "", None]
    got = col_values(spark, [(d,) for d in inp], "d string", standardize_date("d"))
    assert got == ["03/01/2017", "03/01/2017", "05/31/2049", "05/31/1950", "99/99/2017",
                   "03/01/2017", "12", "", None]


def test_slot_and_weekday(spark):
    ms = [1488326400000, 1488328199999, 1488328200000, 1488412799999, 1488672000000]
    df = spark.createDataFrame([(m,) for m in ms], "t long")
    got = [(r[0], r[1]) for r in df.select(half_hour_slot("t"), iso_weekday("t")).collect()]
    assert got == [(0, 3), (0, 3), (1, 3), (47, 3), (0, 7)]


def test_day_end_and_epoch_params():
    assert day_end_ms(1488360000000) == 1488412799999
    assert to_epoch_ms(dt.datetime(2024, 1, 10, 6, 0)) == 1704866400000
    assert to_epoch_ms("2024-01-10T06:00:00.750") == 1704866400000


def test_slot_text(spark):
    got = col_values(spark, [(s,) for s in (0, 1, 23, 24, 25, 47)], "s int", slot_text("s"))
    assert got == ["12:00 AM", "12:30 AM", "11:30 AM", "12:00 PM", "12:30 PM", "11:30 PM"]


def test_ordinal_date(spark):
    days = [dt.date(2026, 12, 1), dt.date(2026, 12, 11), dt.date(2026, 12, 22),
            dt.date(2026, 12, 23), dt.date(2026, 12, 30), dt.date(2026, 12, 12)]
    got = col_values(spark, [(d,) for d in days], "d date", ordinal_date_text("d"))
    assert got == ["December 1st, 2026", "December 11th, 2026", "December 22nd, 2026",
                   "December 23rd, 2026", "December 30th, 2026", "December 12th, 2026"]


def test_vote_and_sum(spark):
    rows = [([1.0, 2.0, 2.0, 3.0, 3.0],), ([0.0, 0.0, 4.0, 4.0, 4.0],), ([5.0] * 5,)]
    df = spark.createDataFrame(rows, "a array<double>")
    got = [(r[0], r[1]) for r in df.select(majority_vote("a"), array_sum("a")).collect()]
    assert got == [(2.0, 11.0), (4.0, 12.0), (5.0, 25.0)]


def test_activity_text(spark):
    got = col_values(spark, [(i,) for i in (0, 4, 7, 8, None)], "c int", activity_text("c"))
    assert got == ["Still", "Driving", "On Subway", "Unknown", "Unknown"]


def test_magnitude(spark):
    got = col_values(spark, [(3.0, 4.0, 12.0)], "x double, y double, z double", magnitude("x", "y", "z"))
    assert got == [13.0]


def test_time_columns_ignore_session_time_zone(spark):
    from strider.functions.timecols import day_folder, epoch_ms, epoch_ms_whole_seconds
    df = spark.createDataFrame([("2024-07-01 00:30:07.179575",), ("2024-03-10 02:30:00.001",),
                                ("2024-11-03 01:30:00",)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("ts"))
    exprs = [epoch_ms("ts"), epoch_ms_whole_seconds("ts"), day_folder("ts"),
             half_hour_slot(epoch_ms("ts")), iso_weekday(epoch_ms("ts"))]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        la = [tuple(r) for r in df.select(*exprs).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    utc = [tuple(r) for r in df.select(*exprs).collect()]
    assert la == utc
    assert utc[0] == (1719793807179, 1719793807000, "010724", 1, 1)
    assert utc[1][0] == 1710037800001 and utc[1][2] == "100324"


def _half_up(x) -> "Decimal":
    from decimal import ROUND_HALF_UP, Decimal
    from decimal import getcontext
    getcontext().prec = 50
    return (Decimal(x.numerator) / Decimal(x.denominator)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def test_rounding_matches_exact_arithmetic(spark):
    import random
    from fractions import Fraction
    rnd = random.Random(12)
    pairs = [(c, c + rnd.randint(0, 10**7)) for c in [rnd.randint(0, 10**7) for _ in range(3000)]]
    pairs += [(1, 8), (1, 16), (5, 400), (1, 3), (2, 3)]
    pairs = [(c, t) for c, t in pairs if t > 0]
    df = spark.createDataFrame(pairs, "c long, t long")
    got = [r[0] for r in df.select(percentage("c", "t")).collect()]
    want = [float(_half_up(Fraction(c * 100, t))) for c, t in pairs]
    assert got == want

    ms = [rnd.randint(0, 10**11) for _ in range(3000)] + [59994, 59995, 3599994, 3599995, 90300, 90299]
    df = spark.createDataFrame([(m,) for m in ms], "ms long")
    got = [r[0] for r in df.select(duration_text("ms", "python")).collect()]

    def text(m):
        unit, name = (1000, "seconds") if m < 60000 else (60000, "minutes") if m < 3600000 else (3600000, "hours")
        return f"{_half_up(Fraction(m, unit))} {name}"
    assert got == [text(m) for m in ms]


def test_percentages_and_durations_are_exact_at_scale(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    from strider.functions.durations import duration_text, percentage
    rng = random.Random(8)
    rows = [(6416122838092, 17426707161274)]
    for _ in range(20000):
        total = rng.randint(10 ** 11, 10 ** 16)
        rows.append((rng.randint(0, total), total))
    got = spark.createDataFrame(rows, "c long, t long").select(
        percentage("c", "t").alias("p"), duration_text("c", "python").alias("d")).collect()
    for (c, t), r in zip(rows, got):
        assert r.p == ((200 * c * 100 + t) // (2 * t)) / 100
        if c >= 3_600_000:
            hours = (Decimal(c) / 3_600_000).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert r.d == f"{hours} hours"
    assert got[0].p == 36.82
