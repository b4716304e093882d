from strider.operators import clean

MOTION = "Time long, Pressure double, Altitude double, Temperature double, date string"


def test_cleaning_order(spark):
    rows = [(1, 1000.0, 0.0, None, "d"), (2, float("nan"), 0.0, 20.0, "d"), (3, 1000.0, 0.0, 20.0, "d")]
    df = spark.createDataFrame(rows, MOTION)
    default = clean.clean_motion(df)
    assert [r.Time for r in default.collect()] == [3]
    assert "Temperature" not in default.columns and "Altitude" not in default.columns
    kept = clean.clean_motion(df, null_check="kept")
    assert sorted(r.Time for r in kept.collect()) == [1, 3]


def test_general_cleaning_and_table_map(spark):
    loc = spark.createDataFrame([(1, 0.0, 5.0, "d"), (2, None, 6.0, "d")],
                                "Time long, Ignore1 double, Latitude double, date string")
    motion = spark.createDataFrame([(1, 1.0, 0.0, None, "d")], MOTION)
    out = clean.clean_tables({"Hips_Location": loc, "Hips_Motion": motion})
    assert out["Hips_Location"].columns == ["Time", "Latitude", "date"]
    assert out["Hips_Location"].count() == 1
    assert out["Hips_Motion"].count() == 0


def test_standardize_table_and_checks(spark):
    df = spark.createDataFrame([("010317", 0), ("020317", 1), (None, 2)], "date string, CoarseLabel int")
    assert [r.date for r in clean.standardize_dates(df).collect()] == ["03/01/2017", "03/02/2017", None]
    assert clean.standardize_dates(df.drop("date")).columns == ["CoarseLabel"]
    checks = clean.expectation_checks([("labels", df, "CoarseLabel", 3), ("dates", df, "date", 3)])
    assert [(r.check, r.actual, r.passed) for r in checks.collect()] == [("labels", 3, True), ("dates", 2, False)]


def test_clean_catalog_tables(spark):
    loc = spark.createDataFrame([(1, 0.0, 5.0, "d"), (2, None, 6.0, "d")],
                                "Time long, Ignore1 double, Latitude double, date string")
    motion = spark.createDataFrame([(1, 1.0, 0.0, 20.0, "d"), (2, None, 0.0, 20.0, "d")], MOTION)
    loc.write.mode("overwrite").saveAsTable("Hips_Location")
    motion.write.mode("overwrite").saveAsTable("Hips_Motion")
    written = clean.clean_catalog_tables(spark, ["Hips_Location", "Hips_Motion"])
    assert written == ["Hips_Location_clean", "Hips_Motion_clean"]
    assert spark.table("Hips_Location_clean").columns == ["Time", "Latitude", "date"]
    assert spark.table("Hips_Motion_clean").columns == ["Time", "Pressure", "date"]
    assert spark.table("Hips_Motion_clean").count() == 1
