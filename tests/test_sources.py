import os

from pyspark.sql import functions as F

from strider.sources import sinks
from strider.sources.sensor_files import (date_from_path, kind_from_name, parse_sensor_lines,
                                          read_sensor_csv, read_sensor_text)
from strider.schemas import kind_of


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_text_parse_golden(spark, tmp_path):
    base = tmp_path / "raw"
    _write(str(base / "010317" / "Hips_Location.txt"),
           "1488360000000 0 0  12.5 50.82 -0.13 NaN\n  1488360000010\t0 0 1 2 3 4 \n\n")
    _write(str(base / "010317" / "Label.txt"), "")
    _write(str(base / "010317" / "notes.csv"), "x")
    df = read_sensor_text(spark, str(base), "Location")
    rows = sorted(df.collect(), key=lambda r: r.Time)
    assert len(rows) == 2
    assert rows[0].Time == 1488360000000 and rows[0].Accuracy == 12.5
    assert rows[0].Altitude != rows[0].Altitude          # NaN
    assert rows[1].Longitude == 3.0 and rows[1].Altitude == 4.0
    assert {r.date for r in rows} == {"010317"}
    assert read_sensor_text(spark, str(base), "Label").count() == 0
    _write(str(base / "020317" / "Bag_Location.txt"), "5 0 0 1 2 3 4\n")
    assert read_sensor_text(spark, str(base), "Location").count() == 3
    hips = read_sensor_text(spark, str(base), "Location", stem="Hips_Location")
    assert sorted(r.Time for r in hips.collect()) == [1488360000000, 1488360000010]


def test_try_cast_and_padding(spark):
    lines = spark.createDataFrame([("abc 1.5",), ("7",)], "value string")
    got = parse_sensor_lines(lines, "labels_track_main", mode="permissive").collect()
    assert got[0].StartTime is None and got[0].EndTime is None      # 'abc', '1.5' → null bigint
    assert got[1].StartTime == 7 and got[1].Activity is None


def test_too_many_fields(spark):
    import pytest
    for wrong in ("1 2 3 4", "1 2"):
        with pytest.raises(Exception):
            parse_sensor_lines(spark.createDataFrame([(wrong,)], "value string"), "labels_track_main").collect()
    lines = spark.createDataFrame([("1 2 3 4",)], "value string")
    assert parse_sensor_lines(lines, "labels_track_main", mode="permissive").count() == 1


def test_kind_rule(spark):
    assert kind_of("Hips_Motion.txt") == "Motion"
    assert kind_of("labels_track_main.txt") == "labels_track_main"
    assert kind_of("Hips_Motion.csv") is None
    df = spark.createDataFrame([("Bag_API_Motion.txt",), ("x.csv",)], "n string")
    assert [r[0] for r in df.select(kind_from_name("n")).collect()] == ["API", None]
    paths = spark.createDataFrame([("file:/a/b/220617/Hips_Motion.txt",)], "p string")
    assert paths.select(date_from_path("p")).first()[0] == "220617"


def test_csv_round_trip(spark, tmp_path):
    base = tmp_path / "csv"
    _write(str(base / "010317" / "Hips_Location.csv"),
           "Time,Ignore1,Ignore2,Accuracy,Latitude,Longitude,Altitude\n1,0,0,5,50.8,-0.1,3\n")
    _write(str(base / "020317" / "Hips_Location.csv"),
           "Time,Ignore1,Ignore2,Accuracy,Latitude,Longitude,Altitude\n2,0,0,6,50.9,-0.2,4\n")
    os.makedirs(base / "030317")
    df = read_sensor_csv(spark, str(base), "Location", "Hips_Location.csv")
    assert sorted((r.Time, r.date) for r in df.collect()) == [(1, "010317"), (2, "020317")]
    out = str(tmp_path / "out_csv")
    sinks.write_csv(df, out)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 2 and "date" in back.columns


def test_table_append_and_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "table")
    a = spark.createDataFrame([(1, "d1"), (2, "d2")], "Time long, date string")
    sinks.write_table(a, path)
    sinks.write_table(a, path)                       # append: rerun duplicates rows
    assert spark.read.parquet(path).count() == 4
    b = spark.createDataFrame([(9, "d2")], "Time long, date string")
    sinks.write_table(b, path, mode="overwrite", dynamic_overwrite=True)
    got = sorted((r.Time, r.date) for r in spark.read.parquet(path).collect())
    assert got == [(1, "d1"), (1, "d1"), (9, "d2")]
    sinks.write_table(b, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 1


def test_prediction_and_anomaly_writers(spark, tmp_path):
    df = spark.createDataFrame([("d", 1, 2.0, -1), ("d", 2, 3.0, 1)],
                               "date string, Time long, final_prediction double, prediction int")
    sinks.write_predictions(df, str(tmp_path / "pred"))
    assert spark.read.option("header", True).csv(str(tmp_path / "pred")).columns == \
        ["date", "Time", "final_prediction"]
    sinks.write_anomalies(df, str(tmp_path / "anom"))
    assert spark.read.option("header", True).csv(str(tmp_path / "anom")).count() == 1
    sinks.write_report(df.select(F.lit(0.5).alias("Accuracy")).limit(1), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first().Accuracy == 0.5


def test_replace_results_keeps_old_on_empty(spark, tmp_path):
    path = str(tmp_path / "stats")
    first = spark.createDataFrame([("Still", 1.0)], "Activity string, Percentage double")
    assert sinks.replace_results(first, path)
    assert not sinks.replace_results(first.where("Percentage > 5"), path)
    assert not sinks.replace_results(None, path)
    assert spark.read.parquet(path).count() == 1


def test_report_text_and_locations(spark, tmp_path):
    rep = spark.createDataFrame([(10, 0.61236, 0.5, 0.61236, "If (feature 0 <= 1.0)")],
                                "Depth int, Accuracy double, Precision double, Recall double, Tree string")
    text = sinks.report_lines(rep).first().value.split("\n")
    assert text[2:5] == ["Accuracy: 0.6124", "Precision: 0.5000", "Recall: 0.6124"]
    assert text[-1] == "If (feature 0 <= 1.0)"
    sinks.write_report_text(rep, str(tmp_path / "report_txt"))
    assert spark.read.text(str(tmp_path / "report_txt")).count() == len(text)
    locs = spark.createDataFrame([(50.8, -0.1, 3)], "Predicted_Latitude double, Predicted_Longitude double, half_hour_interval int")
    sinks.write_predicted_locations(locs, str(tmp_path / "pred_loc"))
    assert spark.read.parquet(str(tmp_path / "pred_loc")).count() == 1


def test_release_folder_keeps_body_positions(spark, tmp_path):
    from strider.operators.features import label_motion_join
    from strider.schemas import SCHEMAS, with_date
    from strider.sources.sensor_files import ingest_release
    day = tmp_path / "raw" / "010317"
    day.mkdir(parents=True)
    width = {k: len(SCHEMAS[k].fields) for k in ("Motion", "Label", "Location")}
    for n, position in enumerate(("Hips", "Bag", "Hand", "Torso")):
        for kind in ("Motion", "Label"):
            rows = [" ".join([str(1000 + 10 * i), *[str(n)] * (width[kind] - 1)]) for i in range(3)]
            (day / f"{position}_{kind}.txt").write_text("\n".join(rows) + "\n")
    (day / "Hips_Location.txt").write_text("")
    found = ingest_release(spark, str(tmp_path / "raw"), str(tmp_path / "tables"))
    assert set(found) == {"Motion", "Label"}
    read = lambda k: spark.read.schema(with_date(SCHEMAS[k]).add("position", "string")).parquet(found[k])
    motion, label = read("Motion"), read("Label")
    assert sorted({r.position for r in motion.collect()}) == ["Bag", "Hand", "Hips", "Torso"]
    joined = label_motion_join(label, motion, axes=["AccelerationX"]).collect()
    assert len(joined) == 12 and all(r.CoarseLabel == int(r.AccelerationX) for r in joined)
