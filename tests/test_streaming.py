import os

from strider.sources.sensor_files import read_sensor_table
from strider.streaming.ingest import ingest_sensor_stream


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_incremental_ingest_is_exactly_once(spark, tmp_path):
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "table"), str(tmp_path / "ck")
    _write(f"{src}/010317/Hips_Location.txt", "1 0 0 1 50.8 -0.1 3\n2 0 0 1 50.8 -0.1 3\n")
    _write(f"{src}/010317/Hips_Motion.txt", " ".join(["1"] * 23) + "\n")
    ingest_sensor_stream(spark, src, "Location", out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    ingest_sensor_stream(spark, src, "Location", out, ck).awaitTermination()     # nothing new
    assert spark.read.parquet(out).count() == 2
    _write(f"{src}/020317/Hips_Location.txt", "3 0 0 1 50.9 -0.2 4\n")
    ingest_sensor_stream(spark, src, "Location", out, ck).awaitTermination()
    table = read_sensor_table(spark, out, "Location")
    got = sorted((r.Time, r.date) for r in table.collect())
    assert table.where("date = '020317'").count() == 1
    assert got == [(1, "010317"), (2, "010317"), (3, "020317")]


def test_csv_stream_reads_one_named_file_per_day(spark, tmp_path):
    from strider.streaming.ingest import ingest_csv_stream
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "table"), str(tmp_path / "ck")
    header = "Time,Ignore1,Ignore2,Accuracy,Latitude,Longitude,Altitude\n"
    _write(f"{src}/010317/Hips_Location.csv", header + "1,0,0,5,50.8,-0.1,3\n")
    _write(f"{src}/010317/Bag_Location.csv", header + "9,0,0,5,50.8,-0.1,3\n")
    ingest_csv_stream(spark, src, "Location", out, "Hips_Location.csv", ck).awaitTermination()
    _write(f"{src}/020317/Hips_Location.csv", header + "2,0,0,6,50.9,-0.2,4\n")
    ingest_csv_stream(spark, src, "Location", out, "Hips_Location.csv", ck).awaitTermination()
    got = sorted((r.Time, r.date) for r in read_sensor_table(spark, out, "Location").collect())
    assert got == [(1, "010317"), (2, "020317")]
