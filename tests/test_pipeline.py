"""Raw sensor files → tables → statistics, tree report and anomalies (README usage)."""

import os
import random

from strider.operators import activity, anomaly, clean, features, stats
from strider.schemas import ANOMALY_FEATURES, MAGNITUDE_FEATURES
from strider.sources import sinks
from strider.sources.sensor_files import read_sensor_table, read_sensor_text


def test_raw_files_to_results(spark, tmp_path):
    rnd = random.Random(1)
    raw = tmp_path / "raw"
    for day in ("010317", "020317"):
        os.makedirs(raw / day)
        with open(raw / day / "Label.txt", "w") as fl, open(raw / day / "Hips_Motion.txt", "w") as fm, \
                open(raw / day / "Bag_Motion.txt", "w") as fb:
            for i in range(400):
                t = 1488326400000 + i * 10
                c = i % 8
                fl.write(f"{t} {c} 0 0 0 0 0 0\n")
                fm.write(" ".join([str(t)] + [f"{c + rnd.random():.4f}" for _ in range(22)]) + "\n")
                fb.write(" ".join([str(t)] + ["0"] * 22) + "\n")
    out = tmp_path / "tables"
    sinks.write_table(read_sensor_text(spark, str(raw), "Label"), str(out / "Label"), mode="overwrite")
    sinks.write_table(read_sensor_text(spark, str(raw), "Motion", stem="Hips_Motion"),
                      str(out / "Hips_Motion"), mode="overwrite")
    labels = read_sensor_table(spark, str(out / "Label"), "Label")
    motion = clean.clean_motion(read_sensor_table(spark, str(out / "Hips_Motion"), "Motion"))
    assert labels.count() == 800 and motion.count() == 800

    dataset = stats.dataset_activity_stats(labels).collect()
    assert [r.Percentage for r in dataset] == [12.5] * 8 and dataset[0].TotalTime == "1.0 seconds"
    assert sinks.replace_results(stats.daily_activity_stats(labels), str(tmp_path / "daily"))
    assert spark.read.parquet(str(tmp_path / "daily")).count() == 16

    joined = features.with_magnitudes(features.label_motion_join(labels, motion))
    assert joined.count() == 800
    report = activity.tree_reports(joined, MAGNITUDE_FEATURES, depths=(10,), with_tree=True)
    sinks.write_report_text(report, str(tmp_path / "report"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert lines[0] == "Decision Tree Classifier Results" and lines[2].startswith("Accuracy: ")

    scored = anomaly.isolation_forest(motion, ANOMALY_FEATURES, key_cols=("date", "Time"),
                                      keep=("date", "Time", *ANOMALY_FEATURES), num_trees=20)
    sinks.write_anomalies(scored, str(tmp_path / "anomalies"))
    assert spark.read.option("header", True).csv(str(tmp_path / "anomalies")).count() == 40
