"""Rows that come after the watermark: left out of a stream's windows, and counted beside them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.plans import metrics
from tidemill.streaming import late
from streams import rows

KIND = "ts long, name string"


def lots(spark, *chunks):
    return [spark.createDataFrame(list(chunk), KIND) for chunk in chunks]


def windows(df):
    return metrics.per_window(df, F.timestamp_seconds("ts"), "10 seconds", ["name"], F.count("*").alias("n"))


def replay(spark, tmp_path, arrivals):
    folder = str(tmp_path / "topic")
    job = lambda: windows(spark.readStream.schema(KIND).parquet(folder))
    counted, mark = late.replay(spark, arrivals, folder, job, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    return spark.read.schema(KIND).parquet(folder), counted, mark


def test_late_rows_are_left_out_and_counted(spark, tmp_path):
    arrivals = lots(
        spark,
        [(1, "a"), (2, None), (23, "a")],          # watermark 21: the first two windows are closed
        [(3, "a"), (19, "b"), (21, "a"), (4, None)],  # only 21 is in time; "b" has late rows alone
        [(50, "z")],                                # watermark 48
    )
    topic, counted, mark = replay(spark, tmp_path, arrivals)
    assert sorted((r.stt[-2:], r.name or "-", r.n) for r in counted.collect()) == [("00", "-", 1), ("00", "a", 1), ("20", "a", 2)]
    got = late.late_counts(windows(topic), counted, ["name"], "n", mark).collect()
    assert sorted((r.stt[-2:], r.name or "-", r.n_rows, r.n_counted, r.n_late) for r in got) == [
        ("00", "-", 2, 1, 1), ("00", "a", 2, 1, 1), ("10", "b", 1, 0, 1), ("20", "a", 2, 2, 0)]


def test_a_repeated_run_adds_nothing(spark, tmp_path):
    topic, counted, mark = replay(spark, tmp_path, lots(spark, [(1, "a"), (40, "a")]))
    before = rows(counted)
    again = late.run_to_end(
        windows(spark.readStream.schema(KIND).parquet(str(tmp_path / "topic"))), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert rows(spark.read.parquet(str(tmp_path / "out")).drop(late.BATCH)) == before
    assert again in (None, mark)


def test_nothing_arrives(spark, tmp_path):
    topic, counted, mark = replay(spark, tmp_path, lots(spark, [], []))
    assert counted.count() == 0 and late.late_counts(windows(topic), counted, ["name"], "n", mark).count() == 0
