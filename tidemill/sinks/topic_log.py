"""Folder topics that take every micro-batch exactly once, while readers are running.

A batch is first written whole to a hidden stage. Its files then move into the topics under names made of the writer,
the batch and the file, and a note is left. A batch that comes again finds the note and does nothing; one whose move was
broken off is moved on from the same stage, not computed anew, so a reader that has seen some of its files never sees their rows
under another name. Records get consecutive offsets in their writer's order unless they bring their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.sinks import tables as sinks

PART = "part"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list:
    p, fs = _fs(spark, path)
    return [f.getPath() for f in fs.listStatus(p) if not f.getPath().getName().startswith(("_", "."))]


def next_offset(spark: SparkSession, path: str, writer: str, before: int) -> int:
    """The first offset behind the batches of ``writer`` below number ``before``."""
    notes = f"{path}/_done/{writer}"
    done = [n for n in sinks.numbered(spark, notes, PART) if n < before and sinks.exists(spark, f"{notes}/{PART}={n}/_SUCCESS")]
    return spark.read.parquet(f"{notes}/{PART}={done[-1]}").first()["next"] if done else 0


def append_once(rows: DataFrame, path: str, writer: str, part: int) -> None:
    """Append rows (``topic``, ``value``, maybe ``key`` and ``offset``) of batch ``part`` to the topics below ``path``."""
    spark = rows.sparkSession
    note, stage = f"{path}/_done/{writer}/{PART}={part}", f"{path}/_stage/{writer}/{PART}={part}"
    if sinks.exists(spark, f"{note}/_SUCCESS"):
        return
    if not sinks.exists(spark, f"{stage}/_SUCCESS"):
        if "offset" not in rows.columns:
            first = next_offset(spark, path, writer, part)
            rows = rows.withColumn("offset", F.monotonically_increasing_id() + F.lit(first))
        sinks.topic_files(rows).mode("overwrite").partitionBy("topic").parquet(stage)
    for folder in _children(spark, stage):
        publish(spark, folder, f"{path}/{folder.getName()}", f"{writer}-{part}-")
    moved = [f"{path}/{f.getName()}/{writer}-{part}-*" for f in _children(spark, stage)]
    last = spark.read.schema("offset long").parquet(*moved).agg(F.max("offset")).first()[0] if moved else None
    behind = next_offset(spark, path, writer, part) if last is None else last + 1
    spark.range(1).select(F.lit(behind).cast("long").alias("next")).write.mode("overwrite").parquet(note)


def publish(spark: SparkSession, stage, target: str, prefix: str) -> None:
    """Move the files of one topic out of the stage; those already moved are there under their name."""
    goal, fs = _fs(spark, target)
    fs.mkdirs(goal)
    for file in _children(spark, stage.toString()):
        to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(goal, prefix + file.getName())
        if not fs.rename(file, to):
            raise OSError(f"cannot move {file} to {to}")


def identified(rows: DataFrame, part: int) -> DataFrame:
    """Adds ``id`` to topic rows: the batch and what the record is, numbered among equal records. A repeated batch gives
    the same ids, for message logs, which cannot replace what they have taken."""
    parts = [F.coalesce(F.col(c), F.lit("\u0000")) for c in rows.columns if c in ("topic", "key", "value")]
    content = F.md5(F.concat_ws("\u0001", *parts).cast("binary"))
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    numbered = counted.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return numbered.withColumn("id", F.concat_ws("-", F.lit(part), content, F.col("_i"))).drop("_n", "_i")


def drop_repeats(records: DataFrame, within: str = "1 hour", time: str = "timestamp") -> DataFrame:
    """Stream records whose ``id`` did not come ``within`` that time before, by the time the message log took them."""
    return records.withWatermark(time, within).dropDuplicatesWithinWatermark(["id"])
