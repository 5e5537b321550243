"""What a window job leaves out of a stream because it came after the watermark.

A window is closed once the watermark has passed its end. Rows of closed windows that come later count nowhere; the
difference between a job over everything that arrived and the same job on the stream tells which windows lost rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.functions.times import text_time
from tidemill.sinks.tables import BATCH, write_append_table


def run_to_end(rows: DataFrame, path: str, checkpoint: str) -> str | None:
    """Run a stream over all that is there now; windows that close are appended to the table ``path``.

    Returns the watermark it ended with, if it got anything. A batch is written under its number, so one that is repeated after a loss takes the place of its first try.
    """
    query = (
        rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, n: write_append_table(batch, path, n)).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query.lastProgress["eventTime"].get("watermark") if query.lastProgress else None


def replay(
    spark: SparkSession, arrivals: Sequence[DataFrame], folder: str, job: Callable[[], DataFrame], path: str, checkpoint: str
) -> tuple[DataFrame, str | None]:
    """Let records arrive in the topic folder one lot after the other, and run the job after each from where it was.

    Returns the windows that were closed and the last watermark.
    """
    mark = None
    for records in arrivals:
        records.write.mode("append").parquet(folder)
        mark = run_to_end(job(), path, checkpoint) or mark
    return spark.read.parquet(path).drop(BATCH), mark


def late_counts(
    arrived: DataFrame, counted: DataFrame, keys: Sequence[str], measure: str, mark: str | None
) -> DataFrame:
    """Per window that the watermark ``mark`` closed (``stt``, ``edt``) and key: all rows, those in time, the late ones.

    ``arrived`` holds the measure over everything, ``counted`` that of the stream; keys are compared null-safely.
    Without a watermark no window is closed.
    """
    by = ["stt", "edt", *keys]
    none = F.lit(0).cast("long")
    both = arrived.where(text_time("edt") <= F.lit(mark).cast("timestamp")).select(
        *by, F.col(measure).alias("n_rows"), none.alias("n_counted")
    ).unionByName(counted.select(*by, none.alias("n_rows"), F.col(measure).alias("n_counted")))
    summed = both.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_counted").alias("n_counted"))
    return summed.withColumn("n_late", F.col("n_rows") - F.col("n_counted"))
