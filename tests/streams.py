"""Helpers: topics as folders of small files, and running a stream over them to the end."""

from __future__ import annotations

import time

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

SCHEMA = pa.schema([("value", pa.string()), ("offset", pa.int64())])


def write_file(folder, index: int, values, first: int) -> int:
    folder.mkdir(parents=True, exist_ok=True)
    table = pa.table({"value": list(values), "offset": list(range(first, first + len(values)))}, schema=SCHEMA)
    pq.write_table(table, str(folder / f"part-{index:05d}.parquet"))
    time.sleep(0.02)  # files are taken in the order of their times
    return first + len(values)


def write_topic(root, topic: str, values, files: int = 3, last=()) -> None:
    """Cut values into files in order; ``last`` makes one more file at the end."""
    values, first = list(values), 0
    step = max(1, -(-len(values) // files))
    for i in range(0, len(values), step):
        first = write_file(root / topic, i, values[i:i + step], first)
    if last:
        write_file(root / topic, 10 ** 6, list(last), first)


def write_chunks(root, topic: str, chunks) -> None:
    """One file per chunk."""
    first = 0
    for i, chunk in enumerate(chunks):
        first = write_file(root / topic, i, list(chunk), first)


def run(stream: DataFrame, checkpoint, name: str) -> DataFrame:
    """Run to the end of the present files, one file a batch; returns what was appended."""
    spark: SparkSession = stream.sparkSession
    query = (
        stream.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(checkpoint / "_checkpoints" / name)).trigger(availableNow=True).start()
    )
    ended = query.awaitTermination(180)
    query.stop()
    assert ended and query.exception() is None
    return spark.table(name)


def rows(df: DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    return sorted((tuple(str(v) for v in r) for r in df.select(*cols).collect()))
