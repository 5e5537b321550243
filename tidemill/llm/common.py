"""What the training-text operators share: the shared folder, written tables, word rules and batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Words are runs of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="tidemill-llm-"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: short lineage, sizes the planner knows, and
    nothing to recompute when an executor is lost."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/tidemill-{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def has_word(line: Column) -> Column:
    return line.rlike(WORD)


def text_key(text: Column) -> Column:
    """32 bits of a text, to tell rows of one id apart."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``most_bytes`` at most; one long text is a batch alone."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if total and total + n > most_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
