"""Writing topics, append tables, keyed tables and dimensions.

Files written under ``batch=<id>`` make a repeated micro-batch replace itself. Keyed tables are
appended to and read as the latest row per key. ``compact`` folds finished batches into one part,
readers take the latest fold and the batches after it, and ``drop_folded`` removes what lies below it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

from tidemill.operators.dedup import keep_last

BATCH = "batch"
FOLDS = "_folds"  # hidden from a plain read of the folder
TABLE = "_table"


# ---- topics ----------------------------------------------------------------------

def as_topic_rows(df: DataFrame, topic: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """``(topic, value)`` rows, the value being the row as JSON; rows that have both are kept, with their key and offset.

    With ``keys`` a column ``key`` holds these columns as JSON, so that a topic keeps the versions of a key together.
    """
    if {"topic", "value"} <= set(df.columns) <= {"topic", "key", "value", "offset"}:
        return df
    if topic is None:
        raise ValueError("rows without a topic column need a topic")
    key = [F.to_json(F.struct(*keys)).alias("key")] if keys else []
    return df.select(F.lit(topic).alias("topic"), *key, F.to_json(F.struct("*")).alias("value"))


def topic_files(rows: DataFrame) -> DataFrameWriter:
    """Writer for files of topic text: names and values come again from record to record, zstd takes half the room for them."""
    return rows.write.option("compression", "zstd")


def write_topic(
    df: DataFrame, topic: str | None = None, servers: str | None = None, path: str | None = None,
    batch_id: int | None = None, keys: Sequence[str] = (),
) -> None:
    """Append rows to their topics; each row names its own topic or all go to ``topic``, keyed by ``keys``.

    A message log cannot replace a repeated batch: there, readers of a keyed topic take the last version of a key.
    """
    rows = as_topic_rows(df, topic, keys)
    if servers:  # the message log numbers its records itself
        rows.drop("offset").write.format("kafka").option("kafka.bootstrap.servers", servers).save()
        return
    target = f"{path}/{BATCH}={batch_id}" if batch_id is not None else path
    mode = "overwrite" if batch_id is not None else "append"
    topic_files(rows).mode(mode).partitionBy("topic").parquet(target)


def route_side_output(df: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Write ``(topic, value)`` rows, one folder per topic, in a single job over the input."""
    write_topic(df, path=path, batch_id=batch_id)


def read_routed(spark: SparkSession, path: str, topic: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("topic") == topic).select("value")


# ---- append and keyed tables -----------------------------------------------------

def write_append_table(df: DataFrame, path: str, batch_id: int = 0) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def write_upsert(df: DataFrame, path: str, batch_id: int = 0) -> None:
    """Append one batch of a keyed table."""
    write_append_table(df, path, batch_id)


def upsert_view(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A keyed table as it stands: the last row per key by ``order``."""
    return keep_last(df, keys, order[0], tuple(order[1:]))


def read_upsert(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The latest row per key; a later batch wins, within a batch ``order`` decides."""
    return upsert_view(read_parts(spark, path), keys, (BATCH, *order)).drop(BATCH)


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the finished folders ``<name>=<number>`` of a folder, in order."""
    if not exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    found = [f.getPath().getName() for f in files if f.getPath().getName().startswith(f"{name}=")]
    return sorted(int(n.split("=")[1]) for n in found)


def last_fold(spark: SparkSession, path: str) -> int | None:
    """The batch up to which the table is folded."""
    folds = [n for n in numbered(spark, f"{path}/{FOLDS}", "upto") if exists(spark, f"{path}/{FOLDS}/upto={n}/_SUCCESS")]
    return folds[-1] if folds else None


def read_parts(
    spark: SparkSession, path: str, schema: T.StructType | None = None, merge: bool = False
) -> DataFrame:
    """The latest fold of a keyed table and the batches after it, each row with its batch.

    With ``merge`` the columns are those of all parts (whose footers are all read). Batches in the fold are not read.
    """
    number = T.StructField(BATCH, T.LongType())
    reader = lambda: (
        spark.read.schema(T.StructType([*schema.fields, number])) if schema else spark.read.option("mergeSchema", merge))
    typed = lambda df: df.withColumn(BATCH, F.col(BATCH).cast("long"))
    upto = last_fold(spark, path)
    if upto is None:
        return typed(reader().parquet(path))
    fold = typed(reader().parquet(f"{path}/{FOLDS}/upto={upto}"))
    later = [f"{path}/{BATCH}={n}" for n in numbered(spark, path, BATCH) if n > upto]
    if not later:
        return fold
    return fold.unionByName(typed(reader().option("basePath", path).parquet(*later)), allowMissingColumns=True)


def compact(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = (), upto: int | None = None,
    merge: bool = False,
) -> int | None:
    """Fold the batches of a keyed table up to ``upto`` (the last finished one) into one part; returns ``upto``.

    Readers follow when the fold is complete. Rows keep the batch they came with, so a later batch still wins.
    Nothing is deleted here: batches and folds below the last fold are no longer read, see ``drop_folded``.
    """
    done = [n for n in numbered(spark, path, BATCH) if exists(spark, f"{path}/{BATCH}={n}/_SUCCESS")]
    upto = max(done, default=None) if upto is None else upto
    before = last_fold(spark, path)
    if upto is None or before is not None and upto <= before:
        return before
    parts = read_parts(spark, path, merge=merge).where(F.col(BATCH) <= upto)
    upsert_view(parts, keys, (BATCH, *order)).write.mode("overwrite").parquet(f"{path}/{FOLDS}/upto={upto}")
    return upto


READ_S = 3_600.0  # how long a reader may hold the file list it began with


def drop_folded(spark: SparkSession, path: str, read_s: float = READ_S) -> list[str]:
    """Remove the batches and folds that the last fold holds; returns their folders.

    Nothing is removed until the fold is ``read_s`` old, as readers that began before it still read what lies below.
    Removing is repeatable: a call that broke off is taken up by the next one, and readers look at none of these folders.
    """
    upto = last_fold(spark, path)
    if upto is None:
        return []
    jvm = spark.sparkContext._jvm
    folder = lambda name: jvm.org.apache.hadoop.fs.Path(name)
    files = folder(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    made = files.getFileStatus(folder(f"{path}/{FOLDS}/upto={upto}/_SUCCESS")).getModificationTime() / 1000
    if time.time() - made < read_s:
        return []
    old = [f"{path}/{BATCH}={n}" for n in numbered(spark, path, BATCH) if n <= upto]
    old += [f"{path}/{FOLDS}/upto={n}" for n in numbered(spark, f"{path}/{FOLDS}", "upto") if n < upto]
    for name in old:
        files.delete(folder(name), True)
    return old


# ---- dimensions ------------------------------------------------------------------

DIM_EXTRA = [T.StructField("_ts", T.LongType()), T.StructField("_pk", T.StringType())]


def dim_schema(sink_columns: str) -> T.StructType:
    return T.StructType([T.StructField(c.strip(), T.StringType()) for c in sink_columns.split(",")])


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def dim_path(root: str, sink_table: str) -> str:
    return f"{root}/{TABLE}={sink_table}"


def ensure_dim_table(spark: SparkSession, root: str, config: dict[str, str]) -> str:
    """Create the all-text table of a routing row unless it is there; returns its folder."""
    path = dim_path(root, config["sink_table"])
    if not exists(spark, path):
        empty = spark.createDataFrame([], T.StructType(dim_schema(config["sink_columns"]).fields + DIM_EXTRA))
        empty.write.parquet(f"{path}/{BATCH}=-1")
    return path


def dim_columns(routed: DataFrame, configs: Sequence[dict[str, str]]) -> DataFrame:
    """Routed changes as rows of all their sink tables: the kept keys as text columns, null where a table has none."""
    names: dict[str, dict[str, None]] = {}
    for config in configs:
        for c in dim_schema(config["sink_columns"]).names:
            names.setdefault(c.lower(), {})[c] = None  # columns know no case, keys of a change do
    return routed.select(
        *[F.coalesce(*[F.col("data").getItem(s) for s in same]).alias(next(iter(same))) for same in names.values()],
        F.col("ts").alias("_ts"), F.col("pk").alias("_pk"), F.col("sink_table").alias(TABLE),
    )


def latest_changes(routed: DataFrame) -> DataFrame:
    """The latest change per sink table and key."""
    return keep_last(
        routed.withColumn("_text", F.to_json("data")), ["sink_table", "pk"], "ts", ("_text",)
    ).drop("_text")


def upsert_dim(routed: DataFrame, configs: Sequence[dict[str, str]], root: str, batch_id: int) -> None:
    """Write one micro-batch of routed changes, in one job for all tables: the latest row of each key.

    Only the changes are written, in the order of the batches; a table is never rewritten here, and one without
    changes gets no folder. A batch that is repeated has the same changes, so it replaces what it wrote.
    """
    for config in configs:
        ensure_dim_table(routed.sparkSession, root, config)
    if not configs:
        return
    rows = dim_columns(latest_changes(routed), configs).withColumn(BATCH, F.lit(batch_id).cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(TABLE, BATCH).parquet(root)


def merge_dim(existing: DataFrame, changes: DataFrame, key: str, ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """A dimension after an upsert: changed keys take their latest change, the others stay."""
    latest = keep_last(changes, [key], ts, tuple(ties)).select(*existing.columns)
    return existing.join(latest.select(key), key, "left_anti").unionByName(latest)


def read_dim(spark: SparkSession, root: str, config: dict[str, str]) -> DataFrame:
    """The current rows of one dimension table, with the columns its routing row names now."""
    cols = dim_schema(config["sink_columns"])
    parts = read_parts(spark, dim_path(root, config["sink_table"]), T.StructType(cols.fields + DIM_EXTRA))
    return upsert_view(parts, ["_pk"], (BATCH, "_ts")).select(*cols.names)


def compact_dim(spark: SparkSession, root: str, sink_table: str, upto: int) -> int | None:
    """Fold the batches of one dimension up to ``upto``, a batch that the job has finished."""
    return compact(spark, dim_path(root, sink_table), ["_pk"], ("_ts",), upto, merge=True)


def batch_writer(write: Callable[..., None], **fixed) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that hands the batch id to one of the writers above."""
    def run(df: DataFrame, batch_id: int) -> None:
        write(df, batch_id=batch_id, **fixed)
    return run
