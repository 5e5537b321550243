"""Starting streaming jobs: one checkpoint per job, writers that repeat a batch safely."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators.clean import (
    clean_rows, dirty_records, drop_blank, drop_control_rows, is_control, parse_change_log, parse_json, parse_json_or_dirty,
)
from tidemill.operators.dedup import keep_last
from tidemill.operators.lookups import small_side
from tidemill.plans.dim import dim_route
from tidemill.schemas import ENVELOPE, TABLE_PROCESS, TOPICS
from tidemill.session import shared_dir
from tidemill.sinks import tables as sinks
from tidemill.sources import topics
from tidemill.streaming.kept import earlier


def start(
    stream: DataFrame, name: str, write: Callable[[DataFrame, int], None], trigger: dict | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Run a stream, handing every micro-batch to ``write(batch, part)``.

    ``part`` orders batches over restarts: it is the batch id of the checkpoint, behind the number of the run that
    the checkpoint began with. A repeated batch has the same part and replaces itself; a stream that lost its
    checkpoint begins a later run, so it overwrites nothing and its rows win over older ones.
    """
    folder = checkpoint or f"{shared_dir(stream.sparkSession)}/checkpoints/{name}"
    run = run_number(stream.sparkSession, folder)
    return (
        stream.writeStream.queryName(name).outputMode("append")
        .foreachBatch(lambda batch, batch_id: write(batch, run * RUN_BATCHES + batch_id))
        .option("checkpointLocation", folder).trigger(**(trigger or {"processingTime": "3 seconds"})).start()
    )


RUN_BATCHES = 1_000_000_000


def run_number(spark: SparkSession, checkpoint: str) -> int:
    """Seconds at which this checkpoint was first used, kept beside its own files."""
    note = f"{checkpoint}/run"
    if not sinks.exists(spark, f"{note}/_SUCCESS"):
        spark.range(1).select(F.lit(int(time.time())).alias("run")).write.mode("overwrite").parquet(note)
    return spark.read.parquet(note).first()["run"]


def to_topics(topic: str | None = None, **where) -> Callable[[DataFrame, int], None]:
    """Writer for topic rows (``topic``, ``value``) or, with ``topic`` and maybe ``keys``, for rows of any shape."""
    return sinks.batch_writer(sinks.write_topic, topic=topic, **where)


def to_table(path: str) -> Callable[[DataFrame, int], None]:
    """Writer for facts and window rows; keyed ones are read back with ``read_upsert``."""
    return sinks.batch_writer(sinks.write_upsert, path=path)


def config_rows(config: DataFrame) -> list[dict[str, str]]:
    """The routing table on the driver: one row per source table, to make the tables it names."""
    return [r.asDict() for r in config.select("sink_table", "sink_columns").distinct().toLocalIterator()]


def dim_batch(read_config: Callable[[SparkSession], DataFrame], root: str, dirty_path: str | None = None):
    """Writer of the dimension job: raw change-log records to dimension tables.

    The routing table is read anew for every micro-batch, so added and removed rows take effect
    with the next one.
    """
    def write(records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        config = read_config(spark)
        parsed = parse_json(drop_blank(records), ENVELOPE)
        rows = clean_rows(parsed, ENVELOPE)
        sinks.upsert_dim(dim_route(drop_control_rows(rows), config), config_rows(config), root, batch_id)
        if dirty_path:
            flagged = parsed.select("value", "row", (F.col("dirty") | is_control("row.type")).alias("dirty"))
            sinks.write_topic(dirty_records(flagged), path=dirty_path, batch_id=batch_id)
    return write


# ---- routing from its change feed ----------------------------------------------------

ROUTING, HELD = "_routing", "_held"  # hidden beside the dimensions
HOLD_PARTS = 10_000
ROUTE = T.StructType([
    *TABLE_PROCESS.fields, T.StructField("deleted", T.BooleanType()), T.StructField("ts_ms", T.LongType()),
    T.StructField("offset", T.LongType())])
HELD_ROW = T.StructType([*ENVELOPE.fields])


def routes(spark: SparkSession, root: str, part: int, live: bool = True) -> DataFrame:
    """The last routing row of each source table below batch ``part``, with its batch; ``live``: without deleted ones."""
    last = keep_last(earlier(spark, f"{root}/{ROUTING}", part, ROUTE), ["source_table"], "ts_ms", ("offset",))
    return last.where(~F.col("deleted")) if live else last


def keep_snapshot(spark: SparkSession, root: str, snapshot: DataFrame) -> None:
    """The routing table as it was before the feed, once."""
    path = f"{root}/{ROUTING}/{sinks.BATCH}=-1"
    if not sinks.exists(spark, f"{path}/_SUCCESS"):
        snapshot.select(*TABLE_PROCESS.names, F.lit(False).alias("deleted"), F.lit(-1).cast("long").alias("ts_ms"),
                        F.lit(-1).cast("long").alias("offset")).write.mode("overwrite").parquet(path)


def feed_batch(root: str, snapshot: Callable[[SparkSession], DataFrame] | None = None, hold_parts: int = HOLD_PARTS,
               never: tuple[str, ...] = ()):
    """Writer of the dimension job for records of the change log (``kind`` log) and of the routing feed (``kind`` feed).

    Routing rows are kept as a table of versions. Changes of a table without a routing row wait (those of the tables in
    ``never`` do not) and are written with the batch that brings the row, if it comes within ``hold_parts`` batches; after a row
    was deleted, what came since then waits for the next one.
    """
    def write(records: DataFrame, part: int) -> None:
        spark = records.sparkSession
        if snapshot is not None:
            keep_snapshot(spark, root, snapshot(spark))
        rows, _ = parse_json_or_dirty(records.where("kind = 'feed'"), topics.CONFIG_CHANGE, carry=("offset",))
        table = F.coalesce("after.source_table", "before.source_table")
        kept_row = [table.alias(n) if n == "source_table" else F.col(f"after.{n}").alias(n) for n in TABLE_PROCESS.names]
        rows.where(table.isNotNull()).select(*kept_row, F.col("after").isNull().alias("deleted"), "ts_ms", "offset").write.mode(
            "overwrite").parquet(f"{root}/{ROUTING}/{sinks.BATCH}={part}")
        config, before = routes(spark, root, part + 1), routes(spark, root, part, live=False)
        was = before.select("source_table", F.col("deleted").alias("_gone"), F.col(sinks.BATCH).alias("_since"))
        fresh = config.join(was, "source_table", "left").where("_gone is null or _gone").select(
            F.col("source_table").alias("table"), F.coalesce("_since", F.lit(-1)).alias("_since"))
        log = parse_change_log(records.where("kind = 'log'"))
        held = earlier(spark, f"{root}/{HELD}", part, HELD_ROW).where(F.col(sinks.BATCH) >= part - hold_parts)
        released = held.join(small_side(fresh), "table").where(F.col(sinks.BATCH) >= F.col("_since")).select(*ENVELOPE.names)
        routing = config.select(*TABLE_PROCESS.names)
        waiting = log.where(~F.col("table").isin(*never)) if never else log
        waiting = waiting.join(small_side(routing.select(F.col("source_table").alias("table"))), "table", "left_anti")
        waiting.select(*ENVELOPE.names).write.mode("overwrite").parquet(f"{root}/{HELD}/{sinks.BATCH}={part}")
        changes = log.select(*ENVELOPE.names).unionByName(released)
        sinks.upsert_dim(dim_route(changes, routing), config_rows(routing), root, part)
    return write


def run_dim_from_feed(log: DataFrame, feed: DataFrame, root: str, snapshot=None, name: str = "dim_from_feed", **options) -> StreamingQuery:
    """The dimension job with its routing table from a change feed: both topics are one stream."""
    hold = {k: options.pop(k) for k in ("hold_parts", "never") if k in options}
    tagged = [df.select(F.lit(kind).alias("kind"), "value", "offset") for kind, df in (("log", log), ("feed", feed))]
    return start(tagged[0].unionByName(tagged[1]), name, feed_batch(root, snapshot, **hold), **options)


def run_dim(records: DataFrame, read_config, root: str, name: str = TOPICS["db"], **options) -> StreamingQuery:
    dirty = options.pop("dirty_path", None)
    return start(records, name, dim_batch(read_config, root, dirty), **options)
