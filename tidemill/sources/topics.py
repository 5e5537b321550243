"""Reading topics, lookup tables and dimensions; batch or stream by one switch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemill.operators.clean import parse_change_log, parse_json_or_dirty
from tidemill.operators.dedup import keep_last
from tidemill.schemas import BASE_DIC, ENVELOPE, ORDER_WIDE_TS, RAW_LOG, TABLE_PROCESS

RECORD = T.StructType([
    T.StructField("value", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("partition", T.IntegerType())])
PARTITION_BITS = 16  # partitions of a topic that an arrival number can tell apart


def arrival(offset: Column, partition: Column) -> Column:
    """One number for the place of a record in its topic: by offset, among equal offsets by partition.

    Within a partition it is the arrival order; over partitions it is a fixed order, so ties fall the same way in every run.
    """
    return F.shiftleft(offset.cast("long"), PARTITION_BITS).bitwiseOR(partition.cast("long"))


def as_records(df: DataFrame) -> DataFrame:
    """``value`` as text, null as the empty string; ``offset`` is the place in the topic, see ``arrival``.

    Without an offset all are 0 and their order is open; records without a partition keep their offset as it is.
    """
    rest = [c for c in df.columns if c not in ("value", "offset", "partition")]
    place = F.coalesce("offset", F.lit(0)) if "offset" in df.columns else None
    if place is not None and "partition" in df.columns:
        place = F.when(F.col("partition").isNull(), place).otherwise(arrival(place, F.col("partition")))
    offset = [place.cast("long").alias("offset")] if place is not None else []
    return df.select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"), *offset, *rest)


def read_topic(
    spark: SparkSession,
    topic: str,
    servers: str | None = None,
    path: str | None = None,
    stream: bool = True,
    start: str = "latest",
    max_per_batch: int | None = None,
) -> DataFrame:
    """Records of one topic as ``value`` and ``offset``, which orders them over all partitions (see ``arrival``).

    With ``servers`` the Kafka source is used. With ``path`` the topic is a folder of JSON-lines or
    parquet files below it (tests, replays); both forms give the same columns.
    """
    if servers:
        reader = spark.readStream if stream else spark.read
        options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
                   "startingOffsets": start if stream else "earliest"}
        if stream and max_per_batch:
            options["maxOffsetsPerTrigger"] = str(max_per_batch)
        raw = reader.format("kafka").options(**options).load()
        return as_records(raw.select("value", "offset", "partition"))
    if not path:
        raise ValueError("give either servers or path")
    if stream:
        reader = spark.readStream.schema(RECORD)
        if max_per_batch:
            reader = reader.option("maxFilesPerTrigger", max_per_batch)
        return as_records(reader.parquet(f"{path}/{topic}"))
    return as_records(spark.read.schema(RECORD).parquet(f"{path}/{topic}"))


def read_keyed(spark: SparkSession, topic: str, path: str) -> DataFrame:
    """A keyed topic as it stands: ``key`` and the last ``value`` of each, keys whose last record is a tombstone left out."""
    rows = spark.read.schema(T.StructType([*RECORD.fields, T.StructField("key", T.StringType())])).parquet(f"{path}/{topic}")
    last = keep_last(rows.where("key is not null"), ["key"], "offset", ("value",))
    return last.where(F.coalesce("value", F.lit("")) != "").select("key", "value")


def read_change_log(spark: SparkSession, topic: str, keys: Sequence[str] | None = None, **where) -> DataFrame:
    """The change-log topic as envelope columns; with ``keys``, ``data`` is a struct of these."""
    return parse_change_log(read_topic(spark, topic, **where), keys=keys)


def read_page_log(spark: SparkSession, topic: str, **where) -> DataFrame:
    """The page topic as ``common``, ``page``, ``ts`` and ``offset``."""
    rows, _ = parse_json_or_dirty(read_topic(spark, topic, **where), RAW_LOG, carry=("offset",))
    return rows.drop("start", "displays", "actions", "err")


def read_rows(
    spark: SparkSession, topic: str, schema: T.StructType, columns: Sequence[str] | None = None, **where
) -> DataFrame:
    """Any detail topic with the given row type, or these ``columns`` of it; empty records are dropped."""
    rows, _ = parse_json_or_dirty(read_topic(spark, topic, **where), schema, columns=columns)
    return rows


def read_detail_topic(spark: SparkSession, topic: str, columns: Sequence[str] | None = None, **where) -> DataFrame:
    """The wide order-detail topic."""
    return read_rows(spark, topic, ORDER_WIDE_TS, columns, **where)


def read_dictionary(spark: SparkSession, path: str | None = None, jdbc: dict[str, str] | None = None) -> DataFrame:
    """The code dictionary from a database table or from parquet."""
    df = spark.read.format("jdbc").options(**jdbc).load() if jdbc else spark.read.schema(BASE_DIC).parquet(path)
    return df.select(*BASE_DIC.names)


def read_dim_config(spark: SparkSession, path: str | None = None, jdbc: dict[str, str] | None = None) -> DataFrame:
    """The routing table as it is now; removed rows no longer route, new ones do at once."""
    df = spark.read.format("jdbc").options(**jdbc).load() if jdbc else spark.read.schema(TABLE_PROCESS).parquet(path)
    return df.select(*TABLE_PROCESS.names)


CONFIG_CHANGE = T.StructType([
    T.StructField("before", TABLE_PROCESS),
    T.StructField("after", TABLE_PROCESS),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
])


def config_from_changes(records: DataFrame) -> DataFrame:
    """Routing table from its change feed: the latest ``after`` per source table, deletes removed."""
    rows, _ = parse_json_or_dirty(records, CONFIG_CHANGE, carry=("offset",))
    keyed = rows.withColumn("table", F.coalesce("after.source_table", "before.source_table"))
    last = keep_last(keyed, ["table"], "ts_ms", ("offset",))
    return last.where(F.col("after").isNotNull()).select("after.*")


def envelope_records(log: DataFrame) -> DataFrame:
    """Envelope columns back to topic text."""
    return log.select(F.to_json(F.struct(*ENVELOPE.names)).alias("value"))
