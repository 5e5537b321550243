"""Per-device rules of the page log: new-visitor flag, unique visitors, jumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.functions.times import millis_to_time
from tidemill.operators.clean import filter_session_start, session_start
from tidemill.operators.firsts import first_rows_of_day
from tidemill.operators.lookups import reduced_join

JUMP_MS = 10_000          # fixed value: a session start alone for this long is a jump
SLICE_MS = 300_000        # look-ahead slices; a divisor of every zone offset


def _day_of(ms: Column | str) -> Column:
    return F.to_date(millis_to_time(ms))


def device_or_row(order: str = "offset") -> Column:
    """The device, or for a row without one a name of its own, which also spreads such rows over tasks."""
    return F.coalesce("common.mid", F.concat(F.lit("\u0000"), F.col(order)))


def first_days(log: DataFrame, order: str = "offset") -> DataFrame:
    """Per device the day it counts as first seen.

    That is the day of its first log when that log claims a new visitor, else the day before.
    """
    first = F.min(F.struct(F.col("ts"), F.col(order), F.col("common.is_new").alias("is_new")))
    return (
        log.where(F.col("common.mid").isNotNull())
        .groupBy(F.col("common.mid").alias("mid"))
        .agg(first.alias("first"))
        .select(
            "mid",
            F.when(F.col("first.is_new") == "1", _day_of("first.ts"))
            .otherwise(F.date_sub(_day_of("first.ts"), 1))
            .alias("first_day"),
        )
    )


def late_claim(first: str) -> Column:
    """Whether a log claims a new device on another day than that of the device's first log, a struct (ts, is_new)."""
    day = F.when(F.col(f"{first}.is_new") == "1", _day_of(f"{first}.ts")).otherwise(F.date_sub(_day_of(f"{first}.ts"), 1))
    return (F.col("common.is_new") == "1") & (_day_of("ts") != day)


def fix_is_new(log: DataFrame, order: str = "offset") -> DataFrame:
    """Set ``common.is_new`` to '0' where a device claims to be new on a later day.

    First days are minima and combine before the shuffle. The join back is by device; a device
    with very many rows is split by the adaptive skew join. Rows without a device match nothing and
    stay as they are; their offset spreads them over the join's tasks.
    """
    base = first_days(log, order)
    late = (F.col("common.is_new") == "1") & (_day_of("ts") != F.col("first_day"))
    joined = reduced_join(log.withColumn("_device", device_or_row(order)), base.withColumnRenamed("mid", "_device"), "_device")
    common = F.when(late, F.col("common").withField("is_new", F.lit("0"))).otherwise(F.col("common"))
    return joined.withColumn("common", common).select(*log.columns)


def unique_visitor(page: DataFrame, order: str = "offset") -> DataFrame:
    """The first session start of each device and day; rows without a device are nobody's."""
    return first_rows_of_day(
        filter_session_start(page).where(F.col("common.mid").isNotNull()), F.col("common.mid"), millis_to_time("ts"), "ts", (order,)
    )


def with_next_within(
    df: DataFrame, key: Column, ms: str, order: str, reach_ms: int, slice_ms: int, **take: Column
) -> DataFrame:
    """Adds ``next_ts`` and the ``take`` columns of the key's next row, if it is near.

    Time is cut into slices and rows are spread by key *and* slice, so one busy key is many
    tasks. Rows in the first ``reach_ms`` of a slice are also shown to the slice before: a next row
    closer than ``reach_ms`` is always found; a farther one may read as missing.
    """
    if slice_ms < reach_ms:
        raise ValueError("a slice must be at least as long as the reach")
    slot = F.floor(F.col(ms) / F.lit(slice_ms))
    near_start = F.col(ms) - slot * slice_ms < reach_ms
    slots = F.when(near_start, F.array(slot, slot - 1)).otherwise(F.array(slot))
    spread = df.withColumn("_key", key).withColumn("_slot", F.explode(slots))
    w = Window.partitionBy("_key", "_slot").orderBy(ms, order)
    cols = {"next_ts": F.lead(ms).over(w), **{n: F.lead(c).over(w) for n, c in take.items()}}
    return spread.withColumns(cols).where(F.col("_slot") == slot).drop("_key", "_slot")


def user_jump(
    page: DataFrame, order: str = "offset", within_ms: int = JUMP_MS, slice_ms: int = SLICE_MS
) -> DataFrame:
    """Session starts not followed, within the limit, by a page of the same session.

    The next row of the device is either missing, or at least ``within_ms`` later, or itself a
    session start. A row without a device has no next row, and hides no other's.
    """
    nxt = with_next_within(
        page, device_or_row(order), "ts", order, within_ms, slice_ms, next_is_start=session_start()
    )
    alone = F.col("next_ts").isNull() | (F.col("next_ts") - F.col("ts") >= within_ms) | F.col("next_is_start")
    return nxt.where(session_start() & alone).select(*page.columns)


def page_marks(log: DataFrame, order: str = "offset", slice_ms: int = SLICE_MS) -> DataFrame:
    """Page rows of a cleaned log, summed per device, slice and 5-second cell, with visit marks.

    The result has one row per device, slice, ``cell`` (ms) and visitor columns, with ``sv_ct``,
    ``pv_ct``, ``dur_sum``, ``uj_ct`` and two marks: ``first_log`` (time, order, claim) over all logs
    of the cell and ``first_start`` (time, order) over its session starts. A jump is found by
    looking ahead within the slice, so the log is read once and shuffled once, by device and slice.
    """
    is_page = F.col("start").isNull()
    seen = log.select(
        *[F.col(f"common.{c}").alias(c) for c in ("mid", "ar", "ch", "vc", "is_new")],
        "ts", order, is_page.alias("is_page"), (is_page & session_start()).alias("is_start"),
        F.col("page.during_time").alias("during_time"),
    )
    # start logs take no part in the page sequence of a device
    key = F.struct(F.coalesce("mid", F.concat(F.lit("\u0000"), F.col(order))).alias("mid"), "is_page")
    near = with_next_within(seen, key, "ts", order, JUMP_MS, slice_ms, next_is_start=F.col("is_start"))
    alone = F.col("next_ts").isNull() | (F.col("next_ts") - F.col("ts") >= JUMP_MS) | F.col("next_is_start")
    cell = F.floor(F.col("ts") / F.lit(CELL_MS)) * CELL_MS
    one = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    return near.groupBy("mid", cell.alias("cell"), "ar", "ch", "vc", "is_new").agg(
        F.sum(one(F.col("is_start"))).alias("sv_ct"),
        F.sum(one(F.col("is_page"))).alias("pv_ct"),
        F.sum(F.when(F.col("is_page"), F.col("during_time"))).alias("dur_sum"),
        F.sum(one(F.col("is_start") & alone)).alias("uj_ct"),
        F.min(F.struct("ts", order, "is_new")).alias("first_log"),
        F.min(F.when(F.col("is_start"), F.struct("ts", order))).alias("first_start"),
    )


CELL_MS = 5_000  # fixed value: length of a traffic window


def visit_counts(marks: DataFrame) -> DataFrame:
    """Adds the corrected ``is_new`` and ``uv_ct`` to the cells of ``page_marks``.

    What is ordered per device here are its cells, not its logs.
    """
    nobody = F.when(F.col("mid").isNull(), F.col("cell"))  # rows without a device are no one group
    device = Window.partitionBy("mid", nobody)
    whole = device.orderBy("first_log").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.first("first_log").over(whole)
    first_day = F.when(first["is_new"] == "1", _day_of(first["ts"])).otherwise(F.date_sub(_day_of(first["ts"]), 1))
    day = _day_of("cell")
    place = F.row_number().over(Window.partitionBy("mid", nobody, "day").orderBy(F.asc_nulls_last("first_start")))
    # As in fix_is_new, rows without a device keep the flag they came with.
    late = F.col("mid").isNotNull() & (F.col("is_new") == "1") & (F.col("day") != F.col("first_day"))
    return (
        marks.withColumn("first_day", first_day).withColumn("day", day)
        .withColumn("uv_ct", (F.col("mid").isNotNull() & F.col("first_start").isNotNull() & (place == 1)).cast("long"))
        .withColumn("is_new", F.when(late, F.lit("0")).otherwise(F.col("is_new")))
    )
