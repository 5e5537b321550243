"""The jobs on streams.

Stateless facts, the word window, registrations and the traffic union use the table functions as
they are; here are the forms that need a watermark, a time bound or per-key state. Inputs are topic
records (``value``, ``offset``), so the jobs can be chained through topics and restarted one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.times import DAY, millis_to_day, millis_to_time, text_time
from tidemill.operators.clean import (
    drop_blank, filter_home_detail, filter_login, filter_session_start, keep_insert, parse_json, parse_json_or_dirty,
    parse_page_log, session_start,
)
from tidemill.operators.dedup import GAP_MS
from tidemill.operators.firsts import RETURN_DAYS
from tidemill.operators.lookups import lookup_join, small_side
from tidemill.operators.split import split_log
from tidemill.operators.visits import JUMP_MS, SLICE_MS, device_or_row
from tidemill.plans import facts, metrics
from tidemill.schemas import ORDER_WIDE, ORDER_WIDE_TS, RAW_LOG
from tidemill.streaming.processors import DAY_MS, NOBODY, DayFirst, FirstDay, FirstOfBurst, Jump, KeepLast

LOG = RAW_LOG.simpleString()
OUT, NO_TIME, EVENT, CLOCK = "append", "None", "EventTime", "ProcessingTime"

# fixed values: how long a stream may run behind
DELAY, REFUND_DELAY, TRAFFIC_DELAY = "2 seconds", "10 seconds", "13 seconds"
# bounds we choose for joins between streams
# Defaults of how far apart records that belong together may come, in event time; every job takes its own.
SAME_WRITE, ORDER_LIFE, REFUND_LIFE = "1 hour", "30 days", "30 days"
LATE_DAYS = 30
SPARE_KEYS = 1024  # rows without a device are spread over as many keys


# ---- log -------------------------------------------------------------------------

def base_log(records: DataFrame) -> DataFrame:
    """``(topic, value)`` rows of the five detail topics and the dirty topic, from one read of the log.

    Rows without a device or time, dirty ones among them, pass as they are and are spread over many keys.
    """
    parsed = parse_json(drop_blank(records), RAW_LOG, carry=("offset",))
    dirty, row = F.col("dirty"), lambda name: F.when(~F.col("dirty"), F.col(f"row.{name}"))
    day = lambda ms: F.date_format(millis_to_time(ms), DAY)
    spare = F.concat(F.lit(NOBODY), F.pmod(F.coalesce("offset", F.lit(0)), F.lit(SPARE_KEYS)).cast("string"))
    keyed = parsed.select(
        F.coalesce(F.when(row("ts").isNotNull(), row("common")["mid"]), spare).alias("mid"), row("ts").alias("ts"), "offset",
        day(row("ts")).alias("day"), day(row("ts") - DAY_MS).alias("day_before"), row("common")["is_new"].alias("is_new"),
        F.when(~dirty, F.struct(*[F.col(f"row.{n}").alias(n) for n in RAW_LOG.names])).alias("log"),
        F.when(dirty, F.col("value")).alias("dirty_text"),
    )
    seen = keyed.groupBy("mid").transformWithState(
        FirstDay(), f"log {LOG}, dirty_text string, day string, first_day string", OUT, NO_TIME
    )
    late = (F.col("log.common.is_new") == "1") & (F.col("day") != F.col("first_day"))
    common = F.when(late, F.col("log.common").withField("is_new", F.lit("0"))).otherwise(F.col("log.common"))
    return split_log(seen.select(F.col("log").withField("common", common).alias("log"), "dirty_text").select("log.*", "dirty_text"))


def day_firsts(
    df: DataFrame, key: Column, ms: Column, carry: Column, carry_type: str, offset: Column | None = None,
    forget_ms: int | None = None, delay: str | None = DELAY, late_days: int = LATE_DAYS,
) -> DataFrame:
    """Day-first rows per key: ``key, day, time, prev_day, is_first, carry``.

    ``time`` keeps the watermark, so a window can follow. With ``delay`` None the input brings
    its watermark along in a column ``_rt``. Rows without a time belong to no day and are left out, days more than
    ``late_days`` before the key's latest as well.
    """
    time = millis_to_time(ms) if delay else F.col("_rt")
    keyed = df.select(
        key.cast("string").alias("key"), time.alias("time"), ms.alias("ts"),
        (F.lit(0) if offset is None else offset).cast("long").alias("offset"),
        millis_to_day(ms).alias("day"), carry.alias("carry"),
    ).where(F.col("ts").isNotNull())
    if delay:
        keyed = keyed.withWatermark("time", delay)
    out = f"key string, day string, time timestamp, prev_day string, is_first long, carry {carry_type}"
    return keyed.groupBy("key").transformWithState(
        DayFirst(forget_ms, late_days), out, OUT, EVENT, eventTimeColumnName="time"
    )


def _page_text(page: DataFrame) -> Column:
    return F.to_json(F.struct("common", "page", "ts"))


def unique_visitor(records: DataFrame) -> DataFrame:
    """Page records to the first session start per device and day, as topic text."""
    starts = filter_session_start(parse_page_log(records, carry=("offset",))).where(F.col("common.mid").isNotNull())
    firsts = day_firsts(
        starts, F.col("common.mid"), F.col("ts"), _page_text(starts), "string", F.col("offset"), forget_ms=DAY_MS
    )
    return firsts.select(F.col("carry").alias("value"))


def user_jump(records: DataFrame, within_ms: int = JUMP_MS, slice_ms: int = SLICE_MS) -> DataFrame:
    """Page records to jumps, as topic text.

    The state is kept by device and slice of time, and the first rows of a slice are shown to the slice before it, so
    a busy device is many small states. Rows without a device are each alone.
    """
    if slice_ms < within_ms:
        raise ValueError("a slice must be at least as long as the limit")
    page = parse_page_log(records, carry=("offset",)).where(F.col("ts").isNotNull())
    slot = F.floor(F.col("ts") / F.lit(slice_ms))
    slots = F.when(F.col("ts") - slot * slice_ms < within_ms, F.array(slot, slot - 1)).otherwise(F.array(slot))
    keyed = page.select(
        device_or_row().alias("mid"), F.explode(slots).alias("slot"), slot.alias("own_slot"), millis_to_time("ts").alias("rt"),
        "ts", "offset", session_start().alias("is_start"), _page_text(page).alias("value"),
    ).withColumn("own", F.col("slot") == F.col("own_slot")).drop("own_slot").withWatermark("rt", DELAY)
    return keyed.groupBy("mid", "slot").transformWithState(
        Jump(within_ms), "value string, ts long", OUT, EVENT
    ).select("value")


# ---- windows over the log ------------------------------------------------------------

def traffic_window(page: DataFrame, uv: DataFrame, uj: DataFrame) -> DataFrame:
    """Traffic metrics of the page, unique-visitor and jump topics."""
    return metrics.traffic_window(*[parse_page_log(r, carry=("offset",)) for r in (page, uv, uj)])


def kw_window(records: DataFrame, splitter=None) -> DataFrame:
    return metrics.kw_window(parse_page_log(records, carry=("offset",)), splitter)


def home_detail_uv_window(records: DataFrame) -> DataFrame:
    page = filter_home_detail(parse_page_log(records, carry=("offset",))).where(F.col("common.mid").isNotNull())
    key = F.concat_ws("\u0001", "common.mid", "page.page_id")
    firsts = day_firsts(
        page, key, F.col("ts"), F.col("page.page_id"), "string", F.col("offset"), forget_ms=DAY_MS
    )
    return metrics.home_detail_counts(
        firsts.select(F.col("carry").alias("page_id"), F.col("time").alias("first_time")), delay=None
    )


def login_window(records: DataFrame, late_days: int = LATE_DAYS) -> DataFrame:
    page = filter_login(parse_page_log(records, carry=("offset",)))
    firsts = day_firsts(page, F.col("common.uid"), F.col("ts"), F.lit(""), "string", F.col("offset"), late_days=late_days)
    gap = F.datediff(F.to_date("day"), F.to_date("prev_day"))
    back = F.coalesce(gap >= RETURN_DAYS, F.lit(False)).cast("long")
    return metrics.login_counts(firsts.select(back.alias("is_back"), F.col("time").alias("first_time")), delay=None)


# ---- windows over trade ----------------------------------------------------------------

def cart_uu_window(cart: DataFrame) -> DataFrame:
    """Cart facts (columns) to users adding first in the day."""
    ms = F.unix_millis(text_time(F.coalesce("operate_time", "create_time")))
    known = cart.where(F.col("user_id").isNotNull())
    firsts = day_firsts(known, F.col("user_id"), ms, F.lit(""), "string", forget_ms=DAY_MS)
    return metrics.cart_counts(firsts.select(F.col("time").alias("first_time")), delay=None)


def latest_details(records: DataFrame) -> DataFrame:
    """Order-detail records to one settled insert version per detail id."""
    parsed = keep_insert(_wide_rows(records))
    # As a table orders them: column by column, a missing value before all others.
    part = lambda c: F.coalesce(F.concat(F.lit("\u0002"), c, F.lit("\u0001")), F.lit("\u0000"))
    tie = F.concat(*[part(F.col(c).cast("string")) for c in metrics.DETAIL_TIES])
    keyed = parsed.select(
        "order_detail_id", F.coalesce(F.unix_millis("ts"), F.lit(-1)).alias("ts"), tie.alias("tie"),
        F.to_json(F.struct(*[c for c in ORDER_WIDE_TS.names if c != "pt"])).alias("value"),
    )
    last = keyed.groupBy("order_detail_id").transformWithState(KeepLast(), "value string", OUT, CLOCK)
    return _wide_rows(last)


def _wide_rows(records: DataFrame) -> DataFrame:
    rows, _ = parse_json_or_dirty(records, ORDER_WIDE_TS)
    return rows


def order_window(details: DataFrame, late_days: int = LATE_DAYS) -> DataFrame:
    """Settled order details to order metrics.

    Amounts stay columns and are summed as such; only user and time go through the per-user state.
    """
    time, zero = text_time("order_create_time"), F.lit(0).cast("decimal(16,2)")
    known = details.where(F.col("user_id").isNotNull())
    firsts = day_firsts(known, F.col("user_id"), F.unix_millis(time), F.lit(""), "string", late_days=late_days)
    amounts = details.select(
        time.alias("time"), F.lit(0).cast("long").alias("is_unique"), F.lit(0).cast("long").alias("is_new"),
        *[metrics.or_zero(c).alias(n) for n, c in metrics.ORDER_AMOUNTS.items()],
    ).withWatermark("time", DELAY)
    return metrics.order_counts(amounts.unionByName(firsts.select(
        "time", F.col("is_first").alias("is_unique"), F.col("prev_day").isNull().cast("long").alias("is_new"),
        *[zero.alias(n) for n in metrics.ORDER_AMOUNTS],
    )), delay=None)


def first_within(df: DataFrame, keys: list[str], time: Column, delay: str = "5 seconds") -> DataFrame:
    """The first row per key, copies dropped while the watermark still covers them."""
    timed = df.withColumn("_rt", time).withWatermark("_rt", delay)
    return timed.dropDuplicatesWithinWatermark(keys)


def first_of_burst(
    df: DataFrame, key: Column, time: Column, carry: Column, carry_type: str, gap_ms: int = GAP_MS, delay: str = DELAY
) -> DataFrame:
    """``time`` (with its watermark) and ``carry`` of rows whose key had no copy within ``gap_ms`` before."""
    keyed = df.select(key.alias("key"), time.alias("time"), F.unix_millis(time).alias("ts"), carry.alias("carry"))
    timed = keyed.dropna(subset=["key", "ts"]).withWatermark("time", delay)
    return timed.groupBy("key").transformWithState(
        FirstOfBurst(gap_ms), f"time timestamp, carry {carry_type}", OUT, EVENT, eventTimeColumnName="time"
    )


def payment_window(paid: DataFrame, gap_ms: int = GAP_MS, late_days: int = LATE_DAYS) -> DataFrame:
    """Payment facts to paying users; copies of a detail within ``gap_ms`` of each other count once."""
    known = paid.where(F.col("user_id").isNotNull())
    once = first_of_burst(
        known, F.col("order_detail_id"), text_time("callback_time"), F.col("user_id"), "string", gap_ms
    ).withColumnRenamed("time", "_rt")
    firsts = day_firsts(once, F.col("carry"), F.unix_millis("_rt"), F.lit(""), "string", delay=None, late_days=late_days)
    return metrics.payment_counts(firsts.select(
        F.col("prev_day").isNull().cast("long").alias("is_new"), F.col("time").alias("first_time")
    ), delay=None)


def province_window(details: DataFrame, province: DataFrame) -> DataFrame:
    return metrics.province_counts(details, province)


def spu_order_window(details: DataFrame, sku_dim: DataFrame) -> DataFrame:
    return metrics.spu_counts(details, sku_dim)


def refund_counts(refund: DataFrame, keys: Sequence[str] = ("sku_id",)) -> DataFrame:
    """Refund requests per sku, to be named by ``metrics.name_refunds``; with a user before it, by ``name_user_refunds``."""
    once = first_within(refund, ["id"], text_time("create_time"), REFUND_DELAY)
    return metrics.per_window(
        once, F.col("_rt"), metrics.SIZE, keys, F.count("*").alias("refund_count"), delay=None)


def refund_window(refund: DataFrame, sku_dim: DataFrame, grain: str = "sku") -> DataFrame:
    once = first_within(refund, ["id"], text_time("create_time"), REFUND_DELAY)
    return metrics.refund_counts(once, sku_dim, grain, F.col("_rt"), delay=None)


# ---- joins of change streams --------------------------------------------------------

def _timed(df: DataFrame, name: str, delay: str = DELAY) -> DataFrame:
    return df.withColumn(name, F.timestamp_seconds("ts")).drop("ts").withWatermark(name, delay)


def _near(left: str, right: str, before: str, after: str) -> Column:
    lo, hi = F.expr(f"interval {before}"), F.expr(f"interval {after}")
    return (F.col(right) >= F.col(left) - lo) & (F.col(right) <= F.col(left) + hi)


def _looked_up(df: DataFrame, dic: DataFrame | None, code: str, name: str) -> DataFrame:
    return df.withColumn(name, F.lit(None).cast("string")) if dic is None else lookup_join(df, dic, code, name)


def named(df: DataFrame, dic: DataFrame, code: str, name: str) -> DataFrame:
    """Rows of a micro-batch with the dictionary's name of today; unknown codes are dropped."""
    return lookup_join(df.drop(name), dic, code, name).select(*df.columns)


def order_detail_wide(
    log: DataFrame, dic: DataFrame | None, database: str | None = facts.SHOP_DB, same_write: str = SAME_WRITE,
    order_life: str = ORDER_LIFE,
) -> DataFrame:
    """Order details joined to their activity, coupon and order versions as these arrive.

    Activity and coupon are written together with the detail (``same_write``), order versions follow within the
    life of an order (``order_life``); state older than that is dropped. A dictionary given here is as it was when
    the stream began; without one the name is left empty for ``named`` to fill in each micro-batch.
    """
    details = _timed(_looked_up(facts.order_details(log, database), dic, "source_type", "dic_name"), "rt")
    rename = lambda df, name: df.withColumnRenamed("order_detail_id", name).drop("id")
    acts = _timed(rename(facts.order_activities(log, database), "_act"), "act_rt")
    coupons = _timed(rename(facts.order_coupons(log, database), "_cou"), "cou_rt")
    infos = _timed(
        facts.order_infos(log, database, "ts").withColumnRenamed("id", "_order"), "info_rt"
    )
    wide = (
        details.join(acts, (F.col("order_detail_id") == F.col("_act")) & _near("rt", "act_rt", same_write, same_write), "left")
        .join(coupons, (F.col("order_detail_id") == F.col("_cou")) & _near("rt", "cou_rt", same_write, same_write), "left")
        .join(infos, (F.col("order_id") == F.col("_order")) & _near("rt", "info_rt", same_write, order_life), "inner")
    )
    return wide.withColumn("pt", F.current_timestamp()).select(*ORDER_WIDE.names, F.col("rt").alias("ts"))


def pay_success(
    log: DataFrame, wide: DataFrame, dic: DataFrame | None, same_write: str = SAME_WRITE, order_life: str = ORDER_LIFE,
) -> DataFrame:
    """Payments joined to order details that arrived up to ``order_life`` before."""
    paid = _looked_up(facts.payments(log), dic, "payment_type_code", "payment_type_name")
    paid = paid.withColumn("pay_rt", text_time("callback_time")).withWatermark("pay_rt", DELAY)
    paid = paid.withColumnRenamed("order_id", "_order")
    details = wide.withColumn("rt", F.col("ts")).withWatermark("rt", DELAY)
    on = (F.col("order_id") == F.col("_order")) & _near("rt", "pay_rt", same_write, order_life)
    return details.join(paid, on, "inner").withColumnRenamed(
        "split_total_amount", "split_payment_amount"
    ).select(*facts.PAY_COLUMNS)


def order_refund(log: DataFrame, dic: DataFrame | None, within: str = REFUND_LIFE) -> DataFrame:
    """Refund requests joined to the refund update of their order, if it comes ``within`` that time.

    A request without one is emitted with nulls, but only after that time has passed. Without a dictionary the rows
    are those that ``facts.name_refunds`` names.
    """
    orders = _timed(facts.refunded_orders(log).withColumnRenamed("order_id", "_order"), "order_rt")
    requests = facts.refunds(log).withColumn("rt", F.timestamp_seconds("ts")).withWatermark("rt", DELAY)
    on = (F.col("order_id") == F.col("_order")) & _near("rt", "order_rt", within, within)
    joined = requests.join(orders, on, "left")
    if dic is None:
        return joined.select(*facts.REFUND_KEYS, "province_id", "ts")
    return facts.name_refunds(joined, small_side(dic.select("dic_code", "dic_name")))

