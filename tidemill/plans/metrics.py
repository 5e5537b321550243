"""Tumbling-window metrics.

Each ``*_window`` function takes detail rows and returns one row per window (and key) with ``stt``
and ``edt``. Counting is partial before every shuffle. Rules that need a key's history run on rows
already reduced to one per key and window or day.

The ``*_counts`` functions are the part after the history rules. They and ``per_window`` carry the
watermark and work on tables and streams alike (on a table the watermark has no effect).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.functions.changes import money
from tidemill.functions.keywords import explode_words
from tidemill.functions.times import millis_to_second_time, millis_to_time, text_time, tumble, window_text
from tidemill.operators.clean import (
    filter_home_detail, filter_login, filter_search_keyword, keep_insert, session_start,
)
from tidemill.operators.dedup import keep_first, keep_first_sliding, keep_last
from tidemill.operators.firsts import day_firsts, first_of_day_and_ever, returning
from tidemill.operators.lookups import dim_join, sku_ids, sku_names, with_sku
from tidemill.operators.visits import page_marks, visit_counts
from tidemill.plans.facts import DETAIL_TIES

TRAFFIC_KEYS = ["ar", "ch", "is_new", "vc"]
# fixed values: window lengths, and how late rows may come
SIZE, TRAFFIC_SIZE = "10 seconds", "5 seconds"
DELAY, REFUND_DELAY, TRAFFIC_DELAY = "2 seconds", "10 seconds", "13 seconds"


def per_window(
    df: DataFrame, time: Column, size: str, keys: Sequence[str], *measures: Column,
    delay: str | None = DELAY,
) -> DataFrame:
    """Group by tumbling window and keys; rows later than the watermark are left out of a stream.

    ``delay`` None: the time column has its watermark already.
    """
    if delay:
        df, time = df.withColumn("_time", time).withWatermark("_time", delay), F.col("_time")
    grouped = df.groupBy(tumble(time, size).alias("window"), *keys).agg(*measures)
    names = [c for c in grouped.columns if c != "window"]
    return grouped.select(*window_text("window"), *names)


def total(name: str, alias: str | None = None) -> Column:
    return F.sum(name).alias(alias or name)


# ---- traffic ---------------------------------------------------------------------

def traffic_rows(rows: DataFrame, **measures: Column | int) -> DataFrame:
    """Page-shaped rows to ``ts``, the four keys and the five measures (missing ones 0)."""
    given = {n: (F.lit(v) if isinstance(v, int) else v) for n, v in measures.items()}
    cols = [given.get(n, F.lit(0)).cast("long").alias(n) for n in ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")]
    return rows.select("ts", *[F.col(f"common.{k}").alias(k) for k in TRAFFIC_KEYS], *cols)


def traffic_union(page: DataFrame, uv: DataFrame, uj: DataFrame) -> DataFrame:
    """The three sources in one shape."""
    views = traffic_rows(
        page, sv_ct=F.when(session_start(), 1).otherwise(0), pv_ct=1, dur_sum=F.col("page.during_time")
    )
    return traffic_rows(uv, uv_ct=1).unionByName(traffic_rows(uj, uj_ct=1)).unionByName(views)


def traffic_window(page: DataFrame, uv: DataFrame, uj: DataFrame) -> DataFrame:
    return per_window(
        traffic_union(page, uv, uj), millis_to_time("ts"), TRAFFIC_SIZE, TRAFFIC_KEYS,
        total("uv_ct"), total("sv_ct"), total("pv_ct"), total("dur_sum"), total("uj_ct"), delay=TRAFFIC_DELAY,
    )


def traffic_window_of_log(log: DataFrame) -> DataFrame:
    """The same metrics straight from a cleaned, uncorrected log (with ``start`` and ``offset``).

    Instead of three detail sources that each go over the log, the log is read once: jumps, page
    counts and the marks for new and unique visitors come from one pass, and the per-device rules
    see only the summed cells.
    """
    cells = visit_counts(page_marks(log)).where("pv_ct > 0")
    return per_window(
        cells, millis_to_time("cell"), TRAFFIC_SIZE, TRAFFIC_KEYS,
        *[total(n) for n in ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")],
    )


def home_detail_uv_window(page: DataFrame) -> DataFrame:
    """Devices whose first home (or detail) view of the day lies in the window."""
    seen = filter_home_detail(page).where(F.col("common.mid").isNotNull()).select(
        F.struct(F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id")).alias("who"),
        millis_to_time("ts").alias("time"),
    )
    firsts = seen.groupBy("who.mid", "who.page_id", F.to_date("time").alias("day")).agg(F.min("time").alias("first_time"))
    return home_detail_counts(firsts)


def home_detail_counts(firsts: DataFrame, delay: str | None = DELAY) -> DataFrame:
    is_home = (F.col("page_id") == "home").cast("long")
    return per_window(
        firsts, F.col("first_time"), SIZE, [],
        F.sum(is_home).alias("home_uv_ct"), F.sum(1 - is_home).alias("good_detail_uv_ct"), delay=delay,
    )


def kw_window(page: DataFrame, splitter=None) -> DataFrame:
    """How often each word was searched for."""
    asked = filter_search_keyword(page).select(
        F.col("page.item").alias("key_word"), millis_to_second_time("ts").alias("rt")
    )
    counted = per_window(
        explode_words(asked, "key_word", "keyword", splitter), F.col("rt"), SIZE, ["keyword"],
        F.count("*").alias("keyword_count"),
    )
    return counted.select(F.lit("search").alias("source"), "*")


# ---- users -----------------------------------------------------------------------

def login_window(page: DataFrame) -> DataFrame:
    """First logins of the day, and how many of them come back after a long pause."""
    return login_counts(returning(filter_login(page), F.col("common.uid"), millis_to_time("ts")))


def login_counts(logins: DataFrame, delay: str | None = DELAY) -> DataFrame:
    return per_window(
        logins, F.col("first_time"), SIZE, [], total("is_back", "back_ct"), F.count("*").alias("uu_ct"), delay=delay
    )


def register_window(registered: DataFrame) -> DataFrame:
    """Registrations; ``ts`` counts seconds."""
    return per_window(registered, F.timestamp_seconds("ts"), SIZE, [], F.count("*").alias("register_ct"))


def cart_uu_window(cart: DataFrame) -> DataFrame:
    """Users whose first cart addition of the day lies in the window."""
    when = text_time(F.coalesce("operate_time", "create_time"))
    return cart_counts(day_firsts(cart, F.col("user_id"), when))


def cart_counts(firsts: DataFrame, delay: str | None = DELAY) -> DataFrame:
    return per_window(firsts, F.col("first_time"), SIZE, [], F.count("*").alias("cart_add_uu_ct"), delay=delay)


# ---- trade -----------------------------------------------------------------------

def latest_details(wide: DataFrame) -> DataFrame:
    """Order details as ordered: insert versions, the latest per detail id."""
    return keep_last(keep_insert(wide), ["order_detail_id"], "ts", DETAIL_TIES)


def or_zero(name: str) -> Column:
    return F.coalesce(money(name), F.lit(0).cast("decimal(16,2)"))


ORDER_AMOUNTS = {
    "order_activity_reduce_amount": "activity_reduce_amount",
    "order_coupon_reduce_amount": "coupon_reduce_amount",
    "order_original_total_amount": "original_total_amount",
}


def order_window(wide: DataFrame, per_order: bool = False) -> DataFrame:
    """Ordering users of the day, first-time users, and summed order amounts.

    Order amounts repeat on every detail row and are summed as they come; ``per_order`` counts
    each order once per window instead.

    A user's orders are first summed per window. That keeps the per-user step, which looks at the
    previous window to tell a first order of the day, down to one row per user and window. Rows without a user
    add their amounts and count for nobody.
    """
    return ordered_counts(latest_details(wide), per_order)


def ordered_counts(details: DataFrame, per_order: bool = False) -> DataFrame:
    """``order_window`` of details that are one row per detail id."""
    rows = details.select(
        "user_id", "order_id", text_time("order_create_time").alias("time"),
        *[or_zero(c).alias(n) for n, c in ORDER_AMOUNTS.items()],
    )
    window = tumble("time", SIZE).alias("window")
    if per_order:
        rows = rows.groupBy("user_id", "order_id", window).agg(*[F.max(n).alias(n) for n in ORDER_AMOUNTS])
        window = F.col("window")
    users = rows.groupBy("user_id", window).agg(*[total(n) for n in ORDER_AMOUNTS])
    day, known = F.to_date("window.start"), F.col("user_id").isNotNull()
    nobody = F.when(~known, F.col("window.start"))  # rows without a user are no one group
    before = F.lag(day).over(Window.partitionBy("user_id", nobody).orderBy("window.start"))
    marked = users.withColumn("prev", before).withColumns({
        "is_unique": (known & (F.col("prev").isNull() | (F.col("prev") != day))).cast("long"),
        "is_new": (known & F.col("prev").isNull()).cast("long"),
        "time": F.col("window.start"),
    })
    return order_counts(marked)


def order_counts(marked: DataFrame, delay: str | None = DELAY) -> DataFrame:
    return per_window(
        marked, F.col("time"), SIZE, [],
        total("is_unique", "order_unique_user_count"), total("is_new", "order_new_user_count"),
        *[F.sum(n).cast("double").alias(n) for n in ORDER_AMOUNTS],
        delay=delay,
    )


def payment_window(paid: DataFrame) -> DataFrame:
    """Paying users of the day and first-time payers; copies of a detail in one burst count by their first."""
    once = keep_first_sliding(
        paid.select("order_detail_id", "user_id", "callback_time"),
        ["order_detail_id"], text_time("callback_time"), ("user_id",),
    )
    return payment_counts(first_of_day_and_ever(once, F.col("user_id"), text_time("callback_time")))


def payment_counts(payers: DataFrame, delay: str | None = DELAY) -> DataFrame:
    return per_window(
        payers, F.col("first_time"), SIZE, [],
        F.count("*").alias("payment_suc_unique_user_count"), total("is_new", "payment_suc_new_user_count"),
        delay=delay,
    )


def order_totals(details: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct orders and their amount per window and keys.

    Details are summed per order first, then orders are counted: exact on a stream too, and one
    busy key is spread over its orders.
    """
    timed = details.withColumn("_time", text_time("order_create_time")).withWatermark("_time", DELAY)
    orders = timed.groupBy(tumble("_time", SIZE).alias("window"), *keys, "order_id").agg(
        F.sum(money("split_total_amount")).alias("amount")
    )
    summed = orders.groupBy(F.window("window", SIZE).alias("window"), *keys).agg(
        F.count("order_id").alias("order_count"), F.sum("amount").cast("double").alias("order_amount")
    )
    return summed.select(*window_text("window"), *keys, "order_count", "order_amount")


def province_window(wide: DataFrame, province: DataFrame) -> DataFrame:
    """Orders and amount per province; the name is looked up after the sums."""
    return province_counts(latest_details(wide), province)


def province_counts(details: DataFrame, province: DataFrame) -> DataFrame:
    return name_provinces(order_totals(details, ["province_id"]), province)


def name_provinces(totals: DataFrame, province: DataFrame) -> DataFrame:
    named = dim_join(totals, province, "province_id", {"name": "province_name"})
    return named.select("stt", "edt", "province_id", "province_name", "order_count", "order_amount")


SPU_KEYS = [
    "user_id", "category1_id", "category1_name", "category2_id", "category2_name", "category3_id",
    "category3_name", "spu_id", "spu_name", "trademark_id", "trademark_name",
]


def spu_order_window(wide: DataFrame, sku_dim: DataFrame) -> DataFrame:
    """Orders and amount per user, category path, spu and trademark."""
    return spu_counts(latest_details(wide), sku_dim)


def spu_totals(details: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """``spu_order_window`` of details that are one row per detail id.

    Only the ids of a sku are joined to the details; names and upper categories follow from these and are joined to the sums.
    """
    ids = ["spu_id", "trademark_id", "category3_id"]
    summed = order_totals(with_sku(details, sku_ids(dims), ids), ["user_id", *ids])
    return sku_names(summed, dims).select("stt", "edt", *SPU_KEYS, "order_count", "order_amount")


def spu_counts(details: DataFrame, sku_dim: DataFrame) -> DataFrame:
    return order_totals(with_sku(details, sku_dim, [k for k in SPU_KEYS if k != "user_id"]), SPU_KEYS)


REFUND_DIMS = [
    "trademark_id", "trademark_name", "category1_id", "category1_name", "category2_id", "category2_name",
    "category3_id", "category3_name",
]


def refund_window(refund: DataFrame, sku_dim: DataFrame, grain: str = "sku") -> DataFrame:
    """Refund requests per trademark and category path, at sku or user grain.

    At sku grain the dimension is joined to the counts, not to the requests.
    """
    once = keep_first(
        refund.select("id", "user_id", "sku_id", "create_time"), ["id"], "create_time", ("sku_id", "user_id")
    )
    return refund_counts(once, sku_dim, grain)


def refund_counts(
    once: DataFrame, sku_dim: DataFrame, grain: str = "sku", time: Column | None = None, delay: str | None = REFUND_DELAY
) -> DataFrame:
    if grain not in ("sku", "user"):
        raise ValueError("grain is 'sku' or 'user'")
    time = text_time("create_time") if time is None else time
    n = F.count("*").alias("refund_count")
    if grain == "user":
        named = with_sku(once, sku_dim, REFUND_DIMS)
        return per_window(named, time, SIZE, ["user_id", *REFUND_DIMS], n, delay=delay)
    return name_refunds(per_window(once, time, SIZE, ["sku_id"], n, delay=delay), sku_dim)


def name_refunds(counted: DataFrame, sku_dim: DataFrame) -> DataFrame:
    return with_sku(counted, sku_dim, REFUND_DIMS).select("stt", "edt", "sku_id", *REFUND_DIMS, "refund_count")


def name_user_refunds(counted: DataFrame, sku_dim: DataFrame) -> DataFrame:
    """Counts per window, user and sku to those per user, trademark and category path.

    A window's counts must all be there: a stream closes a window in one micro-batch.
    """
    named = with_sku(counted, sku_dim, REFUND_DIMS)
    return named.groupBy("stt", "edt", "user_id", *REFUND_DIMS).agg(total("refund_count"))


# ---- text ------------------------------------------------------------------------

def keyword_count(texts: DataFrame, text: str = "text", by: Sequence[str] = (), splitter=None) -> DataFrame:
    """How often each word occurs in a text column."""
    words = explode_words(texts.select(*by, text), text, "keyword", splitter)
    return words.groupBy(*by, "keyword").agg(F.count("*").alias("keyword_count"))
