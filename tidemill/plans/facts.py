"""Change-log jobs: one function per detail fact.

Every function takes the change log as envelope columns (and lookup frames) and works on a table or,
where it has no shuffle or only dictionary joins, on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions import packing
from tidemill.functions.changes import changed_key_exists, changed_key_not_null, field, pick_change
from tidemill.functions.times import text_day
from tidemill.operators.dedup import keep_last
from tidemill.operators.lookups import lookup_join, reduced_join, small_side
from tidemill.schemas import CART_KEYS, ORDER_DETAIL_KEYS, ORDER_INFO_KEYS, ORDER_WIDE, REFUND_KEYS, SHOP_DB

# fixed values: order and payment states
CANCELLED, REFUNDED, PAID = "1003", "1005", "1602"


# ---- order ---------------------------------------------------------------------

def original_amount(number: Column, price: Column) -> Column:
    return (number.try_cast("decimal(16,2)") * price.try_cast("decimal(16,2)")).cast("string")


def order_details(log: DataFrame, database: str | None = SHOP_DB) -> DataFrame:
    keys = {"id": "order_detail_id", **{k: k for k in ORDER_DETAIL_KEYS}}
    original = original_amount(field("sku_num"), field("order_price"))
    rows = pick_change(
        log, "order_detail", ["insert"], keys, original.alias("split_original_amount"), F.col("ts"), database=database,
    )
    return rows.withColumnRenamed("create_time", "order_create_time")


def order_infos(log: DataFrame, database: str | None = SHOP_DB, *extra: str) -> DataFrame:
    keys = {"id": "id", **{k: k for k in ORDER_INFO_KEYS}}
    return pick_change(log, "order_info", ["insert", "update"], keys, "type", "old", *extra, database=database)


def order_activities(log: DataFrame, database: str | None = SHOP_DB) -> DataFrame:
    keys = {"id": "id", "order_detail_id": "order_detail_id", "activity_id": "activity_id",
            "activity_rule_id": "activity_rule_id", "create_time": "activity_create_time"}
    return pick_change(log, "order_detail_activity", ["insert"], keys, "ts", database=database)


def order_coupons(log: DataFrame, database: str | None = SHOP_DB) -> DataFrame:
    keys = {"id": "id", "order_detail_id": "order_detail_id", "coupon_id": "coupon_id",
            "coupon_use_id": "coupon_use_id", "create_time": "coupon_create_time"}
    return pick_change(log, "order_detail_coupon", ["insert"], keys, "ts", database=database)


def _one_per_detail(log: DataFrame, database: str | None) -> DataFrame:
    # The order-detail topic is keyed by detail id, so of several activities (or coupons) of one
    # detail the latest wins. Both are reduced to one row of a detail in one shuffle, so the join is many-to-one.
    one = lambda df, columns, name: df.select("order_detail_id", F.struct("ts", "id", *columns).alias(name))
    both = one(order_activities(log, database), ACTIVITY_COLUMNS, "activity").unionByName(
        one(order_coupons(log, database), COUPON_COLUMNS, "coupon"), allowMissingColumns=True)
    last = both.groupBy("order_detail_id").agg(F.max("activity").alias("activity"), F.max("coupon").alias("coupon"))
    return last.select("order_detail_id", *[F.col(f"activity.{c}") for c in ACTIVITY_COLUMNS],
                       *[F.col(f"coupon.{c}") for c in COUPON_COLUMNS])


def _distinct_versions(infos: DataFrame) -> DataFrame:
    # Copies of one order version would multiply with the details of that order. Versions of equal columns beside
    # VERSION_COLUMNS travel as one row, so these columns are shuffled and sorted once for all of them.
    plain = infos.withColumn("old", F.array_sort(F.map_entries("old")))
    same = [c for c in infos.columns if c not in VERSION_COLUMNS]
    return plain.groupBy(*same).agg(F.collect_set(F.struct(*VERSION_COLUMNS)).alias("_versions"))


def _each_version(joined: DataFrame) -> DataFrame:
    rows = joined.select(*[c for c in joined.columns if c != "_versions"], F.inline("_versions"))
    return rows.withColumn("old", F.map_from_entries("old"))


def order_detail_wide(
    log: DataFrame, dic: DataFrame, database: str | None = SHOP_DB, extras: bool = True, whole: bool = False
) -> DataFrame:
    """Order details with order, activity, coupon and source name; one row per order version.

    The dictionary join goes first: details with an unknown source leave before anything is shuffled.
    Activity and coupon come with one join and never add or drop a row; for readers of other columns
    ``extras=False`` saves it and leaves them empty. For readers of all columns, ``whole``: texts go through the
    shuffles packed; readers of some columns shuffle less without it, as the others are left out.
    """
    packed = lambda df, packs: packing.each(packing.pack, df, packs) if whole else df
    # The original amount follows from two columns and is made after the shuffles.
    details = order_details(log, database).drop("split_original_amount")
    wide = packed(lookup_join(details, dic, "source_type", "dic_name"), DETAIL_PACKS)
    if extras:
        wide = reduced_join(wide, packed(_one_per_detail(log, database), EXTRA_PACKS), "order_detail_id")
    infos = _distinct_versions(packed(order_infos(log, database), ORDER_PACKS)).withColumnRenamed("id", "order_id")
    wide = wide.join(infos, "order_id", "inner")
    if whole:
        wide = packing.each(packing.unpack, wide, {**DETAIL_PACKS, **ORDER_PACKS, **(EXTRA_PACKS if extras else {})})
    if not extras:
        wide = wide.withColumns({c: F.lit(None).cast("string") for c in ACTIVITY_COLUMNS + COUPON_COLUMNS})
    wide = wide.withColumn("split_original_amount", original_amount(F.col("sku_num"), F.col("order_price")))
    wide = _each_version(wide).withColumn("pt", F.current_timestamp())
    return wide.select(*ORDER_WIDE.names, F.timestamp_seconds("ts").alias("ts"))


ACTIVITY_COLUMNS = ["activity_id", "activity_rule_id", "activity_create_time"]
COUPON_COLUMNS = ["coupon_id", "coupon_use_id", "coupon_create_time"]
VERSION_COLUMNS = ["type", "order_status", "operate_time", "old"]  # what a change of its state changes in an order

# columns that travel as one value, digits apart from other text
DETAIL_PACKS = {
    "_detail_text": ["sku_id", "sku_name", "source_type", "dic_name"],
    "_detail_digits": ["order_price", "sku_num", "order_create_time", "source_id", "split_total_amount",
                       "split_activity_amount", "split_coupon_amount"],
}
EXTRA_PACKS = {"_extra_digits": ACTIVITY_COLUMNS + COUPON_COLUMNS}
ORDER_PACKS = {
    "_order_text": ["consignee", "payment_way", "out_trade_no", "trade_body", "process_status", "tracking_no", "parent_order_id"],
    "_order_digits": ["consignee_tel", "total_amount", "user_id", "expire_time", "province_id", "activity_reduce_amount",
                      "coupon_reduce_amount", "original_total_amount", "feight_fee", "feight_fee_reduce"],
}


# among versions of one order detail with equal time the greatest of these wins
DETAIL_TIES = ("split_original_amount", "sku_id", "split_total_amount", "source_id")
# among insert versions of one order with equal time the greatest of these wins
PLACED_COLUMNS = ("user_id", "province_id", "original_total_amount", "activity_reduce_amount", "coupon_reduce_amount")


def details_as_ordered(log: DataFrame, dic: DataFrame, database: str | None = SHOP_DB) -> DataFrame:
    """One row per detail id, its latest, with ``PLACED_COLUMNS`` of its order as it was placed.

    The rows that ``metrics.latest_details`` finds among the wide ones, without making these: details and the insert
    versions of orders are reduced to one row per key, each with a limit before its shuffle, and joined then. A
    detail belongs to one order; details of orders without an insert are left out.
    """
    details = lookup_join(order_details(log, database), dic, "source_type", "dic_name")
    last = keep_last(details, ["order_detail_id"], "ts", DETAIL_TIES)
    placed = order_infos(log, database, "ts").where("type = 'insert'").select(
        F.col("id").alias("order_id"), F.col("ts").alias("placed_ts"), *PLACED_COLUMNS)
    return reduced_join(last, keep_last(placed, ["order_id"], "placed_ts", PLACED_COLUMNS).drop("placed_ts"), "order_id", "inner")


def order_add(wide: DataFrame) -> DataFrame:
    return wide.where(F.col("type") == "insert")


def order_cancel(wide: DataFrame) -> DataFrame:
    return wide.where(
        (F.col("type") == "update") & changed_key_not_null("order_status") & (F.col("order_status") == CANCELLED)
    )


# ---- payment and refund ----------------------------------------------------------

PAY_COLUMNS = (
    "order_detail_id order_id user_id sku_id province_id activity_id activity_rule_id coupon_id "
    "payment_type_code payment_type_name callback_time source_id source_type sku_num "
    "split_original_amount split_activity_amount split_coupon_amount split_payment_amount"
).split()


def payments(log: DataFrame) -> DataFrame:
    keys = {"order_id": "order_id", "payment_type": "payment_type_code", "callback_time": "callback_time"}
    return pick_change(
        log, "payment_info", ["update"], keys,
        where=(field("payment_status") == PAID) & changed_key_not_null("payment_status"),
    )


def pay_success(log: DataFrame, wide: DataFrame, dic: DataFrame) -> DataFrame:
    """Details of successfully paid orders.

    The wide rows arrive partitioned by order id from their last join, and this one reuses that.
    Copies of a payment record are dropped first, so they cannot multiply with the details.
    """
    paid = lookup_join(payments(log).distinct(), dic, "payment_type_code", "payment_type_name")
    return (
        wide.join(paid, "order_id", "inner")
        .withColumnRenamed("split_total_amount", "split_payment_amount")
        .select(*PAY_COLUMNS)
    )


def paid_users(log: DataFrame, dic: DataFrame, database: str | None = SHOP_DB) -> DataFrame:
    """``order_detail_id, user_id, callback_time`` of successfully paid details: the rows of ``pay_success`` without its copies.

    Order versions that name the same user are one row before anything is joined, and payments meet the orders, not
    their details.
    """
    details = lookup_join(order_details(log, database), dic, "source_type", "dic_name").select("order_detail_id", "order_id")
    users = order_infos(log, database).select(F.col("id").alias("order_id"), "user_id").distinct()
    paid = lookup_join(payments(log).distinct(), dic, "payment_type_code", "payment_type_name").select("order_id", "callback_time")
    return reduced_join(details, users.join(paid, "order_id"), "order_id", "inner").select("order_detail_id", "user_id", "callback_time")


def refunds(log: DataFrame) -> DataFrame:
    return pick_change(log, "order_refund_info", ["insert"], REFUND_KEYS, "ts")


def refunded_orders(log: DataFrame) -> DataFrame:
    return pick_change(
        log, "order_info", ["update"], {"id": "order_id", "province_id": "province_id"}, "ts",
        where=(field("order_status") == REFUNDED) & changed_key_exists("order_status"),
    )


def order_refund(log: DataFrame, dic: DataFrame) -> DataFrame:
    """Refund requests with the order's province and both dictionary names.

    The result is keyed by request, so of several refund updates of one order the latest is joined.
    """
    codes = small_side(dic.select("dic_code", "dic_name"))
    orders = keep_last(refunded_orders(log), ["order_id"], "ts", ("province_id",)).drop("ts")
    joined = reduced_join(refunds(log), orders, "order_id")
    return name_refunds(joined, codes)


def name_refunds(joined: DataFrame, codes: DataFrame) -> DataFrame:
    joined = lookup_join(joined, codes, "refund_type", "refund_type_name", "left", checked=True)
    joined = lookup_join(joined, codes, "refund_reason_type", "refund_reason_type_name", "left", checked=True)
    return joined.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        text_day("create_time").alias("date_id"), "create_time",
        F.col("refund_type").alias("refund_type_code"), "refund_type_name",
        F.col("refund_reason_type").alias("refund_reason_type_code"), "refund_reason_type_name",
        "refund_reason_txt", "refund_num", "refund_amount", "ts",
    )


# ---- cart ------------------------------------------------------------------------

def cart_add(log: DataFrame, dic: DataFrame, database: str | None = SHOP_DB) -> DataFrame:
    """Cart inserts, and updates that raise the amount; ``sku_num`` is what was added."""
    now = field("sku_num").try_cast("int")
    before = F.col("old").getItem("sku_num").try_cast("int")
    added = F.when(F.col("type") == "insert", now).otherwise(now - before)
    raised = (F.col("type") == "insert") | (changed_key_not_null("sku_num") & (now > before))
    keys = [k for k in CART_KEYS if k != "sku_num"]
    rows = pick_change(
        log, "cart_info", ["insert", "update"], keys, added.alias("sku_num"), database=database, where=raised
    )
    return lookup_join(rows, dic, "source_type", "dic_name").select(*CART_KEYS, "dic_name")


# ---- coupon, favourite, comment, registration --------------------------------------

def coupon_get(log: DataFrame) -> DataFrame:
    return pick_change(
        log, "coupon_use", ["insert"], ["id", "coupon_id", "user_id"],
        text_day(field("get_time")).alias("date_id"), field("get_time").alias("get_time"), "ts",
    )


def _coupon_changed(log: DataFrame, key: str, name: str) -> DataFrame:
    return pick_change(
        log, "coupon_use", ["update"], ["id", "coupon_id", "user_id", "order_id"],
        text_day(field(key)).alias("date_id"), field(key).alias(name), "ts",
        where=changed_key_exists(key),
    )


def coupon_order(log: DataFrame) -> DataFrame:
    return _coupon_changed(log, "using_time", "order_time")


def coupon_pay(log: DataFrame) -> DataFrame:
    return _coupon_changed(log, "used_time", "payment_time")


def favor_add(log: DataFrame, guard: bool = True) -> DataFrame:
    """Favourites added, or taken up again.

    ``guard=False`` drops the table test from the second branch, so that a change of any table with
    such a flag counts; kept for comparison with jobs that lack the brackets.
    """
    again = (F.col("type") == "update") & (F.col("old").getItem("is_cancel") == "1") & (field("is_cancel") == "0")
    own = F.col("table") == "favor_info"
    added = own & (F.col("type") == "insert")
    cond = added | ((own & again) if guard else again)
    return log.where(cond).select(
        field("id").alias("id"), field("user_id").alias("user_id"), field("sku_id").alias("sku_id"),
        text_day(field("create_time")).alias("date_id"), field("create_time").alias("create_time"), "ts",
    )


def comment_add(log: DataFrame, dic: DataFrame) -> DataFrame:
    rows = pick_change(
        log, "comment_info", ["insert"],
        {"id": "id", "user_id": "user_id", "sku_id": "sku_id", "order_id": "order_id",
         "create_time": "create_time", "appraise": "appraise_code"},
        "ts",
    )
    named = lookup_join(rows, dic, "appraise_code", "appraise_name", "left")
    return named.select(
        "id", "user_id", "sku_id", "order_id", text_day("create_time").alias("date_id"), "create_time",
        "appraise_code", "appraise_name", "ts",
    )


def user_register(log: DataFrame) -> DataFrame:
    return pick_change(
        log, "user_info", ["insert"], {"id": "user_id"},
        text_day(field("create_time")).alias("date_id"), field("create_time").alias("create_time"), "ts",
    )
