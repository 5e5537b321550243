"""Row types of the topics, the change log and the lookup tables."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def strings(names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names.split()]


# ---- fixed values: topic names -------------------------------------------------
TOPICS = {
    "log": "topic_log",
    "db": "topic_db",
    "dirty": "dirty_data",
    "page": "dwd_traffic_page_log",
    "start": "dwd_traffic_start_log",
    "display": "dwd_traffic_display_log",
    "action": "dwd_traffic_action_log",
    "error": "dwd_traffic_error_log",
    "unique_visitor": "dwd_traffic_unique_visitor_detail",
    "user_jump": "dwd_traffic_user_jump_detail",
    "order_detail": "dwd_trade_order_detail",
    "order_add": "dwd_trade_order_add",
    "order_cancel": "dwd_trade_cancel_detail",
    "pay_success": "dwd_trade_pay_detail_suc",
    "order_refund": "dwd_trade_order_refund",
    "cart_add": "dwd_trade_cart_add",
    "coupon_get": "dwd_tool_coupon_get",
    "coupon_order": "dwd_tool_coupon_order",
    "coupon_pay": "dwd_tool_coupon_pay",
    "favor_add": "dwd_interaction_favor_add",
    "comment": "dwd_interaction_comment",
    "register": "dwd_user_register",
}

# ---- raw log -------------------------------------------------------------------
COMMON = T.StructType(strings("mid uid vc ch ar is_new"))
PAGE = T.StructType(
    strings("page_id last_page_id item item_type") + [T.StructField("during_time", T.LongType())]
)
RAW_LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("page", PAGE),
    T.StructField("start", TEXT_MAP),
    T.StructField("displays", T.ArrayType(TEXT_MAP)),
    T.StructField("actions", T.ArrayType(TEXT_MAP)),
    T.StructField("err", TEXT_MAP),
    T.StructField("ts", T.LongType()),
])

# ---- change log ------------------------------------------------------------------
# One envelope serves every table. `ts` is in epoch seconds.
ENVELOPE = T.StructType(
    strings("database table type")
    + [
        T.StructField("data", TEXT_MAP),
        T.StructField("old", TEXT_MAP),
        T.StructField("ts", T.LongType()),
    ]
)
CONTROL_TYPES = ("bootstrap-start", "bootstrap-complete")
ROUTED_TYPES = ("bootstrap-insert", "insert", "update")
SHOP_DB = "shop"

# ---- lookup tables ---------------------------------------------------------------
BASE_DIC = T.StructType(
    strings("dic_code dic_name parent_code")
    + [T.StructField("create_time", T.TimestampType()), T.StructField("operate_time", T.TimestampType())]
)
TABLE_PROCESS = T.StructType(strings("source_table sink_table sink_columns sink_pk sink_extend"))

# ---- change-log columns that are read --------------------------------------------
ORDER_DETAIL_KEYS = (
    "order_id sku_id sku_name order_price sku_num create_time source_type source_id "
    "split_total_amount split_activity_amount split_coupon_amount"
).split()
ORDER_INFO_KEYS = (
    "consignee consignee_tel total_amount order_status user_id payment_way out_trade_no trade_body "
    "operate_time expire_time process_status tracking_no parent_order_id province_id "
    "activity_reduce_amount coupon_reduce_amount original_total_amount feight_fee feight_fee_reduce"
).split()
CART_KEYS = (
    "id user_id sku_id cart_price sku_num sku_name is_checked create_time operate_time "
    "is_ordered order_time source_type source_id"
).split()
REFUND_KEYS = (
    "id user_id order_id sku_id refund_type refund_num refund_amount refund_reason_type "
    "refund_reason_txt create_time"
).split()

# ---- order-detail topic: 42 columns, plus the version time `ts` -------------------
ORDER_WIDE = T.StructType(
    strings(
        "order_detail_id order_id sku_id sku_name order_price sku_num order_create_time source_type "
        "source_id split_original_amount split_total_amount split_activity_amount split_coupon_amount"
    )
    + [T.StructField("pt", T.TimestampType())]
    + strings(" ".join(ORDER_INFO_KEYS) + " type")
    + [T.StructField("old", TEXT_MAP)]
    + strings(
        "activity_id activity_rule_id activity_create_time coupon_id coupon_use_id coupon_create_time dic_name"
    )
)
ORDER_WIDE_TS = T.StructType(ORDER_WIDE.fields + [T.StructField("ts", T.TimestampType())])
