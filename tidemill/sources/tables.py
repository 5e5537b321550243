"""The shop's topics derived from the TPC-H-like tables of a folder.

Everything is a projection of the given tables: a row of `events` is a log record, rows of
`lineitem`, `orders`, `customer`, `part` and `nation` are change-log records.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.functions.times import SECOND
from tidemill.schemas import CONTROL_TYPES, ENVELOPE, SHOP_DB, TEXT_MAP


class Tables:
    """Lazy readers for one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        df = spread(df, LARGE[name]) if name in LARGE else df
        setattr(self, name, df)  # footers are read once per table
        return df

    @cached_property
    def last_part(self) -> int | None:
        """The greatest part key, read once; null without parts."""
        return self.part.agg(F.max("p_partkey")).first()[0]

    @cached_property
    def lines(self) -> DataFrame:
        """The rows of `lineitem` with ``line_columns``."""
        return self.lineitem.withColumns(line_columns())


LARGE = {
    "events": ["event_id"], "lineitem": ["l_orderkey", "l_partkey"], "orders": ["o_orderkey"], "documents": ["doc_id"],
}


def spread(df: DataFrame, by: list[str]) -> DataFrame:
    """Deal the rows of a table over ``spark.tidemill.scan.partitions`` partitions, where a session asks for it.

    The local session does, as its tables are single files; elsewhere a table is read as it is.
    """
    partitions = df.sparkSession.conf.get("spark.tidemill.scan.partitions", None)
    return df.repartition(int(partitions), *by) if partitions else df


# ---- page log --------------------------------------------------------------------

def _event_ms(fast: bool) -> Column:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    if fast:
        start = F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
        micros = start + F.floor((micros - start) / F.lit(1000))
    return F.floor(micros / F.lit(1000))


def _event_rows(t: Tables, fast: bool, items: bool) -> DataFrame:
    e = F.col("event_id")
    last = F.when(e % 5 == 2, "search").when(e % 5 > 2, "home")
    searched = last == "search"
    if items:
        parts = t.part.select(F.col("p_partkey").alias("_part"), F.col("p_name").alias("_item"))
        rows = t.events.withColumn("_key", e % F.lit((t.last_part or 0) + 1))  # events go round all parts
        rows = rows.join(parts, F.col("_key") == F.col("_part"), "left")
    else:
        rows = t.events.withColumn("_item", F.lit(None).cast("string"))
    common = F.struct(
        F.concat(F.lit("m"), F.col("user_id")).alias("mid"),
        F.when(e % 3 != 0, F.col("user_id").cast("string")).alias("uid"),
        F.concat(F.lit("v"), F.col("user_id") % 3).alias("vc"),
        F.concat(F.lit("c"), F.col("user_id") % 2).alias("ch"),
        (F.col("user_id") % 25).cast("string").alias("ar"),
        F.when(e % 4 == 0, "1").otherwise("0").alias("is_new"),
    )
    kind = F.col("event_type")
    page_id = (
        F.when(kind == "view", "good_detail").when(kind == "click", "home").when(kind == "signup", "login")
        .when(kind == "purchase", "trade").otherwise("cart")
    )
    page = F.struct(
        page_id.alias("page_id"),
        last.alias("last_page_id"),
        F.when(searched, F.col("_item")).alias("item"),
        F.when(searched, "keyword").alias("item_type"),
        F.round(F.col("value") * 100).cast("long").alias("during_time"),
    )
    return rows.select(
        common.alias("common"), page.alias("page"), _event_ms(fast).alias("ts"), e.alias("offset"),
        "event_type", "props",
    )


def page_log(t: Tables, fast: bool = False, items: bool = True) -> DataFrame:
    """Every event as a page row; ``fast`` squeezes time a thousandfold for second-long windows.

    Only searches look at the items; without ``items`` they stay empty and `part` is not read.
    """
    return _event_rows(t, fast, items).select("common", "page", "ts", "offset")


def raw_log(t: Tables, fast: bool = False, damaged: bool = False) -> DataFrame:
    """Log records as text with their offset: every event as a whole record.

    Offsets divisible by 11 are start logs, error events carry an error part, view events up to
    three displays, clicks up to two actions. With ``damaged`` some records come a second time, as a log that was
    cut off holds them: empty where 89 divides the offset, cut short where 97 does.
    """
    n = F.col("offset")
    rows = _event_rows(t, fast, True)
    is_start = n % 11 == 0
    element = lambda name, width: F.transform(
        F.sequence(F.lit(1), (n % width).cast("int")),
        lambda i: F.create_map(F.lit(name), F.col("props"), F.lit("order"), i.cast("string")),
    )
    empty = F.lit(None).cast("array<map<string,string>>")
    some = lambda kind, name, width: F.when(
        (F.col("event_type") == kind) & (n % width > 0), element(name, width)
    ).otherwise(empty)
    body = F.struct(
        "common",
        F.when(~is_start, F.col("page")).alias("page"),
        F.when(is_start, F.create_map(F.lit("entry"), F.lit("icon"))).alias("start"),
        some("view", "item", 4).alias("displays"),
        some("click", "action_id", 3).alias("actions"),
        F.when(F.col("event_type") == "error", F.create_map(F.lit("error_code"), (n % 10).cast("string"))).alias("err"),
        "ts",
    )
    text = F.to_json(body)
    if not damaged:
        return rows.select(text.alias("value"), "offset")
    copies = F.when(n % 89 == 0, F.array(text, F.lit(""))).when(n % 97 == 0, F.array(text, F.substring(text, 1, 40)))
    return rows.select(F.explode(F.coalesce(copies, F.array(text))).alias("value"), "offset")


# ---- change log ------------------------------------------------------------------

def _cents(name: str) -> Column:
    """Whole cents, halves away from zero: what ``round`` gives, which goes through a decimal of the number's text."""
    exact = F.col(name) * 100
    whole = exact.cast("long")
    return whole + ((exact - whole) * 2).cast("long")


def _amount(cents: Column) -> Column:
    """Whole cents as amount text with two decimals."""
    return (cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(16,2)").cast("string")


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _map(values: dict[str, Column]) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("string"))])


class Change(NamedTuple):
    """The change records of one source table that rows of a frame make: one of every row, or of those ``where`` holds."""

    rows: DataFrame
    table: str
    kind: str | Column
    data: dict[str, Column]
    time: Column
    old: Column | None = None
    where: Column | str | None = None

    def columns(self, data: Column) -> list[Column]:
        kind = F.lit(self.kind) if isinstance(self.kind, str) else self.kind
        old = (self.old if self.old is not None else F.lit(None)).cast(TEXT_MAP)
        return [F.lit(SHOP_DB).alias("database"), F.lit(self.table).alias("table"), kind.alias("type"),
                data.alias("data"), old.alias("old"), F.unix_timestamp(self.time).alias("ts")]

    def envelope(self) -> DataFrame:
        rows = self.rows if self.where is None else self.rows.where(self.where)
        return rows.select(*self.columns(_map(self.data)))

    def text(self) -> Column:
        """The record as JSON, null for rows that make none."""
        fields = F.struct(*[v.cast("string").alias(k) for k, v in self.data.items()])
        text = F.to_json(F.struct(*self.columns(fields)), {"ignoreNullFields": "false"})
        if self.where is None:
            return text
        return F.when(F.expr(self.where) if isinstance(self.where, str) else self.where, text)


def _order_time() -> Column:
    return F.timestamp_seconds(F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 600)


def _stamp(time: Column) -> Column:
    return F.date_format(time, SECOND)


def line_columns() -> dict[str, Column]:
    """What several records of a line hold, worked out once for all of them."""
    time = F.timestamp_seconds(F.unix_timestamp(F.col("l_shipdate").cast("timestamp")) + F.col("l_orderkey") % 600)
    return {
        "_order": _text("l_orderkey"), "_part": _text("l_partkey"), "_supp": _text("l_suppkey"),
        "_time": time, "_stamp": _stamp(time), "_detail_id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "_line_id": F.concat_ws("-", "l_orderkey", "l_linenumber", _cents("l_extendedprice"), "l_partkey", "l_suppkey"),
        "_net": _amount(F.floor((_cents("l_extendedprice") * (100 - _cents("l_discount")) + 50) / F.lit(100))),
    }


def _unit_price() -> Column:
    cents, qty = _cents("l_extendedprice"), F.col("l_quantity").cast("long")
    return F.floor((cents * 2 + qty) / (qty * 2))


def order_info_log(t: Tables) -> list[Change]:
    """One insert per order, and one update to its later state, both from one pass over the orders."""
    place = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("_place"))
    orders = t.orders.join(place, "o_custkey", "left")
    orders = orders.withColumn("_kind", F.explode(F.array(F.lit("insert"), F.lit("update"))))
    key, made, updated = F.col("o_orderkey"), _order_time(), F.col("_kind") == "update"
    later = F.timestamp_seconds(F.unix_timestamp(made) + 30)
    after = F.when(F.col("o_orderstatus") == "F", "1002").when(F.col("o_orderstatus") == "P", "1003").otherwise("1005")

    data = {
        "id": key,
        "consignee": F.concat(F.lit("c"), F.col("o_custkey")),
        "consignee_tel": F.concat(F.lit("1"), F.lpad(_text(F.col("o_custkey")), 10, "0")),
        "total_amount": _amount(_cents("o_totalprice")),
        "order_status": F.when(updated, after).otherwise("1001"),
        "user_id": F.col("o_custkey"),
        "payment_way": F.col("o_orderpriority"),
        "out_trade_no": F.concat(F.lit("T"), key),
        "trade_body": F.lit(None).cast("string"),
        "operate_time": F.when(updated, _stamp(later)),
        "expire_time": _stamp(F.timestamp_seconds(F.unix_timestamp(made) + 900)),
        "process_status": F.lit(None).cast("string"),
        "tracking_no": F.lit(None).cast("string"),
        "parent_order_id": F.lit(None).cast("string"),
        "province_id": F.col("_place"),
        "activity_reduce_amount": F.when(key % 4 != 0, _amount(key % 50 * 100 + 25)),
        "coupon_reduce_amount": F.when(key % 3 != 0, _amount(key % 30 * 100 + 50)),
        "original_total_amount": _amount(_cents("o_totalprice") + 1000),
        "feight_fee": _amount(key % 10 * 100),
        "feight_fee_reduce": F.lit("0.00"),
    }
    old = F.when(updated, F.create_map(F.lit("order_status"), F.lit("1001")))
    return [Change(orders, "order_info", F.col("_kind"), data, F.when(updated, later).otherwise(made), old)]


def order_detail_log(t: Tables) -> list[Change]:
    data = {
        "id": F.col("_detail_id"),
        "order_id": F.col("_order"),
        "sku_id": F.col("_part"),
        "sku_name": F.concat(F.lit("sku "), F.col("_part")),
        "order_price": _amount(_unit_price()),
        "sku_num": F.col("l_quantity").cast("long"),
        "create_time": F.col("_stamp"),
        "source_type": F.col("l_returnflag"),
        "source_id": F.col("_supp"),
        "split_total_amount": F.col("_net"),
        "split_activity_amount": _amount(_cents("l_discount")),
        "split_coupon_amount": _amount(_cents("l_tax")),
    }
    return [Change(t.lines, "order_detail", "insert", data, F.col("_time"))]


def order_activity_log(t: Tables) -> list[Change]:
    data = {
        "id": F.col("_line_id"), "order_id": F.col("_order"), "order_detail_id": F.col("_detail_id"),
        "activity_id": F.col("l_partkey") % 7, "activity_rule_id": F.col("l_suppkey") % 5,
        "sku_id": F.col("_part"), "create_time": F.col("_stamp"),
    }
    return [Change(t.lines, "order_detail_activity", "insert", data, F.col("_time"), where="l_discount > 0.05")]


def order_coupon_log(t: Tables) -> list[Change]:
    data = {
        "id": F.col("_line_id"), "order_id": F.col("_order"), "order_detail_id": F.col("_detail_id"),
        "coupon_id": F.col("l_partkey") % 11, "coupon_use_id": F.col("_line_id"),
        "sku_id": F.col("_part"), "create_time": F.col("_stamp"),
    }
    return [Change(t.lines, "order_detail_coupon", "insert", data, F.col("_time"), where="l_tax > 0.04")]


def payment_log(t: Tables) -> list[Change]:
    """Payment updates of finished orders, some failed, some without a status change."""
    key = F.col("o_orderkey")
    called = F.timestamp_seconds(F.unix_timestamp(_order_time()) + 60)
    data = {
        "id": key, "user_id": F.col("o_custkey"), "order_id": key,
        "payment_type": F.when(key % 3 == 0, "F").when(key % 3 == 1, "O").otherwise("P"),
        "callback_time": _stamp(called),
        "payment_status": F.when(F.col("o_orderstatus") == "F", "1602").otherwise("1603"),
    }
    old = F.when(key % 10 == 0, F.create_map(F.lit("callback_time"), F.lit(None).cast("string"))).otherwise(
        F.create_map(F.lit("payment_status"), F.lit("1601"))
    )
    return [Change(t.orders, "payment_info", "update", data, called, old, "o_orderstatus <> 'P'")]


def refund_log(t: Tables) -> list[Change]:
    data = {
        "id": F.col("_line_id"), "user_id": F.col("_supp"), "order_id": F.col("_order"),
        "sku_id": F.col("_part"), "refund_type": F.col("l_returnflag"),
        "refund_num": F.col("l_quantity").cast("long"), "refund_amount": F.col("_net"),
        "refund_reason_type": F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linestatus")).otherwise("Z"),
        "refund_reason_txt": F.concat(F.lit("line "), F.col("l_linenumber")),
        "create_time": F.col("_stamp"),
    }
    return [Change(t.lines, "order_refund_info", "insert", data, F.col("_time"), where="l_returnflag = 'R'")]


def cart_log(t: Tables) -> list[Change]:
    """First lines are cart inserts, the others updates raising the amount by line number - 3."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    rows = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumns(line_columns())
    line, qty = F.col("l_linenumber"), F.col("l_quantity").cast("long")
    made = _order_time()
    first = line == 1
    data = {
        "id": F.col("_line_id"), "user_id": F.col("o_custkey"), "sku_id": F.col("_part"),
        "cart_price": _amount(_unit_price()), "sku_num": qty,
        "sku_name": F.concat(F.lit("sku "), F.col("_part")), "is_checked": F.lit(None).cast("string"),
        "create_time": _stamp(made),
        "operate_time": F.when(~first, _stamp(F.timestamp_seconds(F.unix_timestamp(made) + line * 86400))),
        "is_ordered": F.lit("0"), "order_time": F.lit(None).cast("string"),
        "source_type": F.col("l_returnflag"), "source_id": F.col("_supp"),
    }
    old = F.when(~first, F.create_map(F.lit("sku_num"), (qty + 3 - line).cast("string")))
    kind = F.when(first, "insert").otherwise("update")
    return [Change(rows, "cart_info", kind, data, made, old)]


def coupon_log(t: Tables) -> list[Change]:
    """Coupons taken (first lines), used for an order (previous value null) and used for a payment."""
    data = {
        "id": F.col("_line_id"), "coupon_id": F.col("l_partkey") % 11, "user_id": F.col("_supp"),
        "order_id": F.col("_order"), "get_time": F.col("_stamp"),
        "using_time": F.when(F.col("l_discount") > 0.05, _stamp(F.timestamp_seconds(F.unix_timestamp(F.col("_time")) + 86400))),
        "used_time": F.when(F.col("l_tax") > 0.04, _stamp(F.timestamp_seconds(F.unix_timestamp(F.col("_time")) + 172800))),
    }
    blank = lambda key: F.create_map(F.lit(key), F.lit(None).cast("string"))
    made = lambda kind, where, old=None: Change(t.lines, "coupon_use", kind, data, F.col("_time"), old, where)
    return [
        made("insert", "l_linenumber = 1"), made("update", "l_discount > 0.05", blank("using_time")),
        made("update", "l_tax > 0.04", blank("used_time")),
    ]


def favor_log(t: Tables) -> list[Change]:
    """Lines 1, 4, 7: inserts; 2, 5: taken up again; 3, 6: the same flag change in another table."""
    line = F.col("l_linenumber") % 3
    data = {
        "id": F.col("_line_id"), "user_id": F.col("_supp"), "sku_id": F.col("_part"),
        "create_time": F.col("_stamp"), "is_cancel": F.lit("0"),
    }
    old = F.create_map(F.lit("is_cancel"), F.lit("1"))
    kind = F.when(line == 1, "insert").otherwise("update")
    return [
        Change(t.lines, "favor_info", kind, data, F.col("_time"), F.when(line == 2, old), line != 0),
        Change(t.lines, "cart_info_mark", "update", data, F.col("_time"), old, line == 0),
    ]


def comment_log(t: Tables) -> list[Change]:
    data = {
        "id": F.col("_line_id"), "user_id": F.col("_supp"), "sku_id": F.col("_part"),
        "order_id": F.col("_order"), "create_time": F.col("_stamp"), "appraise": F.col("l_returnflag"),
    }
    return [Change(t.lines, "comment_info", "insert", data, F.col("_time"))]


def _customer_time() -> Column:
    start = F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return F.timestamp_seconds(start + F.col("c_custkey") * 7)


def user_log(t: Tables) -> list[Change]:
    data = {"id": F.col("c_custkey"), "login_name": F.col("c_name"), "create_time": _stamp(_customer_time())}
    return [Change(t.customer, "user_info", "insert", data, _customer_time())]


def _part_time(plus: int = 0) -> Column:
    start = F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return F.timestamp_seconds(start + F.col("p_partkey") + plus)


def part_log(t: Tables) -> list[Change]:
    """Parts as a loaded snapshot, later price changes, deletes, and the snapshot's control rows."""
    key = F.col("p_partkey")
    data = lambda price: {
        "id": key, "p_name": F.col("p_name"), "p_brand": F.col("p_brand"), "p_size": F.col("p_size"),
        "p_retailprice": price,
    }
    price = _amount(_cents("p_retailprice"))
    raised = _amount(_cents("p_retailprice") + 100)
    control = F.when(key % 200 == 0, CONTROL_TYPES[0]).otherwise(CONTROL_TYPES[1])
    old = F.create_map(F.lit("p_retailprice"), price)
    return [
        Change(t.part, "part", "bootstrap-insert", data(price), _part_time()),
        Change(t.part, "part", "update", data(raised), _part_time(3600), old, key % 2 == 0),
        Change(t.part, "part", "delete", data(price), _part_time(7200), where=key % 5 == 0),
        Change(t.part, "part", control, {"id": F.lit(None).cast("string")}, _part_time(), where=key % 100 == 0),
    ]


def nation_log(t: Tables) -> list[Change]:
    data = {"id": F.col("n_nationkey"), "name": F.col("n_name"), "region_id": F.col("n_regionkey")}
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return [Change(t.nation, "nation", "insert", data, start)]


LOGS: dict[str, Callable[[Tables], list[Change]]] = {
    "order_info": order_info_log,
    "order_detail": order_detail_log,
    "order_detail_activity": order_activity_log,
    "order_detail_coupon": order_coupon_log,
    "payment_info": payment_log,
    "order_refund_info": refund_log,
    "cart_info": cart_log,
    "coupon_use": coupon_log,
    "favor_info": favor_log,
    "comment_info": comment_log,
    "user_info": user_log,
    "part": part_log,
    "nation": nation_log,
}


def _changes(t: Tables, *tables: str) -> list[Change]:
    return [change for name in (tables or LOGS) for change in LOGS[name](t)]


def change_log(t: Tables, *tables: str) -> DataFrame:
    """The change-log topic as envelope columns: all source tables, or the named ones."""
    return reduce(DataFrame.unionByName, [change.envelope() for change in _changes(t, *tables)])


def change_records(t: Tables, *tables: str) -> DataFrame:
    """The same as topic text, written from the columns: no map is made of a row only to be written out.

    Every frame is read once for all records that its rows make, and the records of a row lie together, as those of a
    transaction do in a change log: files of them take much less room than files of one source table each.
    """
    by_rows: dict[int, list[Change]] = {}
    for change in _changes(t, *tables):
        by_rows.setdefault(id(change.rows), []).append(change)
    texts = lambda made: F.explode(F.array(*[change.text() for change in made])).alias("value")
    parts = [made[0].rows.select(texts(made)) for made in by_rows.values()]
    return reduce(DataFrame.unionByName, parts).where("value is not null")


# ---- lookups and dimensions --------------------------------------------------------

def dictionary(spark: SparkSession) -> DataFrame:
    """Codes A, R, F and O; N, P and Z are unknown on purpose."""
    rows = ", ".join(f"('{c}', 'name {c}', null, null, null)" for c in "ARFO")
    return spark.sql(
        f"select * from values {rows} as d(dic_code, dic_name, parent_code, create_time, operate_time)"
    )


def dim_config(spark: SparkSession) -> DataFrame:
    return spark.sql(
        """select * from values
             ('part', 'dim_part', 'id,p_name,p_retailprice', null, null),
             ('nation', 'dim_nation', 'id,name', 'id', '')
           as c(source_table, sink_table, sink_columns, sink_pk, sink_extend)"""
    )


def dimensions(t: Tables) -> dict[str, DataFrame]:
    """Sku, spu, trademark, category and province tables, all text with one key.

    Trademark `Brand#9` and spu names starting with `red` have no dimension row.
    """
    part = t.part
    sized = part.select(F.col("p_size").alias("c3")).distinct()
    second = sized.select((F.col("c3") % 10).alias("c2")).distinct()
    first = second.select((F.col("c2") % 3).alias("c1")).distinct()
    named = lambda kind, c: F.concat(F.lit(kind), F.col(c))
    return {
        "sku": part.select(
            _text("p_partkey").alias("id"), F.col("p_name").alias("spu_id"), F.col("p_brand").alias("tm_id"),
            _text("p_size").alias("category3_id"),
        ),
        "spu": part.where(~F.col("p_name").startswith("red")).select(F.col("p_name").alias("id")).distinct()
        .select("id", named("spu ", "id").alias("spu_name")),
        "trademark": part.where("p_brand <> 'Brand#9'").select(F.col("p_brand").alias("id")).distinct()
        .select("id", named("tm ", "id").alias("tm_name")),
        "category3": sized.select(
            _text("c3").alias("id"), named("third ", "c3").alias("name"), _text(F.col("c3") % 10).alias("category2_id")
        ),
        "category2": second.select(
            _text("c2").alias("id"), named("second ", "c2").alias("name"), _text(F.col("c2") % 3).alias("category1_id")
        ),
        "category1": first.select(_text("c1").alias("id"), named("first ", "c1").alias("name")),
        "province": t.nation.select(_text("n_nationkey").alias("id"), F.col("n_name").alias("name")),
    }
