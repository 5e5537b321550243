"""Every job and operator as a query over a folder of tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemill.functions import changes as ch, times as tm
from tidemill.functions.keywords import create_split_function, explode_words, listed_words
from tidemill.operators import clean, dedup, firsts, lookups, split, visits
from tidemill.plans import dim, facts, metrics, traffic
from tidemill.schemas import BASE_DIC, ORDER_WIDE_TS, RAW_LOG, TABLE_PROCESS, TOPICS
from tidemill.session import shared_dir, tune
from tidemill.sinks import tables as sinks
from tidemill.sources import tables as src, topics
from tidemill.streaming import jobs, late

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[src.Tables], DataFrame]) -> Callable[[src.Tables], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(src.Tables(tune(spark, "UTC"), folder))
    QUERIES[fn.__name__] = run
    return fn


def flag(c: Column, name: str) -> Column:
    return F.coalesce(c, F.lit(False)).cast("long").alias(name)


def page_cols(*extra: str) -> list[Column]:
    return [F.col("offset").alias("event_id"), F.col("common.mid").alias("mid"),
            F.col("page.page_id").alias("page_id"), F.col("page.last_page_id").alias("last_page_id"), "ts", *extra]


def wide(t: src.Tables, extras: bool = True, whole: bool = False) -> DataFrame:
    more = ["order_detail_activity", "order_detail_coupon"] if extras else []
    log = src.change_log(t, "order_detail", "order_info", *more)
    return facts.order_detail_wide(log, src.dictionary(t.spark), extras=extras, whole=whole)


def as_ordered(t: src.Tables) -> DataFrame:
    return facts.details_as_ordered(src.change_log(t, "order_detail", "order_info"), src.dictionary(t.spark))


def paid_details(t: src.Tables, extras: bool = True) -> DataFrame:
    return facts.pay_success(src.change_log(t, "payment_info"), wide(t, extras), src.dictionary(t.spark))


# ---- sources and sinks -------------------------------------------------------------

def scratch(t: src.Tables, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(t.spark)}/tidemill-{name}-{uuid.uuid4().hex}"


def stored(t: src.Tables, rows: DataFrame, schema: T.StructType, name: str) -> str:
    """A lookup table written with its row type; returns its folder."""
    path = scratch(t, name)
    rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]).write.parquet(path)
    return path


def part_routing(t: src.Tables) -> tuple[DataFrame, dict[str, str]]:
    """Routed changes of the parts, and their routing row."""
    config = src.dim_config(t.spark).where("source_table = 'part'")
    return dim.dim_route(src.change_log(t, "part"), config), config.first().asDict()


@query
def read_topic(t):
    """Raw records by way of a topic folder: empty ones kept as empty text."""
    root = scratch(t, "topics")
    sinks.topic_files(src.raw_log(t, damaged=True)).parquet(f"{root}/{TOPICS['log']}")
    return topics.read_topic(t.spark, TOPICS["log"], path=root, stream=False).select(
        F.col("offset").alias("event_id"), flag(F.col("value") == "", "is_empty"),
        flag(F.substring("value", -1, 1) == "}", "is_whole"),
    )


@query
def read_change_log(t):
    """The whole change log written to its topic, read back and counted per table and type."""
    root = scratch(t, "topics")
    sinks.topic_files(src.change_records(t)).parquet(f"{root}/{TOPICS['db']}")
    log = topics.read_change_log(t.spark, TOPICS["db"], keys=["id"], path=root, stream=False)
    return log.groupBy("table", "type").agg(
        F.count("*").alias("n"), F.sum("ts").alias("ts_sum"), F.count(ch.field("id")).alias("with_id")
    )


@query
def read_detail_topic(t):
    """The wide order details written to their topic and read back."""
    root = scratch(t, "topics")
    sinks.topic_files(sinks.as_topic_rows(wide(t, whole=True).drop("pt"), "order_detail").select("value")).parquet(f"{root}/order_detail")
    columns = ["order_detail_id", "order_id", "sku_id", "split_original_amount", "type", "order_status", "user_id",
               "activity_id", "coupon_id", "dic_name", "ts"]
    rows = topics.read_detail_topic(t.spark, "order_detail", columns, path=root, stream=False)
    return rows.withColumn("ts", F.unix_timestamp("ts"))


@query
def read_dictionary(t):
    """Order details with the names of the dictionary, read from its table."""
    path = stored(t, src.dictionary(t.spark), BASE_DIC, "dictionary")
    rows = facts.order_details(src.change_log(t, "order_detail"))
    return lookups.lookup_join(rows, topics.read_dictionary(t.spark, path), "source_type", "dic_name").select(
        "order_detail_id", "sku_id", "source_type", "dic_name"
    )


@query
def read_dim_config(t):
    """Changes per dimension table, routed by the routing table as it is stored."""
    path = stored(t, src.dim_config(t.spark), TABLE_PROCESS, "routing")
    routed = dim.dim_route(src.change_log(t, "part", "nation", "user_info"), topics.read_dim_config(t.spark, path))
    return routed.groupBy("sink_table", "type").agg(F.count("*").alias("n"))


@query
def read_dim(t):
    """The sku dimension, written to its table and read back."""
    sku = src.dimensions(t)["sku"]
    config = {"sink_table": "dim_sku", "sink_columns": ",".join(sku.columns)}
    data = F.create_map(*[x for c in sku.columns for x in (F.lit(c), F.col(c))])
    routed = sku.select(
        F.lit("dim_sku").alias("sink_table"), data.alias("data"), F.lit(0).cast("long").alias("ts"), F.col("id").alias("pk"))
    root = scratch(t, "dims")
    sinks.upsert_dim(routed, [config], root, 0)
    return sinks.read_dim(t.spark, root, config)


@query
def write_topic(t):
    """Order details written to their topic and read back."""
    path = scratch(t, "topics")
    sinks.write_topic(wide(t, extras=False).drop("pt"), "order_detail", path=path, batch_id=0)
    columns = ["order_detail_id", "order_id", "sku_id", "type"]
    rows, _ = clean.parse_json_or_dirty(sinks.read_routed(t.spark, path, "order_detail"), ORDER_WIDE_TS, columns=columns)
    return rows


@query
def write_append_table(t):
    """Registrations in two batches, the second repeated."""
    path, rows = scratch(t, "registrations"), facts.user_register(src.change_log(t, "user_info"))
    for batch in (0, 1, 1):
        sinks.write_append_table(rows.where(F.col("ts") % 2 == batch), path, batch)
    return t.spark.read.parquet(path).drop(sinks.BATCH)


@query
def write_upsert(t):
    """The keyed order-detail table, written and read back: last version per detail id."""
    order = ("ts", "type", *metrics.DETAIL_TIES)
    kept = ["order_detail_id", "order_id", "sku_id", "type", "order_status", "split_total_amount"]
    path = scratch(t, "details")
    sinks.write_upsert(wide(t, extras=False).select(*dict.fromkeys((*kept, *order))), path, 0)
    return sinks.read_upsert(t.spark, path, ["order_detail_id"], order).select(*kept)


@query
def upsert_dim(t):
    """The part dimension after two batches: the loaded rows, then their updates."""
    routed, config = part_routing(t)
    root = scratch(t, "dims")
    for batch, kind in enumerate(("bootstrap-insert", "update")):
        sinks.upsert_dim(routed.where(F.col("type") == kind), [config], root, batch)
    return sinks.read_dim(t.spark, root, config)


@query
def ensure_dim_table(t):
    """The part dimension made before its first batch and asked for again after it."""
    routed, config = part_routing(t)
    root = scratch(t, "dims")
    sinks.ensure_dim_table(t.spark, root, config)
    sinks.upsert_dim(routed, [config], root, 0)
    sinks.ensure_dim_table(t.spark, root, config)
    return sinks.read_dim(t.spark, root, config).select("id", "p_name")


# ---- parsing, filters, projections ---------------------------------------------------

@query
def parse_json_or_dirty(t):
    parsed = clean.parse_json(clean.drop_blank(src.raw_log(t, damaged=True)), RAW_LOG, carry=("offset",))
    return parsed.select(
        F.col("offset").alias("event_id"), F.col("dirty").cast("long").alias("dirty"),
        F.when(~F.col("dirty"), F.col("row.common.mid")).alias("mid"),
        F.when(~F.col("dirty"), F.col("row.ts")).alias("ts"),
    )


@query
def drop_control_rows(t):
    return clean.drop_control_rows(src.change_log(t, "part")).select("type", ch.field("id").alias("id"), "ts")


@query
def drop_empty_and_keep_insert(t):
    rows = sinks.as_topic_rows(wide(t, extras=False).drop("pt"), "order_detail")
    tombstones = rows.select("topic", F.lit("").alias("value"))
    columns = ["order_detail_id", "order_id", "type", "split_original_amount"]
    return clean.drop_empty_and_keep_insert(clean.made_once(rows).unionAll(tombstones), ORDER_WIDE_TS, columns=columns)


@query
def explode_displays(t):
    rows = split.explode_displays(clean.parse_page_log(src.raw_log(t), carry=("offset",)))
    return rows.select(*page_cols(), F.col("display")["item"].alias("item"), F.col("display")["order"].alias("pos"))


@query
def explode_actions(t):
    rows = split.explode_actions(clean.parse_page_log(src.raw_log(t), carry=("offset",)))
    return rows.select(*page_cols(), F.col("action")["action_id"].alias("action_id"), F.col("action")["order"].alias("pos"))


def _routed_text(rows: DataFrame) -> DataFrame:
    at = lambda path, name: F.get_json_object("value", path).alias(name)
    return rows.select(
        "topic", at("$.common.mid", "mid"), at("$.common.is_new", "is_new"), at("$.ts", "ts"),
        at("$.page.page_id", "page_id"), at("$.err.error_code", "error_code"), at("$.start.entry", "entry"),
        F.coalesce(at("$.display.order", "d"), at("$.action.order", "a")).alias("pos"),
    )


@query
def split_log(t):
    return _routed_text(split.split_log(clean.parse_page_log(src.raw_log(t), carry=("offset",))))


@query
def base_log_split(t):
    """The cleaning job: dirty records, corrected new-visitor flag, five detail topics."""
    return _routed_text(traffic.base_log(src.raw_log(t, damaged=True)))


@query
def route_side_output(t):
    """Rows per topic folder after the cleaning job wrote them in one go."""
    path = scratch(t, "routed")
    sinks.route_side_output(traffic.base_log(src.raw_log(t, damaged=True)), path, batch_id=0)
    return t.spark.read.parquet(path).groupBy("topic").agg(F.count("*").alias("n"))


@query
def pick_change(t):
    return ch.pick_change(
        src.change_log(t, "order_info", "order_detail"), "order_info", ["update"], ["id", "order_status", "user_id", "operate_time"], "ts"
    )


@query
def changed_key_not_null(t):
    log = src.change_log(t, "coupon_use", "cart_info").where("type = 'update'")
    return log.select(
        "table", ch.field("id").alias("id"), flag(ch.changed_key_not_null("using_time"), "using_time"),
        flag(ch.changed_key_not_null("sku_num"), "sku_num"),
    )


@query
def changed_key_exists(t):
    log = src.change_log(t, "coupon_use", "cart_info").where("type = 'update'")
    return log.select(
        "table", ch.field("id").alias("id"), flag(ch.changed_key_exists("using_time"), "using_time"),
        flag(ch.changed_key_exists("sku_num"), "sku_num"),
    )


@query
def prune_map_columns(t):
    log = src.change_log(t, "part").where("type = 'update'")
    return log.select(F.to_json(ch.prune_map("data", F.lit("id,p_name"))).alias("data"), "ts")


@query
def filter_home_detail(t):
    return clean.filter_home_detail(src.page_log(t, items=False)).select(*page_cols())


@query
def filter_session_start(t):
    return clean.filter_session_start(src.page_log(t, items=False)).select(*page_cols())


@query
def filter_login(t):
    return clean.filter_login(src.page_log(t, items=False)).select(*page_cols(), F.col("common.uid").alias("uid"))


@query
def filter_search_keyword(t):
    return clean.filter_search_keyword(src.page_log(t)).select(*page_cols(), F.col("page.item").alias("item"))


# ---- joins -----------------------------------------------------------------------

@query
def join_order_wide(t):
    return wide(t).select(
        "order_detail_id", "sku_id", "order_id", "type", "activity_id", "coupon_id", "dic_name",
        F.unix_timestamp("ts").alias("ts"),
    )


@query
def join_payment_detail(t):
    return paid_details(t, extras=False).select("order_detail_id", "order_id", "payment_type_name", "split_payment_amount")


@query
def join_refund(t):
    return order_refund(t).select("id", "province_id", "refund_type_name", "refund_reason_type_name")


@query
def lookup_join_inner(t):
    rows = facts.order_details(src.change_log(t, "order_detail"))
    return lookups.lookup_join(rows, src.dictionary(t.spark), "source_type", "dic_name").select(
        "order_detail_id", "sku_id", "source_type", "dic_name"
    )


@query
def lookup_join_left(t):
    rows = facts.order_details(src.change_log(t, "order_detail"))
    return lookups.lookup_join(rows, src.dictionary(t.spark), "source_type", "dic_name", "left").select(
        "order_detail_id", "sku_id", "source_type", "dic_name"
    )


@query
def dim_join(t):
    rows = facts.order_details(src.change_log(t, "order_detail")).select("order_detail_id", "sku_id", "ts")
    return lookups.dim_join(rows, src.dimensions(t)["sku"], "sku_id", {"spu_id": "spu_id", "tm_id": "tm_id"})


def _chain(t: src.Tables, rows: DataFrame, with_spu: bool, cols: list[str]) -> DataFrame:
    return lookups.with_sku(rows, lookups.sku_dimension(src.dimensions(t), with_spu), cols)


@query
def dim_chain_order(t):
    rows = facts.order_details(src.change_log(t, "order_detail")).select("order_detail_id", "sku_id", "ts")
    return _chain(t, rows, True, [k for k in metrics.SPU_KEYS if k != "user_id"])


@query
def dim_chain_refund(t):
    rows = facts.refunds(src.change_log(t, "order_refund_info")).select("id", "sku_id")
    return _chain(t, rows, False, metrics.REFUND_DIMS)


@query
def dim_province(t):
    orders = facts.order_infos(src.change_log(t, "order_info")).where("type = 'insert'")
    counted = orders.groupBy("province_id").agg(F.count("*").alias("n"))
    return lookups.dim_join(counted, src.dimensions(t)["province"], "province_id", {"name": "province_name"})


@query
def broadcast_config_join(t):
    joined = lookups.config_join(src.change_log(t, "part", "nation", "user_info"), src.dim_config(t.spark))
    return joined.select("table", "type", "sink_table", ch.field("id").alias("id"), "ts")


# ---- detail facts ------------------------------------------------------------------

@query
def dim_route(t):
    """From change-log text to routed rows: control and other rows dropped, columns pruned."""
    log = clean.parse_change_log(topics.envelope_records(src.change_log(t, "part", "nation", "user_info")))
    return dim.dim_route(log, src.dim_config(t.spark)).withColumn("data", F.to_json("data"))


@query
def fix_is_new(t):
    return visits.fix_is_new(src.page_log(t, items=False)).select(*page_cols(), F.col("common.is_new").alias("is_new"))


@query
def unique_visitor(t):
    return visits.unique_visitor(src.page_log(t, items=False)).select(*page_cols())


@query
def user_jump(t):
    return visits.user_jump(src.page_log(t, fast=True, items=False)).select(*page_cols())


@query
def order_detail_wide(t):
    return wide(t, whole=True).drop("pt").withColumn("old", F.to_json("old")).withColumn("ts", F.unix_timestamp("ts"))


@query
def order_add(t):
    return facts.order_add(wide(t, extras=False)).select("order_detail_id", "order_id", "sku_id", "sku_num", "user_id", "type")


@query
def order_cancel(t):
    return facts.order_cancel(wide(t, extras=False)).select("order_detail_id", "order_id", "sku_id", "user_id", "order_status", "operate_time")


@query
def pay_success(t):
    return paid_details(t)


@query
def order_refund(t):
    return facts.order_refund(src.change_log(t, "order_refund_info", "order_info"), src.dictionary(t.spark))


@query
def cart_add(t):
    return facts.cart_add(src.change_log(t, "cart_info"), src.dictionary(t.spark))


@query
def coupon_get(t):
    return facts.coupon_get(src.change_log(t, "coupon_use"))


@query
def coupon_order(t):
    return facts.coupon_order(src.change_log(t, "coupon_use"))


@query
def coupon_pay(t):
    return facts.coupon_pay(src.change_log(t, "coupon_use"))


@query
def favor_add(t):
    return facts.favor_add(src.change_log(t, "favor_info"))


@query
def comment_add(t):
    return facts.comment_add(src.change_log(t, "comment_info"), src.dictionary(t.spark))


@query
def user_register(t):
    return facts.user_register(src.change_log(t, "user_info"))


# ---- window metrics ------------------------------------------------------------------

@query
def kw_window(t):
    return metrics.kw_window(src.page_log(t, fast=True))


@query
def traffic_window(t):
    """From raw log text to traffic metrics in one pass over the log."""
    return metrics.traffic_window_of_log(clean.parse_page_log(src.raw_log(t, fast=True), carry=("offset",)))


@query
def traffic_window_from_streams(t):
    """The same by way of the page, unique-visitor and jump details."""
    page = traffic.page_rows(src.raw_log(t, fast=True))
    return metrics.traffic_window(page, visits.unique_visitor(page), visits.user_jump(page))


@query
def home_detail_uv_window(t):
    return metrics.home_detail_uv_window(src.page_log(t, items=False))


@query
def login_window(t):
    return metrics.login_window(src.page_log(t, items=False))


@query
def register_window(t):
    return metrics.register_window(facts.user_register(src.change_log(t, "user_info")))


@query
def cart_uu_window(t):
    return metrics.cart_uu_window(facts.cart_add(src.change_log(t, "cart_info"), src.dictionary(t.spark)))


@query
def order_window(t):
    return metrics.ordered_counts(as_ordered(t))


@query
def order_window_per_order(t):
    return metrics.ordered_counts(as_ordered(t), per_order=True)


@query
def payment_window(t):
    log = src.change_log(t, "order_detail", "order_info", "payment_info")
    return metrics.payment_window(facts.paid_users(log, src.dictionary(t.spark)))


@query
def province_window(t):
    return metrics.province_counts(as_ordered(t), src.dimensions(t)["province"])


@query
def spu_order_window(t):
    return metrics.spu_totals(as_ordered(t), src.dimensions(t))


@query
def refund_window(t):
    return metrics.refund_window(order_refund(t), lookups.sku_dimension(src.dimensions(t), with_spu=False))


@query
def refund_window_by_user(t):
    return metrics.refund_window(order_refund(t), lookups.sku_dimension(src.dimensions(t), with_spu=False), "user")


# ---- late rows -------------------------------------------------------------------------

LOTS = 4


def _late_words(t: src.Tables) -> tuple[DataFrame, str | None, str]:
    """Word windows of a stream that gets the page log in four lots, its last watermark, and the folder of its records.

    Every seventh record comes one lot after its neighbours: late where its window is closed by then.
    """
    root, topic = scratch(t, "late"), TOPICS["page"]
    records = src.page_log(t, fast=True).select(F.to_json(F.struct("common", "page", "ts")).alias("value"), "offset")
    last = t.events.agg(F.max("event_id")).first()[0] or 0
    lot = F.floor(F.col("offset") * (LOTS - 1) / F.lit(last + 1)) + (F.col("offset") % 7 == 3).cast("long")
    job = lambda: jobs.kw_window(topics.read_topic(t.spark, topic, path=root))
    closed, mark = late.replay(
        t.spark, [records.where(lot == k) for k in range(LOTS)], f"{root}/{topic}", job, f"{root}/windows", f"{root}/checkpoint")
    return closed, mark, root


@query
def watermark(t):
    """Word windows that a stream closed, rows behind the watermark left out."""
    return _late_words(t)[0]


@query
def late_data(t):
    """Words per closed window: all, counted in time, and late."""
    counted, mark, root = _late_words(t)
    arrived = jobs.kw_window(topics.read_topic(t.spark, TOPICS["page"], path=root, stream=False))
    return late.late_counts(arrived, counted, ["keyword"], "keyword_count", mark)


# ---- firsts, duplicates, unions --------------------------------------------------------

def _day_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", F.date_format("day", tm.DAY)).withColumn(
        "first_time", F.unix_millis("first_time")
    )


@query
def first_of_day(t):
    rows = clean.filter_home_detail(src.page_log(t, items=False))
    return _day_text(firsts.day_firsts(rows, F.col("common.mid"), tm.millis_to_time("ts")))


@query
def first_of_day_and_ever(t):
    return _day_text(firsts.first_of_day_and_ever(src.page_log(t, items=False), F.col("common.uid"), tm.millis_to_time("ts")))


@query
def returning_user(t):
    logins = clean.filter_login(src.page_log(t, items=False))
    return _day_text(firsts.returning(logins, F.col("common.uid"), tm.millis_to_time("ts")))


@query
def dedup_keep_last(t):
    rows = facts.order_details(src.change_log(t, "order_detail"))
    return dedup.keep_last(rows, ["order_detail_id"], "ts", metrics.DETAIL_TIES).select(
        "order_detail_id", "sku_id", "order_price", "split_total_amount", "ts"
    )


@query
def dedup_keep_first(t):
    rows = facts.refunds(src.change_log(t, "order_refund_info"))
    return dedup.keep_first(rows, ["order_id"], "create_time", ("id",)).select("order_id", "id", "create_time")


@query
def dedup_keep_first_sliding(t):
    """One payment row per order detail and burst of copies; every order version joined it."""
    paid = paid_details(t, extras=False).select("order_detail_id", "user_id", "callback_time")
    return dedup.keep_first_sliding(paid, ["order_detail_id"], tm.text_time("callback_time"), ("user_id",))


@query
def union_streams(t):
    page = src.page_log(t, fast=True, items=False)
    return metrics.traffic_union(page, visits.unique_visitor(page), visits.user_jump(page))


# ---- scalar functions and words --------------------------------------------------------

LETTERS = r"\p{L}"  # what the word list of part names cuts

@query
def time_functions(t):
    page = src.page_log(t, items=False).select(F.col("offset").alias("event_id"), "ts")
    text = page.withColumn("full", tm.millis_to_text("ts")).withColumn("day", tm.millis_to_day("ts"))
    return text.select(
        "event_id", "full", "day", tm.to_millis("full").alias("full_ms"), tm.to_millis("day", False).alias("day_ms"),
        tm.day_of_text("full").alias("day_part"),
        tm.window_text(tm.tumble(tm.millis_to_second_time("ts"), "10 seconds"))[0],
    )


@query
def compare_zulu(t):
    """Time texts with one to three fraction digits, compared with their three-digit neighbours."""
    page = src.page_log(t, items=False).select(F.col("offset").alias("event_id"), "ts")
    full = F.concat(tm.millis_to_text("ts"), F.lit("."), F.lpad((F.col("ts") % 1000).cast("string"), 3, "0"))
    cut = F.expr("substring(t, 1, 21 + cast(event_id % 3 as int))")
    return page.withColumn("t", full).select(
        "event_id", F.concat(cut, F.lit("Z")).alias("a"), F.concat("t", F.lit("Z")).alias("b")
    ).withColumn("cmp", tm.compare_zulu("a", "b").cast("long"))


@query
def keyword_split(t):
    asked = clean.filter_search_keyword(src.page_log(t)).select(
        F.col("offset").alias("event_id"), F.col("page.item").alias("item")
    )
    return explode_words(asked, "item")


def unspaced(t: src.Tables, **more) -> tuple[DataFrame, list[str]]:
    """The page log with search phrases written without blanks, and the word list of the shop: the words in its part names."""
    page = src.page_log(t, **more)
    phrase = F.replace(F.col("page.item"), F.lit(" "), F.lit(""))
    words = explode_words(t.part, "p_name", "word").select("word").distinct()
    return page.withColumn("page", F.col("page").withField("item", phrase)), [r.word for r in words.toLocalIterator()]


@query
def kw_window_word_list(t):
    """Search words per window, phrases without blanks cut by the word list."""
    page, words = unspaced(t, fast=True)
    return metrics.kw_window(page, listed_words(words, LETTERS))


@query
def keyword_split_function(t):
    """The same phrases cut by the table function of SQL."""
    page, words = unspaced(t)
    create_split_function(t.spark, "split_part_words", words, LETTERS)
    asked = clean.filter_search_keyword(page).select(F.col("offset").alias("event_id"), F.col("page.item").alias("item"))
    return t.spark.sql(
        "select asked.event_id, asked.item, words.word from {asked} asked, lateral split_part_words(asked.item) words", asked=asked)


@query
def keyword_count(t):
    """Words of all documents, whole texts."""
    return metrics.keyword_count(t.documents, by=["lang"])


