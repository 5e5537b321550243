"""The jobs by name: the topics each reads, what it makes, and the topic or table it writes.

Dictionary and dimensions are read anew for every micro-batch: a job with lookups leaves them to its ``finish``, which
runs on the rows of the batch. Where a lookup has to come before the sums (spu orders), it is a job of its own and a
topic lies between.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators.lookups import sku_dimension, with_sku
from tidemill.plans import facts, metrics
from tidemill.schemas import ORDER_WIDE_TS, TOPICS, strings
from tidemill.sinks import tables as sinks, topic_log
from tidemill.sources import topics
from tidemill.streaming import jobs, kept, runner

# Topics between jobs, beside those of ``schemas.TOPICS``.
SETTLED, WITH_SKU = "order_detail_settled", "order_detail_sku"
ROUTING = "table_process"  # the change feed of the routing table
SKU_DETAIL = T.StructType(strings(" ".join(["order_id", "order_create_time", "split_total_amount", *metrics.SPU_KEYS])))


@dataclass(frozen=True)
class Place:
    """Where topics (Kafka ``servers`` or a folder ``path``), tables and lookups lie.

    ``dictionary``, ``dims`` (name to dimension) and ``config`` are called again for every micro-batch.
    """

    tables: str
    dictionary: Callable[[SparkSession], DataFrame]
    dims: Callable[[SparkSession], dict[str, DataFrame]]
    config: Callable[[SparkSession], DataFrame] | None = None
    servers: str | None = None
    path: str | None = None
    max_per_batch: int | None = None

    def source(self, topic: str) -> tuple[str, dict]:
        """Topic name and options for the readers of ``sources.topics``."""
        where = {"max_per_batch": self.max_per_batch}
        return (topic, {"servers": self.servers, **where}) if self.servers else (f"topic={topic}", {"path": self.path, **where})

    def write(self, rows: DataFrame, writer: str, part: int) -> None:
        """Topic rows of a micro-batch, in one job for all topics; a folder takes a repeated batch once."""
        if self.servers:
            sinks.write_topic(rows, servers=self.servers)
        else:
            topic_log.append_once(rows, self.path, writer, part)


@dataclass(frozen=True)
class Job:
    """``inputs``: reader and topic of each stream; ``topic`` None: a table of the job's name.

    ``keep`` turns the rows of a micro-batch to those to write, with a folder for the tables it keeps and the batch's number.
    """

    inputs: tuple[tuple[Callable[..., DataFrame], str], ...]
    rows: Callable[..., DataFrame]
    topic: str | None = None
    keys: tuple[str, ...] = ()
    finish: Callable[[DataFrame, Place], DataFrame] | None = None
    is_text: bool = False  # the rows are topic text already
    keep: Callable[[DataFrame, Place, str, int], DataFrame] | None = None


def _typed(schema: T.StructType) -> Callable[..., DataFrame]:
    return lambda spark, topic, **where: topics.read_rows(spark, topic, schema, **where)


def _texts(names: str, *more: T.StructField) -> Callable[..., DataFrame]:
    return _typed(T.StructType(strings(names) + list(more)))


def _dictionary(batch: DataFrame, place: Place) -> DataFrame:
    return place.dictionary(batch.sparkSession)


def _skus(batch: DataFrame, place: Place, with_spu: bool) -> DataFrame:
    return sku_dimension(place.dims(batch.sparkSession), with_spu)


def _sku_details(batch: DataFrame, place: Place) -> DataFrame:
    named = with_sku(batch, _skus(batch, place, True), [k for k in metrics.SPU_KEYS if k != "user_id"])
    return named.select(*SKU_DETAIL.names)


_same = lambda stream: stream
_log, _page, _db = ((topics.read_topic, TOPICS["log"]),), (topics.read_topic, TOPICS["page"]), (topics.read_change_log, TOPICS["db"])
_detail = (topics.read_detail_topic, TOPICS["order_detail"])
_settled = (topics.read_detail_topic, SETTLED)

JOBS: dict[str, Job] = {
    "base_log": Job(_log, _same, is_text=True, keep=lambda batch, place, folder, part: kept.base_log(batch, folder, part)),
    "unique_visitor": Job(
        (_page,), _same, TOPICS["unique_visitor"], is_text=True,
        keep=lambda batch, place, folder, part: kept.unique_visitor(batch, folder, part)),
    "user_jump": Job((_page,), jobs.user_jump, TOPICS["user_jump"], is_text=True),
    "order_detail_wide": Job(
        (_db,), _same, TOPICS["order_detail"], is_text=True,
        keep=lambda batch, place, folder, part: kept.order_detail_wide(batch, _dictionary(batch, place), folder, part)),
    "order_add": Job((_detail,), lambda wide: facts.order_add(wide).drop("pt"), TOPICS["order_add"], ("order_detail_id",)),
    "order_cancel": Job((_detail,), lambda wide: facts.order_cancel(wide).drop("pt"), TOPICS["order_cancel"], ("order_detail_id",)),
    "pay_success": Job(
        (_db, _detail), lambda log, wide: jobs.pay_success(log, wide, None), TOPICS["pay_success"], ("order_detail_id",),
        lambda batch, place: jobs.named(batch, _dictionary(batch, place), "payment_type_code", "payment_type_name")),
    "order_refund": Job(
        (_db,), _same, TOPICS["order_refund"], is_text=True,
        keep=lambda batch, place, folder, part: kept.order_refund(batch, _dictionary(batch, place), folder, part)),
    "cart_add": Job((_db,), _same, TOPICS["cart_add"], ("id",), lambda batch, place: facts.cart_add(batch, _dictionary(batch, place))),
    "comment_add": Job((_db,), _same, TOPICS["comment"], ("id",), lambda batch, place: facts.comment_add(batch, _dictionary(batch, place))),
    "coupon_get": Job((_db,), facts.coupon_get, TOPICS["coupon_get"], ("id",)),
    "coupon_order": Job((_db,), facts.coupon_order, TOPICS["coupon_order"], ("id",)),
    "coupon_pay": Job((_db,), facts.coupon_pay, TOPICS["coupon_pay"], ("id",)),
    "favor_add": Job((_db,), facts.favor_add, TOPICS["favor_add"], ("id",)),
    "user_register": Job((_db,), facts.user_register, TOPICS["register"], ("user_id",)),
    "settled_details": Job(
        ((topics.read_topic, TOPICS["order_detail"]),), lambda records: jobs.latest_details(records).drop("pt"), SETTLED,
        ("order_detail_id",)),
    "sku_details": Job((_settled,), _same, WITH_SKU, finish=_sku_details),
    "traffic_window": Job(
        (_page, (topics.read_topic, TOPICS["unique_visitor"]), (topics.read_topic, TOPICS["user_jump"])), jobs.traffic_window),
    "home_detail_uv_window": Job((_page,), jobs.home_detail_uv_window),
    "kw_window": Job((_page,), jobs.kw_window),
    "login_window": Job((_page,), jobs.login_window),
    "register_window": Job(
        ((_texts("user_id create_time", T.StructField("ts", T.LongType())), TOPICS["register"]),), metrics.register_window),
    "cart_uu_window": Job(((_texts("user_id create_time operate_time"), TOPICS["cart_add"]),), jobs.cart_uu_window),
    "order_window": Job((_settled,), jobs.order_window),
    "payment_window": Job(((_texts("order_detail_id user_id callback_time"), TOPICS["pay_success"]),), jobs.payment_window),
    "province_window": Job(
        (_settled,), lambda details: metrics.order_totals(details, ["province_id"]),
        finish=lambda batch, place: metrics.name_provinces(batch, place.dims(batch.sparkSession)["province"])),
    "spu_order_window": Job(((_typed(SKU_DETAIL), WITH_SKU),), lambda details: metrics.order_totals(details, metrics.SPU_KEYS)),
    "refund_window": Job(
        ((_texts("id user_id sku_id create_time"), TOPICS["order_refund"]),), jobs.refund_counts,
        finish=lambda batch, place: metrics.name_refunds(batch, _skus(batch, place, False))),
    "refund_window_by_user": Job(
        ((_texts("id user_id sku_id create_time"), TOPICS["order_refund"]),),
        lambda refund: jobs.refund_counts(refund, ("user_id", "sku_id")),
        finish=lambda batch, place: metrics.name_user_refunds(batch, _skus(batch, place, False))),
}


def start_job(spark: SparkSession, name: str, place: Place, **options) -> StreamingQuery:
    """Start one job; ``options`` are those of ``runner.start``. The dimension job is ``dim``; ``dim_from_feed`` takes its
    routing from the topic ``ROUTING`` (and first from ``place.config``)."""
    if name == "dim_from_feed":
        streams = [topics.read_topic(spark, t, **w) for t, w in (place.source(TOPICS["db"]), place.source(ROUTING))]
        return runner.run_dim_from_feed(*streams, f"{place.tables}/dims", place.config, name, **options)
    if name == "dim":
        topic, where = place.source(TOPICS["db"])
        return runner.run_dim(topics.read_topic(spark, topic, **where), place.config, f"{place.tables}/dims", name, **options)
    job = JOBS[name]
    streams = []
    for read, topic in job.inputs:
        folder, where = place.source(topic)
        streams.append(read(spark, folder, **where))

    def write(batch: DataFrame, part: int) -> None:
        done = job.keep(batch, place, f"{place.tables}/_kept/{name}", part) if job.keep else batch
        done = job.finish(done, place) if job.finish else done
        if job.is_text and job.topic:
            place.write(done.select(F.lit(job.topic).alias("topic"), *done.columns), name, part)
        elif job.is_text or job.topic:
            place.write(sinks.as_topic_rows(done, job.topic, job.keys), name, part)
        else:
            sinks.write_append_table(done, f"{place.tables}/{name}", part)

    return runner.start(job.rows(*streams), name, write, **options)
