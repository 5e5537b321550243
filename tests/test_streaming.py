"""Each streaming job gives what its table form gives, over several micro-batches."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from streams import rows, run, write_chunks, write_topic
from tidemill.functions.times import millis_to_day
from tidemill.operators import clean, lookups, visits
from tidemill.plans import facts, metrics, traffic
from tidemill.schemas import TOPICS
from tidemill.sinks.tables import as_topic_rows
from tidemill.sources import tables as src, topics
from tidemill.streaming import jobs

FAR = 4_102_444_800_000  # a sentinel's time, far after all rows


def sentinel(day: int = 0, **page) -> str:
    import json
    page = {"page_id": "home", "last_page_id": "none", "during_time": 0, **page}
    page = {k: v for k, v in page.items() if v is not None}
    return json.dumps({
        "common": {"mid": "end", "uid": "end", "vc": "v", "ch": "c", "ar": "a", "is_new": "0"},
        "page": page, "ts": FAR + day * 86_400_000,
    })


def texts(df, column="value", order="offset"):
    return [r[0] for r in df.orderBy(order).select(column).collect()]


def page_values(tables, fast=False):
    """Page records in time order, as their topic holds them."""
    page = src.page_log(tables, fast)
    return texts(page.select(F.to_json(F.struct("common", "page", "ts")).alias("value"), "ts", "offset"), order="ts")


def stream(spark, root, topic):
    return topics.read_topic(spark, topic, path=str(root), max_per_batch=1)


def batch(spark, root, topic):
    return topics.read_topic(spark, topic, path=str(root), stream=False)


def no_end(df):
    return df.where("stt < '2100'")


def test_base_log(spark, tables, tmp_path):
    values = texts(src.raw_log(tables, damaged=True).withColumn("t", F.col("offset")), order="t")
    write_topic(tmp_path, "log", values, files=4)
    got = run(jobs.base_log(stream(spark, tmp_path, "log")), tmp_path, "base_log")
    want = traffic.base_log(batch(spark, tmp_path, "log"))
    assert rows(got) == rows(want)
    assert got.where(F.col("topic") == TOPICS["dirty"]).count() == 10


def test_unique_visitor(spark, tables, tmp_path):
    write_topic(tmp_path, "page", page_values(tables), files=5)
    got = run(jobs.unique_visitor(stream(spark, tmp_path, "page")), tmp_path, "uv")
    page = clean.parse_page_log(batch(spark, tmp_path, "page"), carry=("offset",))
    want = visits.unique_visitor(page).select(F.to_json(F.struct("common", "page", "ts")).alias("value"))
    assert rows(got) == rows(want)


def test_user_jump(spark, tables, tmp_path):
    write_topic(tmp_path, "page", page_values(tables, fast=True), files=4, last=[sentinel()])
    # one more file after the sentinel, so that its watermark takes effect
    write_topic(tmp_path / "x", "page", [sentinel(1)], files=1)
    (tmp_path / "x" / "page" / "part-00000.parquet").rename(tmp_path / "page" / "part-z.parquet")
    got = run(jobs.user_jump(stream(spark, tmp_path, "page")), tmp_path, "uj")
    page = clean.parse_page_log(batch(spark, tmp_path, "page"), carry=("offset",)).where("common.mid <> 'end'")
    want = visits.user_jump(page).select(F.to_json(F.struct("common", "page", "ts")).alias("value"))
    assert rows(got) == rows(want)


def test_traffic_window(spark, tables, tmp_path):
    """Three topics side by side; their files cover the same stretches of time."""
    page = src.page_log(tables, fast=True)
    uv, uj = visits.unique_visitor(page), visits.user_jump(page)
    lo, hi = page.select(F.min("ts"), F.max("ts")).first()
    cuts = [lo + (hi - lo) * i // 4 for i in range(5)]
    for topic, df in (("page", page), ("uv", uv), ("uj", uj)):
        got = df.select("ts", F.to_json(F.struct("common", "page", "ts")).alias("value")).orderBy("ts").collect()
        chunks = [[r.value for r in got if a <= r.ts < b or b == r.ts == hi] for a, b in zip(cuts, cuts[1:])]
        write_chunks(tmp_path, topic, [*chunks, [sentinel()]])
    parts = [stream(spark, tmp_path, t) for t in ("page", "uv", "uj")]
    got = run(jobs.traffic_window(*parts), tmp_path, "traffic")
    assert rows(no_end(got)) == rows(metrics.traffic_window(page, uv, uj))


SEARCH = dict(last_page_id="search", item="end", item_type="keyword")


def test_late_rows_are_left_out(spark, tables, tmp_path):
    """A search that comes after the watermark has passed its window changes nothing."""
    values = page_values(tables, fast=True)
    late = next(v for v in values if '"item_type":"keyword"' in v)
    write_chunks(tmp_path, "page", [values[:500], values[500:], [sentinel(**SEARCH)], [late]])
    got = run(jobs.kw_window(stream(spark, tmp_path, "page")), tmp_path, "kw_late")
    assert rows(no_end(got)) == rows(metrics.kw_window(src.page_log(tables, fast=True)))


@pytest.mark.parametrize("name, fast, end", [
    ("kw_window", True, SEARCH),
    ("home_detail_uv_window", False, {}),
    ("login_window", False, {"last_page_id": None}),
])
def test_page_windows(spark, tables, tmp_path, name, fast, end):
    write_topic(tmp_path, "page", page_values(tables, fast), files=4, last=[sentinel(0, **end)])
    got = run(getattr(jobs, name)(stream(spark, tmp_path, "page")), tmp_path, name)
    want = getattr(metrics, name)(src.page_log(tables, fast))
    assert rows(no_end(got)) == rows(want)


def change_topic(spark, tables, root, names, end=(), files=3):
    log = src.change_log(tables, *names)
    text = topics.envelope_records(log).withColumn("ts", F.get_json_object("value", "$.ts").cast("long"))
    write_topic(root, "db", texts(text, order="ts"), files, last=list(end))
    return clean.parse_change_log(stream(spark, root, "db")), log


def change(table, ts, kind="insert", old="null", **data):
    import json
    return json.dumps({"database": "shop", "table": table, "type": kind, "data": data, "old": old if isinstance(old, dict) else None, "ts": ts})


END_S = FAR // 1000
END_TEXT = "2100-01-01 00:00:00"


@pytest.mark.parametrize("name, needs, dic", [
    ("cart_add", ["cart_info"], True), ("coupon_get", ["coupon_use"], False), ("coupon_order", ["coupon_use"], False),
    ("coupon_pay", ["coupon_use"], False), ("favor_add", ["favor_info"], False), ("comment_add", ["comment_info"], True),
    ("user_register", ["user_info"], False),
])
def test_stateless_facts(spark, tables, tmp_path, name, needs, dic):
    live, log = change_topic(spark, tables, tmp_path, needs)
    args = [src.dictionary(spark)] if dic else []
    fn = getattr(facts, name)
    assert rows(run(fn(live, *args), tmp_path, name)) == rows(fn(log, *args))


def test_register_window(spark, tables, tmp_path):
    live, log = change_topic(spark, tables, tmp_path, ["user_info"], [change("user_info", END_S, id="end", create_time=END_TEXT)])
    got = run(metrics.register_window(facts.user_register(live)), tmp_path, "register")
    assert rows(no_end(got)) == rows(metrics.register_window(facts.user_register(log)))


def test_cart_window(spark, tables, tmp_path):
    cart = facts.cart_add(src.change_log(tables, "cart_info"), src.dictionary(spark))
    text = cart.withColumn("t", F.coalesce("operate_time", "create_time"))
    values = texts(text.select(F.to_json(F.struct(*cart.columns)).alias("value"), "t"), order="t")
    end = '{"user_id":"end","create_time":"%s"}' % END_TEXT
    write_topic(tmp_path, "cart", values, files=3, last=[end])
    live = topics.read_rows(spark, "cart", cart.schema, path=str(tmp_path), max_per_batch=1)
    got = run(jobs.cart_uu_window(live), tmp_path, "cart_uu")
    assert rows(no_end(got)) == rows(metrics.cart_uu_window(cart))


def wide_of(tables):
    log = src.change_log(tables, "order_detail", "order_info", "order_detail_activity", "order_detail_coupon")
    return facts.order_detail_wide(log, src.dictionary(tables.spark))


@pytest.fixture(scope="module")
def details(spark, tables):
    """Settled details, as rows and as text in the order of their creation."""
    latest = metrics.latest_details(wide_of(tables)).drop("pt").cache()
    text = latest.select(F.to_json(F.struct(*latest.columns)).alias("value"), "order_create_time", "order_detail_id")
    return latest, [r[0] for r in text.orderBy("order_create_time", "order_detail_id").collect()]


END_DETAIL = (
    '{"order_detail_id":"end","order_id":"end","user_id":"end","sku_id":"end","province_id":"end","type":"insert",'
    '"split_total_amount":"1.00","original_total_amount":"1.00","order_create_time":"%s","ts":"2100-01-01T00:00:00.000Z"}' % END_TEXT
)


@pytest.mark.parametrize("name", ["order_window", "province_window", "spu_order_window"])
def test_order_windows(spark, tables, tmp_path, details, name):
    latest, values = details
    write_topic(tmp_path, "wide", values, files=3, last=[END_DETAIL])
    live = topics.read_detail_topic(spark, "wide", path=str(tmp_path), max_per_batch=1)
    dims = src.dimensions(tables)
    args = {"order_window": [], "province_window": [dims["province"]], "spu_order_window": [lookups.sku_dimension(dims)]}[name]
    got = run(getattr(jobs, name)(live, *args), tmp_path, name)
    assert rows(no_end(got)) == rows(getattr(metrics, name)(latest, *args))


def test_keep_last_settles(spark, tmp_path):
    """Versions of a key within the settling time give one row, the latest."""
    make = lambda key, ts, price: (
        '{"order_detail_id":"%s","type":"insert","split_original_amount":"%s","ts":"2024-01-01T00:00:0%sZ"}' % (key, price, ts)
    )
    update = make("a", "9", "0").replace('"insert"', '"update"')
    write_topic(tmp_path, "wide", [make("a", "1.040", "1"), make("a", "1.9", "2"), make("b", "3", "5"), update, ""], files=2)
    live = jobs.latest_details(stream(spark, tmp_path, "wide"))
    query = (
        live.writeStream.format("memory").queryName("settled").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="500 milliseconds").start()
    )
    try:
        for _ in range(60):
            time.sleep(1)
            if spark.table("settled").count() >= 2:
                break
        time.sleep(2)
    finally:
        query.stop()
    got = [(r.order_detail_id, r.split_original_amount) for r in spark.table("settled").collect()]
    assert sorted(got) == [("a", "2"), ("b", "5")]


def test_payment_window(spark, tables, tmp_path):
    paid = facts.pay_success(src.change_log(tables, "payment_info"), wide_of(tables), src.dictionary(spark))
    values = texts(paid.select(F.to_json(F.struct(*paid.columns)).alias("value"), "callback_time", "order_detail_id"), order="callback_time")
    end = '{"order_detail_id":"end","user_id":"end","callback_time":"%s"}' % END_TEXT
    write_topic(tmp_path, "paid", values, files=3, last=[end])
    live = topics.read_rows(spark, "paid", paid.schema, path=str(tmp_path), max_per_batch=1)
    got = run(jobs.payment_window(live), tmp_path, "payment")
    assert rows(no_end(got)) == rows(metrics.payment_window(paid))


def test_refund_window(spark, tables, tmp_path):
    refund = facts.order_refund(src.change_log(tables, "order_refund_info", "order_info"), src.dictionary(spark))
    values = texts(refund.select(F.to_json(F.struct(*refund.columns)).alias("value"), "create_time", "id"), order="create_time")
    write_topic(tmp_path, "refund", values, files=3, last=['{"id":"end","create_time":"%s"}' % END_TEXT])
    live = topics.read_rows(spark, "refund", refund.schema, path=str(tmp_path), max_per_batch=1)
    dims = lookups.sku_dimension(src.dimensions(tables), with_spu=False)
    got = run(jobs.refund_window(live, dims), tmp_path, "refund")
    assert rows(no_end(got)) == rows(metrics.refund_window(refund, dims))


# ---- joins of streams, on a small made-up log ------------------------------------------

def order_changes():
    """Two orders: one cancelled, one paid; detail 3 has no source in the dictionary."""
    day = 1_704_067_200
    out = []
    for order, user, status, at in (("1", "u1", "1003", day), ("2", "u2", "1002", day + 60)):
        info = dict(id=order, user_id=user, province_id="p", order_status="1001", total_amount="9.00")
        out.append(change("order_info", at, **info))
        out.append(change("order_info", at + 3600, "update", {"order_status": "1001"}, **{**info, "order_status": status}))
    for detail, order, source, at in (("1", "1", "A", day), ("2", "2", "R", day + 60), ("3", "2", "N", day + 60)):
        out.append(change(
            "order_detail", at, id=detail, order_id=order, sku_id="s" + detail, sku_num="2", order_price="3.10",
            create_time="2024-01-01 00:00:00", source_type=source, split_total_amount="6.00",
        ))
    out.append(change("order_detail_activity", day + 1, id="a1", order_detail_id="1", activity_id="act", create_time="x"))
    out.append(change("order_detail_coupon", day + 61, id="c1", order_detail_id="2", coupon_id="cou", create_time="x"))
    out.append(change(
        "payment_info", day + 120, "update", {"payment_status": "1601"}, id="p", order_id="2", payment_type="F",
        payment_status="1602", callback_time="2024-01-01 00:02:00",
    ))
    end = [change(t, END_S, id="end", order_id="end", order_detail_id="end", source_type="A", callback_time=END_TEXT,
                  payment_status="1602", payment_type="F")
           for t in ("order_detail", "order_detail_activity", "order_detail_coupon", "order_info")]
    end.append(change("payment_info", END_S, "update", {"payment_status": "1601"}, id="end", order_id="end",
                      payment_status="1602", payment_type="F", callback_time=END_TEXT))
    return out, end


def test_order_wide_stream(spark, tmp_path):
    values, end = order_changes()
    write_topic(tmp_path, "db", values, files=3, last=end)
    dic = src.dictionary(spark)
    live = clean.parse_change_log(stream(spark, tmp_path, "db"))
    fixed = clean.parse_change_log(batch(spark, tmp_path, "db"))
    shown = lambda df: rows(df.where("order_id <> 'end'").drop("pt").withColumn("old", F.to_json("old")))
    got = run(jobs.order_detail_wide(live, dic), tmp_path, "wide")
    want = facts.order_detail_wide(fixed, dic)
    assert len(shown(want)) == 4
    assert shown(got) == shown(want)


def test_pay_success_stream(spark, tmp_path):
    values, end = order_changes()
    dic = src.dictionary(spark)
    write_topic(tmp_path, "db", values, files=2, last=end)
    fixed = clean.parse_change_log(batch(spark, tmp_path, "db"))
    wide = facts.order_detail_wide(fixed, dic)
    text = [r.value for r in as_topic_rows(wide.drop("pt"), "wide").collect()]
    write_topic(tmp_path, "wide", text, files=2)
    live = jobs.pay_success(
        clean.parse_change_log(stream(spark, tmp_path, "db")),
        topics.read_detail_topic(spark, "wide", path=str(tmp_path), max_per_batch=1), dic,
    )
    got = run(live, tmp_path, "paid")
    want = facts.pay_success(fixed, wide, dic)
    assert rows(got.where("order_id <> 'end'")) == rows(want.where("order_id <> 'end'"))
    assert got.where("order_id = '2'").count() == 2


def test_refund_stream(spark, tmp_path):
    day = 1_704_067_200
    values = [
        change("order_refund_info", day, id="r1", order_id="1", refund_type="A", refund_reason_type="Z", create_time="2024-01-01 00:00:00"),
        change("order_info", day + 5, "update", {"order_status": None}, id="1", order_status="1005", province_id="p1"),
        change("order_refund_info", day, id="r2", order_id="2", refund_type="N", refund_reason_type="F", create_time="2024-01-01 00:00:00"),
    ]
    end = [change("order_refund_info", END_S, id="end", order_id="end", create_time=END_TEXT),
           change("order_info", END_S, "update", {"order_status": None}, id="end", order_status="1005")]
    write_topic(tmp_path, "db", values, files=3, last=end)
    write_topic(tmp_path / "x", "db", end, files=1)
    (tmp_path / "x" / "db" / "part-00000.parquet").rename(tmp_path / "db" / "part-z.parquet")
    dic = src.dictionary(spark)
    got = run(jobs.order_refund(clean.parse_change_log(stream(spark, tmp_path, "db")), dic), tmp_path, "refunds")
    want = facts.order_refund(clean.parse_change_log(batch(spark, tmp_path, "db")), dic)
    keep = lambda df: rows(df.where("id <> 'end'"))
    assert keep(got) == keep(want)
    assert {r.id: r.province_id for r in got.where("id <> 'end'").collect()} == {"r1": "p1", "r2": None}


def test_days_follow_the_session_zone(spark):
    ms = spark.createDataFrame([(1_650_702_276_000,)], "ts long")
    day = lambda: ms.select(millis_to_day("ts")).first()[0]
    assert day() == "2022-04-23"
