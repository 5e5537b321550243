"""Operators on hand-made rows: the corners the driver tables do not have."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import Row, functions as F

from tidemill.functions import changes as ch, keywords, times as tm
from tidemill.operators import clean, dedup, firsts, lookups, split, visits
from tidemill.plans import facts, metrics, traffic
from tidemill.schemas import ENVELOPE, ORDER_WIDE_TS, RAW_LOG, TOPICS
from tidemill.sources import tables as src, topics

DAY0 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC
DAY = 86_400_000


def log_text(mid="m", ts=DAY0, is_new="0", last=None, **more):
    common = {"mid": mid, "uid": more.pop("uid", None), "vc": "v", "ch": "c", "ar": "a", "is_new": is_new}
    page = {"page_id": more.pop("page_id", "home"), "last_page_id": last, "during_time": more.pop("during", 1)}
    body = {"common": common, "page": page, "ts": ts, **more}
    return json.dumps({k: v for k, v in body.items() if v is not None})


def records(spark, *values):
    return spark.createDataFrame([Row(value=v, offset=i) for i, v in enumerate(values)], "value string, offset long")


def pages(spark, *values):
    return split.pages(clean.parse_page_log(records(spark, *values), carry=("offset",)))


# ---- parsing ---------------------------------------------------------------------

def test_malformed_blank_and_good_records(spark):
    rows, dirty = clean.parse_json_or_dirty(
        records(spark, log_text(), "{", "not json", "", None, "[1, 2]", '{"common":{"mid":"x"'), RAW_LOG
    )
    assert rows.count() == 1
    assert sorted(r.value for r in dirty.collect()) == ["[1, 2]", "not json", "{", '{"common":{"mid":"x"']
    assert {r.topic for r in dirty.collect()} == {TOPICS["dirty"]}


def test_null_record_becomes_empty_text(spark):
    assert [r.value for r in topics.as_records(records(spark, None, "a")).collect()] == ["", "a"]


def test_control_rows_and_numbers_in_data(spark):
    text = ['{"database":"shop","table":"cart_info","type":"update","ts":1,"data":{"id":100924,"cart_price":4488.00},"old":{"order_time":null}}',
            '{"type":"bootstrap-start"}', '{"type":"bootstrap-complete"}', '{"table":"x"}', "{"]
    log = clean.parse_change_log(records(spark, *text))
    (row,) = log.collect()
    # a number that is not quoted is read as a number: 4488.00 becomes 4488.0
    assert row.data == {"id": "100924", "cart_price": "4488.0"} and row.old == {"order_time": None}


def test_tombstones_and_updates_are_dropped(spark):
    text = ['{"order_detail_id":"1","type":"insert"}', "", '{"order_detail_id":"2","type":"update"}', "null"]
    assert [r.order_detail_id for r in clean.drop_empty_and_keep_insert(records(spark, *text), ORDER_WIDE_TS).collect()] == ["1"]


# ---- change rows -----------------------------------------------------------------

def changes(spark, *rows):
    full = [dict(database="shop", data={}, old=None, ts=1, type="update") | r for r in rows]
    return spark.createDataFrame([Row(**{n: r[n] for n in ENVELOPE.names}) for r in full], ENVELOPE)


def test_previous_value_null_is_a_change_but_not_a_value(spark):
    log = changes(spark, dict(table="t", old={"c": None}), dict(table="t", old={"c": "1"}), dict(table="t", old={"d": "1"}), dict(table="t"))
    got = [tuple(r) for r in log.select(ch.changed_key_exists("c"), F.coalesce(ch.changed_key_not_null("c"), F.lit(False))).collect()]
    assert got == [(True, False), (True, True), (False, False), (False, False)]


def test_cart_amounts(spark):
    cart = lambda kind, new, old=None, **d: dict(
        table="cart_info", type=kind, data={"id": "1", "sku_num": new, "source_type": "A"} | d, old=old)
    log = changes(
        spark, cart("insert", "2"), cart("update", "5", {"sku_num": "3"}), cart("update", "1", {"sku_num": "3"}),
        cart("update", "9", {"is_ordered": "0"}), cart("update", "10", {"sku_num": "9"}), cart("insert", "4", source_type="?"),
        {**cart("insert", "7"), "database": "other"}, cart("update", "x", {"sku_num": "3"}),
    )
    got = facts.cart_add(log, src.dictionary(spark))
    assert sorted(r.sku_num for r in got.collect()) == [1, 2, 2]


def test_favour_needs_its_own_table(spark):
    fav = lambda table, kind, old=None, **d: dict(table=table, type=kind, data={"id": table, "is_cancel": "0"} | d, old=old)
    log = changes(
        spark, fav("favor_info", "insert"), fav("favor_info", "update", {"is_cancel": "1"}), fav("favor_info", "update", {"is_cancel": "0"}),
        fav("other", "update", {"is_cancel": "1"}), fav("other", "insert"),
    )
    assert facts.favor_add(log).count() == 2
    assert facts.favor_add(log, guard=False).count() == 3


def test_refund_needs_the_status_key_only(spark):
    log = changes(
        spark,
        dict(table="order_refund_info", type="insert", data={"id": "r1", "order_id": "1", "refund_type": "A"}),
        dict(table="order_refund_info", type="insert", data={"id": "r2", "order_id": "2", "refund_type": "?"}),
        dict(table="order_info", data={"id": "1", "order_status": "1005", "province_id": "old"}, old={"order_status": None}, ts=1),
        dict(table="order_info", data={"id": "1", "order_status": "1005", "province_id": "new"}, old={"order_status": "1002"}, ts=2),
        dict(table="order_info", data={"id": "2", "order_status": "1005", "province_id": "x"}, old={"operate_time": "1"}),
    )
    got = {r.id: (r.province_id, r.refund_type_name) for r in facts.order_refund(log, src.dictionary(spark)).collect()}
    assert got == {"r1": ("new", "name A"), "r2": (None, None)}


def test_original_amount_keeps_four_decimals(spark):
    log = changes(spark, dict(table="order_detail", type="insert", data={"id": "1", "sku_num": "3", "order_price": "19.99"}))
    assert facts.order_details(log).first().split_original_amount == "59.9700"


def test_copies_do_not_multiply_in_the_wide_join(spark):
    detail = dict(table="order_detail", type="insert", data={"id": "d", "order_id": "o", "source_type": "A"})
    info = dict(table="order_info", type="insert", data={"id": "o", "user_id": "u"})
    act = dict(table="order_detail_activity", type="insert", data={"id": "a", "order_detail_id": "d", "activity_id": "x"})
    pay = dict(table="payment_info", data={"order_id": "o", "payment_status": "1602", "payment_type": "F", "callback_time": "t"}, old={"payment_status": "1601"})
    log = changes(spark, detail, *[info] * 5, *[act] * 5, *[pay] * 5)
    wide = facts.order_detail_wide(log, src.dictionary(spark))
    assert wide.count() == 1
    assert facts.pay_success(log, wide, src.dictionary(spark)).count() == 1
    assert wide.first().activity_id == "x"
    bare = facts.order_detail_wide(log, src.dictionary(spark), extras=False)
    assert bare.columns == wide.columns and bare.count() == 1 and bare.first().activity_id is None


# ---- new-visitor flag, visitors, jumps ------------------------------------------------

@pytest.mark.parametrize("given, fixed", [
    ([("1", 0), ("1", 1), ("0", 2), ("1", DAY)], ["1", "1", "0", "0"]),  # new on a later day: corrected
    ([("0", 0), ("1", 1), ("1", DAY)], ["0", "0", "0"]),                 # known before: never new
    ([("1", 0)], ["1"]),
    ([("0", DAY - 1), ("1", DAY)], ["0", "0"]),                          # midnight
])
def test_fix_is_new(spark, given, fixed):
    rows, _ = traffic.clean_log(records(spark, *[log_text(ts=DAY0 + t, is_new=n) for n, t in given]))
    assert [r.is_new for r in rows.orderBy("offset").select("common.is_new").collect()] == fixed


def test_unique_visitor_starts_again_at_midnight(spark):
    page = pages(
        spark, log_text(ts=DAY0, last="home"), log_text(ts=DAY0 + 5), log_text(ts=DAY0 + 6), log_text(ts=DAY0 + DAY - 1),
        log_text(ts=DAY0 + DAY), log_text("n", ts=DAY0),
    )
    assert sorted((r.mid, r.ts - DAY0) for r in visits.unique_visitor(page).select("common.mid", "ts").collect()) == [
        ("m", 5), ("m", DAY), ("n", 0)]


@pytest.mark.parametrize("rows, jumps", [
    ([(0, None), (9_999, "home")], []),              # followed in time
    ([(0, None), (10_000, "home")], [0]),            # ten seconds are too late
    ([(0, None), (5, None), (6, "home")], [0]),      # two starts in a row: the first jumped
    ([(0, None)], [0]),                              # nothing follows
    ([(0, "home"), (1, None), (2, "x"), (3, None)], [3]),
    ([(299_999, None), (300_001, "home")], []),      # across a slice
    ([(299_999, None), (309_998, "home")], []),
    ([(299_999, None), (309_999, "home")], [299_999]),
])
def test_user_jump(spark, rows, jumps):
    page = pages(spark, *[log_text(ts=DAY0 + t, last=last) for t, last in rows])
    assert [r.ts - DAY0 for r in visits.user_jump(page).orderBy("ts").collect()] == jumps


def brute_jumps(rows):
    out = []
    for mid in {r[0] for r in rows}:
        mine = sorted(r[1:] for r in rows if r[0] == mid)
        for i, (ts, n, last) in enumerate(mine):
            nxt = mine[i + 1] if i + 1 < len(mine) else None
            if last is None and (nxt is None or nxt[0] - ts >= 10_000 or nxt[2] is None):
                out.append((mid, n))
    return sorted(out)


def test_user_jump_against_brute_force_with_a_busy_device(spark):
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else f"m{i % 7}", rnd.randrange(0, 3_000_000), i, rnd.choice([None, "home"])) for i in range(1500)]
    page = pages(spark, *[log_text(m, ts=DAY0 + t, last=last) for m, t, _, last in rows])
    want = brute_jumps(rows)
    for slice_ms in (10_000, 60_000, visits.SLICE_MS):
        got = visits.user_jump(page, slice_ms=slice_ms).select("common.mid", "offset").collect()
        assert sorted(map(tuple, got)) == want
    with pytest.raises(ValueError):
        visits.user_jump(page, slice_ms=9_999)


def test_one_pass_traffic_equals_the_three_sources(spark):
    rnd = random.Random(5)
    texts = []
    for i in range(800):
        more = {"start": {"entry": "icon"}} if i % 9 == 0 else {}
        texts.append(log_text(
            f"m{rnd.randrange(6)}", ts=DAY0 + rnd.randrange(0, 3 * DAY) if i % 2 else DAY0 + DAY + rnd.randrange(0, 90_000),
            is_new=rnd.choice("01"), last=rnd.choice([None, "home"]), during=i, **more))
    rec = records(spark, *texts)
    page = traffic.page_rows(rec)
    want = metrics.traffic_window(page, visits.unique_visitor(page), visits.user_jump(page))
    got = metrics.traffic_window_of_log(clean.parse_page_log(rec, carry=("offset",)))
    key = lambda df: sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())
    assert key(got) == key(want)


def test_split_log_branches(spark):
    rec = records(
        spark,
        log_text(displays=[{"item": "a"}, {"item": "b"}], actions=[{"action_id": "x"}], err={"error_code": "7"}),
        log_text(start={"entry": "icon"}, displays=[{"item": "a"}], err={"error_code": "8"}),
    )
    out = split.split_log(clean.parse_page_log(rec, carry=("offset",)))
    count = {r.topic: r.n for r in out.groupBy("topic").agg(F.count("*").alias("n")).collect()}
    assert count == {TOPICS["error"]: 2, TOPICS["display"]: 2, TOPICS["action"]: 1, TOPICS["page"]: 1, TOPICS["start"]: 1}
    by = {}
    for r in out.collect():
        by.setdefault(r.topic, []).append(json.loads(r.value))
    assert set(by[TOPICS["page"]][0]) == {"common", "page", "ts"}
    assert "err" not in by[TOPICS["start"]][0] and "displays" in by[TOPICS["start"]][0]
    assert any("displays" in v for v in by[TOPICS["error"]])


# ---- firsts ----------------------------------------------------------------------

def visits_of(spark, *rows):
    return spark.createDataFrame(rows, "k string, t string").withColumn("t", F.to_timestamp("t"))


@pytest.mark.parametrize("gap, back", [(7, 0), (8, 1), (9, 1)])
def test_returning_after_eight_days(spark, gap, back):
    df = visits_of(spark, ("u", "2024-01-01 23:59:59"), ("u", f"2024-01-{1 + gap:02d} 00:00:00"), ("u", f"2024-01-{1 + gap:02d} 09:00:00"))
    got = firsts.returning(df, F.col("k"), F.col("t")).orderBy("day").collect()
    assert [(str(r.first_time), r.is_back) for r in got][1] == (f"2024-01-{1 + gap:02d} 00:00:00", back)
    assert len(got) == 2 and got[0].is_back == 0


def test_new_only_on_the_first_day(spark):
    df = visits_of(spark, ("u", "2024-01-02 10:00:00"), ("u", "2024-01-01 10:00:00"), ("u", "2024-01-01 09:00:00"))
    got = firsts.first_of_day_and_ever(df, F.col("k"), F.col("t")).orderBy("day").collect()
    assert [(str(r.first_time), r.is_new) for r in got] == [("2024-01-01 09:00:00", 1), ("2024-01-02 10:00:00", 0)]


def test_rows_without_a_user_are_nobodys(spark):
    df = visits_of(spark, (None, "2024-01-01 10:00:00"), ("u", "2024-01-01 10:00:00"))
    for rule in (firsts.day_firsts, firsts.first_of_day_and_ever, firsts.returning):
        assert [r.key for r in rule(df, F.col("k"), F.col("t")).collect()] == ["u"]


def test_keep_last_and_first_break_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, "q")], "k string, ts int, v string")
    assert sorted(r.v for r in dedup.keep_last(df, ["k"], "ts", ("v",)).collect()) == ["q", "z"]
    assert sorted(r.v for r in dedup.keep_first(df, ["k"], "ts", ("v",)).collect()) == ["q", "x"]


# ---- lookups ---------------------------------------------------------------------

def test_missing_dimension_rows_stay(spark):
    dim = spark.createDataFrame([("1", "one")], "id string, name string")
    df = spark.createDataFrame([("1",), ("2",), (None,)], "k string")
    got = lookups.dim_join(df, dim, "k", {"name": "n"})
    assert sorted((r.k or "-", r.n) for r in got.collect()) == [("-", None), ("1", "one"), ("2", None)]


def test_broadcast_is_only_asked_for_when_small(spark):
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()
    assert hinted(lookups.small_side(spark.range(10), 10))
    assert not hinted(lookups.small_side(spark.range(11), 10))


# ---- scalars ---------------------------------------------------------------------

@pytest.mark.parametrize("a, b, want", [
    ("2022-04-01 11:10:55.040Z", "2022-04-01 11:10:55.04Z", 0),
    ("2022-04-01 11:10:55.040Z", "2022-04-01 11:10:55.1Z", -1),
    ("2022-04-01 11:10:55.045Z", "2022-04-01 11:10:55.04Z", 1),
    ("2022-04-01 11:10:55.9Z", "2022-04-01 11:10:55.900Z", 0),
    ("2022-04-01 11:10:56.0Z", "2022-04-01 11:10:55.999Z", 1),
])
def test_compare_zulu(spark, a, b, want):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(tm.compare_zulu("a", "b")).first()[0] == want


def test_business_zone(spark):
    ms = spark.createDataFrame([(1_650_702_276_000,)], "ts long")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        row = ms.select(tm.millis_to_text("ts").alias("t"), tm.millis_to_day("ts").alias("d")).first()
        back = spark.createDataFrame([(row.t, row.d)], "t string, d string").select(tm.to_millis("t"), tm.to_millis("d", False)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row.t, row.d) == ("2022-04-23 16:24:36", "2022-04-23")
    assert tuple(back) == (1_650_702_276_000, 1_650_643_200_000)


def test_keyword_split(spark):
    df = spark.createDataFrame([("Red Widget-9",), ("好吃的苹果派",), ("!!",), (None,)], "t string")
    words = [r.word for r in keywords.explode_words(df, "t").collect()]
    assert words == ["red", "widget", "9", "好吃的苹果派"]
    splitter = keywords.word_list_split(["好吃", "苹果", "苹果派"])
    assert [r.word for r in keywords.explode_words(df, "t", splitter=splitter).collect()] == [
        "red", "widget", "9", "好吃", "的", "苹果派"]


def test_words_of_a_list_in_columns_are_those_of_the_udf(spark):
    """Random texts of few letters: nested words, words of other scripts, empty and null texts."""
    rng = random.Random(3)
    words = ["好吃", "苹果", "苹果派", "果派大", "派", "T恤", "red", "大好吃苹", "", "a.b"]
    texts = ["".join(rng.choice("好吃苹果派大恤tT1 -") for _ in range(rng.randrange(30))) for _ in range(300)] + ["", None, "!!"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, phrase string")
    got = keywords.explode_words(df, "phrase", "word", keywords.listed_words(words))
    want = keywords.explode_words(df, "phrase", "word", keywords.word_list_split(words))
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    keywords.create_split_function(spark, "split_listed", words)
    df.createOrReplaceTempView("phrases")
    in_sql = spark.sql("select p.id, p.phrase, w.word from phrases p, lateral split_listed(p.phrase) w")
    assert sorted(map(tuple, in_sql.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError):
        keywords.create_split_function(spark, "a; drop")


def test_a_word_list_for_other_letters(spark):
    df = spark.createDataFrame([("smallring9x",), ("redred",)], "t string")
    cut = keywords.listed_words(["small", "ring", "red", "re'd"], r"\p{L}")
    assert [r.word for r in keywords.explode_words(df, "t", splitter=cut).collect()] == ["small", "ring", "9", "x", "red", "red"]
    assert [r.word for r in keywords.explode_words(df, "t", splitter=keywords.listed_words([])).collect()] == ["smallring9x", "redred"]


def test_details_as_ordered_are_those_of_the_wide_rows(spark, tables):
    """On the tables, and where versions are copied, orders lack an insert, or keys are missing."""
    log, dic = src.change_log(tables, "order_detail", "order_info", "payment_info"), src.dictionary(spark)
    cols = ["order_detail_id", "order_id", "sku_id", "order_create_time", "split_total_amount", *facts.PLACED_COLUMNS]
    change = lambda table, kind, ts, **data: ("shop", table, kind, data, None, ts)
    detail = lambda key, order, ts, sku="1": change(
        "order_detail", "insert", ts, id=key, order_id=order, sku_id=sku, source_type="A", sku_num="1", order_price="2.00")
    odd = spark.createDataFrame([
        detail("a", "1", 5), detail("a", "1", 6, "2"), detail("a", "1", 6, "3"), detail("b", "2", 5), detail("c", None, 5),
        detail(None, "1", 5), change("order_info", "insert", 5, id="1", user_id="u", province_id="p"),
        change("order_info", "insert", 5, id="1", user_id="u", province_id="p"),
        change("order_info", "update", 9, id="1", user_id="later"), change("order_info", "update", 9, id="2", user_id="x"),
    ], log.schema)
    for rows in (log, odd):
        want = metrics.latest_details(facts.order_detail_wide(rows, dic, extras=False)).select(cols)
        got = facts.details_as_ordered(rows, dic).select(cols)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert {(r.order_detail_id, r.sku_id, r.user_id) for r in got.collect()} == {("a", "3", "u"), (None, "1", "u")}
    paid = facts.pay_success(log, facts.order_detail_wide(log, dic, extras=False), dic)
    users = facts.paid_users(log, dic)
    assert users.distinct().exceptAll(paid.select(users.columns).distinct()).isEmpty()
    assert paid.select(users.columns).distinct().exceptAll(users.distinct()).isEmpty() and users.count() < paid.count()


def test_per_order_amounts_count_once(spark):
    wide = spark.createDataFrame([
        (f"d{i}", "o1", "u", "insert", "2024-01-01 00:00:01", "10.00", None, "100.00", i) for i in range(3)
    ], "order_detail_id string, order_id string, user_id string, type string, order_create_time string, "
       "activity_reduce_amount string, coupon_reduce_amount string, original_total_amount string, ts long")
    for c in metrics.DETAIL_TIES:
        wide = wide.withColumn(c, F.lit("x"))
    every, once = metrics.order_window(wide).first(), metrics.order_window(wide, per_order=True).first()
    assert (every.order_original_total_amount, every.order_coupon_reduce_amount) == (300.0, 0.0)
    assert (once.order_original_total_amount, once.order_unique_user_count, once.order_new_user_count) == (100.0, 1, 1)
