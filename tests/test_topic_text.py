"""Topic text: what is written, and readers that take some of it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tidemill import catalog
from tidemill.catalog import QUERIES
from tidemill.functions import packing
from tidemill.operators import clean
from tidemill.plans import facts
from tidemill.schemas import ENVELOPE, ORDER_WIDE_TS
from tidemill.sources import tables as src, topics


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_change_records_hold_the_change_log(tables):
    """written from the columns, read back as the envelope."""
    records = src.change_records(tables)
    shown = lambda df: df.select("database", "table", "type", F.to_json("data").alias("data"), F.to_json("old").alias("old"), "ts")
    got, want = shown(clean.parse_change_log(records)), shown(clean.drop_control_rows(src.change_log(tables)))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert "keys: [id,consignee" not in plan(records) and "map(id" not in plan(records)


def test_keys_of_the_change_log(spark):
    """a reader of some keys finds the same values in the same records."""
    rows = texts(
        spark,
        '{"database":"shop","table":"a","type":"insert","data":{"id":7,"x":{"y":1}},"old":null,"ts":1}',
        '{"table":"a","type":"update","data":{"x":"1"},"old":{"x":null},"ts":2}',
        '{"table":"a","type":"update","data":null,"ts":3}', '{"table":"a","type":"update","data":"no object","ts":4}',
        '{"table":"a","type":"update","data":{"id":"1"},"old":5,"ts":4}', '{"table":"a","type":"update","data":{"id":"1"},"ts":"x"}',
        '{"table":"a","type":"update","data":{"id":"1","x":"cut', '{"table":"a","data":{"id":"1"},"ts":5}',
        '{"table":"a","type":"bootstrap-start","data":{"id":"1"},"ts":6}', "", "[]", "1",
    )
    take = lambda df: [tuple(r) for r in df.select("table", "type", F.col("data").getItem("id"), "ts").collect()]
    got = take(clean.parse_change_log(rows, keys=["id"]))
    assert got == take(clean.parse_change_log(rows)) == [("a", "insert", "7", 1), ("a", "update", None, 2), ("a", "update", None, 3)]


@pytest.mark.parametrize("size, cents", [
    (0.5, 50), (1.005, 100), (-1.005, -100), (0.125, 13), (-0.125, -13), (2.675, 268), (0.0, 0), (-0.0, 0), (90071992547409.9, 9007199254740991)])
def test_cents(spark, size, cents):
    """Whole cents as `round` gives them, halves away from zero."""
    row = spark.createDataFrame([(size,)], "x double").select(
        src._cents("x").alias("now"), F.round(F.col("x") * 100).cast("long").alias("want")).first()
    assert row.now == row.want == cents


WIDE_TEXTS = (
    '{"order_detail_id":"1","type":"insert","sku_name":{"a":1},"ts":"2024-01-01T00:00:00.000Z"}',
    '{"order_detail_id":"2","type":"\\u0069nsert","old":{"x":"y"}}', '{"order_detail_id":"3","type":"update","sku_name":"insert"}',
    '{"order_detail_id":"4","type":"insert","old":"no object"}', '{"order_detail_id":"5","type":"insert","ts":[]}',
    '{"order_detail_id":"6","type":"insert","sku_name":"cut', '{"order_detail_id":"7"}', '{"order_detail_id":"8","type":"insert","sku_name":"\\q"}', "",
)


def test_columns_of_a_detail_topic(spark):
    """a reader of some columns finds the same rows and the same dirty records."""
    columns = ["order_detail_id", "type"]
    all_rows, all_dirty = clean.parse_json_or_dirty(texts(spark, *WIDE_TEXTS), ORDER_WIDE_TS)
    rows, dirty = clean.parse_json_or_dirty(texts(spark, *WIDE_TEXTS), ORDER_WIDE_TS, columns=columns)
    assert rows.columns == columns and rows.collect() == all_rows.select(*columns).collect()
    assert [r.order_detail_id for r in rows.collect()] == ["1", "2", "3", "7"]
    assert dirty.collect() == all_dirty.collect() and dirty.count() == 4


@pytest.mark.parametrize("name", ["read_detail_topic", "write_topic", "drop_empty_and_keep_insert"])
def test_only_asked_columns_are_parsed(spark, name):
    text = QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    parsed = next(line for line in text.split("\n") if "from_json(" in line)
    assert "order_detail_id,StringType" in parsed and "consignee_tel" not in parsed


def test_inserts_are_parsed_and_text_is_made_once(spark):
    """other records are left out unparsed, escaped letters read; the filters on the text do not make it again."""
    kept = clean.drop_empty_and_keep_insert(texts(spark, *WIDE_TEXTS), ORDER_WIDE_TS, columns=["order_detail_id", "type"])
    assert [tuple(r) for r in kept.collect()] == [("1", "insert"), ("2", "insert")]
    text = QUERIES["drop_empty_and_keep_insert"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("StructsToJsonEvaluator") == 1


def test_order_versions_travel_together(spark):
    """one shuffled row for the versions of an order, copies dropped, every version a row again; one pass over the orders."""
    change = "database string, `table` string, type string, data map<string,string>, old map<string,string>, ts long"
    order = lambda kind, status, old=None, **more: ("shop", "order_info", kind, {"id": "o", "user_id": "u", "order_status": status, **more}, old, 1)
    log = spark.createDataFrame([
        ("shop", "order_detail", "insert", {"id": "d", "order_id": "o", "sku_num": "2", "order_price": "1.5", "source_type": "A"}, None, 1),
        ("shop", "order_detail", "insert", {"id": "e", "order_id": None, "source_type": "A"}, None, 1),
        *[order("insert", "1001")] * 3, *[order("update", "1002", {"order_status": "1001", "a": None})] * 2,
        order("update", "1002", {"a": None, "order_status": "1001"}), order("update", "1003", {}, user_id="v"), order("update", "1003", None, user_id="v"),
    ], change)
    wide = facts.order_detail_wide(log, src.dictionary(spark))
    rows = [tuple(r) for r in wide.select("order_detail_id", "user_id", "type", "order_status", F.to_json("old"), "split_original_amount").collect()]
    assert sorted(rows, key=str) == sorted([
        ("d", "u", "insert", "1001", None, "3.0000"), ("d", "u", "update", "1002", '{"a":null,"order_status":"1001"}', "3.0000"),
        ("d", "v", "update", "1003", "{}", "3.0000"), ("d", "v", "update", "1003", None, "3.0000")], key=str)
    text = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set(" in text
    text = QUERIES["order_detail_wide"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("o_orderpriority#") and sum("Relation [o_orderkey" in line for line in text.split("\n")) == 1


def test_records_of_a_row_are_made_in_one_pass(tables):
    """one read of the lines for all their records and one for the cart; the records of a line lie together."""
    records = src.change_records(tables)
    text = records._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [l_orderkey" in line for line in text.split("\n")) == 2
    own = src.change_records(tables, "order_detail", "comment_info").select(
        F.get_json_object("value", "$.table").alias("table"), F.get_json_object("value", "$.data.id").alias("id")).collect()
    assert [r.table for r in own[:4]] == ["order_detail", "comment_info"] * 2
    assert all(after.id.startswith(f"{before.id}-") for before, after in zip(own[::2], own[1::2]))


@pytest.mark.parametrize("name, folder", [
    ("read_change_log", "topics/topic_db"), ("read_detail_topic", "topics/order_detail"), ("write_topic", "topics/batch=0/topic=order_detail")])
def test_topic_files_are_packed(spark, tmp_path, monkeypatch, name, folder):
    """files of topic text are written with zstd."""
    monkeypatch.setattr(catalog, "scratch", lambda t, kind: f"{tmp_path}/{kind}")
    QUERIES[name](spark, SMALL)
    files = list((tmp_path / folder).glob("*.parquet"))
    assert files and all(".zstd." in f.name for f in files)


@pytest.mark.parametrize("digits", [False, True])
def test_packed_columns_come_back(spark, digits):
    """every text, null or odd, comes back as it was, and only equal rows have equal values."""
    odd = ["", "0", "12.50", "-7", "2024-01-01 00:10:00", "abc", "E", "\u001f", "\u001e", "ä漢", " ", "a\nb", "1\n", "7" * 99, None]
    rows = [(i, a, b, odd[(i + j) % len(odd)]) for i, a in enumerate(odd) for j, b in enumerate(odd)]
    df = spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(rows)], "k long, a string, b string, c string")
    packed = packing.pack(df, ["a", "b", "c"], "p", digits)
    assert packed.columns == ["k", "p", "p_rest"]
    assert packed.where("(p is null) = (p_rest is null)").isEmpty()
    assert sorted(map(tuple, packing.unpack(packed, ["a", "b", "c"], "p", digits).collect())) == sorted(map(tuple, df.collect()))
    assert packed.select("p", "p_rest").distinct().count() == len({r[1:] for r in rows})
    none = spark.sql("select 1 as k, cast(null as binary) as p, cast(null as array<string>) as p_rest")
    none = none if digits else none.withColumn("p", F.col("p").cast("string"))
    assert packing.unpack(none, ["a", "b"], "p", digits).collect() == [(1, None, None)]


def test_whole_rows_travel_packed(spark, tables):
    """the same rows as unpacked, in shuffles of few columns."""
    log, dic = src.change_log(tables, "order_detail", "order_info", "order_detail_activity", "order_detail_coupon"), src.dictionary(spark)
    shown = lambda df: df.drop("pt").withColumn("old", F.to_json("old"))
    got, want = shown(facts.order_detail_wide(log, dic, whole=True)), shown(facts.order_detail_wide(log, dic))
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    text = QUERIES["order_detail_wide"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joined = next(line for line in text.split("\n") if "Join Inner, (order_id" in line)
    assert joined and "_detail_digits" in text and "_order_digits" in text and "_extra_digits" in text
