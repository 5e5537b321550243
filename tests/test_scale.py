"""Plans: what is shuffled, what is pushed down, and what a hot key does."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tidemill.catalog import QUERIES
from tidemill.operators import dedup, visits
from tidemill.plans import facts, metrics
from tidemill.sources import tables as src


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan as it was run, after the adaptive steps."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def conf(spark):
    """Settings changed for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value in (None, "<undefined>") else spark.conf.set(key, value)


@pytest.mark.parametrize("name", QUERIES)
def test_plan_has_no_cross_join_single_task_or_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|SinglePartition", text)
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", text)


@pytest.mark.parametrize("name", ["dedup_keep_last", "dedup_keep_first", "unique_visitor"])
def test_one_row_per_key_is_limited_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert re.search(r"WindowGroupLimit .*Partial", text) and re.search(r"WindowGroupLimit .*Final", text)


@pytest.mark.parametrize("name, columns", [
    ("comment_add", {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"}),
    ("login_window", {"event_id", "ts", "user_id"}),
    ("dedup_keep_first", {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                          "l_linestatus", "l_returnflag", "l_shipdate"}),
])
def test_only_needed_columns_are_read(spark, conf, name, columns):
    conf(spark__sql__maxMetadataStringLength="2000")
    (schema,) = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, SMALL))))
    assert {c.split(":")[0] for c in schema.split(",")} == columns


def test_filters_reach_the_scan(spark):
    assert "GreaterThan(l_discount,0.05)" in plan(QUERIES["coupon_order"](spark, SMALL))


def test_unrelated_tables_leave_the_plan(spark, tables):
    """Of the whole change log only the table asked for is read."""
    text = plan(facts.user_register(src.change_log(tables)))
    assert set(re.findall(r"sf[0-9.]+/(\w+)\.parquet", text)) == {"customer"}


def hot_log(spark, n=60_000):
    """A third of all rows belongs to one device."""
    i = F.col("id")
    mid = F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), i % 5000))
    return spark.range(0, n, 1, 8).select(
        F.struct(mid.alias("mid"), F.when(i % 2 == 0, "u").alias("uid"), F.lit("v").alias("vc"), F.lit("c").alias("ch"),
                 F.lit("a").alias("ar"), F.when(i % 7 == 0, "1").otherwise("0").alias("is_new")).alias("common"),
        F.struct(F.lit("home").alias("page_id"), F.when(i % 5 > 1, "home").alias("last_page_id"), F.lit(None).cast("string").alias("item"),
                 F.lit(None).cast("string").alias("item_type"), F.lit(1).cast("long").alias("during_time")).alias("page"),
        F.lit(None).cast("map<string,string>").alias("start"),
        (F.lit(1_704_067_200_000) + i * 997).alias("ts"), i.alias("offset"),
    )


SPLIT_EARLY = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__adaptive__coalescePartitions__parallelismFirst": "false",
}


def test_hot_device_is_split_in_the_join(spark, conf):
    conf(**SPLIT_EARLY)
    fixed = visits.fix_is_new(hot_log(spark))
    assert "skew=true" in final_plan(fixed)
    assert fixed.count() == 60_000
    last_new = fixed.where("common.mid = 'hot' and common.is_new = '1'").agg(F.max("ts")).first()[0]
    assert last_new < 1_704_067_200_000 + 86_400_000


def hot_changes(spark, n=40_000):
    """A third of all detail and refund records are of one order and detail."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").otherwise(i.cast("string"))
    base = spark.range(0, n, 1, 8)

    def rows(table, kind, ts, old=None, **data):
        pairs = [x for k, v in data.items() for x in (F.lit(k), v.cast("string"))]
        return base.select(
            F.lit("shop").alias("database"), F.lit(table).alias("table"), F.lit(kind).alias("type"),
            F.create_map(*pairs).cast("map<string,string>").alias("data"),
            (F.create_map(*map(F.lit, old)) if old else F.lit(None)).cast("map<string,string>").alias("old"),
            F.lit(ts).cast("long").alias("ts"),
        )

    parts = [
        rows("order_detail", "insert", 1, id=key, order_id=key, sku_id=i, source_type=F.lit("A")),
        rows("order_detail_activity", "insert", 1, id=i, order_detail_id=key, activity_id=key),
        rows("order_detail_coupon", "insert", 1, id=i, order_detail_id=key, coupon_id=key),
        rows("order_info", "insert", 1, id=key, user_id=key),
        rows("order_info", "update", 2, ("order_status", "1001"), id=key, user_id=key, order_status=F.lit("1005"), province_id=key),
        rows("order_refund_info", "insert", 1, id=i, order_id=key, sku_id=i, refund_type=F.lit("A")),
    ]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def test_hot_order_is_split_and_copies_do_not_multiply(spark, conf):
    conf(**SPLIT_EARLY)
    log, dic = hot_changes(spark), src.dictionary(spark)
    wide = facts.order_detail_wide(log, dic).select("order_detail_id", "sku_id", "activity_id", "coupon_id", "user_id", "type")
    assert final_plan(wide).count("skew=true") >= 2
    assert wide.count() == 80_000 and wide.where("activity_id is null or coupon_id is null").count() == 0
    refund = facts.order_refund(log, dic).select("id", "province_id", "refund_type_name")
    assert "skew=true" in final_plan(refund)
    assert refund.count() == 40_000


def own_details(log):
    """The same changes with a detail id of its own for every detail record."""
    data = F.map_concat(F.map_filter("data", lambda k, _: k != "id"), F.create_map(F.lit("id"), F.col("data")["sku_id"]))
    return log.withColumn("data", F.when(F.col("table") == "order_detail", data).otherwise(F.col("data")))


def test_hot_order_is_split_where_reduced_details_meet_it(spark, conf):
    conf(**SPLIT_EARLY, spark__sql__adaptive__coalescePartitions__minPartitionSize="2KB")  # else one task maps all
    log, dic = own_details(hot_changes(spark)), src.dictionary(spark)
    placed = facts.details_as_ordered(log, dic).select("order_detail_id", "user_id", "sku_id")
    assert "skew=true" in final_plan(placed)
    assert placed.count() == 40_000 and placed.where("user_id = 'hot'").count() == 13_334


@pytest.mark.parametrize("name, most", [
    ("order_window", 5), ("province_window", 4), ("payment_window", 6), ("spu_order_window", 9), ("order_detail_wide", 4), ("pay_success", 5)])
def test_exchanges_of_the_order_family(spark, conf, name, most):
    """Without dealing the local files over the cores."""
    conf(spark__tidemill__scan__partitions="")
    assert plan(QUERIES[name](spark, SMALL)).count("Exchange hashpartitioning") <= most


def biggest_share(df, *keys) -> float:
    """Rows of the fullest group, as a share of all."""
    n = df.groupBy(*keys).count()
    return n.agg(F.max("count") / F.sum("count")).first()[0]


def test_hot_device_is_many_groups_in_the_look_ahead(spark):
    log = hot_log(spark)
    slot = F.floor(F.col("ts") / visits.SLICE_MS)
    assert biggest_share(log, "common.mid") > 0.3
    assert biggest_share(log, "common.mid", slot) < 0.01


def test_hot_detail_is_many_groups_in_the_sliding_rule(spark):
    """Copies of one detail are looked at by slices: what is shuffled and ordered is a slice of a detail."""
    paid = hot_log(spark).select(F.col("common.mid").alias("order_detail_id"), F.timestamp_millis("ts").alias("time"), "offset")
    text = plan(dedup.keep_first_sliding(paid, ["order_detail_id"], F.col("time"), ("offset",)))
    assert re.search(r"hashpartitioning\(order_detail_id#\d+, _slot#", text)
    assert biggest_share(paid, "order_detail_id", F.floor(F.unix_millis("time") / dedup.SLICE_MS)) < 0.01


def test_hot_user_is_reduced_before_its_own_shuffle(spark, conf):
    """Day firsts of a hot user: what reaches the per-user step is one row per day."""
    text = plan(metrics.login_window(hot_log(spark)))
    window = text.index("Window [lag(")
    assert "HashAggregate" in text[window:] and "min(" in text[window:]


def test_joins_shuffle_by_key_when_dimensions_have_grown(spark, conf):
    conf(**{"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"})
    text = plan(QUERIES["spu_order_window"](spark, SMALL))
    assert "SortMergeJoin [sku_id" in text
    # only the dictionary, whose rows were counted, is still broadcast
    assert text.count("BroadcastHashJoin") == 1


def test_payment_join_reuses_the_order_partitioning(spark, conf):
    conf(**{"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"})
    text = plan(QUERIES["pay_success"](spark, SMALL))
    top = text[:text.index("SortMergeJoin [order_id")]
    inner = text[text.index("SortMergeJoin [order_id"):]
    assert "Exchange" not in top
    assert not re.match(r"SortMergeJoin \[order_id[^\n]*\n[^\n]*Exchange", inner)
