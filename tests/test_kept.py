"""Jobs on kept tables: corrected joins, first days, topics that take a batch once, arrival order, routing from its feed."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from streams import rows, run, write_chunks
from test_streaming import change, stream
from tidemill.operators import clean, visits
from tidemill.plans import facts, metrics, traffic
from tidemill.schemas import TOPICS
from tidemill.sinks import tables as sinks, topic_log
from tidemill.sources import tables as src, topics
from tidemill.streaming import job_table, jobs, kept, runner

DAY = 86_400_000


def log_of(spark, *texts):
    return clean.parse_change_log(spark.createDataFrame([(t,) for t in texts], "value string"))


def values(df):
    return [(json.loads(r.key), json.loads(r.value) if r.value else None) for r in df.collect()]


# ---- corrected joins ---------------------------------------------------------------

def refund(key, order, ts=1_000):
    return change("order_refund_info", ts, id=key, order_id=order, refund_type="A", refund_reason_type="Z", create_time="2024-01-01 00:00:00")


def refunded(order, province, ts=1_001):
    return change("order_info", ts, "update", {"order_status": "1002"}, id=order, order_status="1005", province_id=province)


def test_a_refund_is_there_at_once_and_corrected_later(spark, tmp_path):
    dic, path = src.dictionary(spark), str(tmp_path)
    gone = "gone"  # a tombstone

    def at(part, *texts):
        found = {}
        for key, row in values(kept.order_refund(log_of(spark, *texts), dic, path, part)):
            found.setdefault(key["id"], []).append(row.get("province_id") if row else gone)
        return found

    assert at(0, refund("r1", "1"), refund("r2", "2")) == {"r1": [None], "r2": [None]}
    for _ in range(2):  # the same batch again says the same
        assert at(1, refunded("1", "7")) == {"r1": [gone, "7"]}
    assert at(2, refunded("1", "7", 1_002)) == {}  # nothing changes
    assert at(3, refunded("1", "8", 1_003), refund("r3", "1")) == {"r1": [gone, "8"], "r3": ["8"]}
    assert at(4) == {}


def test_corrected_order_rows_end_as_the_table_has_them(spark, tables, tmp_path):
    """Changes of all order tables in any order over four batches: the rows that hold in the end are those of the table."""
    log = src.change_log(tables, *kept.ORDER_TABLES)
    texts = [r.value for r in topics.envelope_records(log).collect()]
    random.Random(1).shuffle(texts)
    dic, root = src.dictionary(spark), str(tmp_path)
    for part in range(4):
        out = kept.order_detail_wide(log_of(spark, *texts[part::4]), dic, f"{root}/kept", part, 4_000)
        topic_log.append_once(out.select(F.lit("wide").alias("topic"), "key", "value"), f"{root}/topics", "wide", part)
    sent = spark.read.parquet(f"{root}/topics/topic=wide")
    want = facts.order_detail_wide(log, dic).drop("pt")
    assert sent.where("value = ''").count() > 0
    # all versions that hold: those sent after the last tombstone of their key
    last = sent.groupBy("key").agg(F.max(F.when(F.col("value") == "", F.col("offset"))).alias("dead"))
    live = sent.join(last, "key").where("value <> '' and (dead is null or offset > dead)").select("value")
    now, _ = clean.parse_json_or_dirty(live, job_table.ORDER_WIDE_TS)
    cols = ["order_detail_id", "sku_id", "type", "order_status", "activity_id", "coupon_id", "dic_name", "split_total_amount"]
    assert rows(now.select(*cols).distinct()) == rows(want.select(*cols).distinct())
    keyed = topics.read_keyed(spark, "topic=wide", f"{root}/topics")
    assert keyed.count() == want.select("order_detail_id").distinct().count()


def test_old_changes_are_not_looked_for(spark, tmp_path):
    dic, path = src.dictionary(spark), str(tmp_path)
    kept.order_refund(log_of(spark, refund("r1", "1", 0)), dic, path, 0)
    assert kept.order_refund(log_of(spark, refunded("1", "7", 40 * 86_400)), dic, path, 1).count() == 0
    assert kept.order_refund(log_of(spark, refunded("1", "7", 20 * 86_400)), dic, path, 1).count() == 2


def test_order_refund_job_answers_in_its_batch(spark, tmp_path):
    place = job_table.Place(str(tmp_path / "tables"), src.dictionary, None, path=str(tmp_path / "topics"), max_per_batch=1)
    write_chunks(tmp_path / "in", "t", [[refund("r1", "1")]])
    folder = tmp_path / "topics" / f"topic={TOPICS['db']}"
    folder.mkdir(parents=True)

    def step(number, text):
        write_chunks(tmp_path / f"in{number}", "t", [[text]])
        (tmp_path / f"in{number}" / "t" / "part-00000.parquet").rename(folder / f"{number}.parquet")
        query = job_table.start_job(spark, "order_refund", place, trigger={"availableNow": True}, checkpoint=str(tmp_path / "ck"))
        assert query.awaitTermination(120) and query.exception() is None
        return {json.loads(r.key)["id"]: json.loads(r.value).get("province_id")
                for r in topics.read_keyed(spark, f"topic={TOPICS['order_refund']}", str(tmp_path / "topics")).collect()}

    assert step(0, refund("r1", "1")) == {"r1": None}
    assert step(1, refunded("1", "7")) == {"r1": "7"}


# ---- first days ----------------------------------------------------------------------

def page(mid, ts, is_new="1", last=None, **more):
    return json.dumps({"common": {"mid": mid, "is_new": is_new}, "page": {"page_id": "home", "last_page_id": last}, "ts": ts, **more})


def records(spark, texts, first=0):
    return spark.createDataFrame([(t, first + k) for k, t in enumerate(texts)], "value string, offset long")


def test_base_log_batches_give_what_the_table_gives(spark, tables, tmp_path):
    raw = src.raw_log(tables, damaged=True).collect()
    raw.sort(key=lambda r: r.offset)
    out = None
    for part in range(4):
        some = raw[len(raw) * part // 4:len(raw) * (part + 1) // 4]
        got = kept.base_log(spark.createDataFrame(some, "value string, offset long"), str(tmp_path / "mids"), part)
        got.write.parquet(str(tmp_path / "out" / f"{part}"))
    got = spark.read.parquet(*[str(tmp_path / "out" / f"{p}") for p in range(4)])
    want = traffic.base_log(src.raw_log(tables, damaged=True))
    assert rows(got.drop("offset")) == rows(want)
    assert got.where("offset is null").count() == 0


def test_first_day_survives_restarts_and_learns_from_earlier_logs(spark, tmp_path):
    path = str(tmp_path)
    at = lambda part, *texts: sorted(
        (json.loads(r.value)["ts"] // DAY, json.loads(r.value)["common"]["is_new"])
        for r in kept.base_log(records(spark, texts), path, part).collect())
    assert at(0, page("a", 5 * DAY)) == [(5, "1")]
    assert at(1, page("a", 6 * DAY)) == [(6, "0")] == at(1, page("a", 6 * DAY))
    assert at(2, page("a", 4 * DAY)) == [(4, "1")]  # earlier than all before
    # Without a device the claim stands; a device whose first log does not claim to be new was there the day before.
    assert at(3, page("a", 5 * DAY), page(None, 9 * DAY), page("b", 9 * DAY, "0"), page("b", 9 * DAY + 1, "1")) == [
        (5, "0"), (9, "0"), (9, "0"), (9, "1")]
    sinks.compact(spark, path, ["mid"], ["ts"], upto=2)
    assert at(4, page("a", 7 * DAY), page("b", 10 * DAY)) == [(7, "0"), (10, "0")]
    assert "Python" not in kept.base_log(records(spark, [page("a", 1)]), path, 5)._jdf.queryExecution().executedPlan().toString()


def test_unique_visitors_over_batches(spark, tables, tmp_path):
    log = src.page_log(tables).withColumn("value", F.to_json(F.struct("common", "page", "ts"))).orderBy("ts")
    texts = [(r.value, r.offset) for r in log.select("value", "offset").collect()]
    texts += [(page(None, 5 * DAY), 10 ** 6)]
    found = []
    for part in range(5):
        batch = spark.createDataFrame(texts[len(texts) * part // 5:len(texts) * (part + 1) // 5], "value string, offset long")
        for _ in range(2):  # a repeated batch says the same
            got = rows(kept.unique_visitor(batch, str(tmp_path), part).select("value"))
        found += got
    want = visits.unique_visitor(src.page_log(tables)).select(F.to_json(F.struct("common", "page", "ts")).alias("value"))
    assert sorted(found) == rows(want)


def test_days_too_far_back_are_left_out(spark, tmp_path):
    log = clean.parse_page_log(records(spark, [page("a", 100 * DAY), page("a", 90 * DAY), page("a", 10 * DAY)]), carry=("offset",))
    got = kept.first_of_day(log, F.col("common.mid"), F.col("ts"), str(tmp_path), 0, late_days=20)
    assert sorted(r.ts // DAY for r in got.collect()) == [90, 100]
    assert kept.first_of_day(log.limit(0), F.col("common.mid"), F.col("ts"), str(tmp_path), 1).count() == 0


# ---- jumps of a busy device ------------------------------------------------------------

def test_jumps_of_one_device_are_many_states(spark, tables, tmp_path, monkeypatch):
    """One device holds all rows: its state is cut into slices, and jumps at their ends are as in the table."""
    rng = random.Random(2)
    texts, ts = [], 0
    for _ in range(400):
        ts += rng.choice([1, 4_000, 9_999, 10_000, 30_000])
        texts.append(page("hot", ts, last=rng.choice([None, "home"])))
    texts += [page(None, 50_000), page(None, 50_001)]
    end = [page("end", 4_102_444_800_000), page("end", 4_102_531_200_000)]
    write_chunks(tmp_path, "page", [texts[:200], texts[200:], end[:1], end[1:]])
    got = run(jobs.user_jump(stream(spark, tmp_path, "page"), slice_ms=60_000), tmp_path, "hot_jumps").where("value not like '%\"end\"%'")
    log = clean.parse_page_log(topics.read_topic(spark, "page", path=str(tmp_path), stream=False), carry=("offset",))
    want = visits.user_jump(log).where("common.mid is null or common.mid <> 'end'").select(F.to_json(F.struct("common", "page", "ts")).alias("value"))
    assert rows(got) == rows(want) and want.where("value like '%\"ts\":5000%'").count() >= 2
    with pytest.raises(ValueError):
        jobs.user_jump(stream(spark, tmp_path, "page"), slice_ms=1_000)


# ---- rows without a device -------------------------------------------------------------

def test_rows_without_a_device_count_for_nobody(spark):
    log = clean.parse_page_log(records(spark, [page(None, 1), page(None, 2), page(None, 3), page("a", 4)]), carry=("offset",))
    assert [r.ts for r in visits.unique_visitor(log).collect()] == [4]
    assert sum(r.home_uv_ct for r in metrics.home_detail_uv_window(log).collect()) == 1
    assert sorted(r.ts for r in visits.user_jump(log).collect()) == [1, 2, 3, 4]  # none hides another
    whole = clean.parse_page_log(records(spark, [page(None, 1), page(None, 2), page("a", 3)]), carry=("offset",))
    assert sum(r.uv_ct for r in metrics.traffic_window_of_log(whole).collect()) == 1


# ---- topics that take a batch once -------------------------------------------------------

def topic_rows(spark, *values):
    return spark.createDataFrame([("t", v) for v in values], "topic string, value string").repartition(3)


def test_a_broken_off_move_is_moved_on(spark, tmp_path, monkeypatch):
    """A reader that runs all the time sees each record once, whatever breaks off and comes again."""
    root, seen = str(tmp_path / "topics"), []

    def read():
        query = topics.read_topic(spark, "topic=t", path=root).writeStream.foreachBatch(
            lambda df, _: seen.extend((r.value, r.offset) for r in df.collect())).option(
            "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        assert query.awaitTermination(60) and query.exception() is None

    topic_log.append_once(topic_rows(spark, *"abcdef"), root, "w", 0)
    read()
    children, publish = topic_log._children, topic_log.publish

    def one_file_only(*args):  # killed behind the first file of the second batch
        monkeypatch.setattr(topic_log, "_children", lambda spark, path: children(spark, path)[:1])
        publish(*args)
        raise RuntimeError("killed")

    monkeypatch.setattr(topic_log, "publish", one_file_only)
    with pytest.raises(RuntimeError):
        topic_log.append_once(topic_rows(spark, *"ghijkl"), root, "w", 1)
    monkeypatch.undo()
    read()
    assert 6 < len(seen) < 12
    topic_log.append_once(topic_rows(spark, *"ghijkl"), root, "w", 1)
    topic_log.append_once(topic_rows(spark, "never"), root, "w", 1)  # it is there already
    topic_log.append_once(topic_rows(spark), root, "w", 2)
    topic_log.append_once(topic_rows(spark, "m"), root, "w", 3)
    read()
    assert sorted(v for v, _ in seen) == list("abcdefghijklm")
    place = dict(seen)
    assert len(set(place.values())) == 13
    assert max(place[v] for v in "abcdef") < min(place[v] for v in "ghijkl") and place["m"] == max(place.values())


def test_repeats_in_a_message_log_are_dropped(spark, tmp_path):
    rows_ = topic_rows(spark, "a", "a", "b")
    first, again, later = (sorted(r.id for r in topic_log.identified(rows_, p).collect()) for p in (1, 1, 2))
    assert first == again and len(set(first)) == 3 and not set(first) & set(later)
    for k, part in enumerate((1, 1, 2)):
        topic_log.identified(rows_, part).withColumn("timestamp", F.timestamp_seconds(F.lit(k))).coalesce(1).write.parquet(str(tmp_path / "t" / f"{k}"))
    live = spark.readStream.schema("topic string, value string, id string, timestamp timestamp").option(
        "recursiveFileLookup", True).parquet(str(tmp_path / "t"))
    assert run(topic_log.drop_repeats(live), tmp_path, "repeats").count() == 6


# ---- arrival order over partitions -------------------------------------------------------

def test_ties_fall_the_same_way_over_partitions(spark, tmp_path):
    """Two partitions hold equal offsets of one device at one time: table and stream take the same first row."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "page").mkdir()
    for p in (1, 0):
        texts = [json.dumps({"common": {"mid": "a", "vc": f"{p}{k}"}, "page": {"page_id": "home"}, "ts": 5}) for k in range(3)]
        pq.write_table(pa.table({"value": texts, "offset": pa.array(range(3), pa.int64()), "partition": pa.array([p] * 3, pa.int32())}),
                       str(tmp_path / "page" / f"{p}.parquet"))
    batch = topics.read_topic(spark, "page", path=str(tmp_path), stream=False)
    assert [r.offset for r in batch.orderBy("offset").collect()] == [0, 1, 65536, 65537, 131072, 131073]
    found = visits.unique_visitor(clean.parse_page_log(batch, carry=("offset",))).collect()
    assert [r.common.vc for r in found] == ["00"]
    live = run(jobs.unique_visitor(topics.read_topic(spark, "page", path=str(tmp_path))), tmp_path, "ties")
    assert [json.loads(r.value)["common"]["vc"] for r in live.collect()] == ["00"]
    here = kept.unique_visitor(batch, str(tmp_path / "kept"), 0).collect()
    assert [json.loads(r.value)["common"]["vc"] for r in here] == ["00"]


# ---- routing from its feed -----------------------------------------------------------------

def route(after, ts, before=None):
    full = lambda t: t and {"source_table": t[0], "sink_table": t[1], "sink_columns": t[2], "sink_pk": "id", "sink_extend": None}
    return json.dumps({"before": full(before), "after": full(after), "op": "u", "ts_ms": ts})


def part_row(key, name, ts, table="part"):
    return change(table, ts, id=key, p_name=name, extra="x")


def test_dimensions_follow_the_routing_feed(spark, tmp_path):
    root, path = str(tmp_path / "dims"), str(tmp_path / "topics")
    part, nation = ("part", "dim_part", "id,p_name"), ("nation", "dim_nation", "id,p_name")
    snapshot = lambda s: s.createDataFrame([("part", "dim_part", "id,p_name", "id", None)], topics.TABLE_PROCESS)
    steps = iter(range(100))

    def step(log=(), feed=()):
        number = next(steps)
        for topic, texts in (("db", log), ("routing", feed)):
            write_chunks(tmp_path / f"in{number}", topic, [texts])
            (tmp_path / "topics" / topic).mkdir(parents=True, exist_ok=True)
            (tmp_path / f"in{number}" / topic / "part-00000.parquet").rename(tmp_path / "topics" / topic / f"{number}.parquet")
        query = runner.run_dim_from_feed(
            topics.read_topic(spark, "db", path=path), topics.read_topic(spark, "routing", path=path), root, snapshot,
            never=("orders",), trigger={"availableNow": True}, checkpoint=str(tmp_path / "ck"))
        assert query.awaitTermination(120) and query.exception() is None

    def dim(name):
        config = {"sink_table": name, "sink_columns": "id,p_name"}
        return {r.id: r.p_name for r in sinks.read_dim(spark, root, config).collect()}

    step([part_row("1", "a", 1), part_row("n1", "early", 1, "nation"), part_row("o", "never", 1, "orders"), "no json"])
    assert dim("dim_part") == {"1": "a"} and not (tmp_path / "dims" / "_table=dim_nation").exists()
    step([part_row("n2", "same batch", 2, "nation")], [route(nation, 10)])  # its routing row comes: what waited is written
    assert dim("dim_nation") == {"n1": "early", "n2": "same batch"}
    step([part_row("n1", "newer", 3, "nation")], [route(None, 20, part)])
    assert dim("dim_nation")["n1"] == "newer"
    step([part_row("1", "while gone", 4), part_row("2", "while gone", 4)])
    assert dim("dim_part") == {"1": "a"}  # no routing row any more
    step(feed=[route(part, 30), "broken"])
    assert dim("dim_part") == {"1": "while gone", "2": "while gone"}
    step([part_row("1", "b", 5)], [route(None, 40, nation), route(nation, 50)])
    assert dim("dim_part")["1"] == "b" and dim("dim_nation") == {"n1": "newer", "n2": "same batch"}
    held = spark.read.parquet(f"{root}/{runner.HELD}")
    assert held.where("table = 'orders'").count() == 0
