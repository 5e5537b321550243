"""Restarts without a checkpoint, mixed scripts, bad time texts, days out of order, rows without a device."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from tidemill import session
from tidemill.functions import keywords, times
from streams import rows, run, write_chunks
from tidemill.operators import dedup, visits
from tidemill.plans import metrics, traffic
from tidemill.sinks import tables as sinks
from tidemill.sources import topics
from tidemill.streaming import jobs, processors, runner


def _run_once(spark, source, table, checkpoint):
    stream = spark.readStream.schema("id long, v string, ts long").parquet(source)
    runner.start(stream, "repair", runner.to_table(table), {"availableNow": True}, checkpoint).awaitTermination()


def test_lost_checkpoint_loses_no_rows(spark, tmp_path, monkeypatch):
    table, first, second = (str(tmp_path / n) for n in ("table", "first", "second"))
    clock = iter([1_000, 2_000])
    monkeypatch.setattr(runner.time, "time", lambda: next(clock, 3_000))
    write = lambda rows, name: spark.createDataFrame(rows, "id long, v string, ts long").write.parquet(str(tmp_path / name))
    write([(1, "old", 9), (2, "kept", 9)], "a")
    write([(1, "new", 1), (3, "added", 1)], "b")
    _run_once(spark, str(tmp_path / "a"), table, first)
    _run_once(spark, str(tmp_path / "a"), table, first)  # an ordinary restart repeats nothing
    _run_once(spark, str(tmp_path / "b"), table, second)  # the first checkpoint is gone
    got = {r.id: r.v for r in sinks.read_upsert(spark, table, ["id"], ["ts"]).collect()}
    assert got == {1: "new", 2: "kept", 3: "added"}
    assert runner.run_number(spark, first) == 1_000 and runner.run_number(spark, second) == 2_000


def test_cluster_must_name_its_folder(spark):
    class Context:
        master, applicationId = "spark://somewhere:7077", "a"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context

    with pytest.raises(ValueError):
        session.shared_dir(Session())
    assert session.shared_dir(spark) == session.shared_dir(spark)


def test_mixed_scripts_are_cut_where_the_script_changes(spark):
    rows = spark.createDataFrame([("512GB 5G手机 Banana手机壳 㐀㐁x",), (None,)], "text string")
    got = keywords.explode_words(rows, "text", splitter=keywords.word_list_split(["手机", "手机壳", "㐀㐁"]))
    assert [r.word for r in got.collect()] == ["512gb", "5g", "手机", "banana", "手机壳", "㐀㐁", "x"]


def test_bad_time_text_is_null(spark):
    rows = spark.createDataFrame([("2022-03-04 05:06:07",), ("not a time",), (None,)], "t string")
    got = [r[0] for r in rows.select(F.date_format(times.text_time("t"), times.SECOND)).collect()]
    assert got == ["2022-03-04 05:06:07", None, None]


def test_a_day_behind_a_later_one_counts(spark):
    class Handle:
        state = None

        def getValueState(self, *_):
            return self

        def exists(self):
            return self.state is not None

        def get(self):
            return self.state

        def update(self, value):
            self.state = value

    from pyspark.sql import Row

    keeper = processors.DayFirst()
    keeper.init(Handle())
    row = lambda day, offset: Row(time=day, offset=offset, day=day, carry="", ts=0)
    send = lambda *rows: [(r.day, r.prev_day) for r in keeper.handleInputRows(("k",), iter(rows), None)]
    assert send(row("2024-05-03", 1)) == [("2024-05-03", None)]
    assert send(row("2024-05-01", 2), row("2024-05-03", 3)) == [("2024-05-01", None)]
    assert send(row("2024-05-02", 4), row("2024-05-01", 5)) == [("2024-05-02", "2024-05-01")]
    assert send(row("2024-07-01", 6)) == [("2024-07-01", "2024-05-03")]
    assert send(row("2024-05-04", 7)) == []  # later than the documented bound


def test_rows_without_a_device_keep_their_flag(spark):
    day = 86_400_000
    marks = spark.createDataFrame(
        [(None, 0, "1", (0, 1, "0")), (None, 5 * day, "1", (5 * day, 2, "1")), ("m", 0, "1", (0, 3, "1")),
         ("m", 5 * day, "1", (5 * day, 4, "1"))],
        "mid string, cell long, is_new string, first_log struct<ts:long,offset:long,is_new:string>",
    ).withColumn("first_start", F.lit(None).cast("struct<ts:long,offset:long>"))
    got = {(r.mid, r.cell): r.is_new for r in visits.visit_counts(marks).collect()}
    assert got == {(None, 0): "1", (None, 5 * day): "1", ("m", 0): "1", ("m", 5 * day): "0"}


def test_orders_without_a_user_add_amounts_only(spark):
    wide = spark.createDataFrame(
        [("1", "o1", "u", "5"), ("2", "o2", None, "7"), ("3", "o3", None, None)],
        "order_detail_id string, order_id string, user_id string, original_total_amount string",
    ).selectExpr(
        "*", "'insert' as type", "timestamp_seconds(0) as ts", "'2024-01-01 00:00:01' as order_create_time",
        *[f"cast(null as string) as {c}" for c in (*metrics.DETAIL_TIES, "activity_reduce_amount", "coupon_reduce_amount")],
    )
    got = metrics.order_window(wide).first()
    assert (got.order_unique_user_count, got.order_new_user_count, got.order_original_total_amount) == (1, 1, 12.0)


# (key, second, kept): every copy renews the five seconds; 300 is where a slice ends
BURSTS = [("a", 0, True), ("a", 4, False), ("a", 8, False), ("a", 14, True), ("b", 8, True), ("b", 296, True),
          ("b", 300, False), ("b", 304, False), ("b", 310, True)]


def _paid(spark, found):
    rows = [(k, f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}") for k, s, *_ in found]
    return spark.createDataFrame(rows, "k string, t string")


def test_sliding_duplicates(spark, tmp_path):
    every = [*BURSTS, ("a", 0, False)]
    extra = spark.createDataFrame([(None, "2024-01-01 00:00:00"), ("c", "no time")], "k string, t string")
    table = _paid(spark, every).unionByName(extra)
    want = rows(_paid(spark, [b for b in BURSTS if b[2]]))
    assert rows(dedup.keep_first_sliding(table, ["k"], times.text_time("t"))) == want
    for i in range(3):  # on a stream, in time order over three batches
        part = sorted(every, key=lambda r: r[1])[i * 4:i * 4 + 4]
        _paid(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = spark.readStream.schema("k string, t string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    once = jobs.first_of_burst(live, F.col("k"), times.text_time("t"), F.struct("k", "t"), "struct<k:string,t:string>")
    assert rows(run(once.select("carry.*"), tmp_path, "bursts")) == want


def test_stream_leaves_rows_without_a_device_alone(spark, tmp_path):
    day = 86_400_000
    log = lambda mid, ts: (
        '{"common":{%s"is_new":"1"},"page":{"page_id":"home","during_time":1},"ts":%d}' % (f'"mid":"{mid}",' if mid else "", ts))
    values = [log("m", 0), log(None, 0), "{bad", log("m", 3 * day), log(None, 3 * day), log(None, 3 * day)]
    write_chunks(tmp_path, "log", [values[:3], values[3:]])
    records = lambda **where: topics.read_topic(spark, "log", path=str(tmp_path), **where)
    got = rows(run(jobs.base_log(records(max_per_batch=1)), tmp_path, "nobody"))
    assert got == rows(traffic.base_log(records(stream=False)))
    assert sum('"is_new":"0"' in value for _, value in got) == 1 and len(got) == 6


def test_jumps_of_a_busy_device_are_judged_in_one_pass(spark):
    from pyspark.sql import Row

    class State(list):
        reads = 0

        def get(self):
            self.reads += 1
            return self

        def appendValue(self, value):
            self.append(Row("ts", "offset", "is_start", "own", "value")(*value))

        def put(self, values):
            self[:] = [Row("ts", "offset", "is_start", "own", "value")(*v) for v in values]

        def exists(self):
            return bool(self)

        def update(self, value):
            self[:] = [*value]

    class Handle:
        rows, judged, timers = State(), State(), []

        def getListState(self, *_):
            return self.rows

        def getValueState(self, *_):
            return self.judged

        def registerTimer(self, at):
            self.timers.append(at)

    class Clock:
        def getCurrentWatermarkInMs(self):
            return 1_000_000

    class Info:
        def __init__(self, at):
            self.getExpiryTimeInMs = lambda: at

    jump, handle = processors.Jump(10), Handle()
    jump.init(handle)
    make = Row("ts", "offset", "is_start", "own", "value")
    list(jump.handleInputRows(("m",), iter([make(k, k, True, True, str(k)) for k in range(0, 1_000_020, 20)]), None))
    out = [r.ts for at in sorted(handle.timers) if at <= 1_000_000 for r in jump.handleExpiredTimer(("m",), Clock(), Info(at))]
    assert out == list(range(0, 1_000_000, 20)) and handle.rows.reads == 1
    assert [r.ts for r in handle.rows] == [1_000_000]
