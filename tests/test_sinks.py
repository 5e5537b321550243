"""Sinks: topics, keyed tables, dimension tables, and the streaming dimension job."""

from __future__ import annotations

import json
import time

from pyspark.sql import functions as F

from streams import write_chunks
from tidemill.plans import dim, traffic
from tidemill.schemas import TABLE_PROCESS, TOPICS
from tidemill.session import shared_dir
from tidemill.sinks import tables as sinks
from tidemill.sources import tables as src, topics
from tidemill.streaming import runner

CONFIG = [dict(source_table="part", sink_table="dim_part", sink_columns="id,p_name", sink_pk=None, sink_extend=None)]


def config_frame(spark, rows=CONFIG):
    return spark.createDataFrame([tuple(r[c] for c in TABLE_PROCESS.names) for r in rows], TABLE_PROCESS)


def test_route_side_output_writes_each_topic_once(spark, tables, tmp_path):
    rows = traffic.base_log(src.raw_log(tables, damaged=True))
    for _ in range(2):  # the same batch again replaces itself
        sinks.route_side_output(rows, str(tmp_path / "out"), batch_id=0)
    want = {r.topic: r.n for r in rows.groupBy("topic").agg(F.count("*").alias("n")).collect()}
    assert set(want) == {TOPICS[t] for t in ("page", "start", "display", "action", "error", "dirty")}
    for topic, n in want.items():
        assert sinks.read_routed(spark, str(tmp_path / "out"), topic).count() == n


def test_topic_rows_name_their_topic(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    assert sinks.as_topic_rows(df, "t").collect()[0].asDict() == {"topic": "t", "value": '{"k":"a","n":1}'}


def test_upsert_keeps_the_latest(spark, tmp_path):
    path = str(tmp_path / "facts")
    make = lambda *rows: spark.createDataFrame(rows, "id string, v int, ts long")
    sinks.write_upsert(make(("a", 1, 1), ("a", 2, 2), ("b", 1, 1)), path, 0)
    sinks.write_upsert(make(("a", 3, 1)), path, 1)
    sinks.write_upsert(make(("a", 3, 1)), path, 1)
    got = sorted(tuple(r) for r in sinks.read_upsert(spark, path, ["id"], ["ts"]).collect())
    assert got == [("a", 3, 1), ("b", 1, 1)]
    read = lambda: sorted(tuple(r) for r in sinks.read_upsert(spark, path, ["id"], ["ts"]).collect())
    assert sinks.compact(spark, path, ["id"], ["ts"]) == 1
    assert read() == got and sinks.read_parts(spark, path).count() == 2  # the two batches are not read any more
    sinks.write_upsert(make(("b", 7, 0), ("c", 1, 1)), path, 2)
    assert read() == [("a", 3, 1), ("b", 7, 0), ("c", 1, 1)]
    assert sinks.compact(spark, path, ["id"], ["ts"]) == 2 == sinks.compact(spark, path, ["id"], ["ts"])
    assert read() == [("a", 3, 1), ("b", 7, 0), ("c", 1, 1)]


def test_readers_pass_over_an_unfinished_fold(spark, tmp_path):
    path = str(tmp_path / "facts")
    make = lambda *rows: spark.createDataFrame(rows, "id string, v int")
    sinks.write_upsert(make(("a", 1)), path, 0)
    make(("a", 9)).withColumn("batch", F.lit(0)).write.parquet(f"{path}/{sinks.FOLDS}/upto=0")
    (tmp_path / "facts" / sinks.FOLDS / "upto=0" / "_SUCCESS").unlink()
    assert [tuple(r) for r in sinks.read_upsert(spark, path, ["id"]).collect()] == [("a", 1)]


def test_folded_parts_are_removed_once_no_reader_needs_them(spark, tmp_path):
    """Over many batches the number of folders stays bounded and the table as it is; a young fold removes nothing."""
    path, want, most = str(tmp_path / "facts"), {}, 0
    folders = lambda: sinks.numbered(spark, path, "batch") + sinks.numbered(spark, f"{path}/{sinks.FOLDS}", "upto")
    assert sinks.drop_folded(spark, str(tmp_path / "nothing")) == []
    for batch in range(7):
        sinks.write_upsert(spark.createDataFrame([("a", batch), (f"k{batch}", batch)], "id string, v int"), path, batch)
        want |= {"a": batch, f"k{batch}": batch}
        if batch % 2:
            assert sinks.compact(spark, path, ["id"]) == batch
            assert sinks.drop_folded(spark, path) == []
            before = spark.read.parquet(f"{path}/batch={batch}")  # a reader that began before
            assert len(sinks.drop_folded(spark, path, 0)) >= 2 and sinks.drop_folded(spark, path, 0) == []
            assert before.schema.names == ["id", "v"]
        most = max(most, len(folders()))
        assert {r.id: r.v for r in sinks.read_upsert(spark, path, ["id"]).collect()} == want
    assert most <= 3


def test_keyed_topic_rows(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    got = sinks.as_topic_rows(df, "t", ["k"])
    assert got.first().asDict() == {"topic": "t", "key": '{"k":"a"}', "value": '{"k":"a","n":1}'}
    assert sinks.as_topic_rows(got) is got


def test_dims_of_one_batch_are_one_write(spark, tmp_path):
    """Tables with other columns, one repeated batch, a column that a table gets later, and a fold."""
    root = str(tmp_path)
    routed = lambda *rows: spark.createDataFrame(rows, "sink_table string, pk string, ts long, data map<string,string>")
    a, b = ({"sink_table": t, "sink_columns": c} for t, c in (("dim_a", "id,name"), ("dim_b", "id, size")))
    both = routed(("dim_a", "1", 1, {"id": "1", "name": "x"}), ("dim_b", "1", 1, {"id": "1", "size": "9"}))
    for _ in range(2):
        sinks.upsert_dim(both, [a, b], root, 0)
    a["sink_columns"] = "id,name,extra"
    sinks.upsert_dim(routed(("dim_a", "2", 2, {"id": "2", "name": "y", "extra": "e"})), [a, b], root, 1)
    read = lambda c: sorted(tuple(r) for r in sinks.read_dim(spark, root, c).collect())
    want = [("1", "x", None), ("2", "y", "e")]
    assert read(a) == want and read(b) == [("1", "9")]
    assert sinks.numbered(spark, sinks.dim_path(root, "dim_b"), "batch") == [-1, 0]  # no folder without changes
    assert sinks.compact_dim(spark, root, "dim_a", 1) == 1
    assert read(a) == want
    sinks.upsert_dim(routed(("dim_a", "1", 0, {"id": "1", "name": "z"})), [a, b], root, 2)
    assert read(a) == [("1", "z", None), ("2", "y", "e")] and read(b) == [("1", "9")]


def test_ensure_dim_table(spark, tmp_path):
    path = sinks.ensure_dim_table(spark, str(tmp_path), CONFIG[0])
    sinks.ensure_dim_table(spark, str(tmp_path), CONFIG[0])
    assert [f.name for f in spark.read.parquet(path).schema][:2] == ["id", "p_name"]
    assert sinks.read_dim(spark, str(tmp_path), CONFIG[0]).count() == 0


def test_dim_route_uses_default_key_and_prunes(spark, tables):
    routed = dim.dim_route(src.change_log(tables, "part"), config_frame(spark))
    assert {tuple(sorted(r.data)) for r in routed.limit(5).collect()} == {("id", "p_name")}
    assert routed.where("pk <> data['id'] or type = 'delete'").count() == 0


def change(key, name, ts, kind="update", table="part"):
    return json.dumps({"database": "shop", "table": table, "type": kind, "ts": ts, "data": {"id": key, "p_name": name, "x": 1}})


def test_dim_job_follows_its_config(spark, tmp_path):
    """A row added to the routing table takes effect with the next batch, a removed one as well."""
    root, conf = str(tmp_path / "dims"), {"rows": []}
    (tmp_path / "db").mkdir()
    records = topics.read_topic(spark, "db", path=str(tmp_path), max_per_batch=1)
    read_config = lambda s: config_frame(s, conf["rows"])
    options = dict(trigger={"availableNow": True}, checkpoint=str(tmp_path / "ck"), dirty_path=str(tmp_path / "dirty"))

    def feed(step, *values):
        write_chunks(tmp_path / f"in{step}", "db", [values])
        (tmp_path / f"in{step}" / "db" / "part-00000.parquet").rename(tmp_path / "db" / f"{step}.parquet")
        time.sleep(0.02)
        query = runner.run_dim(records, read_config, root, **options)
        assert query.awaitTermination(120) and query.exception() is None

    feed(0, change("1", "lost", 1, "insert"))               # no routing row yet
    conf["rows"] = CONFIG
    feed(1, change("2", "two", 2, "insert"), change("3", "x", 2, "delete"), change(None, None, 2, "bootstrap-start"), "{bad")
    feed(2, change("2", "second", 3), change("2", "older", 2), change("4", "four", 3, "bootstrap-insert"))
    conf["rows"] = []
    feed(3, change("4", "ignored", 4))
    got = {r.id: r.p_name for r in sinks.read_dim(spark, root, CONFIG[0]).collect()}
    assert got == {"2": "second", "4": "four"}
    dirty = sorted(r.value[:9] for r in sinks.read_routed(spark, str(tmp_path / "dirty"), TOPICS["dirty"]).collect())
    assert dirty == ['{"databas', "{bad"]


def test_config_change_feed(spark):
    row = lambda t, s: {"source_table": t, "sink_table": s, "sink_columns": "id"}
    feed = [
        {"before": None, "after": row("a", "dim_a"), "op": "r", "ts_ms": 1},
        {"before": row("a", "dim_a"), "after": row("a", "dim_a2"), "op": "u", "ts_ms": 2},
        {"before": None, "after": row("b", "dim_b"), "op": "c", "ts_ms": 2},
        {"before": row("b", "dim_b"), "after": None, "op": "d", "ts_ms": 3},
    ]
    records = spark.createDataFrame([(json.dumps(f), i) for i, f in enumerate(feed)], "value string, offset long")
    got = [(r.source_table, r.sink_table) for r in topics.config_from_changes(records).collect()]
    assert got == [("a", "dim_a2")]


def test_lookup_sources(spark, tmp_path):
    src.dictionary(spark).select(
        "dic_code", "dic_name", F.col("parent_code").cast("string").alias("parent_code"),
        F.col("create_time").cast("timestamp").alias("create_time"),
        F.col("operate_time").cast("timestamp").alias("operate_time"),
    ).write.parquet(str(tmp_path / "dic"))
    config_frame(spark).write.parquet(str(tmp_path / "conf"))
    assert topics.read_dictionary(spark, str(tmp_path / "dic")).count() == 4
    assert topics.read_dim_config(spark, str(tmp_path / "conf")).first().sink_table == "dim_part"


def test_shared_dir_prefers_the_session_setting(spark):
    class Conf:
        def get(self, key, default=None):
            return "hdfs://shared/x" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert shared_dir(Session()) == "hdfs://shared/x"
    assert shared_dir(spark).startswith("/tmp/")
