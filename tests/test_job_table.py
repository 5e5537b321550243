"""Jobs started by name, linked by topics, with lookups as they are at each micro-batch."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from streams import write_chunks
from tidemill import catalog
from tidemill.schemas import TOPICS
from tidemill.sources import tables as src
from tidemill.streaming import job_table
from test_sinks import CONFIG, config_frame

LATE = 4_102_444_800


def place_of(tmp_path, dictionary, dims, **more):
    return job_table.Place(
        tables=str(tmp_path / "tables"), dictionary=dictionary, dims=dims, path=str(tmp_path / "topics"), **more)


def run_job(spark, tmp_path, name, place):
    query = job_table.start_job(spark, name, place, trigger={"availableNow": True}, checkpoint=str(tmp_path / "ck" / name))
    assert query.awaitTermination(120) and query.exception() is None


def put(tmp_path, topic, step, *values):
    write_chunks(tmp_path / f"in{step}{topic}", "t", [values])
    folder = tmp_path / "topics" / f"topic={topic}"
    folder.mkdir(parents=True, exist_ok=True)
    (tmp_path / f"in{step}{topic}" / "t" / "part-00000.parquet").rename(folder / f"{step}.parquet")


def values(spark, tmp_path, topic):
    return [json.loads(r.value) for r in spark.read.parquet(str(tmp_path / "topics" / f"topic={topic}")).collect()]


def cart(key, source, ts):
    return json.dumps({"database": "shop", "table": "cart_info", "type": "insert", "ts": ts, "data": {
        "id": key, "user_id": "u" + key, "sku_num": "1", "source_type": source, "create_time": "2024-01-01 00:00:00"}})


def test_a_new_code_is_seen_by_the_next_batch(spark, tmp_path):
    codes = [("A", "first")]
    dictionary = lambda s: s.createDataFrame(codes, "dic_code string, dic_name string")
    place = place_of(tmp_path, dictionary, None)
    put(tmp_path, TOPICS["db"], 0, cart("1", "A", 1), cart("2", "B", 1))
    run_job(spark, tmp_path, "cart_add", place)
    codes.append(("B", "second"))
    put(tmp_path, TOPICS["db"], 1, cart("3", "B", 2))
    run_job(spark, tmp_path, "cart_add", place)
    got = {r["id"]: r["dic_name"] for r in values(spark, tmp_path, TOPICS["cart_add"])}
    assert got == {"1": "first", "3": "second"}
    run_job(spark, tmp_path, "cart_uu_window", place)  # the next job reads what this one wrote


def detail(key, province, second):
    return json.dumps({
        "order_detail_id": key, "order_id": "o" + key, "user_id": "u", "province_id": province, "type": "insert",
        "split_total_amount": "2.00", "order_create_time": second, "ts": "2024-01-01T00:00:00.000Z"})


def test_a_new_dimension_row_is_seen_by_the_next_batch(spark, tmp_path):
    rows = [("1", "north")]
    place = place_of(tmp_path, None, lambda s: {"province": s.createDataFrame(rows, "id string, name string")})
    topic = job_table.SETTLED
    put(tmp_path, topic, 0, detail("1", "1", "2024-01-01 00:00:01"), detail("2", "2", "2024-01-01 00:00:02"))
    put(tmp_path, topic, 1, detail("3", "2", "2024-01-01 00:01:00"))
    run_job(spark, tmp_path, "province_window", place)
    rows.append(("2", "south"))
    put(tmp_path, topic, 2, detail("end", "1", "2100-01-01 00:00:00"))
    run_job(spark, tmp_path, "province_window", place)
    found = spark.read.parquet(str(tmp_path / "tables" / "province_window")).collect()
    got = {(r.stt[-8:], r.province_id): r.province_name for r in found}
    assert got == {("00:00:00", "1"): "north", ("00:00:00", "2"): None, ("00:01:00", "2"): "south"}


def test_refunds_by_user_are_those_of_the_table(spark, tables, tmp_path):
    rows = catalog.order_refund(tables).select("id", "user_id", "sku_id", "create_time")
    texts = [r[0] for r in rows.orderBy("create_time").select(F.to_json(F.struct("*"))).collect()]
    place = place_of(tmp_path, None, lambda s: src.dimensions(tables))
    topic = TOPICS["order_refund"]
    put(tmp_path, topic, 0, *texts[:len(texts) // 2])
    put(tmp_path, topic, 1, *texts[len(texts) // 2:], *texts[-3:])  # some come twice
    put(tmp_path, topic, 2, json.dumps({"id": "end", "user_id": "u", "sku_id": "1", "create_time": "2100-01-01 00:00:00"}))
    run_job(spark, tmp_path, "refund_window_by_user", place)
    found = spark.read.parquet(str(tmp_path / "tables" / "refund_window_by_user")).drop("batch")
    want = catalog.refund_window_by_user(tables).select(found.columns)
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty() and not found.isEmpty()


def inputs(tmp_path, name):
    for topic in {TOPICS["db"]} if name == "dim" else {topic for _, topic in job_table.JOBS[name].inputs}:
        put(tmp_path, topic, 0, "", "{}")


def test_every_job_is_wired(spark, tables, tmp_path):
    """Streams fit the rows of each job, and lookups the rows of a batch."""
    place = place_of(tmp_path, src.dictionary, lambda s: src.dimensions(tables))
    for name, job in job_table.JOBS.items():
        (tmp_path / name).mkdir()
        inputs(tmp_path / name, name)
        here = place_of(tmp_path / name, None, None)
        streams = []
        for read, topic in job.inputs:
            folder, where = here.source(topic)
            streams.append(read(spark, folder, **where))
        rows = job.rows(*streams)
        assert rows.isStreaming, name
        batch = spark.createDataFrame([], rows.schema)
        done = job.keep(batch, place, str(tmp_path / name / "kept"), 0) if job.keep else batch
        done = job.finish(done, place) if job.finish else done
        assert set(job.keys) <= set(done.columns), name
        assert done.isEmpty(), name


@pytest.mark.parametrize("name", ["dim", "settled_details", "sku_details", "spu_order_window", "traffic_window", "unique_visitor"])
def test_jobs_start(spark, tables, tmp_path, name):
    inputs(tmp_path, name)
    place = place_of(tmp_path, src.dictionary, lambda s: src.dimensions(tables), config=lambda s: config_frame(s, CONFIG))
    if name == "settled_details":  # its timers follow the clock, so it never has nothing to do
        query = job_table.start_job(spark, name, place, checkpoint=str(tmp_path / "ck"))
        query.awaitTermination(10)
        query.stop()
        assert query.exception() is None
    else:
        run_job(spark, tmp_path, name, place)
