import json

import pytest
from pyspark.sql import functions as F

from tallygrid.sources import queue as qu

def now():
    return F.lit("2015-02-04 12:00:00").cast("timestamp")


def message(i):
    body = {"id": i + 1, "text": f"text {i}\nline", "timestamp_ms": str(1423000000000 + i * 3_600_000)}
    if i % 3:
        body["geo"] = {"coordinates": [24.5 + i, -81.25]}
    return json.dumps(body if i % 10 else {"delete": {"status": {"id": i}}})


@pytest.fixture
def queue(spark, path):
    """Two partitions of 40 and 25 messages in segments of eight."""
    folder = path("queue")
    for part, span in ((0, range(0, 40)), (1, range(100, 125))):
        rows = spark.createDataFrame([(i, message(i)) for i in span], "n int, value string")
        qu.append_messages(spark, rows, folder, ["n"], part, segment_rows=8)
    return folder


def run(spark, queue, out, **how):
    return qu.drain(spark, queue, out, "g", now(), 7, segment_rows=8, **how)


def result(spark, out, rows):
    log = rows(qu.read_log(spark, out), "batch_id", "group_name", "k_partition", "k_offset")
    return rows(qu.read_flat(spark, out)), rows(qu.read_geo(spark, out)), log


def test_offsets_follow_on(spark, queue):
    assert qu.end_offsets(spark, queue) == {0: 40, 1: 25}
    more = spark.createDataFrame([(i, message(i)) for i in range(3)], "n int, value string")
    qu.append_messages(spark, more, queue, ["n"], 1, segment_rows=8)
    assert qu.end_offsets(spark, queue) == {0: 40, 1: 28}
    got = qu.read_queue(spark, queue).where("k_partition = 1").orderBy("k_offset").collect()
    assert [r["k_offset"] for r in got] == list(range(28)) and got[26]["value"] == message(1)


def test_a_range_opens_its_segments_only(spark, queue):
    part = qu.read_range(spark, queue, {0: 9, 1: 20}, {0: 18, 1: 25}, segment_rows=8)
    assert sorted((r["k_partition"], r["k_offset"]) for r in part.collect()) == [
        *((0, i) for i in range(9, 18)), *((1, i) for i in range(20, 25))]
    opened = {r[0].split("queue-")[1].split("/", 1)[1].rsplit("/", 1)[0]
              for r in part.select(F.input_file_name()).distinct().collect()}
    assert opened == {"k_partition=0/segment=1", "k_partition=0/segment=2", "k_partition=1/segment=2",
                      "k_partition=1/segment=3"}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(((k_partition" in plan and "PushedFilters: [Or(" in plan


def test_a_stopped_drain_goes_on(spark, queue, path, rows):
    whole, stopped = path("whole"), path("stopped")
    assert run(spark, queue, whole) == [0, 1, 2, 3, 4, 5]
    assert run(spark, queue, stopped, most_batches=2) == [0, 1]
    assert run(spark, queue, stopped, most_batches=1) == [2]
    assert run(spark, queue, stopped) == [3, 4, 5]
    assert run(spark, queue, stopped) == []
    assert result(spark, stopped, rows) == result(spark, whole, rows)
    flat = qu.read_flat(spark, whole)
    assert flat.count() == flat.select("id").distinct().count() == 58
    assert len(flat.columns) == 36


@pytest.mark.parametrize("broken", ["_log", "files.export_delimited"])
def test_a_batch_that_failed_counts_once(spark, queue, path, rows, monkeypatch, broken):
    """The job ends between a batch's files, or between files and log; the queue has grown when
    it is run again."""
    out, whole = path("out"), path("whole")
    run(spark, queue, out, most_batches=1)

    def fail(*_):
        raise RuntimeError("stopped")

    owner, name = (qu.files, "export_delimited") if "." in broken else (qu, broken)
    with monkeypatch.context() as m:
        m.setattr(owner, name, fail)
        with pytest.raises(RuntimeError):
            run(spark, queue, out)
    before = len(qu.logged(spark, out, "flat"))
    assert before == 1 and qu.read_geo(spark, out).select("batch_id").distinct().count() == 1
    more = spark.createDataFrame([(i, message(i)) for i in range(200, 230)], "n int, value string")
    qu.append_messages(spark, more, queue, ["n"], 1, segment_rows=8)
    run(spark, queue, out)
    run(spark, queue, whole)
    assert result(spark, out, rows)[0] == result(spark, whole, rows)[0]
    assert rows(qu.read_geo(spark, out), "value", "day") == rows(qu.read_geo(spark, whole), "value", "day")


def test_an_empty_queue(spark, path):
    assert qu.drain(spark, path("none"), path("out"), "g", now()) == []


def test_a_full_segment_is_no_single_task(spark, path, monkeypatch):
    """Wide messages are ordered in parts of so many bytes, and the parts of a segment stay apart."""
    folder, ordered = path("queue"), qu.ordered_ids
    monkeypatch.setattr(qu, "ordered_ids", lambda *a, **k: ordered(*a, **k, part_bytes=20_000))
    monkeypatch.setattr(qu, "SEGMENT_ROWS", 1000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows = spark.range(0, 400).select(F.col("id").alias("n"), F.concat(*[
            F.md5(F.concat("id", F.lit(f"-{i}"))) for i in range(16)]).alias("value"))
        qu.append_messages(spark, rows, folder, ["n"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = qu.read_queue(spark, folder)
    assert len(got.inputFiles()) > 4 and got.select("segment").distinct().count() == 1
    assert qu.end_offsets(spark, folder) == {0: 400}
    want = rows.select(F.col("n").alias("k_offset"), "value")
    assert got.select("k_offset", "value").exceptAll(want).isEmpty() and got.count() == 400
