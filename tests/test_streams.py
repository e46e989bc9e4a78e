from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallygrid.functions import geo
from tallygrid.operators import counts as ct, layers, spatial as sp
from tallygrid.sources import files
from tallygrid.streaming import counts as sc, routing

from test_space_layers import EVENT, at

SCHEMA = "lat double, lng double, text string, ts timestamp"


@pytest.fixture
def landed(spark, path):
    """Messages in four files, so that a stream of one file per batch has four."""
    data = [(24.561 + i % 3, -81.799, f"bread w{i % 5} lol", at(f"2015-02-04 {10 + i % 4}:05:00"))
            for i in range(40)]
    folder = path("in")
    (spark.createDataFrame(data, SCHEMA).repartition(4, "text").coalesce(4)
     .write.parquet(folder))
    return folder


def stream(spark, folder, precision=2, per_batch=1):
    raw = sc.read_stream(spark, folder, SCHEMA, files_per_batch=per_batch)
    return geo.located(geo.with_cell(raw, precision=precision))


def batch(spark, folder, precision=2):
    return geo.located(geo.with_cell(spark.read.parquet(folder), precision=precision))


def test_batches_add_up_to_the_batch_job(spark, landed, path, rows):
    out = path()
    query = sc.micro_batch_counts(stream(spark, landed), out, path("state"), stop=["lol"])
    query.awaitTermination()
    assert len(routing.progress_rows(query)) >= 2
    assert rows(sc.sum_batches(spark, out)) == rows(ct.cell_counts(batch(spark, landed), stop=["lol"]))


def test_restart_reads_nothing_twice(spark, landed, path, rows):
    out, state = path(), path("state")
    for _ in range(2):
        sc.micro_batch_counts(stream(spark, landed), out, state).awaitTermination()
    assert rows(sc.sum_batches(spark, out)) == rows(ct.cell_counts(batch(spark, landed)))


def test_speed_rows_read_as_updates(spark, landed, path, rows):
    out = path()
    now = F.lit("2015-02-04 15:00:00").cast("timestamp")
    sc.micro_batches(stream(spark, landed, 3), out, path("state"), stamp=now).awaitTermination()
    speed = sc.read_speed(spark, out)
    assert {r.yymmddhh for r in speed.collect()} == {"15020415"}
    changed = layers.changes_since(speed, F.lit("2015-02-04 14:00:00").cast("timestamp"))
    assert "PartitionFilters: []" not in changed._jdf.queryExecution().executedPlan().toString()
    words, tweets = layers.updates(changed)
    whole = geo.coarsen(batch(spark, landed, 3))
    assert rows(words) == rows(ct.cell_counts(whole))
    assert rows(tweets) == rows(ct.cell_messages(whole))


def test_old_hours_of_the_speed_layer_expire(spark, landed, path):
    out = path()
    stamps = lambda batch: F.lit(f"2015-02-04 1{batch}:00:00").cast("timestamp")
    query = sc.micro_batches(stream(spark, landed, 3), out, path("state"), stamp=stamps)
    query.awaitTermination()
    assert max(rows for _, rows in routing.progress_rows(query)) <= 40  # a batch is read once
    hours = sorted({r.yymmddhh for r in sc.read_speed(spark, out).collect()})
    assert len(hours) >= 2
    assert files.expire_buckets(spark, out, hours[0]) == [f"yymmddhh={hours[0]}"]
    assert sorted({r.yymmddhh for r in sc.read_speed(spark, out).collect()}) == hours[1:]


def test_a_running_trigger(spark, landed, path, rows):
    out = path()
    query = sc.micro_batch_counts(stream(spark, landed), out, path("state"), every=sc.BATCH_SECONDS)
    query.processAllAvailable()
    query.stop()
    assert rows(sc.sum_batches(spark, out)) == rows(ct.cell_counts(batch(spark, landed)))


def test_event_time_equals_batch(spark, landed, path, rows):
    out = path()
    windows = sc.hour_windows(stream(spark, landed), delay="1 day")
    sc.event_hours(windows, out, path("state")).awaitTermination()
    hours = batch(spark, landed).withColumn("hour", F.date_trunc("hour", "ts"))
    want = ct.cell_counts(hours, ["hour", *ct.CELL])
    assert rows(sc.latest_windows(spark, out)) == rows(want)


def test_a_batch_uploads_the_changes_of_its_state(spark, landed, path, rows):
    out, state = path(), path("state")
    for _ in range(2):  # the second run goes on from what the first one stored
        sc.event_hours(sc.hour_windows(stream(spark, landed), delay="1 day"), out, state).awaitTermination()
    names = [f.name for f in Path(state, "state").rglob("*") if f.is_file()]
    assert any(n.endswith(".changelog") for n in names) and not any(n.endswith(".zip") for n in names)
    want = ct.cell_counts(batch(spark, landed).withColumn("hour", F.date_trunc("hour", "ts")), ["hour", *ct.CELL])
    assert rows(sc.latest_windows(spark, out)) == rows(want)


def test_routing(spark, landed, path):
    events = spark.createDataFrame([("e", 24.56, -81.80, at("2015-02-04 10:00:00"),
                                     at("2015-02-04 11:00:00"))], EVENT)
    out = path()
    raw = sc.read_stream(spark, landed, SCHEMA, files_per_batch=2)
    routing.route_live(raw, lambda: events, routing.to_files(out), path("state")).awaitTermination()
    sent = spark.read.schema("text string, lat double").json(out)
    want = sp.messages_in_boxes(spark.read.parquet(landed), events)
    assert sent.count() == want.count() > 0
    assert routing.in_boxes(spark.read.parquet(landed), [(24.0, 25.0, -82.0, -81.0)]).count() == 14
