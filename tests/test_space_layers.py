import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallygrid.operators import counts as ct, layers, spatial as sp, summary as su

CELL = list(ct.CELL)
EVENT = ("eb_id string, latitude double, longitude double, start_time_utc timestamp, "
         "end_time_utc timestamp")
MESSAGE = "id int, lat double, lng double, ts timestamp"


def at(text):
    return dt.datetime.fromisoformat(text)


def test_box_join_borders(spark):
    events = spark.createDataFrame(
        [("e", 37.0, -122.0, at("2015-02-04 10:00:00"), at("2015-02-04 11:00:00")),
         ("online", None, None, at("2015-02-04 00:00:00"), at("2015-02-05 00:00:00"))], EVENT)
    messages = spark.createDataFrame([
        (1, 37.05, -122.05, at("2015-02-04 09:30:00")),
        (2, 37.051, -122.0, at("2015-02-04 10:00:00")),
        (3, 37.0, -122.0, at("2015-02-04 11:31:00")),
        (4, 37.0, -122.0, at("2015-02-04 11:30:00"))], MESSAGE)
    got = sorted(r.id for r in sp.messages_in_boxes(messages, events).collect())
    assert got == [1, 4]


@pytest.mark.parametrize("slot", [3_600, 86_400])
def test_box_join_equals_brute_force(spark, slot):
    rng = random.Random(3)
    start = at("2015-02-01 00:00:00")

    def when():
        return start + dt.timedelta(minutes=rng.randint(0, 6000))

    # A third of the events and of the messages sit at one venue.
    def place():
        return (37.0, -122.0) if rng.random() < 0.33 else (
            37 + rng.randint(-40, 40) / 100, -122 + rng.randint(-40, 40) / 100)

    events = []
    for i in range(120):
        s = when()
        events.append((str(i), *place(), s, s + dt.timedelta(minutes=rng.randint(0, 2000))))
    messages = [(i, *place(), when()) for i in range(300)]
    h, slack = 0.05, dt.timedelta(minutes=30)
    want = sorted(i for i, la, ln, t in messages if any(
        a - h <= la <= a + h and b - h <= ln <= b + h and s - slack <= t <= e + slack
        for _, a, b, s, e in events))
    joined = sp.messages_in_boxes(spark.createDataFrame(messages, MESSAGE),
                                  spark.createDataFrame(events, EVENT), slot_seconds=slot)
    got = sorted(r.id for r in joined.collect())
    assert got == want and 0 < len(want) < 300


def test_dense_bins_are_split(spark):
    """Many boxes with borders of their own in one bin: rows as before, few boxes to a message."""
    rng = random.Random(5)
    start = at("2015-02-04 00:00:00")
    events = []
    for i in range(3000):
        s = start + dt.timedelta(minutes=rng.randint(0, 1000))
        events.append((str(i), 37.05 + rng.random() / 10, -122.05 + rng.random() / 10, s,
                       s + dt.timedelta(minutes=rng.randint(0, 40))))
    messages = [(i, 37 + rng.random() / 5, -122.1 + rng.random() / 5,
                 start + dt.timedelta(minutes=rng.randint(0, 1500))) for i in range(400)]
    messages += [(400 + i, e[1] + d, e[2] - d, e[3]) for i, e in enumerate(events[:40]) for d in (-0.05, 0.05)]
    events += [("copy", *events[0][1:])]
    h, slack = 0.05, dt.timedelta(minutes=0)
    want = sorted(i for i, la, ln, t in messages if any(
        a - h <= la <= a + h and b - h <= ln <= b + h and s - slack <= t <= e + slack
        for _, a, b, s, e in events))
    df = spark.createDataFrame(messages, MESSAGE)
    boxes = spark.createDataFrame(events, EVENT)
    for most in (100, 5000):
        got = sorted(r.id for r in sp.messages_in_boxes(df, boxes, slack="0 minutes", most=most).collect())
        assert got == want and 0 < len(want) < len(messages)


def test_a_message_meets_few_boxes(spark):
    n, most = 6_000, 400
    one = spark.range(n).select(
        *[(F.lit(10.0) + F.pmod(F.xxhash64(F.col("id") + k), F.lit(10 ** 6)) / 10 ** 7).alias(c)
          for k, c in ((0, "south"), (10 ** 6, "west"))], F.lit(0).cast("bigint").alias("_from"),
        F.lit(9).cast("bigint").alias("_to"), F.lit(0).cast("bigint").alias("_slot"))
    one = one.withColumns({"north": F.col("south") + 0.1, "east": F.col("west") + 0.1,
                           "_row": F.lit(100).cast("bigint"), "_col": F.lit(100).cast("bigint")})
    listed, levels = sp.split_dense(one, 0.05, most)
    per_cell = listed.groupBy(*sp.CELL).agg(
        F.count_if(F.col("north") < sp.WORLD).alias("boxes"), F.count_if(F.col("north") >= sp.WORLD).alias("spans"))
    worst = per_cell.agg(F.max("boxes"), F.max("spans"), F.count(F.lit(1))).first()
    assert worst[0] <= most and worst[1] <= 1 and worst[2] > 30 and 1 < len(levels) <= sp.DEEPEST + 1
    # a cell with a listing has none above it
    above = listed.select(*sp.CELL).distinct().alias("a")
    for up in levels[1:]:
        shifted = above.where(F.col("_level") >= up).select(
            (F.col("_level") - up).alias("_level"), F.shiftright("_row", up).alias("_row"),
            F.shiftright("_col", up).alias("_col"), "_slot")
        assert shifted.join(above, sp.CELL, "left_semi").isEmpty()


def test_boxes_in_covered_cells_go(spark):
    """What is left to compare with lies along the outline of all boxes."""
    n = 2000
    one = spark.range(n).select(
        *[(F.lit(10.0) + F.pmod(F.xxhash64(F.col("id") + k), F.lit(10 ** 6)) / 10 ** 7).alias(c)
          for k, c in ((0, "south"), (10 ** 6, "west"))],
        (F.col("id") % 2 * 20).alias("_from"), (F.col("id") % 2 * 20 + 9).alias("_to"),
        F.lit(0).cast("bigint").alias("_slot"))
    one = one.withColumns({"north": F.col("south") + 0.1, "east": F.col("west") + 0.1,
                           "_row": F.lit(100).cast("bigint"), "_col": F.lit(100).cast("bigint")})
    assert sp.split_dense(one, 0.05, 100)[0].count() < 3 * n


def seen(monkeypatch, frame, name, which):
    """Frames that a method was called on."""
    plain, found = getattr(type(frame), name), []

    def noted(self, *args, **kw):
        if which in self.columns:
            found.append(self)
        return plain(self, *args, **kw)

    monkeypatch.setattr(type(frame), name, noted)
    return found


def test_split_bins_do_not_repeat_messages(spark, monkeypatch):
    """A message goes to the join once, however many levels there are."""
    events = spark.range(600).select(
        (37 + F.pmod("id", F.lit(29)) / 290).alias("latitude"), (F.pmod("id", F.lit(31)) / 310 - 122).alias("longitude"),
        *[(F.lit(at("2015-02-04 00:00:00")) + F.make_dt_interval(mins=F.pmod("id", F.lit(7)) * 60 + m)).alias(c)
          for c, m in (("start_time_utc", 0), ("end_time_utc", 30))])
    messages = spark.range(500).select(
        "id", (37 + F.pmod("id", F.lit(41)) / 200).alias("lat"), (F.pmod("id", F.lit(43)) / 200 - 122).alias("lng"),
        (F.lit(at("2015-02-04 00:00:00")) + F.make_dt_interval(mins=F.col("id"))).alias("ts"))
    met = seen(monkeypatch, messages, "join", "_mrow")
    got = {r.id for r in sp.messages_in_boxes(messages, events, slack="0 minutes", most=20).collect()}
    assert met and {f.count() for f in met} == {500}
    boxes = events.collect()
    assert got == {m.id for m in messages.collect() if any(
        e.latitude - .05 <= m.lat <= e.latitude + .05 and e.longitude - .05 <= m.lng <= e.longitude + .05
        and e.start_time_utc <= m.ts <= e.end_time_utc for e in boxes)}


def test_sparse_events_are_listed_once_or_twice(spark, monkeypatch):
    """Bins and slots suit the events: few rows each, and the same messages."""
    rng = random.Random(8)
    start, h, slack = at("2015-02-01 00:00:00"), 0.05, dt.timedelta(minutes=30)
    events = []
    for i in range(2000):
        s = start + dt.timedelta(minutes=rng.randint(0, 300_000))
        events.append((str(i), 30 + rng.randint(0, 15_000) / 1000, -120 + rng.randint(0, 19) / 100, s,
                       s + dt.timedelta(days=rng.randint(0, 5))))
    events += [("backward", 37.0, -120.0, start + dt.timedelta(days=9), start), ("endless", 37.0, -120.0, start, None)]
    messages = [(i, 30 + rng.randint(0, 16_000) / 1000, -120 + rng.randint(-8, 27) / 100,
                 start + dt.timedelta(minutes=rng.randint(0, 300_000))) for i in range(600)]
    messages += [(600 + i, e[1] + d, e[2] - d, e[4] + slack) for i, e in enumerate(events[:60]) for d in (-h, h)]
    messages += [(900, None, -120.0, start), (901, 37.0, -120.0, None)]
    df = spark.createDataFrame(messages, MESSAGE)
    listed = seen(monkeypatch, df, "hint", "south")
    got = sorted(r.id for r in sp.messages_in_boxes(df, spark.createDataFrame(events, EVENT)).collect())
    want = sorted(i for i, la, ln, t in messages if None not in (la, t) and any(
        e and a - h <= la <= a + h and b - h <= ln <= b + h and s - slack <= t <= e + slack
        for _, a, b, s, e in events))
    assert got == want and 120 <= len(want) < len(messages)
    assert len(listed) == 1 and listed[0].count() < 3 * len(events)


def test_listed_boxes_are_not_broadcast(spark, path):
    places = path()
    spark.createDataFrame([("e", 37.0, -122.0, at("2015-02-04 10:00:00"), at("2015-02-04 11:00:00"))],
                          EVENT).write.parquet(places)
    messages = spark.createDataFrame([(1, 37.0, -122.0, at("2015-02-04 10:30:00"))], MESSAGE)
    joined = sp.messages_in_boxes(messages, spark.read.parquet(places))
    assert joined.count() == 1
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_box_join_plan(spark):
    events = spark.createDataFrame([], EVENT)
    messages = spark.createDataFrame([], MESSAGE)
    plan = sp.messages_in_boxes(messages, events)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "LeftSemi" in plan


def test_box_requests_are_bounded(spark):
    boxes = spark.range(25).select(F.col("id").cast("string").alias("eb_id"),
                                   F.concat(F.lit("b"), "id").alias("box"))
    got = sp.box_requests(boxes, 10).collect()
    assert sorted(len(r.boxes.split(",")) for r in got) == [5, 10, 10]
    assert sorted(",".join(r.boxes for r in got).split(",")) == sorted(f"b{i}" for i in range(25))


def test_region_counts(spark):
    cells = spark.createDataFrame([(37.0, -122.0), (40.5, -73.5), (41.0, -74.0), (0.0, 0.0)],
                                  "lat double, lng double")
    got = {r.region: r.cells for r in sp.region_counts(cells).collect()}
    assert got == {"sf": 1, "ny": 2}


@pytest.mark.parametrize("tweets,want", [
    ([1, 1, 1, 1, 6], ["below_avg"] * 4 + ["three_std"]), ([3, 3, 3], ["three_std"] * 3)])
def test_sigma_buckets(spark, tweets, want):
    df = spark.createDataFrame([(t,) for t in tweets], "tweets bigint")
    assert sorted(r.fill_key for r in su.sigma_bucket(df).collect()) == sorted(want)
    plan = su.sigma_bucket(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_summary(spark):
    df = spark.createDataFrame([(t,) for t in (1, 1, 1, 1, 6)], "tweets bigint")
    assert tuple(su.summary(df).first()) == (5, 10, 2.0, 4.0, 2.0)


def word_rows(data):
    return [(la, ln, w, c) for (la, ln), ws in data.items() for w, c in ws.items()]


def test_merge_of_sample_payloads(spark, rows):
    batch = {(2456, -8180): {"ciabata": 1, "bread": 1}}
    speed = spark.createDataFrame([
        ("15020416", None, 25.812, -80.241, "shesdanger,1:lol,2:n,1:OVERALL_CNT,1"),
        ("15020416", None, 24.561, -81.799, "ciabata,1:putting,1:OVERALL_CNT,1"),
        ("15020416", None, 40.0, -74.0, "super,5:awesome,10:OVERALL_CNT,1"),
        ("15020416", None, 0.0, 0.0, "lost,1:OVERALL_CNT,9")],
        "yymmddhh string, timestamp timestamp, lat double, lng double, data string")
    speed_words, speed_tweets = layers.updates(speed)
    batch_words = spark.createDataFrame(word_rows(batch), "cell_lat long, cell_lng long, "
                                                          "word string, cnt long")
    batch_tweets = spark.createDataFrame([(2456, -8180, 1)],
                                         "cell_lat long, cell_lng long, tweets long")
    words, tweets = layers.merge_layers(batch_words, speed_words, batch_tweets, speed_tweets)
    assert rows(tweets) == [(2456, -8180, 2), (2581, -8024, 1), (4000, -7400, 1)]
    assert rows(words) == sorted(word_rows({
        (2456, -8180): {"ciabata": 2, "bread": 1, "putting": 1},
        (2581, -8024): {"shesdanger": 1, "lol": 2, "n": 1},
        (4000, -7400): {"super": 5, "awesome": 10}}), key=repr)


def test_merge_equals_batch_over_both(spark, rows):
    texts = [(1, 1, "a b"), (1, 1, "b c"), (2, 2, "a"), (3, 3, "z z")]
    df = spark.createDataFrame(texts, "cell_lat long, cell_lng long, text string")
    one, two = df.where("text <> 'b c'"), df.where("text = 'b c'")
    words, tweets = layers.merge_layers(ct.cell_counts(one), ct.cell_counts(two),
                                        ct.cell_messages(one), ct.cell_messages(two))
    assert rows(words) == rows(ct.cell_counts(df)) and rows(tweets) == rows(ct.cell_messages(df))


def test_latest_bucket_over_midnight(spark, rows):
    df = spark.createDataFrame([("15020423", 1), ("15020422", 2)], "yymmddhh string, v int")
    now = F.lit("2015-02-05 00:20:00").cast("timestamp")
    assert rows(layers.latest_bucket(df, now)) == [("15020423", 1)]
    both = df.union(spark.createDataFrame([("15020500", 3)], df.schema))
    assert rows(layers.latest_bucket(both, now)) == [("15020500", 3)]
    assert rows(layers.latest_bucket(df.where("v = 2"), now)) == []


def test_changes_over_the_hour(spark, rows):
    df = spark.createDataFrame(
        [("15020422", at("2015-02-04 22:59:59"), 1), ("15020422", at("2015-02-04 22:10:00"), 2),
         ("15020423", at("2015-02-04 23:00:00"), 3)], "yymmddhh string, timestamp timestamp, v int")
    since = F.lit("2015-02-04 22:30:00").cast("timestamp")
    assert rows(layers.changes_since(df, since), "v") == [(1,), (3,)]
