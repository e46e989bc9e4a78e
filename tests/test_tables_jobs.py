import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallygrid import schemas, session
from tallygrid.operators import counts as ct, warehouse as wh
from tallygrid.plans import jobs
from tallygrid.sources import files, tables as tb, topics
from workload import suite

from test_events_messages import as_of, EVENT, at, events, pages, tallies


def kv(spark, data):
    return spark.createDataFrame(data, "k int, v string, t int")


def test_upsert(spark, rows):
    target = kv(spark, [(1, "x", 0), (2, "y", 0)])
    source = kv(spark, [(2, "z", 1), (3, "w", 1)])
    once = wh.upsert(target, source, ["k"])
    assert rows(once, "k", "v") == [(1, "x"), (2, "z"), (3, "w")]
    assert rows(wh.upsert(once, source, ["k"])) == rows(once)
    twice = wh.upsert(target, kv(spark, [(2, "a", 1), (2, "b", 2)]), ["k"], [F.desc("t")])
    assert rows(twice, "k", "v") == [(1, "x"), (2, "b")]


def test_high_water(spark):
    df = spark.createDataFrame([(9, 1), (4, 2), (5, 2)], "lv int, ts int")
    assert tuple(wh.high_water(df, "lv", "ts").first()) == (5, 2)
    assert tuple(wh.high_water(df, "lv").first()) == (9,)
    assert tuple(wh.high_water(df.where("lv > 99"), "lv").first()) == (None,)


def test_capped(spark, rows):
    df = kv(spark, [(i, "x", i) for i in range(9)])
    top, last = wh.capped(df, ["k"], 4)
    assert [r[0] for r in rows(top)] == [0, 1, 2, 3] and tuple(last.first())[:2] == (4, 3)


def test_offsets(spark):
    names = spark.createDataFrame([("b/topic_offset_123_169.txt",), ("b/topic_offset_99_170.txt",),
                                   ("b/other.csv",)], "path string")
    log = spark.createDataFrame([("g", 1, 50, None), ("h", 1, 900, None)], schemas.OFFSETS)
    assert wh.next_offset(names, log, "g").first()["k_offset"] == 123
    assert wh.next_offset(names.where("path = 'b/other.csv'"), log, "g").first()["k_offset"] == 50
    assert wh.next_offset(names.limit(0), log, "none").first()["k_offset"] == 0
    entry = wh.offset_entry(wh.next_offset(names, log, "g"), "g", 1, as_of())
    assert log.union(entry).count() == 3


def test_delimited_text(spark, path):
    df = spark.createDataFrame([("a", None, "b\nc")], "x string, y int, z string")
    assert files.delimited(df, ["x", "y", "z"]).first()["value"] == "a\x07\\N\x07bc"


def test_strict_load(spark, path, rows):
    df = spark.createDataFrame([(1, 'say "hi', 2.5), (2, None, None), (3, '"', 1.0)],
                               "a int, b string, c double")
    out = path()
    files.export_delimited(df, df.columns, out)
    assert rows(files.load_delimited(spark, out, "a int, b string, c double")) == rows(df)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|BadRecord|malformed"):
        files.load_delimited(spark, out, "a int, b int, c double").collect()


def test_geo_csv_days(spark, path, rows):
    df = spark.createDataFrame([
        (1.25, 2.5, "Hi, @a\nb", at("2015-02-04 10:00:00")), (None, 2.5, "x", at("2015-02-04 11:00:00")),
        (3.5, 4.5, 'a "q" b', at("2015-02-05 00:00:00"))], "lat double, lng double, text string, ts timestamp")
    out = path()
    files.export_geo_csv(df, out, ts="ts")
    assert sorted(n for n in os.listdir(out) if n.startswith("day")) == ["day=020415", "day=020515"]
    day = files.read_geo_csv(spark, out, "020415")
    assert rows(day, "cell_lat", "cell_lng", "text") == [(125, 250, "Hi @a b"), (None, None, "x")]
    assert "PartitionFilters: [isnotnull(day" in day._jdf.queryExecution().executedPlan().toString()
    assert files.read_geo_csv(spark, out).count() == 3


def test_buckets_are_replaced_and_pruned(spark, path, rows):
    out = path()
    df = spark.createDataFrame([(1, 1, "a", 1, "15020403"), (1, 1, "a", 2, "15020404")],
                               schemas.CELL_COUNTS)
    files.write_buckets(df, out, sort=["cell_lat"])
    files.write_buckets(df.where("yymmddhh = '15020404'").withColumn("cnt", F.lit(9).cast("bigint")), out)
    got = files.read_buckets(spark, out)
    assert rows(got, "yymmddhh", "cnt") == [("15020403", 1), ("15020404", 9)]
    hour = got.where("yymmddhh = '15020403'")
    assert "PartitionFilters: [isnotnull(yymmddhh" in hour._jdf.queryExecution().executedPlan().toString()
    assert files.expire_buckets(spark, out, "15020403") == ["yymmddhh=15020403"]
    assert rows(files.read_buckets(spark, out), "yymmddhh") == [("15020404",)]


def test_tables(spark, rows):
    tb.drop_table(spark, "t_live")
    live = tb.ensure_table(spark, "t_live", "k int, v string, t int")
    assert tb.table_exists(spark, "t_live") and live.count() == 0
    tb.upsert_table(spark, "t_live", kv(spark, [(1, "a", 0)]), ["k"])
    tb.upsert_table(spark, "t_live", kv(spark, [(1, "b", 1), (2, "c", 1)]), ["k"])
    assert rows(tb.read_table(spark, "t_live"), "k", "v") == [(1, "b"), (2, "c")]
    tb.append_table(spark, "t_live", spark.createDataFrame([("x", 0), ("y", 0)], "v string, t int"),
                    "k", ["v"])
    assert sorted(r.k for r in spark.table("t_live").collect()) == [1, 2, 3, 4]
    assert tb.row_count(spark.table("t_live"), F.col("t") == 0).first()["n"] == 2
    tb.drop_table(spark, "t_live")
    assert not tb.table_exists(spark, "t_live")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("t_live")]


def test_replacing_keeps_partitions(spark, rows):
    tb.drop_table(spark, "t_parts")
    tb.ensure_table(spark, "t_parts", "k int, v string, yymmddhh string", partition_by=["yymmddhh"])
    first = spark.createDataFrame([(1, "a", "15020403"), (2, "b", "15020404")], "k int, v string, yymmddhh string")
    tb.upsert_table(spark, "t_parts", first, ["k"])
    tb.upsert_table(spark, "t_parts", first.where("k = 2").withColumn("v", F.lit("c")), ["k"])
    assert rows(spark.table("t_parts"), "k", "v") == [(1, "a"), (2, "c")]
    assert tb.partition_columns(spark, "t_parts") == ["yymmddhh"]
    assert tb.expire_table(spark, "t_parts", "15020403") == ["15020403"]
    assert rows(spark.table("t_parts"), "k", "v") == [(2, "c")]
    tb.replace_table(spark, "t_parts", spark.table("t_parts").limit(0))
    assert spark.table("t_parts").count() == 0
    tb.drop_table(spark, "t_parts")


def test_an_upsert_rewrites_its_buckets_only(spark, rows):
    tb.drop_table(spark, "t_buckets")
    tb.ensure_table(spark, "t_buckets", "k int, v string", buckets=16)
    tb.upsert_table(spark, "t_buckets", spark.range(200).selectExpr("int(id) AS k", "'old' AS v"), ["k"])
    def files_of():
        return set(spark.table("t_buckets").inputFiles())

    before = files_of()
    tb.upsert_table(spark, "t_buckets", spark.createDataFrame([(5, "new"), (900, "new")], "k int, v string"), ["k"])
    rewritten = {f.split("/")[-2] for f in before - files_of()}
    assert 1 <= len(rewritten) <= 2 and len({f.split("/")[-2] for f in before & files_of()}) >= 14
    assert sorted(rows(spark.table("t_buckets"), "k", "v")) == sorted(
        [(i, "new" if i == 5 else "old") for i in range(200)] + [(900, "new")])
    tb.drop_table(spark, "t_buckets")


@pytest.mark.parametrize("buckets", [0, 4])
@pytest.mark.parametrize("statement", [1, 2])
def test_a_failure_on_the_way_loses_no_row(spark, rows, monkeypatch, buckets, statement):
    """The job ends at one of the statements that make new rows current; the next run has
    every stored row and finishes the work."""
    tb.drop_table(spark, "t_safe")
    tb.ensure_table(spark, "t_safe", "k int, v string", buckets=buckets)
    tb.upsert_table(spark, "t_safe", spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string"), ["k"])
    real, seen = type(spark).sql, []

    def failing(self, text, *args, **kwargs):
        if text.startswith("ALTER TABLE") and "t_safe" in text:
            seen.append(text)
            if len(seen) == statement:
                raise RuntimeError("the job ends here")
        return real(self, text, *args, **kwargs)

    source = spark.createDataFrame([(2, "x"), (3, "y"), (4, "z")], "k int, v string")
    monkeypatch.setattr(type(spark), "sql", failing)
    try:
        tb.upsert_table(spark, "t_safe", source, ["k"])
    except RuntimeError:
        pass
    monkeypatch.undo()
    spark.catalog.refreshTable("t_safe")
    held = {r.k: r.v for r in tb.ensure_table(spark, "t_safe", "k int, v string", buckets=buckets).collect()}
    assert held[1] == "a" and held[2] in "bx" and held[3] in "cy"
    tb.upsert_table(spark, "t_safe", source, ["k"])
    assert rows(spark.table("t_safe"), "k", "v") == [(1, "a"), (2, "x"), (3, "y"), (4, "z")]
    tb.drop_table(spark, "t_safe")


def test_jdbc_and_topic_options():
    assert tb.jdbc_options("jdbc:x", "t")["fetchsize"] == "3000"
    split = tb.jdbc_options("jdbc:x", "t", "id", 0, 100, 8)
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "8")
    with pytest.raises(ValueError):
        tb.jdbc_options("jdbc:x", "t", "id")
    assert "maxOffsetsPerTrigger" not in topics.kafka_options("h:1", "t")
    drain = topics.kafka_options("h:1", "t", per_batch=topics.BATCH_MESSAGES)
    assert drain["maxOffsetsPerTrigger"] == "50000"


def test_shared_dir_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    beside = spark.conf.get("spark.sql.warehouse.dir")
    assert session.shared_dir(spark) == named if named else session.shared_dir(spark).startswith(beside)
    assert session.new_dir(spark, "x") != session.new_dir(spark, "x")


def test_hourly_job_twice(spark, path, rows):
    csv, out = path("csv"), path("out")
    df = spark.createDataFrame([(24.561, -81.799, "bread, ciabata!"), (24.559, -81.801, "bread"),
                                (None, None, "lost words")], "lat double, lng double, text string")
    files.export_geo_csv(df, csv)
    for _ in range(2):
        jobs.hourly_job(spark, csv, out, as_of(), stop=["the"])
    words, tweets = jobs.current_view(spark, out, as_of())
    assert rows(words) == [(2456, -8180, "bread", 2), (2456, -8180, "ciabata", 1)]
    assert rows(tweets) == [(2456, -8180, 2)]
    assert set(files.read_buckets(spark, out).columns) == {"cell_lat", "cell_lng", "word", "cnt", "yymmddhh"}
    exported = path("maps")
    jobs.export_maps(spark, out, "15020412", exported, as_of())
    stored = jobs.read_map_buckets(spark, exported).collect()
    assert {r.location for r in stored} == {"24.56,-81.80"}
    assert sorted(":".join(r.key for r in stored).split(":")) == ["OVERALL_CNT,2", "bread,2", "ciabata,1"]
    assert jobs.hour_view(spark, out, "15020411")[0].count() == 0


def test_jobs_over_tables(spark, path, rows):
    for name in ("ev", "cs", "wd", "pho"):
        tb.drop_table(spark, name)
    venue = {"name": "Hall", "latitude": "24.561", "longitude": "-81.799"}
    landed = pages(spark, art=[{**EVENT, "venue": venue}], music=[{**EVENT, "venue": venue}])
    for _ in range(2):
        jobs.event_job(spark, landed, "ev", path("archive"), as_of())
    assert rows(spark.table("ev"), "eb_id", "category") == [("7", "art")]
    words, tweets = tallies(spark)
    for _ in range(2):
        jobs.conference_job(spark, words, tweets, "ev", "cs", as_of())
    assert rows(spark.table("cs"), "tid", "eb_id", "tweets", "word1") == [(2, "7", 3, "a")]
    jobs.word_job(spark, words, "wd", as_of())
    jobs.word_job(spark, words, "wd", as_of())
    assert sorted(r.wid for r in spark.table("wd").collect()) == [1, 2, 3]
    jobs.word_job(spark, words, "wd", F.lit(dt.datetime(2015, 2, 4, 13)).cast("timestamp"))
    assert sorted(r.wid for r in spark.table("wd").collect()) == [1, 2, 3, 4, 5, 6]
    index = spark.createDataFrame([("a", "u1"), ("b", "u2"), ("z", "u3")], "word string, url string")
    jobs.photo_job(spark, words, spark.table("ev"), index, "pho", as_of())
    later = F.lit(dt.datetime(2015, 2, 5, 12)).cast("timestamp")
    jobs.photo_job(spark, words, spark.table("ev"), index, "pho", later)
    assert rows(spark.table("pho"), "pid", "yymmddhh", "word") in (
        [(1, "15020412", "a"), (2, "15020412", "b"), (3, "15020512", "a"), (4, "15020512", "b")],
        [(1, "15020412", "b"), (2, "15020412", "a"), (3, "15020512", "b"), (4, "15020512", "a")])
    eight = F.lit(dt.datetime(2015, 2, 11, 12)).cast("timestamp")
    jobs.photo_job(spark, words, spark.table("ev"), index, "pho", eight)
    assert {r.yymmddhh for r in spark.table("pho").collect()} == {"15020512", "15021112"}
    for name in ("ev", "cs", "wd", "pho"):
        tb.drop_table(spark, name)


def test_counts_survive_a_failing_task(spark, rows):
    """Ids stay the same when the frame is computed again from scratch."""
    df = spark.range(200).select(F.col("id").alias("k"))
    stored = df.where("k < 50").withColumn("i", F.col("k") + 1)
    a = rows(wh.with_next_ids(df, stored, "i", ["k"]), "k", "i")
    b = rows(wh.with_next_ids(df.repartition(7), stored, "i", ["k"]), "k", "i")
    assert a == b and min(i for _, i in a) == 51
    assert events(spark).count() == 5 and ct.CELL == ("cell_lat", "cell_lng")


def test_hours_that_share_a_folder(spark, path, rows):
    """Many small hours lie in few folders; a write replaces its hours and no others."""
    out, kind = path(), "cell_lat bigint, cell_lng bigint, word string, cnt bigint, yymmddhh string"
    hours = [f"{m:02d}{d:02d}{h:02d}" for m in (1, 2) for d in range(1, 29) for h in range(0, 24, 6)]
    data = [(1, 2, "w", i, "03" + h) for i, h in enumerate(hours)] + [(1, 2, "none", 7, None)]
    files.write_buckets(spark.createDataFrame(data, kind), out, sort=["cell_lat"], folder=4)
    assert len([n for n in os.listdir(out) if "=" in n]) == 3
    cols = ["cell_lat", "cell_lng", "word", "cnt", "yymmddhh"]
    assert rows(files.read_buckets(spark, out), *cols) == sorted(data, key=repr)
    new = [(1, 2, "v", 0, data[5][4]), (3, 4, "v", 0, data[5][4]), (1, 2, "v", 1, "03040100"), (1, 2, "n", 8, None)]
    files.write_buckets(spark.createDataFrame(new, kind), out, folder=4)
    want = [d for d in data if d[4] not in (data[5][4], None)] + new
    assert rows(files.read_buckets(spark, out), *cols) == sorted(want, key=repr)


def test_days_and_hours_go_on(spark, path, rows):
    """Messages two weeks apart are said on days and in hours of their own."""
    sf = path("sf")
    spark.createDataFrame([(0, "bread", "en", "src3", 100), (429, "bread", "en", "src3", 100),
                           (429 * 9, "bread", "en", "src3", 100)],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint"
                          ).write.parquet(f"{sf}/documents.parquet")
    assert rows(suite.daily_top10(spark, sf), "yymmdd") == [("240101",), ("240115",), ("240506",)]
    assert len(rows(suite.hour_buckets(spark, sf), "yymmddhh")) == 3
