import pytest
from pyspark.sql import functions as F

from tallygrid import schemas
from tallygrid.sources import files, versions as vs
from tallygrid.streaming import compaction as cp, counts as sc

KEY = "cell_lat BIGINT, cell_lng BIGINT, word STRING, cnt BIGINT"


def counts_batch(spark, path, n):
    rows = [(n % 3, 1, f"w{i % 4}", i + n) for i in range(10)]
    spark.createDataFrame(rows, KEY).write.mode("overwrite").parquet(f"{path}/batch_id={n}")


def speed_batch(spark, path, n):
    rows = [(f"2015-02-04 {10 + n % 3}:0{n % 10}:00", 24.5 + i, -81.0, f"w{i}:OVERALL_CNT,1", f"1502041{n % 3}")
            for i in range(5)]
    (spark.createDataFrame(rows, "timestamp string, lat double, lng double, data string, yymmddhh string")
     .withColumn("timestamp", F.col("timestamp").cast("timestamp"))
     .write.mode("overwrite").partitionBy("yymmddhh").parquet(f"{path}/batch_id={n}"))


def test_a_long_run_of_batches(spark, path, rows):
    """After each batch the sums are right, few folders are open and each row is written
    once a level."""
    out, want = path(), {}
    for n in range(20):
        counts_batch(spark, out, n)
        for i in range(10):
            key = (n % 3, 1, f"w{i % 4}")
            want[key] = want.get(key, 0) + i + n
        sc.compact_counts(spark, out, fanout=3)
        cp.clean(spark, out, keep=1)
        assert len(cp.visible(spark, out)) <= 2 * 3
    assert rows(sc.sum_batches(spark, out)) == sorted(((*k, v) for k, v in want.items()), key=repr)
    _, runs = vs.latest(spark, out)
    assert max(r["level"] for r in runs) == 2 and len(cp._batches(spark, out)) == len(cp.visible(spark, out))


def test_readers_see_one_version_throughout(spark, path, rows, monkeypatch):
    out = path()
    for n in range(4):
        speed_batch(spark, out, n)
    before, want = sc.read_speed(spark, out), rows(sc.read_speed(spark, out))
    during = []

    def look(*how):
        during.append(rows(sc.read_speed(spark, out)))  # the run is written, not yet named
        return commit(*how)

    commit = vs.commit
    with monkeypatch.context() as m:
        m.setattr(vs, "commit", look)
        sc.compact_speed(spark, out, fanout=2)
    after = sc.read_speed(spark, out)
    assert rows(before) == want and all(d == want for d in during) and rows(after) == want
    assert len(during) == 3 and len(cp.visible(spark, out)) == 1
    # the times of rows stay, so changes are read as before
    assert rows(after.where("timestamp >= '2015-02-04 11:00:00'")) == [
        r for r in want if str(r[0]) >= "2015-02-04 11:00:00"]
    hours = after.where("yymmddhh = '15020411'")
    assert "PartitionFilters: [isnotnull(yymmddhh" in hours._jdf.queryExecution().executedPlan().toString()


def test_hours_expire_in_merged_runs(spark, path):
    out = path()
    for n in range(4):
        speed_batch(spark, out, n)
    sc.compact_speed(spark, out, fanout=2)
    cp.clean(spark, out, keep=1)
    assert files.expire_buckets(spark, out, "15020410") == ["yymmddhh=15020410"]
    assert {r[0] for r in sc.read_speed(spark, out).select("yymmddhh").collect()} == {"15020411", "15020412"}


def test_a_merge_that_failed_or_lost_changes_nothing(spark, path, rows, monkeypatch):
    out = path()
    for n in range(3):
        counts_batch(spark, out, n)
    want = rows(sc.sum_batches(spark, out))

    def fail(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(vs, "commit", fail)
        with pytest.raises(RuntimeError):
            sc.compact_counts(spark, out, fanout=3)
    assert rows(sc.sum_batches(spark, out)) == want
    assert sc.compact_counts(spark, out, fanout=3) == 0
    assert rows(sc.sum_batches(spark, out)) == want
    with pytest.raises(vs.Conflict):
        vs.commit(spark, out, 0, [])
    assert vs.latest(spark, out)[0] == 0 and len(vs.latest(spark, out)[1]) == 1


def test_a_retried_batch_and_an_unfinished_one(spark, path, rows):
    out = path()
    for n in range(2):
        counts_batch(spark, out, n)
    sc.compact_counts(spark, out, fanout=2)
    want = rows(sc.sum_batches(spark, out))
    counts_batch(spark, out, 1)  # written again after it was merged
    assert rows(sc.sum_batches(spark, out)) == want
    counts_batch(spark, out, 2)
    vs.remove(spark, f"{out}/batch_id=2/_SUCCESS")
    assert rows(sc.sum_batches(spark, out)) == want


def test_an_empty_folder(spark, path):
    assert sc.read_speed(spark, path()).collect() == []
    assert sc.read_speed(spark, path()).columns == [c.split()[0] for c in schemas.SPEED_COUNTS.split(", ")]
    assert sc.compact_counts(spark, path()) == -1 and cp.clean(spark, path()) == []
