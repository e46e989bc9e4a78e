import pytest
from pyspark.sql import functions as F

from tallygrid.sources import keyed as ky, versions as vs


def table(spark, n):
    return spark.range(n).select("id", (F.col("id") * 2).alias("v"), (F.col("id") % 3).cast("string").alias("day"))


def source(spark, rows):
    return spark.createDataFrame(rows, "id bigint, v bigint, day string")


def test_spread_keys_rewrite_their_files_only(spark, path, rows):
    root = path()
    ky.create_keyed(spark, root, table(spark, 200_000), ["id"], file_rows=500)
    before = {e["file"] for e in ky._version(spark, root)[2]}
    assert 350 <= len(before) <= 450
    incoming = table(spark, 200_000).where("id % 2000 = 11").withColumn("v", F.lit(-1).cast("bigint"))
    done = ky.upsert_keyed(spark, root, incoming)
    after = {e["file"] for e in ky._version(spark, root)[2]}
    assert done["rewritten"] <= 100 and done["rewritten_rows"] <= 100 * 1000
    assert len(before - after) == done["rewritten"] and len(after - before) == done["written"] <= 101
    got = ky.read_keyed(spark, root)
    assert got.count() == 200_000 and got.where("v = -1").count() == 100
    assert got.exceptAll(table(spark, 200_000)).count() == 100
    assert rows(ky.read_keyed(spark, root, version=0).where("id = 11")) == [(11, 22, "2")]
    assert len(ky.clean_keyed(spark, root, keep=1)) == done["rewritten"]
    assert ky.read_keyed(spark, root).count() == 200_000


def test_statistics_and_filters_keep_files_unread(spark, path):
    """What the search for a key's file reads, by the scan's own count of rows."""
    root = path()
    ky.create_keyed(spark, root, table(spark, 100_000).where("id % 2 = 0"), ["id"], file_rows=5000)
    _, head, files = ky._version(spark, root)

    def scanned(value):
        df = ky._read(spark, root, head, files).select("id").where(F.col("id").isin([value]))
        df.write.format("noop").mode("overwrite").save()
        out = df._jdf.queryExecution()
        return df.count(), out.executedPlan().toString()

    assert scanned(500)[0] == 1 and "PushedFilters: [In(id" in scanned(500)[1] or "EqualTo(id" in scanned(500)[1]
    import pyarrow.parquet as pq
    some = pq.ParquetFile(f"{root}/{files[0]['file']}").metadata.row_group(0).column(0)
    assert some.statistics.min is not None
    ranges = sorted((m.statistics.min, m.statistics.max) for m in (
        pq.ParquetFile(f"{root}/{e['file']}").metadata.row_group(0).column(0) for e in files))
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_values_within_are_kept_apart(spark, path, rows):
    root = path()
    ky.create_keyed(spark, root, table(spark, 900), ["id"], ["day"], file_rows=100)
    assert all(set(e["within"]) == {"day"} for e in ky._version(spark, root)[2])
    one = ky.read_keyed(spark, root, {"day": ["1"]})
    assert one.count() == 300 and {r[0] for r in one.select("day").distinct().collect()} == {"1"}
    assert len(one.inputFiles()) < len(ky.read_keyed(spark, root).inputFiles()) / 2
    ky.upsert_keyed(spark, root, source(spark, [(4, 0, "2"), (2000, 1, "9"), (2001, 1, None)]))  # 4 moves
    assert ky.read_keyed(spark, root, {"day": ["1"]}).count() == 299
    assert rows(ky.read_keyed(spark, root, {"day": ["9"]})) == [(2000, 1, "9")]
    assert rows(ky.read_keyed(spark, root, {"day": [None]})) == [(2001, 1, None)]
    assert ky.read_keyed(spark, root).count() == 902


def test_ends_between_and_two_writers(spark, path, rows, monkeypatch):
    root = path()
    ky.create_keyed(spark, root, table(spark, 100), ["id"], file_rows=10)
    want, new = rows(ky.read_keyed(spark, root)), source(spark, [(5, -1, "x"), (200, -1, "x")])

    def fail(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(vs, "commit", fail)
        with pytest.raises(RuntimeError):
            ky.upsert_keyed(spark, root, new)
    assert rows(ky.read_keyed(spark, root)) == want
    commit = vs.commit

    def late(spark, root, version, entries):
        commit(spark, root, version, vs.latest(spark, root)[1])  # another writer was first
        commit(spark, root, version, entries)

    with monkeypatch.context() as m:
        m.setattr(vs, "commit", late)
        with pytest.raises(vs.Conflict):
            ky.upsert_keyed(spark, root, new)
    assert rows(ky.read_keyed(spark, root)) == want
    assert ky.upsert_keyed(spark, root, new)["rewritten"] == 1
    assert ky.read_keyed(spark, root).where("v = -1").count() == 2 and ky.read_keyed(spark, root).count() == 101


def test_odd_keys_and_empty_sources(spark, path, rows):
    root = path()
    ky.create_keyed(spark, root, source(spark, []), ["id"])
    assert ky.read_keyed(spark, root).collect() == []
    assert ky.upsert_keyed(spark, root, source(spark, [])) == {"rewritten": 0, "rewritten_rows": 0, "written": 0}
    ky.upsert_keyed(spark, root, source(spark, [(1, 1, "a"), (1, 2, "b"), (None, 3, "c")]), [F.desc("v")])
    ky.upsert_keyed(spark, root, source(spark, [(1, 5, "a"), (None, 4, "c")]))
    assert rows(ky.read_keyed(spark, root)) == sorted([(1, 5, "a"), (None, 3, "c"), (None, 4, "c")], key=repr)
    many = table(spark, 3000)  # more keys than are given to the scan
    ky.upsert_keyed(spark, root, many)
    assert ky.read_keyed(spark, root).count() == 3002


def test_files_of_one_name_are_told_apart(spark, path, rows):
    """One task writes a file of the same name for each value."""
    root = path()
    ky.create_keyed(spark, root, table(spark, 30), ["id"], ["day"], file_rows=1000)
    names = [e["file"].rsplit("/", 1)[1] for e in ky._version(spark, root)[2]]
    assert len(names) == 3 and len(set(names)) == 1
    done = ky.upsert_keyed(spark, root, source(spark, [(0, -1, "0")]))
    assert done["rewritten"] == 1 and done["rewritten_rows"] == 10
    want = sorted((i, -1 if i == 0 else 2 * i, str(i % 3)) for i in range(30))
    assert sorted(tuple(r) for r in ky.read_keyed(spark, root).collect()) == want
