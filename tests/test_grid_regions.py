import random

import pytest
from pyspark.sql import functions as F

from tallygrid.functions import geo
from tallygrid.operators import regions as rg
from tallygrid.sources import grid

CELLS = "yymmdd string, cell_lat bigint, cell_lng bigint, id bigint"


def interleaved(a, b, bits=26):
    a, b = a + (1 << bits - 1), b + (1 << bits - 1)
    return sum((b >> i & 1) << 2 * i | (a >> i & 1) << 2 * i + 1 for i in range(bits))


def test_morton_interleaves_bits(spark):
    rng = random.Random(1)
    rows = [(0, 0), (-1, 1), (2 ** 25 - 1, -2 ** 25), *[(rng.randrange(-10 ** 6, 10 ** 6), rng.randrange(-10 ** 6, 10 ** 6))
                                                       for _ in range(200)]]
    got = spark.createDataFrame(rows, "a bigint, b bigint").select("a", "b", geo.morton(F.col("a"), F.col("b")).alias("z"))
    assert all(r["z"] == interleaved(r["a"], r["b"]) for r in got.collect())


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Two days of 40,000 cells each, in files of several row groups."""
    rows = spark.range(80_000).select(
        F.when(F.col("id") % 2 == 0, "240101").otherwise("240102").alias("yymmdd"),
        (F.floor(F.col("id") / 400) * 7 % 200).alias("cell_lat"), (F.col("id") * 13 % 400 - 200).alias("cell_lng"), "id")
    path = str(tmp_path_factory.mktemp("grid") / "table")
    grid.write_grid(rows, path, files=8, group_bytes=16 << 10)
    return rows, path


def scanned_rows(df):
    """The rows that the scan gave the plan, by its own metric."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    todo = [plan]
    while todo:
        node = todo.pop()
        if "Scan" in node.nodeName():
            return int(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    raise AssertionError("no scan")


def test_a_read_by_range_skips_folders_and_row_groups(spark, stored, rows):
    source, path = stored
    got = grid.in_range(grid.read_grid(spark, path, CELLS), ["240101"], [14, 21, 28], -30, -10)
    want = source.where("yymmdd = '240101' AND cell_lat IN (14, 21, 28) AND cell_lng > -30 AND cell_lng < -10")
    assert rows(got, "id") == rows(want, "id") and got.count() > 20
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yymmdd" in plan or "PartitionFilters: [(yymmdd" in plan
    assert "GreaterThan(cell_lng,-30)" in plan and "In(cell_lat" in plan
    assert got.count() <= scanned_rows(got) < 40_000 / 8  # of the day's rows
    longitudes = grid.read_grid(spark, path, CELLS).where("yymmdd = '240101' AND cell_lng > 150")
    assert scanned_rows(longitudes) < 40_000 / 3  # a range of the other coordinate alone


def test_a_day_is_replaced_and_rows_without_a_cell_stay(spark, path, rows):
    out = path()
    first = spark.createDataFrame([("1", 1, 2, 1), ("2", 5, 6, 2), ("2", None, None, 3)], CELLS)
    grid.write_grid(first, out)
    grid.write_grid(spark.createDataFrame([("1", 9, 9, 4)], CELLS), out)
    assert rows(grid.read_grid(spark, out, CELLS), "yymmdd", "id") == [("1", 4), ("2", 2), ("2", 3)]
    assert grid.in_range(grid.read_grid(spark, out, CELLS), [], [9], 0, 10).count() == 0


BOX = "region string, south double, north double, west double, east double"


def brute(points, boxes):
    return {b[0]: sum(p is not None and q is not None and b[1] <= p <= b[2] and b[3] <= q <= b[4] for p, q in points)
            if None not in b else 0 for b in boxes}


@pytest.mark.parametrize("task_rows", [1_000_000, 20])
def test_boxes_of_all_sizes(spark, task_rows):
    rng = random.Random(6)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(500)]
    points += [(24.5, -81.25)] * 300 + [(None, 1.0), (1.0, None), (90.0, 180.0), (-90.0, -180.0), (0.0, 0.0)]
    boxes = [("world", -90.0, 90.0, -180.0, 180.0), ("spot", 24.5, 24.5, -81.25, -81.25), ("none", 1.0, None, 1.0, 2.0),
             ("inside out", 5.0, 4.0, 0.0, 1.0), ("edge", 0.0, 64.0, 0.0, 64.0), ("cell", 0.0, 512.0, -512.0, 0.0)]
    for i in range(300):
        size = 2.0 ** rng.uniform(-12, 8)
        lat, lng = rng.choice(points[:500])
        boxes.append((f"b{i}", lat - size * rng.random(), lat + size, lng - size, lng + size * rng.random()))
    df = spark.createDataFrame(points, "lat double, lng double")
    got = rg.counts_per_region(df, spark.createDataFrame(boxes, BOX), task_rows=task_rows)
    assert {r["region"]: r["n"] for r in got.collect()} == brute(points, boxes)
    listed = rg.covers(spark.createDataFrame(boxes, BOX)).groupBy("region").count()
    assert listed.agg(F.max("count")).first()[0] <= 4


def test_many_regions_join_by_equality(spark):
    boxes = spark.range(100_000).select(
        F.col("id").alias("region"), *[(v + d).alias(n) for n, v, d in (
            ("south", F.col("id") % 180 - 90.0, 0.0), ("north", F.col("id") % 180 - 90.0, 0.5),
            ("west", F.col("id") % 359 - 180.0, 0.0), ("east", F.col("id") % 359 - 180.0, 0.25))])
    points = spark.range(2000).select((F.col("id") % 180 - 89.75).alias("lat"), (F.col("id") % 359 - 179.9).alias("lng"))
    found = rg.points_in_regions(points, boxes)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    counts = rg.counts_per_region(points, boxes)
    assert counts.count() == 100_000 and counts.agg(F.sum("n")).first()[0] == found.count() > 0


def test_empty_regions(spark):
    none = spark.createDataFrame([], BOX)
    points = spark.createDataFrame([(1.0, 2.0)], "lat double, lng double")
    assert rg.points_in_regions(points, none).count() == 0 and rg.counts_per_region(points, none).count() == 0
