import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallygrid.operators import ids, ranking as rk, selection as sel

KINDS = "i int, l bigint, f double, s string, d date, t timestamp, b boolean, m decimal(10,2), k bigint"


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    rows = []
    for k in range(3000):
        row = [rng.randrange(5), rng.choice([-2 ** 63, 2 ** 63 - 1, 0, rng.randrange(10 ** 12)]),
               rng.choice([float("nan"), float("inf"), -1.5, rng.random()]),
               rng.choice(["", "a", "a\0", "é" * 40 + str(k % 9), "same text", "z" + str(rng.randrange(50))]),
               date(2000 + rng.randrange(20), 1, 1), datetime(2020, 1, 1, rng.randrange(24)), rng.random() < .5, None]
        rows.append([v if rng.random() < .9 else None for v in row] + [k])
    return spark.createDataFrame(rows, KINDS).withColumn("m", (F.col("k") % 7).cast("decimal(10,2)")).cache()


@pytest.mark.parametrize("order", [["i", "k"], ["-i", "-k"], ["l", "k"], ["-l", "k"], ["f", "k"], ["-f", "-k"],
                                   ["s", "k"], ["-s", "-k"], ["d", "-s", "k"], ["-t", "i", "k"], ["b", "-m", "k"],
                                   ["-b", "s", "-l", "k"]])
@pytest.mark.parametrize("n", [1, 700, 2500])
def test_the_condition_holds_the_first_rows(table, order, n):
    want = [r["k"] for r in table.orderBy(*sel.sort_order(order)).limit(n).collect()]
    condition = sel.bounded(table, order, n)
    left = table if condition is None else table.where(condition)
    assert [r["k"] for r in left.orderBy(*sel.sort_order(order)).limit(n).collect()] == want
    if all(c.strip("-") in "ildk" for c in order):  # nothing ties for good, and spare rows are few
        assert left.count() <= n + max(1, n // 10)


def test_only_wanted_rows_are_stored(spark, rows, monkeypatch):
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("k"), F.lit("x" * 20).alias("text"))
    kept, durable = [], ids.durable

    def watched(frame):
        out = durable(frame)
        kept.append(out.count())
        return out

    monkeypatch.setattr(ids, "durable", watched)
    got = rk.first_rows(df, ["-k"], 2000)
    assert rows(got.select("k")) == rows(df.orderBy(F.desc("k")).limit(2000).select("k"))
    assert kept and max(kept) <= 2200


def test_rows_that_tie_and_empty_tables(spark):
    same = spark.range(5000).select(F.lit(1).alias("v"), F.lit("t").alias("s"), "id")
    assert rk.first_rows(same, ["v", "s", "id"], 1500).agg(F.max("id")).first()[0] == 1499
    assert rk.first_rows(same.where("id < 0"), ["v", "id"], 1500).count() == 0
    assert rk.first_rows(same, ["id"], 10 ** 6).count() == 5000
