import random

import pytest
from pyspark.sql import functions as F

from tallygrid.operators import ranking as rk
from tallygrid.plans import rankings
from tallygrid.sources import keyed as ky

SCHEMA = "day string, word string, cnt bigint"


def parts(n, words=40):
    rng = random.Random(n)
    return [[(f"d{i // 2}", f"w{int(rng.paretovariate(.7)) % words}", rng.randint(1, 3)) for _ in range(60)]
            for i in range(n)]


def full(spark, data):
    counts = (spark.createDataFrame([r for p in data for r in p], SCHEMA)
              .groupBy("day", "word").agg(F.sum("cnt").alias("cnt")))
    return rk.rank_words(counts, ["day"])


@pytest.fixture
def kept(spark, path):
    root, data = path(), parts(4)
    rankings.create(spark, root, "day", file_rows=10)
    for i, p in enumerate(data):
        assert rankings.add_part(spark, root, f"h{i}", spark.createDataFrame(p, SCHEMA).coalesce(1))
    return root, data


COLS = ("day", "word", "cnt", "rank")


def test_parts_one_by_one_equal_one_ranking(spark, kept, rows):
    root, data = kept
    want = rows(full(spark, data), *COLS)
    assert rows(rankings.read_ranks(spark, root), *COLS) == want
    assert rows(rankings.read_ranks(spark, root, ["d1"]), *COLS) == [r for r in want if r[0] == "d1"]
    # a part is added once
    assert not rankings.add_part(spark, root, "h1", spark.createDataFrame(data[1], SCHEMA))
    assert rows(rankings.read_ranks(spark, root), *COLS) == want
    some = [r for r in want if r[0] == "d0" and r[1] in ("w1", "w2", "w39")]
    assert rows(rankings.ranks_of(spark, root, "d0", ["w1", "w2", "w39", "none"]), *COLS) == some
    for k in (1, 5, 500):
        best = sorted((-r[2], r[1]) for r in want if r[0] == "d1")[:k]
        assert sorted((-r.cnt, r.word) for r in rankings.best_words(spark, root, "d1", k).collect()) == best


def test_only_touched_counts_are_rewritten(spark, kept):
    root, _ = kept
    before = {e["file"]: e["within"]["day"] for e in ky._version(spark, f"{root}/counts")[2]}
    rankings.add_part(spark, root, "late", spark.createDataFrame([("d1", "w1", 1), ("d1", "w1", 1)], SCHEMA))
    after = {e["file"] for e in ky._version(spark, f"{root}/counts")[2]}
    gone = [before[f] for f in before if f not in after]
    assert gone == ["d1"] and len(before) > 3


def test_an_ended_job_leaves_the_old_ranking(spark, kept, rows, monkeypatch):
    root, data = kept
    want = rows(full(spark, data), *COLS)
    extra, other = [("d1", "w1", 50), ("d1", "new", 7)], [("d0", "w2", 9), (None, "w", 1), ("d0", None, 1)]
    upsert = ky.upsert_onto

    def first_only(spark, where, *args, **kwargs):
        if where.endswith("levels"):
            raise RuntimeError("ended")
        return upsert(spark, where, *args, **kwargs)

    monkeypatch.setattr(ky, "upsert_onto", first_only)
    with pytest.raises(RuntimeError):
        rankings.add_part(spark, root, "x", spark.createDataFrame(extra, SCHEMA))
    monkeypatch.setattr(ky, "upsert_onto", upsert)
    assert rows(rankings.read_ranks(spark, root), *COLS) == want
    # another part goes on from what readers see, not from what was left
    assert rankings.add_part(spark, root, "y", spark.createDataFrame(other, SCHEMA))
    assert rows(rankings.read_ranks(spark, root), *COLS) == rows(full(spark, [*data, other[:1]]), *COLS)
    assert rankings.add_part(spark, root, "x", spark.createDataFrame(extra, SCHEMA))
    want = rows(full(spark, [*data, other[:1], extra]), *COLS)
    assert rows(rankings.read_ranks(spark, root), *COLS) == want
    assert rankings.clean(spark, root, keep=1)
    assert rows(rankings.read_ranks(spark, root), *COLS) == want


def test_no_part_and_an_empty_part(spark, path):
    root = path()
    rankings.create(spark, root, "day")
    assert rankings.read_ranks(spark, root).count() == 0
    assert rankings.best_words(spark, root, "d", 3).count() == 0
    assert rankings.add_part(spark, root, "none", spark.createDataFrame([], SCHEMA))
    assert rankings.read_ranks(spark, root).count() == 0
