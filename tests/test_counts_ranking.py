import collections
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallygrid.operators import counts as ct, ids, ranking as rk

CELL = list(ct.CELL)


def counts_frame(spark, data):
    return spark.createDataFrame(data, "cell_lat bigint, cell_lng bigint, word string, cnt bigint")


def test_cell_counts_and_messages(spark, rows):
    df = spark.createDataFrame([(1, 2, "a b a"), (1, 2, "b"), (3, 4, "a")],
                               "cell_lat bigint, cell_lng bigint, text string")
    assert rows(ct.cell_counts(df)) == [(1, 2, "a", 2), (1, 2, "b", 2), (3, 4, "a", 1)]
    assert rows(ct.cell_messages(df)) == [(1, 2, 2), (3, 4, 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.text("ab \n.,'", max_size=12)), max_size=15),
       st.integers(1, 5))
def test_totals_do_not_depend_on_partitions(spark, data, parts):
    df = spark.createDataFrame([(c, c, t) for c, t in data],
                               "cell_lat bigint, cell_lng bigint, text string")
    want = collections.Counter()
    for c, t in data:
        kept = "".join(ch for ch in t if ch in "ab \n")
        want.update((c, w) for w in kept.split())
    got = ct.cell_counts(df.repartition(parts)).collect()
    assert {(r.cell_lat, r.word): r.cnt for r in got} == dict(want)


def test_plain_corpus_count(spark):
    df = spark.createDataFrame([("The cat  and\n@you it's Cat the\n",)], "text string")
    got = {r.word: r.cnt for r in ct.word_count(df).collect()}
    # "the\n" is tested as it stands, so it passes and is trimmed afterwards.
    assert got == {"cat": 1, "": 1, "Cat": 1, "the": 1}
    lines = spark.createDataFrame([("1,2,fine day,x",), ("1,2,short",)], "value string")
    assert {r.word: r.cnt for r in ct.line_word_count(lines).collect()} == {"fine": 1, "day": 1}
    top = ct.most_frequent(counts_frame(spark, [(0, 0, "a", 2), (0, 0, "b", 2)])).first()
    assert (top.cnt, top.word) == (2, "b")


@pytest.mark.parametrize("parts", [1, 3, 100])
def test_map_form_keeps_every_word(spark, rows, parts):
    rng = random.Random(1)
    data = [(1, 1, f"w{i}", rng.randint(1, 9)) for i in range(40)] + [(2, 2, "x", 1)]
    tweets = spark.createDataFrame([(1, 1, 7), (2, 2, 1), (3, 3, 4)],
                                   "cell_lat bigint, cell_lng bigint, tweets bigint")
    marked = ct.marked_counts(counts_frame(spark, data), tweets)
    packed = ct.counts_to_maps(marked, parts=parts)
    assert (packed.where("cell_lat = 1").count() > 1) == (parts > 1)
    assert packed.where("cell_lat = 1").count() <= parts
    words, back = ct.split_measure(ct.merge_maps(packed, CELL, "data"), CELL)
    assert rows(words, *CELL, "word", "cnt") == sorted(data, key=repr)
    assert rows(back) == [(1, 1, 7), (2, 2, 1), (3, 3, 4)]


def test_words_and_messages_in_one_pass(spark, rows):
    df = spark.createDataFrame([(1, 1, "a b a http://x"), (1, 1, None), (1, 1, ""), (2, 2, "The b")],
                               "cell_lat bigint, cell_lng bigint, text string")
    words, tweets = ct.split_measure(ct.cell_tallies(df, CELL, stop=["the"]), CELL)
    assert rows(words) == rows(ct.cell_counts(df, CELL, stop=["the"]))
    assert rows(tweets) == rows(ct.cell_messages(df, CELL))


def test_top_words_with_ties(spark):
    wide = rk.pivot_topk(counts_frame(spark, [(0, 0, "b", 2), (0, 0, "a", 2), (0, 0, "c", 1)]), CELL)
    r = wide.first()
    assert [r[f"word{i}"] for i in range(1, 5)] == ["a", "b", "c", None]
    assert [r[f"count{i}"] for i in range(1, 5)] == [2, 2, 1, None]
    back = rk.unpivot_topk(wide, CELL).orderBy("rk").collect()
    assert [(x.rk, x.word, x.cnt) for x in back] == [(1, "a", 2), (2, "b", 2), (3, "c", 1)]


def test_representative_order(spark):
    df = counts_frame(spark, [(0, 0, "aa", 5), (0, 0, "bbbb", 5), (0, 0, "c", 9), (0, 0, "ab", 5)])
    nested = rk.nest_pairs(df, CELL).first()["words"]
    assert [p.word for p in nested] == ["c", "bbbb", "aa", "ab"]


def test_rank_words_equals_rank(spark):
    rng = random.Random(2)
    data = [(d, 0, f"w{i}", rng.randint(1, 6)) for d in (1, 2) for i in range(50)]
    got = {(r.cell_lat, r.word): r["rank"] for r in
           rk.rank_words(counts_frame(spark, data), ["cell_lat"]).collect()}
    for d, _, w, c in data:
        assert got[d, w] == 1 + sum(1 for x in data if x[0] == d and x[3] > c)


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_dense_ids(spark, n):
    df = spark.range(n).select(F.col("id").alias("k"))
    got = ids.dense_ids(df, "i", ["k"], start=10).collect()
    assert sorted(r.i for r in got) == list(range(11, 11 + n))
    again = ids.dense_ids(df.repartition(3), "i", ["k"], start=10).collect()
    assert {r.k: r.i for r in got} == {r.k: r.i for r in again}


def test_ordered_ids_with_a_hot_value(spark):
    # Two thirds of the rows share the leading value.
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(7)).alias("v"), "id")
    order = [F.desc("v"), F.asc("id")]
    got = {r.id: r.rn for r in ids.ordered_ids(df, "rn", order, part_rows=100).collect()}
    want = sorted(df.collect(), key=lambda r: (-r.v, r.id))
    assert got == {r.id: i for i, r in enumerate(want, 1)}


def test_pages_and_labels(spark):
    df = spark.range(30).select(F.col("id").alias("k"))
    assert [r.k for r in rk.page(df, [F.asc("k")], 12, 2).collect()] == list(range(24, 30))
    paged = {r.k: r.page for r in rk.pages(df, [F.asc("k")], 12).collect()}
    assert paged == {k: k // 12 for k in range(30)}
    labels = {r.k: r.colors for r in rk.cycle_label(df, [F.asc("k")]).collect()}
    assert labels == {k: rk.LABELS[(k + 1) % 12] for k in range(30)}
    assert rk.page_window(10, 0) == [0, 1, 2, 3, 4]
    assert rk.page_window(10, 5) == [3, 4, 5, 6, 7]
    assert rk.page_window(10, 9) == [5, 6, 7, 8, 9]
    assert rk.page_window(3, 1) == [0, 1, 2]


def test_many_first_rows_are_not_kept_in_memory(spark, rows, monkeypatch):
    df = spark.range(100).select(F.col("id").alias("k"))
    near = rows(rk.first_rows(df, [F.desc("k")], 30))
    deep = rows(rk.page(df, [F.desc("k")], 10, 4))
    monkeypatch.setattr(rk, "SHORT", 5)
    assert rows(rk.first_rows(df.repartition(6), [F.desc("k")], 30)) == near
    assert rows(rk.page(df.repartition(6), [F.desc("k")], 10, 4)) == deep
    assert rows(rk.page(df, [F.desc("k")], 10, 4)) == deep


def test_sample_is_repeatable(spark, rows):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    a = rows(rk.sample_rows(df, F.col("k"), 20))
    assert a == rows(rk.sample_rows(df.repartition(5), F.col("k"), 20)) and len(a) == 20
    assert a != rows(rk.sample_rows(df, F.col("k"), 20, seed="1"))
    assert len(rows(rk.sample_rows(df.limit(5), F.col("k"), 20))) == 5


def test_latest_row(spark, rows):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, t int")
    assert rows(rk.latest_by(df, ["k"], [F.desc("t")]), "k", "v") == [(1, "b"), (2, "c")]


def test_map_rows_of_a_large_vocabulary_are_bounded(spark):
    """A cell of two million words beside a small one: no row is over the bound, none is small
    but the last of its task, and the maps are the counts."""
    words = spark.range(2_000_000).select(
        F.when(F.col("id") < 10, 2).otherwise(1).cast("bigint").alias("cell_lat"), F.lit(0).cast("bigint").alias("cell_lng"),
        F.concat(F.lit("word"), F.col("id").cast("string")).alias("word"), (F.col("id") % 9 + 1).alias("cnt"))
    packed = ct.counts_to_maps(words, most_bytes=1 << 16)
    size = F.aggregate(F.map_keys("data"), F.lit(0), lambda n, w: n + F.octet_length(w) + ct.ENTRY_BYTES)
    rows = packed.select("cell_lat", "part", size.alias("n")).collect()
    assert max(r["n"] for r in rows) <= (1 << 16) + 40 and len({(r["cell_lat"], r["part"]) for r in rows}) == len(rows)
    assert sum(r["n"] < 1 << 15 for r in rows) <= 2 * ct.MAP_PARTS
    back = ct.merge_maps(packed, list(ct.CELL), "data")
    assert back.count() == 2_000_000 and back.exceptAll(words).count() == 0
    assert packed._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
