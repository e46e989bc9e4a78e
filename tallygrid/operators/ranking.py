"""Top-k, ranks, pages and the wide/nested forms of ranked words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ids import ordered_ids
from .selection import bounded, sort_order
from .skew import lookup_join

# ---------------------------------------------------------------- fixed values
TOP_WORDS = 10
LIST_PAGE = 12
DETAIL_PAGE = 21
PAGE_WINDOW = 5
ROW_CAP = 10_000
LABELS = (
    "rgb(0, 66, 140)", "rgb(0, 100, 181)", "rgb(58, 150, 193)", "rgb(242, 167, 52)",
    "rgb(125, 200, 204)", "rgb(225, 167, 181)", "rgb(234, 184, 146)", "rgb(0, 16, 99)",
    "rgb(51, 51, 51)", "rgb(209, 184, 46)", "rgb(125, 33, 40)", "rgb(25, 50, 105)",
)
# -----------------------------------------------------------------------------


# A global limit merges the best rows of all tasks in one task, which is for short
# lists; a longer one is read off numbered rows, which no task merges.
SHORT = 1_000


def by_count(cnt: str = "cnt", *ties: str) -> list[Column]:
    """Largest count first; ties by the named columns."""
    return [F.desc(cnt), *[F.asc(t) for t in (ties or ("word",))]]


def representative(cnt: str = "cnt", word: str = "word") -> list[Column]:
    """Largest count, then longest word, then alphabet."""
    return [F.desc(cnt), F.desc(F.length(word)), F.asc(word)]


def top_k(df: DataFrame, order: Sequence[Column], k: int,
          by: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` rows, overall or per group.

    Per group each map task first cuts every group to ``k`` rows, so a hot group
    reaches the shuffle as ``k`` rows per task. Needs a total ``order``.
    """
    if not by:
        return first_rows(df, order, k)
    return ranked(df, order, k, by, "_rk").drop("_rk")


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows in a total order; a name such as ``-cnt`` is falling.

    The length asked for decides the plan, never the data: up to ``SHORT`` rows are
    Spark's own limit, more are read off numbered rows. Where the order is by names,
    only rows that histograms of these columns leave are numbered.
    """
    if n <= SHORT:
        return df.orderBy(*sort_order(order)).limit(n)
    if all(isinstance(item, str) for item in order):
        wanted = bounded(df, order, n)
        df = df if wanted is None else df.where(wanted)
    return ordered_ids(df, "_rn", sort_order(order)).where(F.col("_rn") <= n).drop("_rn")


def ranked(df: DataFrame, order: Sequence[Column], k: int, by: Sequence[str],
           rank_col: str = "rk") -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def latest_by(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    return top_k(df, order, 1, key)


def pivot_topk(counts: DataFrame, by: Sequence[str], k: int = TOP_WORDS) -> DataFrame:
    """``(*by, word1..wordk, count1..countk)``, NULL where a group has fewer."""
    top = ranked(counts, by_count(), k, by)
    at = [F.col("rk") == i for i in range(1, k + 1)]
    return top.groupBy(*by).agg(
        *[F.max(F.when(c, F.col("word"))).alias(f"word{i}") for i, c in enumerate(at, 1)],
        *[F.max(F.when(c, F.col("cnt"))).alias(f"count{i}") for i, c in enumerate(at, 1)],
    )


def unpivot_topk(df: DataFrame, keep: Sequence[str], k: int = TOP_WORDS) -> DataFrame:
    """Back to ``(*keep, rk, word, cnt)``, missing places left out."""
    places = ", ".join(f"{i}, word{i}, count{i}" for i in range(1, k + 1))
    return (df.select(*keep, F.expr(f"stack({k}, {places}) AS (rk, word, cnt)"))
              .where(F.col("word").isNotNull()))


def nest_pairs(counts: DataFrame, by: Sequence[str], k: int = TOP_WORDS) -> DataFrame:
    """``(*by, words)``: the ``k`` most representative words as an array of
    ``struct(word, cnt)``, in that order."""
    top = ranked(counts, representative(), k, by)
    pairs = F.sort_array(F.collect_list(F.struct("rk", "word", "cnt")))
    return top.groupBy(*by).agg(
        F.transform(pairs, lambda p: F.struct(p["word"].alias("word"),
                                              p["cnt"].alias("cnt"))).alias("words"))


def rank_words(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every word's ``rank()`` by count within its group.

    A rank is one plus the rows with a larger count, so the window runs over the
    distinct counts of a group (about the square root of its tokens at most),
    never over its words.
    """
    return place_words(counts, counts.groupBy(*by, "cnt").agg(F.count(F.lit(1)).alias("_n")), by)


def place_words(counts: DataFrame, levels: DataFrame, by: Sequence[str]) -> DataFrame:
    """``rank_words`` by ``levels``, which have the words (``_n``) of each group and count."""
    above = (Window.partitionBy(*by).orderBy(F.desc("cnt"))
             .rowsBetween(Window.unboundedPreceding, -1))
    ranks = levels.select(
        *by, "cnt", (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).alias("rank"))
    return lookup_join(counts, ranks, [*by, "cnt"], sizes=levels)


def page(df: DataFrame, order: Sequence[Column], size: int, n: int) -> DataFrame:
    """Page ``n`` (from 0)."""
    if (n + 1) * size > SHORT:
        return pages(df, order, size).where(F.col("page") == n).drop("page")
    return df.orderBy(*order).offset(n * size).limit(size)


def pages(df: DataFrame, order: Sequence[Column], size: int) -> DataFrame:
    """All rows with their ``page`` (from 0)."""
    numbered = ordered_ids(df, "_rn", order)
    return (numbered.withColumn("page", F.floor((F.col("_rn") - 1) / F.lit(size)).cast("bigint"))
            .drop("_rn"))


def page_window(pages_total: int, current: int, window: int = PAGE_WINDOW) -> list[int]:
    """Page numbers offered around the current one."""
    first = max(0, min(current - window // 2, pages_total - window))
    return list(range(first, min(first + window, pages_total)))


def cycle_label(df: DataFrame, order: Sequence[Column], labels: Sequence[str] = LABELS,
                label_col: str = "colors") -> DataFrame:
    """Hand out labels in turn over the ordered rows; the first row gets the
    second label."""
    numbered = ordered_ids(df, "_rn", order)
    ring = F.array(*[F.lit(x) for x in labels])
    place = (F.pmod(F.col("_rn"), F.lit(len(labels))) + 1).cast("int")
    return numbered.withColumn(label_col, F.element_at(ring, place)).drop("_rn")


def sample_rows(df: DataFrame, key: Column, n: int, seed: str = "0") -> DataFrame:
    """A repeatable random sample of ``n`` rows: the smallest salted md5s."""
    return first_rows(df, [F.md5(F.concat(key, F.lit(seed))), key], n)
