"""Rankings kept up hour by hour.

Two keyed tables (``sources.keyed``): ``counts`` has a row per group and word, ``levels`` a row per
group and count with how many words have it. A part (an hour's counts, say) changes the counts of
its own words and moves each from its old level to its new one; counts of other groups are not
read, nor files that hold none of the words. A rank is one plus the words on higher levels, which
are few (about the square root of a group's tokens), so a word's rank needs its own row and these,
and the best words are read by a least count that the levels give.

A manifest over both (``sources.versions``) names their versions and the parts that are in them. It
is created last, so readers never see one without the other; a job that ends before leaves what
nobody reads, and run again goes on from what the manifest names. A part is added once. Two
writers cannot both make the next manifest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import by_count, place_words, top_k
from ..session import discard, durable
from ..sources import keyed as ky, versions as vs


def create(spark: SparkSession, root: str, by: str, file_rows: int = ky.FILE_ROWS) -> None:
    """Empty rankings of words by the text column ``by``."""
    empty = {"counts": f"`{by}` string, word string, cnt bigint", "levels": f"`{by}` string, cnt bigint, _n bigint"}
    for name, key in (("counts", "word"), ("levels", "cnt")):
        rows = spark.createDataFrame([], empty[name])
        ky.create_keyed(spark, f"{root}/{name}", rows, [by, key], [by], file_rows)
    vs.commit(spark, root, 0, [{"by": by, "counts": 0, "levels": 0, "parts": []}])


def _state(spark: SparkSession, root: str) -> tuple[int, dict]:
    version, rows = vs.latest(spark, root)
    if not rows:
        raise FileNotFoundError(f"no rankings at {root}")
    return version, rows[0]


def add_part(spark: SparkSession, root: str, part: str, counts: DataFrame) -> bool:
    """Add ``(by, word, cnt)``; False where a part of this name is there already.

    The groups of a part are listed by the driver: an hour's are a day or two. Rows with a NULL
    group, word or count say nothing.
    """
    version, now = _state(spark, root)
    by = now["by"]
    if part in now["parts"]:
        return False
    key = [by, "word"]
    delta = durable(counts.where(F.col(by).isNotNull() & F.col("word").isNotNull())
                    .groupBy(F.col(by).cast("string").alias(by), "word").agg(F.sum("cnt").alias("_add"))
                    .where("_add <> 0"))
    groups = {by: [r[0] for r in delta.select(by).distinct().collect()]}
    moved = durable(delta.join(_stored(spark, root, now, "counts", groups), key, "left")
                    .select(*key, F.col("cnt").alias("_was"), (F.coalesce("cnt", F.lit(0)) + F.col("_add")).alias("cnt")))
    steps = moved.select(by, F.explode(F.array(
        F.struct(F.col("_was").alias("cnt"), F.lit(-1).alias("_step")),
        F.struct(F.col("cnt"), F.lit(1).alias("_step")))).alias("s")).select(by, "s.*").where("cnt IS NOT NULL")
    levels = (steps.groupBy(by, "cnt").agg(F.sum("_step").alias("_step")).where("_step <> 0")
              .join(_stored(spark, root, now, "levels", groups), [by, "cnt"], "left")
              .select(by, "cnt", (F.coalesce("_n", F.lit(0)) + F.col("_step")).alias("_n")))
    after = dict(now, parts=[*now["parts"], part])
    for name, rows in (("counts", moved.select(*key, "cnt")), ("levels", levels)):
        after[name], _ = ky.upsert_onto(spark, f"{root}/{name}", rows, base=now[name])
    vs.commit(spark, root, version + 1, [after])
    discard(delta, moved)
    return True


def _stored(spark: SparkSession, root: str, state: dict, name: str, groups: dict | None = None) -> DataFrame:
    return ky.read_keyed(spark, f"{root}/{name}", groups, state[name])


def _of(spark: SparkSession, root: str, groups: Sequence[str] | None) -> tuple[str, DataFrame, DataFrame]:
    """(by, counts, levels with words) of the groups, or of all."""
    _, state = _state(spark, root)
    wanted = None if groups is None else {state["by"]: list(groups)}
    return (state["by"], _stored(spark, root, state, "counts", wanted),
            _stored(spark, root, state, "levels", wanted).where("_n > 0"))


def read_ranks(spark: SparkSession, root: str, groups: Sequence[str] | None = None) -> DataFrame:
    """``(by, word, cnt, rank)`` of all words of some groups, or of all groups."""
    by, counts, levels = _of(spark, root, groups)
    return place_words(counts, levels, [by])


def ranks_of(spark: SparkSession, root: str, group: str, words: Sequence[str]) -> DataFrame:
    """The rows of a few words; the scan skips what statistics and Bloom filters show to have none."""
    by, counts, levels = _of(spark, root, [group])
    return place_words(counts.where(F.col("word").isin(list(words))), levels, [by])


def best_words(spark: SparkSession, root: str, group: str, k: int) -> DataFrame:
    """The first ``k`` words of a group, by count, then word: read from the least count up that ``k`` words reach."""
    by, counts, levels = _of(spark, root, [group])
    # a level is in if fewer than k words lie above it: its rank is k at most
    ranked = place_words(levels.select(by, "cnt"), levels, [by])
    least = ranked.where(F.col("rank") <= k).agg(F.min("cnt")).scalar()
    return top_k(counts.where(F.col("cnt") >= least), by_count(), k)


def clean(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove what the newest ``keep`` manifests do not name; a job that was ended leaves files, too."""
    kept = vs.forget(spark, root, keep)
    gone = []
    for name in ("counts", "levels"):
        first = min(rows[0][name] for rows in kept)
        later = sum(n >= first for n in vs.numbers(spark, f"{root}/{name}"))
        gone += ky.clean_keyed(spark, f"{root}/{name}", later)
    return gone
