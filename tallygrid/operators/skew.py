"""Joins where a few keys may hold much of one side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds over 1/SHARE of the left rows, so there are fewer than
# SHARE hot keys whatever the data: that bound is what allows broadcasting them.
SHARE = 1_000
# Rows of one key that a task may get.
TASK_ROWS = 1_000_000


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                task_rows: int = TASK_ROWS,
                sizes: DataFrame | None = None) -> DataFrame:
    """Join ``left`` (distinct rows, keys not NULL) to ``right``, which has one row
    per key; ``how`` is inner, left or left_semi.

    Rows of a hot key are spread by the hash of the row over as many salts as it has
    ``task_rows`` rows, and the key's one row on the right is repeated for each; so a
    key of any size leaves about ``task_rows`` rows to a task. AQE's own skew join
    does not help here: it needs a plain shuffle on both sides, and these right
    sides are aggregates that already sit on the key. ``sizes`` gives the left rows
    per key (``_n``) where the caller has them.
    """
    keys = list(keys)
    if sizes is None:
        sizes = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    floor = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("t")).scalar() / F.lit(SHARE)
    hot = (sizes.where((F.col("_n") > floor) & (F.col("_n") > task_rows))
           .select(*keys, F.ceil(F.col("_n") / F.lit(task_rows)).alias("_hot")))
    salts = F.coalesce("_hot", F.lit(1))
    salt = F.pmod(F.xxhash64(*left.columns), salts)
    last = salts - 1
    salted = (left.join(F.broadcast(hot), keys, "left")
              .withColumn("_salt", salt.cast("bigint")).drop("_hot"))
    targets = (right.join(F.broadcast(hot), keys, "left")
               .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint")))).drop("_hot"))
    return salted.join(targets, [*keys, "_salt"], how).drop("_salt")
