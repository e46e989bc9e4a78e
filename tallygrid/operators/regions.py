"""Regions as a table: boxes of any sizes joined to points by equality.

The plane is cut into square cells, each level's half as wide as the level's above. A box is listed
under the cells it touches on the level whose cells are just as wide as its longer side or
wider, which are four at most, whatever its size. A point looks up its cell of each level that
boxes are on: these are few, and known once the boxes are. The exact test follows.

Points are counted by place first, so a place said a million times is one row. A cell of many points,
as wide boxes have, is cut by salts of a bounded number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import TASK_ROWS

# The widest level's cells hold any box on a globe; level L has cells of WIDEST / 2^L.
WIDEST = 512.0
DEEPEST = 40
SIDES = ("south", "north", "west", "east")


def _level(width: Column) -> Column:
    """The deepest level whose cells are as wide as a box. Powers of two are exact in floats."""
    level = F.floor(F.log2(F.lit(WIDEST) / F.greatest(width, F.lit(WIDEST / 2 ** DEEPEST))))
    level = F.least(F.greatest(level, F.lit(0)), F.lit(DEEPEST)).cast("int")
    # a rounded logarithm may be one too deep
    return F.when((F.lit(WIDEST) / F.pow(F.lit(2.0), level) < width) & (level > 0), level - 1).otherwise(level)


def _cell(degrees: Column, level: Column) -> Column:
    return F.floor(degrees * F.pow(F.lit(2.0), level) / F.lit(WIDEST)).cast("bigint")


def covers(boxes: DataFrame) -> DataFrame:
    """``boxes`` with ``_level``, ``_row`` and ``_col``: one row per cell that a box touches. Boxes without all
    four sides, or turned inside out, touch none."""
    sound = boxes.where("south <= north AND west <= east").withColumn(
        "_level", _level(F.greatest(F.col("north") - F.col("south"), F.col("east") - F.col("west"))))
    level = F.col("_level")
    return (sound.withColumn("_row", F.explode(F.sequence(_cell(F.col("south"), level), _cell(F.col("north"), level))))
            .withColumn("_col", F.explode(F.sequence(_cell(F.col("west"), level), _cell(F.col("east"), level)))))


def points_in_regions(points: DataFrame, boxes: DataFrame, lat: str = "lat", lng: str = "lng",
                      task_rows: int = TASK_ROWS) -> DataFrame:
    """Each point with each box around it: the columns of ``points``, then those of ``boxes`` but the
    sides. Points without a position are in none."""
    listed = covers(boxes)
    levels = [r[0] for r in listed.select("_level").distinct().collect()]  # DEEPEST + 1 at most
    if not levels:
        levels = [0]
    placed = (points.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
              .withColumn("_level", F.explode(F.array(*[F.lit(n) for n in sorted(levels)]))))
    placed = placed.withColumns({"_row": _cell(F.col(lat), F.col("_level")), "_col": _cell(F.col(lng), F.col("_level"))})
    cell = ["_level", "_row", "_col"]
    # cells with more points than a task should get; fewer than rows / task_rows of a level
    crowded = (placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > task_rows)
               .select(*cell, F.ceil(F.col("_n") / task_rows).cast("int").alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))
    spread = (placed.join(crowded, cell, "left")
              .withColumn("_salt", F.pmod(F.xxhash64(*points.columns), salts).cast("int")).drop("_salts"))
    listed = (listed.join(crowded, cell, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts"))
    inside = (F.col(lat).between(F.col("south"), F.col("north"))
              & F.col(lng).between(F.col("west"), F.col("east")))
    return spread.join(listed, [*cell, "_salt"]).where(inside).drop(*cell, "_salt", *SIDES)


def counts_per_region(points: DataFrame, boxes: DataFrame, region: str = "region", lat: str = "lat",
                      lng: str = "lng", task_rows: int = TASK_ROWS) -> DataFrame:
    """``(region, n)``: points inside each box, 0 for a box with none; a region of several boxes
    counts a point once a box."""
    names: Sequence[str] = [region, *SIDES]
    places = (points.groupBy(F.col(lat).alias("_lat"), F.col(lng).alias("_lng"))
              .agg(F.count(F.lit(1)).alias("_count")))
    found = points_in_regions(places, boxes.select(*names), "_lat", "_lng", task_rows)
    counted = found.select(region, "_count").unionByName(boxes.select(region, F.lit(0).cast("bigint").alias("_count")))
    return counted.groupBy(region).agg(F.sum("_count").alias("n"))
