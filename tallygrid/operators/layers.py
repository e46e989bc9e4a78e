"""Batch layer, speed layer, and the two together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import maps
from ..functions.geo import cell_index, coarsen, located
from ..functions.times import hour_bucket
from .counts import CELL, merge_maps, split_measure


def bucket(df: DataFrame, hour: str, bucket_col: str = "yymmddhh") -> DataFrame:
    """One hour (prunes to its directory on a bucketed table)."""
    return df.where(F.col(bucket_col) == hour)


def changes_since(df: DataFrame, since: Column, ts: str = "timestamp",
                  bucket_col: str = "yymmddhh") -> DataFrame:
    """Rows newer than ``since``; older hours are pruned by the bucket, so the
    change of hour loses nothing."""
    return df.where((F.col(bucket_col) >= hour_bucket(since)) & (F.col(ts) > since))


def latest_bucket(df: DataFrame, as_of: Column, bucket_col: str = "yymmddhh") -> DataFrame:
    """The hour of ``as_of``, or the hour before if that has no rows."""
    now = hour_bucket(as_of)
    before = hour_bucket(as_of - F.expr("INTERVAL 1 HOUR"))
    two = df.where(F.col(bucket_col).isin(now, before))
    newest = two.agg(F.max(bucket_col).alias("b"))
    return two.where(F.col(bucket_col) == newest.scalar())


def batch_view(map_counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Map rows of a bucket to words ``(cell, word, cnt)`` and messages
    ``(cell, tweets)``; rows of the same cell are summed."""
    return split_measure(merge_maps(located(map_counts), CELL, "data"), CELL)


def updates(speed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Speed rows ``(lat, lng, data text)`` to words and messages on the batch
    grid. Each row is summed at its own 3-decimal cell's coarse cell."""
    cells = speed.select(
        cell_index(F.col("lat"), 3).alias("cell_lat"),
        cell_index(F.col("lng"), 3).alias("cell_lng"),
        maps.text_to_pairs(F.col("data")).alias("data"))
    # The mark of rows without a place is the origin cell.
    placed = coarsen(cells).where((F.col("cell_lat") != 0) | (F.col("cell_lng") != 0))
    return split_measure(merge_maps(placed, CELL, "data"), CELL)


def _sum_union(a: DataFrame, b: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    cols = [*by, value]
    return (a.select(*cols).unionByName(b.select(*cols))
             .groupBy(*by).agg(F.sum(value).cast("bigint").alias(value)))


def merge_layers(batch_words: DataFrame, speed_words: DataFrame, batch_tweets: DataFrame,
                 speed_tweets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both layers added up: words per cell, and messages per cell. A cell in one
    layer only is kept as it is; a word twice in a cell becomes one row."""
    return (_sum_union(batch_words, speed_words, (*CELL, "word"), "cnt"),
            _sum_union(batch_tweets, speed_tweets, CELL, "tweets"))
