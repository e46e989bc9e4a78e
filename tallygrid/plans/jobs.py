"""The batch jobs. ``as_of`` is always passed in; nothing reads the clock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.geo import cell_index, located, split_cell
from ..functions.text import default_stop_words
from ..functions.times import hour_bucket
from ..operators import conferences as cf
from ..operators import photos as ph
from ..operators.counts import (CELL, batch_rows, cell_counts, cell_messages,
                                counts_to_maps, marked_counts, split_measure)
from ..operators.layers import bucket, latest_bucket
from ..sources import files
from ..sources import tables as tb

KEYED = ("yymmddhh", *CELL)
# Parts of a stored table that an upsert may rewrite alone.
TABLE_BUCKETS = 64


def hourly_tallies(lines: DataFrame, as_of: Column,
                   stop: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Words and messages per cell of one hour's lines."""
    stamped = located(lines).withColumn("yymmddhh", hour_bucket(as_of))
    return cell_counts(stamped, KEYED, stop=stop), cell_messages(stamped, KEYED)


def hourly_job(spark: SparkSession, csv_path: str, out: str, as_of: Column,
               stop: Sequence[str] | None = None, day: str | None = None) -> None:
    """Geo CSV files to the hour's counts, a row per cell and word, messages under their
    reserved key; running it again replaces the hour."""
    lines = files.read_geo_csv(spark, csv_path, day)
    words, tweets = hourly_tallies(
        lines, as_of, default_stop_words() if stop is None else stop)
    files.write_buckets(marked_counts(words, tweets, KEYED), out, sort=CELL)


def export_maps(spark: SparkSession, path: str, hour: str, out: str, as_of: Column) -> None:
    """One stored hour as map rows, for readers that want a cell's words together."""
    stored = bucket(files.read_buckets(spark, path), hour)
    files.write_buckets(batch_rows(counts_to_maps(stored, KEYED), "yymmddhh", as_of), out)


def conference_job(spark: SparkSession, words: DataFrame, tweets: DataFrame,
                   events_table: str, stats_table: str, as_of: Column) -> None:
    """Statistics of recent events, put into the stored table by event."""
    stored = tb.ensure_table(spark, stats_table, schemas.CONFERENCE_STATS, buckets=TABLE_BUCKETS)
    last = stored.agg(F.coalesce(F.max("tid"), F.lit(0)).alias("m"))
    stats = cf.conference_stats(spark.table(events_table), words, tweets, as_of,
                                start_id=last.scalar())
    tb.upsert_table(spark, stats_table, stats, ["eb_id"])


def word_job(spark: SparkSession, counts: DataFrame, words_table: str,
             as_of: Column) -> None:
    """One hour's words, appended under new ids."""
    tb.ensure_table(spark, words_table, schemas.WORDS)
    rows = cf.word_rows(counts, as_of).drop("wid")
    tb.append_table(spark, words_table, rows, "wid", ["latitude", "longitude", "words"],
                    F.col("created_at") == as_of)


def photo_job(spark: SparkSession, counts: DataFrame, events: DataFrame,
              index: DataFrame, photos_table: str, as_of: Column,
              keep_days: int = 7) -> None:
    """Photos of the words at recent events, appended to their hour; old hours are
    dropped whole."""
    tb.ensure_table(spark, photos_table, schemas.PHOTOS, partition_by=["yymmddhh"])
    words = ph.event_words(events, counts, as_of)
    found = ph.found_photos(words, index).withColumn("yymmddhh", hour_bucket(as_of))
    tb.append_table(spark, photos_table, found, "pid", ["word", "url"],
                    F.col("yymmddhh") == hour_bucket(as_of))
    cutoff = hour_bucket(as_of - F.expr(f"INTERVAL {keep_days} DAYS"))
    tb.expire_table(spark, photos_table, spark.range(1).select(cutoff).first()[0])


def event_job(spark: SparkSession, pages: DataFrame, events_table: str, archive: str,
              as_of: Column) -> None:
    """Landed search pages into the catalogue, and all columns to the archive. The
    same event under two keywords is stored once."""
    tb.ensure_table(spark, events_table, schemas.EVENTS, buckets=TABLE_BUCKETS)
    found = cf.page_events(pages)
    files.archive(cf.archive_events(found), archive)
    tb.upsert_table(spark, events_table, cf.flatten_events(found, as_of), ["eb_id"],
                    [F.desc("created_at"), F.asc("category")])


def current_view(spark: SparkSession, path: str,
                 as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Words and messages per cell of the newest hour stored."""
    return _view(latest_bucket(files.read_buckets(spark, path), as_of))


def hour_view(spark: SparkSession, path: str, hour: str) -> tuple[DataFrame, DataFrame]:
    return _view(bucket(files.read_buckets(spark, path), hour))


def _view(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_measure(rows.select(*CELL, "word", "cnt"), CELL)


def read_map_buckets(spark: SparkSession, path: str) -> DataFrame:
    """Map rows with their cell, which the location text names exactly."""
    rows = files.read_buckets(spark, path, schemas.MAP_COUNTS)
    at = split_cell(F.col("location"))
    placed = rows.withColumns({"cell_lat": cell_index(at["lat"]),
                               "cell_lng": cell_index(at["lng"])})
    return placed.where((F.col("cell_lat") != 0) | (F.col("cell_lng") != 0))
