"""Cell tallies over a stream.

``micro_batches`` has no state: each batch is tallied alone and readers add the
batches up. ``event_hours`` keeps one running count per hour, cell and word and
gives what the batch job gives on the same messages.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions.times import hour_bucket
from ..operators.counts import (CELL, cell_counts, cell_tallies, counts_to_maps, speed_rows,
                                tokens, without_words)
from ..session import apply_settings
from . import compaction

# ---------------------------------------------------------------- fixed values
BATCH_SECONDS = "3 seconds"
# -----------------------------------------------------------------------------
CELL_TYPES = "cell_lat BIGINT, cell_lng BIGINT"


def read_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
                files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder as a stream, at most so many per batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None],
               checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run ``write`` on every micro-batch; without ``every`` only on what is there
    now, then stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (stream.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def _write_batch(df: DataFrame, path: str, batch: int, by: Sequence[str] = ()) -> None:
    """One folder per batch, overwritten when the batch is retried; in it one folder per
    hour where the rows have one."""
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/batch_id={batch}")


def micro_batches(stream: DataFrame, path: str, checkpoint: str, stop: Sequence[str] = (),
                  stamp: Column | Callable[[int], Column] | None = None,
                  every: str | None = None, precision: int = 3) -> StreamingQuery:
    """Located messages ``(cell_lat, cell_lng, text)`` to speed rows
    ``(yymmddhh, timestamp, lat, lng, data)``, one set per batch. ``stamp`` is the
    batch's time, or gives it by the batch's number; by default it is the clock. A batch is read once: words and messages are
    counted together."""
    def write(batch: DataFrame, batch_id: int) -> None:
        now = F.current_timestamp() if stamp is None else stamp
        now = now(batch_id) if callable(now) and not isinstance(now, Column) else now
        maps = counts_to_maps(cell_tallies(batch, CELL, stop=stop))
        rows = speed_rows(maps.withColumn("yymmddhh", hour_bucket(now)), "yymmddhh", now,
                          precision)
        _write_batch(rows, path, batch_id, ["yymmddhh"])

    return each_batch(stream, write, checkpoint, every)


def read_speed(spark: SparkSession, path: str) -> DataFrame:
    """The speed rows of all finished batches, merged or not. The hour is a folder, so a
    filter on it (``changes_since``) reads no older files."""
    folders = compaction.visible(spark, path)
    return compaction.read_folders(spark, path, folders, schemas.SPEED_COUNTS).drop("batch_id")


def compact_speed(spark: SparkSession, path: str, fanout: int = compaction.FANOUT) -> int:
    """Merge the folders of speed rows that have gathered; rows and their times stay."""
    return compaction.compact(spark, path, schemas.SPEED_COUNTS, ["lat", "lng", "timestamp"], "yymmddhh",
                              fanout=fanout)


def compact_counts(spark: SparkSession, path: str, by: str = CELL_TYPES,
                   fanout: int = compaction.FANOUT) -> int:
    """Merge the long-form batches that have gathered, adding counts up. ``by`` names the
    columns of a key and their types."""
    keys = [c.split()[0] for c in by.split(", ")]
    return compaction.compact(spark, path, f"{by}, word STRING, cnt BIGINT", [*keys, "word"],
                              sum_by=[*keys, "word"], fanout=fanout)


def micro_batch_counts(stream: DataFrame, path: str, checkpoint: str,
                       by: Sequence[str] = CELL, stop: Sequence[str] = (),
                       every: str | None = None) -> StreamingQuery:
    """The same in long form: ``(*by, word, cnt)`` per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(cell_counts(batch, by, stop=stop), path, batch_id)

    return each_batch(stream, write, checkpoint, every)


def sum_batches(spark: SparkSession, path: str, by: str = CELL_TYPES) -> DataFrame:
    """Long-form batches added up, merged or not."""
    keys = [c.split()[0] for c in by.split(", ")]
    rows = compaction.read_folders(spark, path, compaction.visible(spark, path),
                                   f"{by}, word STRING, cnt BIGINT")
    return rows.groupBy(*keys, "word").agg(F.sum("cnt").alias("cnt"))


def hour_windows(stream: DataFrame, ts: str = "ts", delay: str = "1 hour",
                 stop: Sequence[str] = ()) -> DataFrame:
    """Running ``(hour, cell_lat, cell_lng, word, cnt)`` by event time. ``delay`` is
    how late a message may come before its hour is closed to it."""
    timed = stream.withColumn("ts", F.col(ts).cast("timestamp")).withWatermark("ts", delay)
    words = without_words(tokens(timed, ["ts", *CELL]), list(stop))
    return (words.groupBy(F.window("ts", "1 hour").alias("w"), *CELL, "word")
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.col("w.start").alias("hour"), *CELL, "word", "cnt"))


def event_hours(windows: DataFrame, path: str, checkpoint: str,
                every: str | None = None) -> StreamingQuery:
    """Write the counts that changed in each batch. The open hours' counts are held in RocksDB,
    on the executors' disks."""
    apply_settings(windows.sparkSession, streaming=True)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (windows.writeStream.outputMode("update")
            .foreachBatch(lambda df, batch: _write_batch(df, path, batch))
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def latest_windows(spark: SparkSession, path: str) -> DataFrame:
    """The newest value of each count; a running count never falls, so that is
    the largest."""
    return (spark.read.parquet(path).groupBy("hour", *CELL, "word")
            .agg(F.max("cnt").alias("cnt")))
