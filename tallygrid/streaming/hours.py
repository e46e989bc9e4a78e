"""Hours that close: event-time tallies written once an hour's end is behind the watermark.

The watermark of a batch is the latest message time of the batches before it, less the delay, as
Spark has it. A message whose hour had ended by then is late: it goes to a side output as it is
and changes no count. All others are tallied by hour into ``open``, a folder a batch and hour,
and an hour that the batch's own times leave behind is added up from these into one folder of
``closed``, which no later batch touches. So every message is in its hour's counts or among the
late ones, and what is held between batches are files, whose size no task's memory bounds.

A batch ends with a manifest (``sources.versions``) that holds the latest time; it says that
the batch is done. Whatever a batch writes before that is overwritten when it is run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions.times import hour_bucket
from ..operators.counts import CELL, cell_counts
from ..sources import files
from ..sources import versions as vs
from .counts import each_batch

HOUR = "yymmddhh"
HOUR_MICROS = 3_600_000_000
# Files of an hour in a batch at most, so tasks that share a full hour.
HOUR_FILES = 8


def _end(hour: str) -> int:
    """When the hour of a folder's name ends, in microseconds."""
    start = datetime.strptime(hour, "%y%m%d%H").replace(tzinfo=timezone.utc)
    return round((start + timedelta(hours=1)).timestamp()) * 1_000_000


def close_hours(stream: DataFrame, path: str, checkpoint: str, delay: timedelta = timedelta(hours=1),
                stop: Sequence[str] = (), ts: str = "ts", every: str | None = None) -> StreamingQuery:
    """Located messages to ``closed`` hours of cell and word counts, and ``late`` messages. Messages without
    a time count as late."""
    behind = delay // timedelta(microseconds=1)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        version, state = vs.latest(spark, path)
        if version >= number:  # ended, and run again all the same
            return
        high = state[0]["high"] if state else None
        mark = None if high is None else high - behind
        held = batch.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp"))).persist()
        try:
            _split(held, number, mark)
            newest = held.agg(F.max("_at")).first()[0]
        finally:
            held.unpersist()
        high = max((t for t in (high, newest) if t is not None), default=None)
        ended = [] if high is None else [x for x in _open(spark) if _end(x[1]) <= high - behind]
        fresh = sorted({hour for _, hour in ended if mark is None or _end(hour) > mark})
        if fresh:
            _close(spark, fresh)
        vs.commit(spark, path, number, [{"high": high}])
        vs.forget(spark, path, keep=2)
        for batch_folder, hour in ended:  # counted, or left by a batch that ended here
            vs.remove(spark, f"{path}/open/{batch_folder}/{HOUR}={hour}")

    def _split(held: DataFrame, number: int, mark: int | None) -> None:
        is_late: Column = F.col("_at").isNull()
        if mark is not None:
            is_late = is_late | (F.col("_at") - F.pmod("_at", F.lit(HOUR_MICROS)) + HOUR_MICROS <= mark)
        held.where(is_late).drop("_at").write.mode("overwrite").parquet(f"{path}/late/batch_id={number}")
        timed = held.where(~is_late).withColumn(HOUR, hour_bucket(F.col(ts).cast("timestamp")))
        counts = cell_counts(timed, [HOUR, *CELL], stop=stop)
        # else every task has rows, and a file, of every hour
        (counts.repartition(HOUR, F.pmod(F.xxhash64(*CELL, "word"), F.lit(HOUR_FILES))).write.mode("overwrite")
         .partitionBy(HOUR).parquet(f"{path}/open/batch_id={number}"))

    def _open(spark: SparkSession) -> list[tuple[str, str]]:
        """The batch folders and hours that are open; looks at names only."""
        return [(b, n.split("=", 1)[1]) for b in vs.names(spark, f"{path}/open")
                for n in vs.names(spark, f"{path}/open/{b}") if n.startswith(HOUR + "=")]

    def _close(spark: SparkSession, hours: Sequence[str]) -> None:
        parts = (spark.read.schema(schemas.CELL_COUNTS + ", batch_id BIGINT").parquet(f"{path}/open")
                 .where(F.col(HOUR).isin(list(hours))))
        summed = parts.groupBy(HOUR, *CELL, "word").agg(F.sum("cnt").alias("cnt"))
        files.write_buckets(summed.select(*CELL, "word", "cnt", HOUR), f"{path}/closed", sort=CELL)

    return each_batch(stream, write, checkpoint, every)


def read_closed(spark: SparkSession, path: str) -> DataFrame:
    """Counts of the closed hours; hours are folders, which ``expire_buckets`` removes."""
    if not vs.exists(spark, f"{path}/closed"):
        return spark.createDataFrame([], schemas.CELL_COUNTS)
    return files.read_buckets(spark, f"{path}/closed")


def read_late(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The late messages."""
    return spark.read.schema(f"{schema}, batch_id BIGINT").parquet(f"{path}/late").drop("batch_id")
