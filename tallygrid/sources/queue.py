"""A queue kept in files: messages addressed by partition and offset, and its drain.

A queue folder holds one segment folder per partition and run of offsets, as
``k_partition=P/segment=S``, rows sorted by offset. A read of a range of offsets names the
segments that hold it, so it lists and opens no others, and row-group statistics cut the
segments at its ends.

A drain takes what is there in batches of a bounded number of rows. A batch is written to
folders named by its number, which a repeat overwrites; the log entry that holds the
offsets it ends at is written last and is what makes it count. So a drain that ends anywhere
and is run again writes every message once, and gives the files of an undisturbed run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.times import from_epoch_ms, path_day
from ..operators.ids import ordered_ids
from ..operators.messages import FLAT_MESSAGE, flatten_messages, parse_messages
from ..operators.warehouse import offset_entry
from . import files
from .topics import BATCH_MESSAGES

SEGMENT_ROWS = 1_000_000
QUEUE = "k_offset BIGINT, value STRING, k_partition INT, segment BIGINT"
LOG = schemas.OFFSETS + ", batch_id BIGINT"


# ---- the queue

def append_messages(spark: SparkSession, rows: DataFrame, path: str, order: Sequence[Column | str],
                    partition: int = 0, segment_rows: int = SEGMENT_ROWS) -> None:
    """Add ``value`` rows to a partition under the offsets that follow its last, in ``order``
    (which must be total)."""
    first = end_offsets(spark, path).get(partition, 0)
    numbered = ordered_ids(rows, "k_offset", order, start=first - 1)
    segments = numbered.select("k_offset", "value", F.lit(partition).alias("k_partition"),
                               F.floor(F.col("k_offset") / segment_rows).alias("segment"))
    # the numbered rows lie in order in files, which are scanned in splits: a segment has a file or more
    (segments.sortWithinPartitions("segment", "k_offset").write.mode("append")
     .partitionBy("k_partition", "segment").parquet(path))


def _stored(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUEUE).parquet(path)


def end_offsets(spark: SparkSession, path: str) -> dict[int, int]:
    """The offset after the last message of each partition. Reads the newest segment of each
    only, and of it the offsets."""
    if not _stored(spark, path):
        return {}
    rows = read_queue(spark, path)
    newest = rows.select("k_partition", "segment").distinct().groupBy("k_partition").agg(
        F.max("segment").alias("segment")).collect()  # folder names alone
    ends = {}
    for r in newest:
        last = rows.where((F.col("k_partition") == r["k_partition"]) & (F.col("segment") == r["segment"]))
        ends[r["k_partition"]] = last.agg(F.max("k_offset")).first()[0] + 1
    return ends


def read_range(spark: SparkSession, path: str, start: dict[int, int], end: dict[int, int],
               segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Messages of each partition from ``start`` up to, not with, ``end``."""
    wanted = F.lit(False)
    for p, stop in end.items():
        low = start.get(p, 0)
        wanted = wanted | ((F.col("k_partition") == p)
                           & F.col("segment").between(low // segment_rows, max(low, stop - 1) // segment_rows)
                           & (F.col("k_offset") >= low) & (F.col("k_offset") < stop))
    return read_queue(spark, path).where(wanted)


# ---- the drain

def read_log(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(LOG).parquet(f"{out}/log")


def resume_point(spark: SparkSession, out: str, group: str) -> tuple[int, dict[int, int]]:
    """The number of the next batch, and the offsets it starts at."""
    if not _stored(spark, f"{out}/log"):
        return 0, {}
    done = read_log(spark, out).where(F.col("group_name") == group)
    ends = done.groupBy("k_partition").agg(F.max("k_offset").alias("o"), F.max("batch_id").alias("b")).collect()
    return max((r["b"] for r in ends), default=-1) + 1, {r["k_partition"]: r["o"] for r in ends}


def drain(spark: SparkSession, queue: str, out: str, group: str, as_of: Column,
          batch_rows: int = BATCH_MESSAGES, most_batches: int | None = None,
          segment_rows: int = SEGMENT_ROWS) -> list[int]:
    """Take what the queue holds, ``batch_rows`` messages of each partition at a time: flat
    text to ``flat``, geo CSV by day to ``geo``, the offsets reached to ``log``. Gives the
    numbers of the batches; stops when drained, or after ``most_batches``."""
    batch, start = resume_point(spark, out, group)
    last = end_offsets(spark, queue)
    done: list[int] = []
    while most_batches is None or len(done) < most_batches:
        end = {p: min(start.get(p, 0) + batch_rows, stop) for p, stop in last.items()}
        if all(end[p] <= start.get(p, 0) for p in end):
            break
        write_batch(read_range(spark, queue, start, end, segment_rows), out, batch)
        _log(spark, out, batch, end, group, as_of)
        done.append(batch)
        batch, start = batch + 1, {**start, **end}
    return done


def write_batch(messages: DataFrame, out: str, batch: int) -> None:
    """A batch's rows to its folders; parsed once, and again from the queue where they are lost."""
    parsed = parse_messages(messages.select("value")).persist()
    try:
        flat = flatten_messages(parsed)
        safe = flat.toDF(*[c.replace("-", "_") for c in FLAT_MESSAGE])
        files.export_delimited(safe, safe.columns, f"{out}/flat/batch_id={batch}")
        at = F.col("geo.coordinates")
        placed = parsed.select(F.get(at, F.lit(0)).alias("lat"), F.get(at, F.lit(1)).alias("lng"), "text",
                               from_epoch_ms(F.col("timestamp_ms")).alias("ts"))
        files.export_geo_csv(placed, f"{out}/geo/batch_id={batch}", ts="ts", replace=True)
    finally:
        parsed.unpersist()


def _log(spark: SparkSession, out: str, batch: int, end: dict[int, int], group: str, as_of: Column) -> None:
    entries = [offset_entry(spark.range(1).select(F.lit(o).cast("bigint").alias("k_offset")), group, p, as_of)
               for p, o in sorted(end.items())]
    rows = entries[0]
    for entry in entries[1:]:
        rows = rows.unionAll(entry)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{out}/log/batch_id={batch}")


def logged(spark: SparkSession, out: str, folder: str) -> list[str]:
    """The folders of the batches that count. One that was begun and not logged is left out."""
    numbers = [r[0] for r in read_log(spark, out).select("batch_id").distinct().collect()]
    return [f"{out}/{folder}/batch_id={n}" for n in sorted(numbers)]


def read_flat(spark: SparkSession, out: str) -> DataFrame:
    """The flat messages of all batches that count, as text."""
    schema = ", ".join(f"`{c}` STRING" for c in FLAT_MESSAGE)
    return files.load_delimited(spark, logged(spark, out, "flat"), schema)


def read_geo(spark: SparkSession, out: str) -> DataFrame:
    """``(value, batch_id, day)``: the geo CSV lines of all batches that count."""
    return (spark.read.schema("value STRING, batch_id BIGINT, day STRING").option("basePath", f"{out}/geo")
            .text(logged(spark, out, "geo")))
