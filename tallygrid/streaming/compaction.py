"""Merging the folders of micro-batches, while batches are written and read.

A stream that writes a folder every three seconds leaves 28,800 a day. ``compact`` merges
whole batches to runs and runs to larger ones, ``fanout`` at a time, so a row is written once
a level and readers open few folders: at most ``fanout`` runs a level, and the batches
since the last merge. Runs are sorted by cell inside an hour. Long-form counts are added up as
they are merged; speed rows keep their times, which readers filter on.

A run lies beside the batches in ``batch_id=-K``, K counting up, and keeps hour folders, so hours
expire in runs as in batches. A manifest (``sources.versions``) names the runs and up to which
batch they reach; readers take these runs and the finished batches after it, so at every moment
they see each batch once. A batch that is retried after it was merged is not seen again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versions as vs

FANOUT = 16


def _batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[9:]) for n in vs.names(spark, path) if n.startswith("batch_id="))


def _folder(path: str, number: int) -> str:
    return f"{path}/batch_id={number}"


def _reach(runs: list[dict]) -> int:
    return max((r["last"] for r in runs), default=-1)


def _tail(spark: SparkSession, path: str, after: int) -> list[int]:
    """The finished batches after a number, up to the first that is not."""
    out = []
    for n in _batches(spark, path):
        if n > after:
            if not vs.exists(spark, f"{_folder(path, n)}/_SUCCESS"):
                break
            out.append(n)
    return out


def visible(spark: SparkSession, path: str) -> list[str]:
    """The folders that hold every finished batch once."""
    _, runs = vs.latest(spark, path)
    found = [r["id"] for r in runs] + _tail(spark, path, _reach(runs))
    return [_folder(path, n) for n in found]


def read_folders(spark: SparkSession, path: str, folders: Sequence[str], schema: str) -> DataFrame:
    """Rows of some folders of a stream's output."""
    if not folders:
        return spark.createDataFrame([], f"{schema}, batch_id BIGINT")
    reader = spark.read.schema(f"{schema}, batch_id BIGINT").option("basePath", path)
    return reader.parquet(*folders)


def compact(spark: SparkSession, path: str, schema: str, sort: Sequence[str], hour: str | None = None,
            sum_by: Sequence[str] | None = None, fanout: int = FANOUT) -> int:
    """Merge what has gathered; gives the version that readers now see. ``hour`` is the column
    of the hour folders, ``sum_by`` the columns that make a count, whose ``cnt`` are added."""
    version, runs = vs.latest(spark, path)
    while True:
        tail = _tail(spark, path, _reach(runs))
        if len(tail) >= fanout:
            merged, level, rest = tail[:fanout], 1, runs
            first, last = merged[0], merged[-1]
        else:
            full = [level for level in {r["level"] for r in runs}
                    if sum(r["level"] == level for r in runs) >= fanout]
            if not full:
                return version
            old = [r for r in runs if r["level"] == min(full)][:fanout]
            merged, level = [r["id"] for r in old], min(full) + 1
            first, last = min(r["first"] for r in old), max(r["last"] for r in old)
            rest = [r for r in runs if r not in old]
        number = min([*_batches(spark, path), 0]) - 1
        rows = read_folders(spark, path, [_folder(path, n) for n in merged], schema).drop("batch_id")
        _write_run(rows, _folder(path, number), sort, hour, sum_by)
        runs = [*rest, {"id": number, "level": level, "first": first, "last": last}]
        version += 1
        vs.commit(spark, path, version, runs)


def _write_run(rows: DataFrame, folder: str, sort: Sequence[str], hour: str | None,
               sum_by: Sequence[str] | None) -> None:
    if sum_by:
        rows = rows.groupBy(*sum_by).agg(F.sum("cnt").alias("cnt"))
    by = [hour] if hour else []
    # a busy hour is cut into several files, quiet ones share tasks
    (rows.hint("rebalance", *by, *(() if by else sort[:1])).sortWithinPartitions(*by, *sort)
     .write.mode("overwrite").partitionBy(*by).parquet(folder))


def clean(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove the folders that none of the newest ``keep`` versions shows; gives their numbers."""
    kept = vs.forget(spark, path, keep)
    if not kept:
        return []
    reach, used = min(map(_reach, kept)), {r["id"] for runs in kept for r in runs}
    oldest = min(used, default=0)  # a run under it may be being written
    gone = [n for n in _batches(spark, path) if 0 <= n <= reach or oldest <= n < 0 and n not in used]
    for n in gone:
        vs.remove(spark, _folder(path, n))
    return gone
