"""Table maintenance as DataFrames: upsert, high-water marks, caps, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ids import dense_ids
from .ranking import first_rows, latest_by


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str],
           newest_first: Sequence[Column] = ()) -> DataFrame:
    """``target`` with every ``source`` row put in by key: same key replaced, new
    key added. With ``newest_first`` a key that repeats in the source counts once,
    its first row in that order; without it keys must be unique."""
    incoming = latest_by(source, key, newest_first) if newest_first else source
    incoming = incoming.select(*target.columns)
    kept = target.join(incoming.select(*key), list(key), "left_anti")
    return kept.select(*target.columns).unionByName(incoming)


def high_water(df: DataFrame, value: str, ts: str | None = None) -> DataFrame:
    """``(last_value, last_ts)``: the largest value, or the largest among the rows
    of the newest time; one pass."""
    if ts is None:
        return df.agg(F.max(value).alias("last_value"))
    top = df.agg(F.max(F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))).alias("m"))
    return top.select(F.col("m.v").alias("last_value"), F.col("m.t").alias("last_ts"))


def capped(df: DataFrame, order: Sequence[str], n: int) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` rows in ``order``, and one row ``(row_count, last columns…)``
    that tells where the next export starts."""
    rows = first_rows(df, order, n)
    last = rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max(F.struct(*[F.col(c) for c in order],
                       *[F.col(c) for c in df.columns if c not in order])).alias("last"))
    return rows, last.select("row_count", "last.*")


def expire(df: DataFrame, cutoff: Column, bucket_col: str = "yymmddhh") -> DataFrame:
    """Rows newer than the cutoff bucket."""
    return df.where(F.col(bucket_col) > cutoff)


def with_next_ids(rows: DataFrame, target: DataFrame, id_col: str, key: Sequence[str],
                  recompute: bool = False) -> DataFrame:
    """Rows numbered on from the largest id stored in ``target``."""
    stored = target.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m"))
    return dense_ids(rows, id_col, key, start=stored.scalar(), recompute=recompute)


def append_with_ids(rows: DataFrame, target: DataFrame, id_col: str,
                    key: Sequence[str]) -> DataFrame:
    """``target`` plus the rows under new ids."""
    return target.unionByName(
        with_next_ids(rows, target, id_col, key).select(*target.columns))


def next_offset(files: DataFrame, log: DataFrame, group: str,
                path: str = "path") -> DataFrame:
    """``(k_offset)``: the larger of the last offset in the file names and the last
    one in the log (0 when neither has any)."""
    named = F.regexp_extract(path, r"_offset_(\d+)_", 1)
    in_files = files.agg(F.max(F.when(named != "", named).cast("bigint")).alias("o"))
    in_log = log.where(F.col("group_name") == group).agg(F.max("k_offset").alias("o"))
    return (in_files.unionAll(in_log)
            .agg(F.coalesce(F.max("o"), F.lit(0)).cast("bigint").alias("k_offset")))


def offset_entry(offset: DataFrame, group: str, partition: int, as_of: Column) -> DataFrame:
    """The log row to add."""
    return offset.select(
        F.lit(group).alias("group_name"), F.lit(partition).alias("k_partition"),
        "k_offset", as_of.alias("created_at"))
