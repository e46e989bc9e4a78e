"""Located rows stored for reads by range: a folder per day, in it files along a Morton curve.

The rows of a day are dealt to files by ranges of the curve and sorted by it inside, so files and
their row groups cover small patches. A read names days, which prunes folders, and ranges or
lists of both coordinates, whose row groups' statistics leave the patches that may hold them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geo import geo_in_range, morton

# Bytes of a row group; smaller ones skip more and cost more to list.
GROUP_BYTES = 32 << 20


def write_grid(df: DataFrame, path: str, day: str = "yymmdd", lat: str = "cell_lat", lng: str = "cell_lng",
               files: int | None = None, group_bytes: int = GROUP_BYTES) -> None:
    """Replace the days that ``df`` holds. Rows without a cell come first. ``files`` is about how
    many are written in all; by default as many as shuffles have partitions."""
    curve = F.coalesce(morton(F.col(lat), F.col(lng)), F.lit(-1))
    curved = df.withColumn("_curve", curve)
    ranged = (curved.repartitionByRange(files, day, "_curve") if files
              else curved.repartitionByRange(day, "_curve"))
    (ranged.sortWithinPartitions(day, "_curve").drop("_curve").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("parquet.block.size", group_bytes)
     .partitionBy(day).parquet(path))


def read_grid(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The stored rows; the schema keeps the day text."""
    return spark.read.schema(schema).parquet(path)


def in_range(stored: DataFrame, days: Sequence[str], lats: Sequence[int], lng_lo: float, lng_hi: float,
             day: str = "yymmdd", lat: str = "cell_lat", lng: str = "cell_lng") -> DataFrame:
    """Rows of some days, latitude out of a list, longitude inside an open interval."""
    return geo_in_range(stored.where(F.col(day).isin(list(days))), list(lats), lng_lo, lng_hi, lat, lng)
