"""File readers and writers.

Writers that lay rows out in folders ask for a rebalance on the folder column:
AQE then cuts a folder that holds much of the data into several tasks and joins
small ones, so a hot hour is no single task and a quiet one no crumb of a file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import clean_text
from ..functions.times import path_day
from ..operators.messages import locate
from ..session import durable

# ---------------------------------------------------------------- fixed values
FIELD_END = "\x07"
NULL_TEXT = "\\N"
ROW_END = "\n"
# -----------------------------------------------------------------------------


# ---- geo CSV lines

def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines of a path, a glob, or a list of either."""
    return spark.read.text(path)


def read_geo_csv(spark: SparkSession, path: str | list[str], day: str | None = None,
                 precision: int = 2) -> DataFrame:
    """``(lat, lng, text, cell_lat, cell_lng)`` of geo CSV files under a path or
    glob; with ``day`` of the ``day=MMddyy`` folder only.

    The CSV scan cuts the lines itself (no quoting; fields after the text are
    ignored). A line without three fields has no cell.
    """
    schema = schemas.GEO_CSV if day is None else schemas.GEO_CSV + ", day STRING"
    rows = (spark.read.schema(schema).option("quote", "").option("escape", "")
            .option("mode", "PERMISSIVE").csv(path))
    if day is not None:
        rows = rows.where(F.col("day") == day).drop("day")
    return locate(rows, precision)


def geo_csv_line(lat: Column, lng: Column, text: Column) -> Column:
    """``lat,lng,text`` with the text cleaned to one line; an empty field shows as
    the field-end mark."""
    def shown(c: Column) -> Column:
        return F.coalesce(F.when(c != "", c), F.lit(FIELD_END))

    return F.concat_ws(",", shown(F.nullif(lat, F.lit(0.0)).cast("string")),
                       shown(F.nullif(lng, F.lit(0.0)).cast("string")),
                       shown(clean_text(text)))


def export_geo_csv(df: DataFrame, path: str, lat: str = "lat", lng: str = "lng",
                   text: str = "text", ts: str | None = None, replace: bool = False) -> None:
    """Write geo CSV lines, with ``ts`` in one folder per day. Days that the rows do not have
    stay as they are, or with ``replace`` go."""
    value = geo_csv_line(F.col(lat), F.col(lng), F.col(text)).alias("value")
    if ts is None:
        df.select(value).write.mode("overwrite").text(path)
        return
    mode = "static" if replace else "dynamic"
    (df.select(value, path_day(F.col(ts)).alias("day")).hint("rebalance", "day")
     .write.mode("overwrite").option("partitionOverwriteMode", mode)
     .partitionBy("day").text(path))


# ---- delimited export and strict load

def delimited(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``value``: fields as text between field-end marks, NULL as ``\\N``, line
    ends taken out."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in cols]
    line = F.concat_ws(FIELD_END, *fields)
    return df.select(F.replace(line, F.lit(ROW_END), F.lit("")).alias("value"))


def export_delimited(df: DataFrame, cols: Sequence[str], path: str) -> None:
    delimited(df, cols).write.mode("overwrite").text(path)


def load_delimited(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Read such files back; one row that does not fit the schema fails the read."""
    return (spark.read.schema(schema)
            .option("sep", FIELD_END).option("nullValue", NULL_TEXT)
            .option("quote", "").option("escape", "").option("mode", "FAILFAST")
            .csv(path))


# ---- hour buckets

def write_buckets(df: DataFrame, path: str, bucket: str = "yymmddhh",
                  sort: Sequence[str] = (), folder: int | None = None) -> None:
    """Replace exactly the hours that ``df`` holds, so a re-run is harmless. With
    ``sort`` the files carry tight min/max statistics on those columns.

    An hour is a folder. Where hours are many and hold little, ``folder`` names how many leading
    characters share one: the hours lie in order in its files, whose statistics tell them
    apart, and the folders that rows go to are written anew with their other hours."""
    by = bucket
    if folder is not None:
        by = "_folder"
        df = _with_other_hours(df.withColumn(by, F.substring(bucket, 1, folder)), path, bucket)
    out = df.hint("rebalance", by)
    if sort or folder is not None:
        out = out.sortWithinPartitions(*dict.fromkeys([by, bucket]), *sort)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(by).parquet(path))


def _with_other_hours(df: DataFrame, path: str, bucket: str) -> DataFrame:
    """The rows and, of the folders they go to, the stored rows of other hours."""
    spark = df.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return df
    df = durable(df)
    stored = spark.read.schema(df.schema).parquet(path).alias("s")
    hours = df.select("_folder", bucket).distinct().alias("n")
    same = F.col("s._folder").eqNullSafe(F.col("n._folder"))
    held = F.col(f"s.{bucket}").eqNullSafe(F.col(f"n.{bucket}"))
    # staged, as the files they are read from are replaced
    others = durable(stored.join(hours, same, "left_semi").alias("s").join(hours, held, "left_anti"))
    return df.unionByName(others)


def read_buckets(spark: SparkSession, path: str,
                 schema: str = schemas.CELL_COUNTS) -> DataFrame:
    """A bucketed table; the schema keeps the bucket text (``03`` stays ``03``)."""
    return spark.read.schema(schema).parquet(path).drop("_folder")


def expire_buckets(spark: SparkSession, path: str, cutoff: str,
                   bucket: str = "yymmddhh") -> list[str]:
    """Delete whole hours up to and with the cutoff, right under the path or, as streams
    write them, in its batch folders. Looks at folder names only."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    hours = spark._jvm.org.apache.hadoop.fs.Path
    found = [s for depth in (f"{path}/{bucket}=*", f"{path}/batch_id=*/{bucket}=*")
             for s in fs.globStatus(hours(depth)) or []]
    for status in found:
        name = status.getPath().getName()
        if name.startswith(bucket + "=") and name[len(bucket) + 1:] <= cutoff:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(set(gone))


# ---- landed event pages and photo answers

def read_event_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(keyword, value)``: one search page per line under ``keyword=…`` folders."""
    return spark.read.schema("value STRING, keyword STRING").text(path)


def read_photo_answers(spark: SparkSession, path: str) -> DataFrame:
    """``(word, xml)``: one answer per file under ``word=…`` folders."""
    return (spark.read.schema("value STRING, word STRING").option("wholetext", True)
            .text(path).withColumnRenamed("value", "xml"))


def archive(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def file_paths(df: DataFrame) -> DataFrame:
    """``path`` of the files behind rows, each once."""
    return df.select(F.input_file_name().alias("path")).distinct()
