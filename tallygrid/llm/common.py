"""Helpers the corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrid.session import new_dir, release, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a session that was started
    without it (``--py-files``)."""
    context = spark.sparkContext
    if getattr(context, "_tallygrid_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tallygrid-")) / "tallygrid.zip"  # served by the driver
    with zipfile.ZipFile(archive, "w") as out:
        for source in package.rglob("*.py"):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tallygrid_shipped = True


def small_batches(spark: SparkSession) -> None:
    """Few rows and bytes at a time between the JVM and the Python workers, and out of Parquet
    files: both hold a batch whole, and the JVM never gives back what its largest took."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "512")


def drop_staged(*frames: DataFrame) -> None:
    """Remove what ``staged`` wrote for frames that nothing reads any more."""
    for df in frames:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            release(df.sparkSession, path)


def text_of(column: str) -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lowered and all else untouched."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a NULL id counts as ''."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % modulus).cast("int")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each altered until no column of ``df`` is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def replace_columns(df: DataFrame, added: dict[str, Column]) -> list[Column]:
    """All columns of ``df`` but those that ``added`` names, then the added ones."""
    lost = {name.lower() for name in added}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in lost]
    return kept + [value.alias(name) for name, value in added.items()]


def with_field(schema: T.StructType, name: str, kind: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, T._parse_datatype_string(kind))])


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, to bound what one step holds."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


HELD: list = []  # of functions whose results a worker keeps for its next tasks (``lru_cache``)


def freed(task, *uses):
    """``task`` (a function of batches), giving back what it held as it ends: Python workers
    stay for later stages, and would keep the largest size they ever had. What the functions
    of ``HELD`` keep for other operators' tasks is dropped as it begins, but for ``uses``."""
    def run(batches):
        for held in HELD:
            if held not in uses:
                held.cache_clear()
        yield from task(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return run


def text_bytes(texts: pa.Array) -> list[bytes]:
    return [v or b"" for v in texts.cast(pa.large_binary()).to_pylist()]


@contextlib.contextmanager
def new_file(folder: str, suffix: str):
    """A file of a name that no other task or attempt uses: (its address, a stream).

    A failed attempt leaves a file that no manifest names.
    """
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    with system.open_output_stream(f"{root}/{name}", compression=None) as out:
        yield f"{folder}/{name}", out


def open_file(address: str):
    system, path = fs.FileSystem.from_uri(address)
    return system.open_input_file(path)


def folder_uri(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one, as an address that tasks can open."""
    path = spark._jvm.org.apache.hadoop.fs.Path(new_dir(spark, name))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString().replace("file:/", "file:///", 1).replace(
        "file://///", "file:///")


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected ``links`` (a, b): rows (node, component), the
    component being its smallest node. Nodes without a link do not appear; links with a
    NULL end or of a node to itself are left out.

    Large-star and small-star steps: every step replaces links by links to a smaller
    neighbour, keeps the components and ends as a star on the smallest node. Each step
    is written to the shared folder; minima are combined before they are shuffled, and
    both sides of the joins are plain shuffles, so that a hub's rows can be split.
    """
    now = staged(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _all_stars(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))
        large = staged(large.union(low.where("u <> m")))
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").union(down).distinct())
        after = staged(small)
        drop_staged(now, large)
        now = after
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _all_stars(links: DataFrame) -> bool:
    """Whether each node has one link to a smaller node, which has none, or none itself."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select("v", F.lit(0), F.lit(1)))
    odd = (ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
           .where("up > 1 OR up > 0 AND down > 0"))
    return not odd.take(1)
