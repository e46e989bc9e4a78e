"""Tables stored by key, whose upserts rewrite only the files they have rows in.

Rows lie in Parquet files sorted by key, each with the key's range in its statistics and a
Bloom filter per key column, under ``data``. A manifest (``sources.versions``) lists the files of
each version. An upsert finds the files that hold its keys from the key columns alone and
``_metadata.file_path``, writes what becomes of these and the new rows to new files, and
creates the next manifest. A job that ends before that leaves the old version; two writers
cannot both make the next one; readers of the old version end on it until ``clean_keyed``.

With ``within`` columns, files hold rows of one value of each, which the manifest names: a reader
asks for values and opens no other files.

A NULL in a key equals nothing: such rows are added by every upsert.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import latest_by
from ..session import discard, durable
from . import versions as vs

# Rows of a file, and of an upsert whose keys are given to the scan to skip row groups by.
FILE_ROWS, LISTED_KEYS = 2_000_000, 1000
PUSHED_VALUES = "spark.sql.parquet.pushdown.inFilterThreshold"


def _write(rows: DataFrame, root: str, key: Sequence[str], within: Sequence[str], files: int) -> list[dict]:
    """Rows to new files, in the order of the key; gives their entries."""
    spark, folder = rows.sparkSession, f"data/{uuid.uuid4().hex}"
    # a folder per value gives each file one value; the rows keep theirs beside it
    stored = rows.select("*", *[F.col(c).alias(f"_in_{c}") for c in within])
    writer = stored.repartitionByRange(files, *within, *key).sortWithinPartitions(*within, *key).write
    for column in key:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.partitionBy(*[f"_in_{c}" for c in within]).parquet(f"{root}/{folder}")
    written = (spark.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{root}/{folder}")
               .groupBy(F.col("_metadata.file_path").alias("file"))
               .agg(F.count(F.lit(1)).alias("n"), *[F.first(F.col(c).cast("string")).alias(c) for c in within]))
    return [{"file": f"{folder}/{r['file'].split(folder + '/', 1)[1]}", "rows": r["n"],
             "within": {c: r[c] for c in within}} for r in written.collect()]


def create_keyed(spark: SparkSession, root: str, rows: DataFrame, key: Sequence[str],
                 within: Sequence[str] = (), file_rows: int = FILE_ROWS) -> None:
    """The first version of a table."""
    rows = durable(rows)
    found = _write(rows, root, key, within, max(1, -(-rows.count() // file_rows)))
    head = {"key": list(key), "within": list(within), "file_rows": file_rows, "schema": rows.schema.json()}
    vs.commit(spark, root, 0, [head, *found])


def _version(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, dict, list[dict]]:
    if version is None:
        version, rows = vs.latest(spark, root)
    else:
        rows = vs.entries(spark, root, version)
    if not rows:
        raise FileNotFoundError(f"no table at {root}")
    return version, rows[0], rows[1:]


def _read(spark: SparkSession, root: str, head: dict, files: Sequence[dict]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(head["schema"]))
    if not files:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("recursiveFileLookup", "true")
            .parquet(*[f"{root}/{e['file']}" for e in files]))


def read_keyed(spark: SparkSession, root: str, where: dict[str, Sequence[str]] | None = None,
               version: int | None = None) -> DataFrame:
    """The rows of a version, the newest by default; ``where`` gives wanted values, as text, of
    ``within`` columns, and files of others are not opened."""
    _, head, files = _version(spark, root, version)
    return _read(spark, root, head, _of_values(files, where or {}))


def _of_values(files: Sequence[dict], where: dict[str, Sequence[str | None]]) -> list[dict]:
    return [e for e in files if all(e["within"][c] in values for c, values in where.items())]


def upsert_keyed(spark: SparkSession, root: str, source: DataFrame,
                 newest_first: Sequence[Column] = ()) -> dict[str, int]:
    """Put ``source`` into the table by key, in one new version: rows of a stored key are replaced,
    others added. A row moves where its ``within`` values change. Gives how many files were
    rewritten and added, and of how many rows."""
    return upsert_onto(spark, root, source, newest_first)[1]


def upsert_onto(spark: SparkSession, root: str, source: DataFrame, newest_first: Sequence[Column] = (),
                base: int | None = None) -> tuple[int, dict[str, int]]:
    """The same on top of version ``base`` (None: the newest), whatever later versions say; gives the
    new version's number, too. For tables whose versions a manifest over them names."""
    newest, head, files = _version(spark, root)
    if base is not None:
        _, head, files = _version(spark, root, base)
    key, within = head["key"], head["within"]
    incoming = latest_by(source, key, newest_first) if newest_first else source
    incoming = durable(incoming.select(*_read(spark, root, head, []).columns))
    touched = _touched(spark, root, head, files, incoming)
    old = [e for e in files if e["file"] in touched]
    kept = _read(spark, root, head, old).join(incoming.select(*key), key, "left_anti")
    count = incoming.count()
    rows = sum(e["rows"] for e in old)
    changed = kept.unionByName(incoming) if old else incoming
    new = _write(changed, root, key, within, max(len(old), -(-(rows + count) // head["file_rows"]))) if count else []
    vs.commit(spark, root, newest + 1, [head, *[e for e in files if e["file"] not in touched], *new])
    discard(incoming)
    return newest + 1, {"rewritten": len(old), "rewritten_rows": rows, "written": len(new)}


def _touched(spark: SparkSession, root: str, head: dict, files: Sequence[dict], incoming: DataFrame) -> set[str]:
    """The files that hold a key of ``incoming``; reads key columns, of the row groups only that
    their statistics and Bloom filters allow."""
    key = head["key"]
    if not files:
        return set()
    stored = _read(spark, root, head, files).select(*key, F.col("_metadata.file_path").alias("_file"))
    few = incoming.select(*key).limit(LISTED_KEYS + 1).collect()
    if len(few) <= LISTED_KEYS:
        for column in key:
            stored = stored.where(F.col(column).isin([r[column] for r in few]))
    found = stored.join(incoming.select(*key), key, "left_semi").select("_file").distinct()
    before = spark.conf.get(PUSHED_VALUES)
    spark.conf.set(PUSHED_VALUES, str(LISTED_KEYS))
    try:
        paths = [r["_file"] for r in found.collect()]
    finally:
        spark.conf.set(PUSHED_VALUES, before)
    # a task that writes for several values gives files of one name in several folders
    return {path[path.rindex("/data/") + 1:] for path in paths}


def clean_keyed(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the files that the versions before the newest ``keep`` name and these do not."""
    known = [vs.entries(spark, root, n)[1:] for n in vs.numbers(spark, root)]
    kept = vs.forget(spark, root, keep)
    used = {e["file"] for rows in kept for e in rows[1:]}
    gone = sorted({e["file"] for rows in known for e in rows} - used)
    for file in gone:
        vs.remove(spark, f"{root}/{file}")
    return gone
