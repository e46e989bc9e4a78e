"""Versions of a folder: a manifest file names what readers see.

``_versions/N.json`` under the folder lists the entries of version N, one JSON object a line.
Writers put new files beside the old ones and then create the next manifest, which only one
writer can; readers take the newest manifest and open what it names. What no kept
version names is removed later, so a reader that began on an older version ends on it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_versions"


class Conflict(Exception):
    """Another writer has made this version."""


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none where there is no folder."""
    fs, where = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def numbers(spark: SparkSession, root: str) -> list[int]:
    found = [n for n in names(spark, f"{root}/{FOLDER}") if n.endswith(".json") and not n.startswith(".")]
    return sorted(int(n.removesuffix(".json")) for n in found)


def entries(spark: SparkSession, root: str, version: int) -> list[dict]:
    fs, where = _fs(spark, f"{root}/{FOLDER}/{version}.json")
    stream = fs.open(where)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return [json.loads(line) for line in text.splitlines()]


def latest(spark: SparkSession, root: str) -> tuple[int, list[dict]]:
    """The newest version and its entries; -1 and none where there is none."""
    found = numbers(spark, root)
    return (found[-1], entries(spark, root, found[-1])) if found else (-1, [])


def commit(spark: SparkSession, root: str, version: int, rows: list[dict]) -> None:
    """Create a version: written under a name of its own, then renamed."""
    fs, target = _fs(spark, f"{root}/{FOLDER}/{version}.json")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{FOLDER}/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray("\n".join(json.dumps(r) for r in rows).encode()))
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise Conflict(f"version {version} of {root} is there already")


def forget(spark: SparkSession, root: str, keep: int) -> list[list[dict]]:
    """Remove the manifests before the newest ``keep``; the entries of those that stay."""
    found = numbers(spark, root)
    for old in found[:-keep]:
        remove(spark, f"{root}/{FOLDER}/{old}.json")
    return [entries(spark, root, n) for n in found[-keep:]]
