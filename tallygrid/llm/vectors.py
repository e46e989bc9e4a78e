"""Exact range join of vectors by cosine, and its connected components.

Vectors are scaled to unit length, where cosine c is distance sqrt(2 - 2c), a metric. Pivots
partition them: a vector's home is the cell of its nearest pivot. A vector v also goes to
every cell that may hold a neighbour of it within distance r, that is to cell j unless one
of these shows there is none (i: its home, d: distance, R: how far vectors of the cell lie from its pivot):

* d(v, j) > R(j) + r, or d(v, j) > d(v, i) + 2 r, by the triangle inequality;
* v lies more than r beyond the plane halfway between pivots i and j.

So a cell's neighbours are among its home vectors and its guests, and each home vector's
links are counted in its home cell, once. Cells are cut into blocks of ``block`` home vectors.
A vector is stored once, in the file of its block; a block is one task, which holds its home
vectors and reads past them the blocks that the bounds leave, a few rows at a time. So what a
task holds, what is shuffled and what lies on disk does not grow with the number of blocks.
Single precision, with what its rounding may take, finds the rows that may have a link;
these get cosines in double precision. A task emits one count per home vector and the links
of a spanning forest, never the pairs; links of two blocks come from one of them only.

Equal vectors are joined once, as a class with its number of rows. What is broadcast is the
pivots: one for ``block`` vectors, ``MOST_PIVOTS`` at most.

Where distances hardly differ, as between random vectors of many dimensions, no metric
bound prunes and a cell gets most of the vectors: the join is then as quadratic as the
problem.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components
have no link; vectors of different lengths do not link; a repeated id is a row each time;
a NULL id is never the name of a component, unless all of its ids are NULL; an empty table
gives an empty result. Only the two named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.session import release

from .common import components, drop_staged, folder_uri, freed, new_file, open_file, slices, small_batches, staged

COSINE = 0.95
BLOCK = 4096
MOST_PIVOTS = 1024
STEP = 1024
SLACK = 1e-7  # what rounding may take from a bound


def _units(raw: pa.Array, length: int) -> np.ndarray:
    fixed = raw.cast(pa.binary(8 * length))
    return np.frombuffer(fixed.buffers()[1], "<f8", len(fixed) * length, fixed.offset * 8 * length).reshape(-1, length)


def unit_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, length, unit): the scaled vector as bytes of doubles, NULL for one without links."""

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, STEP):
            out, lengths = [], []
            for v in batch.column("v").to_pylist():
                x = np.array(v if v else [], np.float64) if v is None or None not in v else np.zeros(0)
                x = x if len(x) and np.isfinite(x).all() else np.zeros(0)
                if len(x):  # twice, so that neither tiny nor huge components are lost
                    most = np.abs(x).max()
                    x = x / most if most > 0 else np.zeros(0)
                    x = x / np.linalg.norm(x) if len(x) else x
                lengths.append(len(x))
                out.append(x.astype("<f8").tobytes() if len(x) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(lengths, pa.int32()), pa.array(out, pa.binary())],
                ["id", "length", "unit"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(freed(scale), "id long, length int, unit binary")


def _apart(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * cosines))


def _assign(units: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(home, distance from its pivot)"""
    cosines = units @ pivots.T
    home = cosines.argmax(1)
    return home, _apart(cosines[np.arange(len(home)), home])


def _homes(classes: DataFrame, pivots: np.ndarray, length: int) -> dict[int, int]:
    """Home vectors per cell."""

    def assign(batches):
        for batch in slices(batches, STEP):
            if batch.num_rows:
                home, _ = _assign(_units(batch.column("unit"), length), pivots)
                yield pa.RecordBatch.from_arrays([pa.array(home)], ["cell"])

    found = classes.select("unit").mapInArrow(freed(assign), "cell long").groupBy("cell").count()
    return {r["cell"]: r["count"] for r in found.collect()}


def _stored(classes: DataFrame, pivots: np.ndarray, length: int, block: int, folder: str) -> tuple[DataFrame, int]:
    """(block, cell, reach, file): each class in the file of its block, which is of a cell and as far
    as ``reach`` from its pivot; the number of blocks."""
    sizes = _homes(classes, pivots, length)
    blocks = np.array([max(1, -(-sizes.get(j, 0) // block)) for j in range(len(pivots))])
    first = np.cumsum(blocks) - blocks
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("unit", pa.binary(8 * length))])

    def deal(batches):
        for batch in slices(batches, STEP):
            if batch.num_rows:
                home, far = _assign(_units(batch.column("unit"), length), pivots)
                own = first[home] + batch.column("tie").to_numpy() % blocks[home]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.astype(np.int32)), pa.array(home.astype(np.int32)), pa.array(far), batch.column("id"),
                     batch.column("n"), batch.column("unit")], ["block", "cell", "far", "id", "n", "unit"])

    def store(batches):
        some = (batch for batch in slices(batches, STEP) if batch.num_rows)
        head = next(some, None)
        if head is None:
            return
        reach = 0.0
        with new_file(folder, ".arrow") as (file, out), pa.ipc.new_file(out, schema) as to:
            for batch in chain([head], some):
                reach = max(reach, batch.column("far").to_numpy().max())
                to.write_batch(pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("n"), batch.column("unit").cast(schema.field("unit").type)],
                    schema=schema))
        yield pa.RecordBatch.from_arrays([head.column("block").slice(0, 1), head.column("cell").slice(0, 1),
                                          pa.array([reach]), pa.array([file])], ["block", "cell", "reach", "file"])

    spread = classes.select("id", "n", "unit", F.abs(F.xxhash64("unit") % (1 << 30)).alias("tie"))
    dealt = spread.mapInArrow(freed(deal), "block int, cell int, far double, id long, n long, unit binary")
    return (dealt.repartitionById(int(blocks.sum()), F.col("block"))
            .mapInArrow(freed(store), "block int, cell int, reach double, file string"), int(blocks.sum()))


def _read(file: str, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, n, units) of a block, some rows at a time."""
    with open_file(file) as source, pa.ipc.open_file(source) as rows:
        for i in range(rows.num_record_batches):
            batch = rows.get_batch(i)
            yield batch.column("id").to_numpy(), batch.column("n").to_numpy(), _units(batch.column("unit"), length)


def _found(kind: int, ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), kind, np.int32)), pa.array(ids, pa.int64()),
                                       pa.array(values, pa.int64())], ["kind", "id", "value"])


def _join_block(stored: dict[int, tuple[int, float, str]], pivots: np.ndarray, length: int, cosine: float):
    """Of each block among a task's rows: counts (kind 0: id, links) and forest links
    (kind 1: id, linked id). ``stored``: each block's cell, reach and file."""
    radius = math.sqrt(2 - 2 * cosine) + SLACK
    maybe = np.float32(cosine - (length + 8) * 2.0 ** -23)  # what single precision makes of a link at least

    def join_one(block: int) -> Iterator[pa.RecordBatch]:
        cell, far, file = stored[block]
        ids, counts, units = map(np.concatenate, zip(*_read(file, length)))
        single = units.T.astype(np.float32)
        links, labels = np.zeros(len(units), np.int64), np.arange(len(units))

        def against(n: np.ndarray, other: np.ndarray, joins: bool) -> tuple[np.ndarray, np.ndarray]:
            """Join with some vectors: which of them have a link, and with which home vector one each."""
            nonlocal labels
            some = np.flatnonzero((other.astype(np.float32) @ single >= maybe).any(1))
            near = other[some] @ units.T >= cosine if len(some) else np.zeros((0, len(units)), bool)
            linked = near.any(1)
            some, near = some[linked], near[linked]
            if not len(some):
                return some, some
            links[:] += n[some] @ near
            if not joins:
                return some, some
            low, high = np.where(near, labels, len(labels)).min(1), np.where(near, labels, -1).max(1)
            for k in np.flatnonzero(low != high):
                group = np.unique(labels[near[k]])
                if len(group) > 1:
                    labels = np.where(np.isin(labels, group), group[0], labels)
            return some, near.argmax(1)

        for s in range(0, len(units), STEP):
            against(counts[s:s + STEP], units[s:s + STEP], True)
        links[:] -= 1  # of a class's own rows, all but the row itself
        for other_block, (home, reach, other_file) in stored.items():
            if other_block == block:
                continue
            apart = _apart(pivots[home] @ pivots[cell])
            if home != cell and (apart > reach + far + radius or apart > 2 * (reach + radius)):
                continue
            for guest_ids, n, guests in _read(other_file, length):
                if home != cell:
                    own, here = guests @ pivots[home], guests @ pivots[cell]
                    close = ((_apart(here) <= far + radius) & (_apart(here) <= _apart(own) + 2 * radius)
                             & (own - here <= radius * apart + SLACK))
                    guest_ids, n, guests = guest_ids[close], n[close], guests[close]
                if len(guests):
                    some, at = against(n, guests, other_block > block)
                    if other_block > block and len(some):
                        yield _found(1, guest_ids[some], ids[at])
        yield _found(0, ids, links)
        joined = np.flatnonzero(labels != np.arange(len(labels)))
        yield _found(1, ids[joined], ids[labels[joined]])

    def join(batches):
        for batch in batches:
            for block in batch.column("block").to_pylist():
                yield from join_one(block)

    return join


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *,
                 cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """One row per input row: id, n_links (other rows within the cosine), component_id (the
    smallest id that links lead to, itself included) and kept (it is that id)."""
    spark = df.sparkSession
    small_batches(spark)
    units = staged(unit_vectors(df, id_col, vector_col))
    whole = units.where("unit IS NOT NULL")
    # A class's node is its smallest id, but a hash where it has none or shares it.
    turn = F.row_number().over(Window.partitionBy("least").orderBy("length", "unit"))
    own_id = F.col("least").isNotNull() & (turn == 1)
    classes = staged(whole.groupBy("unit", "length").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
                     .withColumn("id", F.when(own_id, F.col("least")).otherwise(F.xxhash64("unit", "length")))
                     .withColumn("key", F.xxhash64("unit")))
    # From here on, rows and classes go by their nodes.
    members = staged(whole.join(classes.select("unit", "length", F.col("id").alias("node")), ["unit", "length"])
                     .select("id", "node")
                     .union(units.where("unit IS NULL").select("id", F.lit(None).cast("long"))))
    drop_staged(units)
    sizes = classes.groupBy("length").count().collect()
    without = _without_links(members.where("node IS NULL").select("id"), id_col)
    if not sizes:
        return without
    results, folders = None, []
    for r in sorted(sizes, key=lambda r: r["length"]):
        length, n = r["length"], r["count"]
        own = classes.where(F.col("length") == length)
        some = own.orderBy("key", "unit").select("unit").limit(min(MOST_PIVOTS, -(-n // block))).collect()
        pivots = np.array([np.frombuffer(x["unit"], "<f8") for x in some])
        folders.append(folder_uri(spark, "vectors"))
        files, parts = _stored(own, pivots, length, block, folders[-1])
        files = staged(files)
        stored = {r["block"]: (r["cell"], r["reach"], r["file"]) for r in files.collect()}
        found = (files.select("block").repartitionById(parts, F.col("block"))
                 .mapInArrow(freed(_join_block(stored, pivots, length, cosine)), "kind int, id long, value long"))
        results = found if results is None else results.union(found)
    nodes = staged(classes.select("id", "least"))
    drop_staged(classes)
    results = staged(results)
    for folder in folders:
        release(spark, folder)
    counts = results.where("kind = 0").select("id", F.col("value").alias("n_links"))
    links = results.where("kind = 1").select(F.col("id").alias("a"), F.col("value").alias("b"))
    joined = (nodes.join(counts, "id")
              .join(components(links).withColumnRenamed("node", "id"), "id", "left")
              .withColumn("c", F.coalesce("component", "id")))
    names = joined.groupBy("c").agg(F.min("least").alias("component_id"))
    joined = staged(joined.join(names, "c").select(F.col("id").alias("node"), "n_links", "component_id"))
    linked = members.join(joined, "node").select(F.col("id").alias(id_col), "n_links", "component_id")
    linked = linked.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
    return linked.union(without)


def _without_links(ids: DataFrame, id_col: str) -> DataFrame:
    return ids.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                      F.col("id").alias("component_id"), F.lit(True).alias("kept"))
