"""Dense numbering without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable


def dense_ids(df: DataFrame, id_col: str, key: Sequence[str],
              start: Column | int = 0, shard_digits: int = 3,
              recompute: bool = False) -> DataFrame:
    """Number rows ``start+1, start+2, …`` without gaps.

    ``key`` must be unique. Rows are ordered by ``(shard, key)``, a shard being
    the first hex digits of the key's md5: shards are even whatever the key looks
    like, and the offsets table has at most ``16^shard_digits`` rows, which is
    what makes broadcasting it safe. No sampling is involved, so a recomputed
    partition gets the same ids.

    The rows are read twice, to count the shards and to number them; they are made
    durable first, so that what made them runs once. ``recompute`` leaves that out
    where the rows are a plain scan.
    """
    if not 1 <= shard_digits <= 5:
        raise ValueError("shard_digits must be 1 to 5")
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    shard = F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, shard_digits)
    sharded = df.withColumn("_shard", shard)
    if not recompute:
        sharded = durable(sharded)
    sizes = sharded.groupBy("_shard").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_shard").orderBy(*key))
    first = F.lit(start) if isinstance(start, int) else start
    return (sharded.withColumn("_rn", within)
            .join(F.broadcast(offsets), "_shard")
            .withColumn(id_col, (first + F.col("_before") + F.col("_rn")).cast("bigint"))
            .drop("_shard", "_rn", "_before"))


# Rows of a sorted part, and bytes of their values.
PART_ROWS, PART_BYTES = 1_000_000, 256 << 20


def ordered_ids(df: DataFrame, id_col: str, order: Sequence[Column | str], start: int = 0,
                recompute: bool = False, part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES) -> DataFrame:
    """Number rows ``start+1, …`` in ``order`` (which must be total).

    Rows are range-partitioned on the whole order, so one repeated leading value
    still spreads, into parts of about ``part_rows`` rows, or ``part_bytes`` bytes where the
    texts of so many have more; the sorted rows are made
    durable, counted per part, and each part gets the sum of those before it. The
    offsets table has one row per part.

    The rows are counted, sampled and sorted, so they are made durable first;
    ``recompute`` leaves that out where they are a plain scan.
    """
    if not recompute:
        df = durable(df)
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema
             if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    wide = sum(texts, F.lit(8 * len(df.columns)).cast("bigint"))
    count, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(wide), F.lit(0))).first()
    n = max(1, -(-count // part_rows), -(-size // part_bytes))
    ranged = durable(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
          .withColumn("_pos", F.monotonically_increasing_id()))
    part = F.shiftright("_pos", 33)
    local = F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    ranged = ranged.withColumns({"_part": part, "_local": local})
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (ranged.join(F.broadcast(offsets), "_part")
            .withColumn(id_col, (F.lit(start + 1) + F.col("_before") + F.col("_local"))
                        .cast("bigint"))
            .drop("_pos", "_part", "_local", "_before"))
