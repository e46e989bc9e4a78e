"""The first n rows of a table in an order, for n that no task should merge.

A row's place in the order is a list of whole or floating numbers: a number, time or date is
one, a text one per seven bytes. The value of the n-th row is closed in on by histograms: the
first number's range is cut into bins, counted, and the bin that holds the n-th row is cut again,
until it holds few rows or one value, whose rows the next number then tells apart. Each
histogram reads the columns of the order only and sends a row a bin. What the last one
leaves are the rows wanted and those of one bin; no others are sorted, shuffled or stored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 1024
# Texts are told apart by so many bytes; rows alike in these stay together.
CHUNK, CHUNKS = 7, 5
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def parsed(name: str) -> tuple[str, bool]:
    """``"-cnt"`` is falling by ``cnt``, NULL last; ``"cnt"`` is rising, NULL first."""
    return (name[1:], True) if name.startswith("-") else (name, False)


def sort_order(order: Sequence[Column | str]) -> list[Column | str]:
    """Names of an order as Spark's sort takes them."""
    out = []
    for item in order:
        name, falling = parsed(item) if isinstance(item, str) else (item, False)
        out.append(F.desc(name) if falling else name)
    return out


def _always(_) -> bool:
    return True


def _numbers(name: str, kind: T.DataType) -> list[tuple[Column, bool, Callable]]:
    """Numbers that rise with a column: (number, whether whole, whether rows that tie at a value
    may be told apart by the next number). NULL is left to the caller."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (*WHOLE, T.BooleanType)):
        return [(c.cast("long"), True, _always)]
    if isinstance(kind, T.DateType):
        return [(F.unix_date(c).cast("long"), True, _always)]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return [(F.unix_micros(c.cast("timestamp")), True, _always)]
    if isinstance(kind, T.StringType):
        parts = [F.hex(F.substring(c.cast("binary"), CHUNK * i + 1, CHUNK)) for i in range(CHUNKS)]
        found = [(F.conv(F.rpad(p, 2 * CHUNK, "0"), 16, 10).cast("long"), True, _always) for p in parts]
        # of texts alike so far the shorter comes first; longer ones may go on differently
        return [*found, (F.octet_length(c).cast("long"), True, lambda size: size <= CHUNK * CHUNKS)]
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        value = c.cast("double")  # decimals may tie by rounding
        return [(F.when(F.isnan(value), float("inf")).otherwise(value), False, lambda _: False)]
    return []


def _levels(df: DataFrame, order: Sequence[str]) -> list[tuple[Column, Column, Callable]]:
    """(-1, 0 or 1: before, among or behind the numbers; number; may rows that tie go on) per level."""
    out = []
    for item in order:
        name, falling = parsed(item)
        levels = _numbers(name, df.schema[name].dataType)
        if not levels:
            break
        null = F.when(F.col(f"`{name}`").isNull(), 1 if falling else -1).otherwise(0)
        for number, whole, exact in levels:
            if falling and whole:
                out.append((null, F.bitwise_not(number), lambda v, exact=exact: exact(~v)))
            else:
                out.append((null, -number if falling else number, exact))
    return out


def bounded(df: DataFrame, order: Sequence[str], n: int, spare: int | None = None) -> Column | None:
    """A condition that holds for the first ``n`` rows in ``order`` and for few more: at most ``spare``
    (a tenth of n by default), or rows that tie. None where all rows are wanted."""
    spare = max(1, n // 10) if spare is None else spare
    before, fixed, left, whole = F.lit(False), F.lit(True), n, True
    for side, number, exact in _levels(df, order):
        rows = df.where(fixed).select(side.alias("side"), number.alias("number"))
        counts = {r["side"]: r for r in rows.groupBy("side").agg(
            F.count(F.lit(1)).alias("n"), F.min("number").alias("low"), F.max("number").alias("high")).collect()}
        if sum(r["n"] for r in counts.values()) <= left + spare:
            return None if whole else before | fixed
        whole = False
        for at in (-1, 0, 1):
            size = counts[at]["n"] if at in counts else 0
            if size >= left:
                break
            before, left = before | (fixed & (side == at)), left - size
        fixed = fixed & (side == at)
        if at != 0:  # the n-th row has a NULL; the next column goes on
            continue
        low, high, cut = counts[0]["low"], counts[0]["high"], True
        while low < high and size > left + spare and cut:
            for start, stop, size in _histogram(rows.where("side = 0"), low, high):
                if size >= left:
                    break
                left -= size
            before = before | (fixed & (number < start))
            cut = (start, stop) != (low, high)  # floats may be too close to be cut
            low, high = start, stop
        fixed = fixed & number.between(low, high)
        if size <= left + spare or low != high or not exact(low):
            break
    return before | fixed


def _histogram(rows: DataFrame, low, high) -> list[tuple]:
    """(first, last, rows) of the bins between ``low`` and ``high`` that hold rows, in order; first
    and last are values that occur."""
    inside = rows.where(F.col("number").between(low, high))
    if isinstance(low, int):
        width = -(-(high - low + 1) // BINS)
        at = F.floor((F.col("number").cast("decimal(20,0)") - F.lit(low)) / F.lit(width))
    else:
        at = F.floor((F.col("number") - F.lit(low)) / F.lit((high - low) / BINS))
    bins = inside.groupBy(at.alias("bin")).agg(F.min("number").alias("first"), F.max("number").alias("last"),
                                               F.count(F.lit(1)).alias("n"))
    return [(r["first"], r["last"], r["n"]) for r in bins.orderBy("bin").collect()]  # BINS + 1 at most
