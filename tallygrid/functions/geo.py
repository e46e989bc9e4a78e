"""Grid cells and boxes.

A cell is a pair of integers, ``floor(degrees * 10^precision + 0.5)``: equal in
every engine and cheap to shuffle. Text like ``"24.56,-81.80"`` is display only.
An unlocated row has NULL in both.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
BATCH_PRECISION = 2
STREAM_PRECISION = 3
UNLOCATED_TEXT = "0.00,0.00"
# A coordinate: optional sign, digits, exactly one dot, at least one digit.
COORDINATE = r"^[+-]?\d*\.\d+$"
# Half the side of an event's box, in degrees.
HALF_BOX = 0.05
# Named regions: (south, north, west, east), borders included.
REGIONS = {
    "sf": (36.8, 37.8, -122.75, -121.75),
    "ny": (40.0, 41.0, -74.0, -73.0),
}
# -----------------------------------------------------------------------------


def valid_coord(c: Column) -> Column:
    """True for text like ``12.5``; false for ``12``, ``abc.5``, blanks and NULL."""
    return F.coalesce(c.rlike(COORDINATE), F.lit(False))


def cell_index(c: Column, precision: int = BATCH_PRECISION) -> Column:
    return F.floor(c * F.lit(float(10 ** precision)) + F.lit(0.5)).cast("bigint")


def with_cell(df: DataFrame, lat: str = "lat", lng: str = "lng",
              precision: int = BATCH_PRECISION) -> DataFrame:
    """Add ``cell_lat``/``cell_lng``; both NULL unless both coordinates are good.

    The test reads the raw columns only, so a filter on the cell costs little
    where Catalyst moves it below this projection.
    """
    types = dict(df.dtypes)

    def good(name: str) -> Column:
        c = F.col(name)
        return valid_coord(c) if types[name] == "string" else c.isNotNull() & ~F.isnan(c)

    both = good(lat) & good(lng)
    return df.withColumns({
        name: F.when(both, cell_index(F.col(c).try_cast("double"), precision))
        for name, c in (("cell_lat", lat), ("cell_lng", lng))
    })


def located(df: DataFrame) -> DataFrame:
    """Rows with a cell (its two parts are NULL together)."""
    return df.where(F.col("cell_lat").isNotNull())


def coarsen(df: DataFrame, from_precision: int = STREAM_PRECISION,
            to_precision: int = BATCH_PRECISION) -> DataFrame:
    """Move cells to a coarser grid, halves up."""
    step = 10 ** (from_precision - to_precision)
    return df.withColumns({
        c: F.floor((F.col(c) / F.lit(float(step))) + F.lit(0.5)).cast("bigint")
        for c in ("cell_lat", "cell_lng")
    })


def cell_degrees(c: Column, precision: int = BATCH_PRECISION) -> Column:
    return c / F.lit(float(10 ** precision))


def cell_text(lat: Column, lng: Column, precision: int = BATCH_PRECISION) -> Column:
    """``"24.56,-81.80"``; the unlocated mark when the cell is NULL."""
    shown = F.format_string(
        f"%.{precision}f,%.{precision}f",
        cell_degrees(lat, precision), cell_degrees(lng, precision),
    )
    return F.when(lat.isNull() | lng.isNull(), F.lit(UNLOCATED_TEXT)).otherwise(shown)


def split_cell(c: Column) -> Column:
    """``"lat,lng"`` text to ``struct(lat, lng)`` of DOUBLE."""
    return F.struct(
        F.split_part(c, F.lit(","), F.lit(1)).try_cast("double").alias("lat"),
        F.split_part(c, F.lit(","), F.lit(2)).try_cast("double").alias("lng"),
    )


def in_box(lat: Column, lng: Column, box: tuple[float, float, float, float]) -> Column:
    south, north, west, east = box
    return lat.between(south, north) & lng.between(west, east)


def in_any_box(lat: Column, lng: Column,
               boxes: Iterable[tuple[float, float, float, float]]) -> Column:
    out = F.lit(False)
    for box in boxes:
        out = out | in_box(lat, lng, box)
    return out


def geo_in_range(df: DataFrame, lats: list[float], lng_lo: float, lng_hi: float,
                 lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Latitude out of a list, longitude inside an open interval."""
    return df.where(F.col(lat).isin(lats) & (F.col(lng) > lng_lo) & (F.col(lng) < lng_hi))


def box_text(lat: Column, lng: Column, half: float = HALF_BOX) -> Column:
    """``west,south,east,north``, four decimals."""
    sides = [(lng, -half), (lat, -half), (lng, half), (lat, half)]
    return F.concat_ws(",", *[F.round(c + F.lit(d), 4).cast("string") for c, d in sides])


def morton(row: Column, column: Column, bits: int = 26) -> Column:
    """The place of a cell on a Morton curve: the bits of its two whole numbers, which lie
    between ``-2^(bits-1)`` and ``2^(bits-1)``, in turn. Neighbours on the curve are neighbours
    in both, so sorted files have narrow ranges of both."""
    if not 1 <= bits <= 31:
        raise ValueError("bits must be 1 to 31")

    def spread(number: Column) -> Column:
        at = (number + F.lit(1 << (bits - 1))).cast("bigint").bitwiseAND(F.lit((1 << bits) - 1))
        for shift in (16, 8, 4, 2, 1):  # each step halves the runs of bits that lie together
            mask = sum(((1 << shift) - 1) << place for place in range(0, 64, 2 * shift))
            at = at.bitwiseOR(F.shiftleft(at, shift)).bitwiseAND(F.lit(mask))
        return at

    return F.shiftleft(spread(row), 1).bitwiseOR(spread(column))
