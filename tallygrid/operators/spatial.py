"""Joins on place and time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import HALF_BOX, REGIONS, box_text, in_box
from ..functions.predicates import LIVE_SLACK, has_position, interval, live
from ..session import staged
from .ids import dense_ids

# Boxes whose borders may cross a cell before it is split, and how often a bin is halved at most.
DENSE, DEEPEST = 4096, 8
MOST_SENT = 100_000
# Bins tried, in boxes' widths, with slots so many times as long as events last; boxes that one may meet.
GRIDS, SPARSE = ((4, 8), (2, 8), (1, 8), (1, 2)), 32
CELL = ["_level", "_row", "_col", "_slot"]
WORLD = 1e6  # beyond all degrees


def event_boxes(events: DataFrame, half: float = HALF_BOX) -> DataFrame:
    """Events with a position, plus the sides of their box."""
    lat, lng = F.col("latitude"), F.col("longitude")
    h = F.lit(half)
    return events.where(has_position()).withColumns({
        "south": lat - h, "north": lat + h, "west": lng - h, "east": lng + h,
    })


def box_strings(events: DataFrame, half: float = HALF_BOX) -> DataFrame:
    """``(eb_id, box)``: one request string per event with a position."""
    return events.where(has_position()).select(
        "eb_id", box_text(F.col("latitude"), F.col("longitude"), half).alias("box"))


def live_boxes(events: DataFrame, as_of: Column, half: float = HALF_BOX) -> DataFrame:
    return box_strings(events.where(live(as_of)), half)


def box_requests(boxes: DataFrame, per_request: int = 100) -> DataFrame:
    """``(request, boxes)``: boxes joined by commas, at most ``per_request`` in
    one string, so no row grows with the number of events."""
    numbered = dense_ids(boxes, "_id", ["eb_id"], recompute=True)
    request = F.floor((F.col("_id") - 1) / F.lit(per_request)).cast("bigint")
    return (numbered.withColumn("request", request).groupBy("request")
            .agg(F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("_id", "box"))),
                            lambda s: s["box"]), ",").alias("boxes")))


def messages_in_boxes(messages: DataFrame, events: DataFrame, half: float = HALF_BOX,
                      slack: str = LIVE_SLACK, lat: str = "lat", lng: str = "lng",
                      ts: str = "ts", slot_seconds: int = 86_400, most: int = DENSE) -> DataFrame:
    """Messages inside the box of an event running at the message's time (give or
    take ``slack``), each once.

    A range join as an equi-join: the plane is cut into bins and time into slots; an event is
    listed under every bin and slot it touches, a message under its own only, and the exact
    test runs on what meets there. A semi join never emits pairs, and a hot bin's messages can
    be split over tasks. The listing is merged with the messages, never sent whole to every task
    by way of the driver. Where events are sparse, bins are some boxes wide and slots some times as
    long as events last (``_grid``), so that an event is listed once or twice. Elsewhere bins are one box
    wide and slots ``slot_seconds`` long; an event is cut to each slot's span first, so the many
    events that fill a slot at one place become one row, and bins of more than ``most`` boxes
    are split (``split_dense``), for which the boxes are counted first. A message then
    goes by its cell of the level that holds it, looked up in the cells that were split.
    """
    first, last = F.unix_micros("_from"), F.unix_micros("_to")
    spans = event_boxes(events, half).select(
        "south", "north", "west", "east",
        (F.col("start_time_utc") - interval(slack)).alias("_from"),
        (F.col("end_time_utc") + interval(slack)).alias("_to"),
    ).withColumns({"_from": first, "_to": last}).where("_from <= _to")
    bins, slot_us, sparse = _grid(spans, half, slot_seconds * 1_000_000, most)
    width = half * bins
    listed = spans.withColumn("_slot", F.explode(F.sequence(_slot("_from", slot_us), _slot("_to", slot_us))))
    splits: list[DataFrame] = []
    part_us = slot_us
    if sparse:
        listed = _binned(listed, width).withColumn("_level", F.lit(0))
    else:
        listed = listed.withColumns({
            "_from": F.greatest("_from", F.col("_slot") * slot_us),
            "_to": F.least("_to", (F.col("_slot") + 1) * slot_us - 1),
        }).distinct()
        part_us = _part(listed, slot_us)
        listed, splits = _split(listed, width, most, DEEPEST, part_us)
        listed = listed.withColumn("_slot", F.explode(F.sequence(_slot("_from", part_us), _slot("_to", part_us))))
    placed = messages.withColumns({"_at": F.unix_micros(ts), "_mlevel": F.lit(0)})
    if splits:
        deep = len(splits)
        placed = (placed.where(F.col(lat).isNotNull() & F.col(lng).isNotNull() & F.col("_at").isNotNull())
                  .withColumns({"_mrow": _cell(F.col(lat), deep, width), "_mcol": _cell(F.col(lng), deep, width),
                                "_mslot": _slot("_at", slot_us)}))
    for level, cells in enumerate(splits):
        # short conditions: all look-ups are compiled as one, which is only fast while it is small
        cells = cells.select(*[F.col(c).alias(f"_s{c}") for c in CELL[1:]], F.lit(1).alias("_more"))
        split = ((F.col("_mlevel") == level) & (F.shiftright("_mrow", deep - level) == F.col("_s_row"))
                 & (F.shiftright("_mcol", deep - level) == F.col("_s_col")) & (F.col("_mslot") == F.col("_s_slot")))
        placed = (placed.join(cells, split, "left")
                  .withColumn("_mlevel", F.when(F.col("_more").isNotNull(), F.lit(level + 1)).otherwise(F.col("_mlevel")))
                  .drop("_s_row", "_s_col", "_s_slot", "_more"))
    level = F.col("_mlevel")
    placed = placed.withColumns({"_mrow": _cell(F.col(lat), level, width), "_mcol": _cell(F.col(lng), level, width),
                                 "_mslot": _slot("_at", part_us)})
    inside = ((F.col("_mrow") == F.col("_row")) & (F.col("_mcol") == F.col("_col"))
              & (F.col("_mslot") == F.col("_slot")) & (level == F.col("_level"))
              & F.col(lat).between(F.col("south"), F.col("north"))
              & F.col(lng).between(F.col("west"), F.col("east"))
              & F.col("_at").between(F.col("_from"), F.col("_to")))
    return (placed.join(listed.hint("merge"), inside, "left_semi")
            .drop("_at", "_mlevel", "_mrow", "_mcol", "_mslot"))


def _slot(micros: str, length: int) -> Column:
    # Whole numbers throughout: a rounded quotient could cross a slot's border.
    at = F.col(micros)
    return F.call_function("div", at - F.pmod(at, F.lit(length)), F.lit(length))


def _grid(spans: DataFrame, half: float, slot_us: int, most: int) -> tuple[int, int, bool]:
    """(boxes that a bin is wide, a slot's length, whether that is sparse): the widest bins of ``GRIDS``, with
    slots of ``slot_us`` doubled until events are short beside them, in which a box meets few
    others and no bin can hold more than ``most``; else one box and ``slot_us``."""
    lasting = spans.agg(F.avg(F.col("_to") - F.col("_from")).alias("mean"),
                        F.max(F.col("_to") - F.col("_from")).alias("most")).first()
    for bins, times in GRIDS if lasting["mean"] is not None else ():
        length = slot_us
        while length < times * lasting["mean"]:
            length *= 2
        # by the corner and the beginning, so that each event counts once
        corners = spans.groupBy(_cell(F.col("south"), 0, half * bins), _cell(F.col("west"), 0, half * bins),
                                _slot("_from", length)).count()
        n = F.col("count").cast("double")
        found = corners.agg(F.max(n).alias("most"), (F.sum(n * n) / F.sum(n)).alias("mean")).first()
        # a bin holds boxes with corners in it and in those before it, by place and time
        reach = (3 if bins == 1 else 2) ** 2 * (2 + lasting["most"] // length)
        if found["mean"] <= SPARSE and found["most"] * reach <= most:
            return bins, length, True
    return 1, slot_us, False


def _part(listed: DataFrame, slot_us: int) -> int:
    """A slot's length, halved while it is over four times as long as spans are in it."""
    mean, length = listed.agg(F.avg(F.col("_to") - F.col("_from"))).first()[0], slot_us
    while mean is not None and length % 2 == 0 and length > max(4 * mean, slot_us >> 10, 1_000_000):
        length //= 2
    return length


def _binned(listed: DataFrame, half: float) -> DataFrame:
    """Boxes under every bin they touch."""
    for name, low, high in (("_row", "south", "north"), ("_col", "west", "east")):
        touched = F.sequence(_cell(F.col(low), 0, half), _cell(F.col(high), 0, half))
        listed = listed.withColumn(name, F.explode(touched))
    return listed


def _cell(degrees: Column, level: Column | int, half: float) -> Column:
    """The cell of a level, where a bin is halved ``level`` times; cells of a level lie in those above."""
    scale = F.pow(F.lit(2.0), level if isinstance(level, Column) else F.lit(level))
    return F.floor(degrees / F.lit(2 * half) * scale).cast("bigint")


def _split(spans: DataFrame, half: float, most: int, deepest: int, part_us: int) -> tuple[DataFrame, list[DataFrame]]:
    """The listing of spans of slots under bins and the cells that were split, by level. The spans are
    staged if there are any such cells, instead of their listing, which is some times as long."""
    if not _crowded(_binned(spans, half).withColumn("_level", F.lit(0)), most).take(1):
        return _binned(spans, half).withColumn("_level", F.lit(0)), []
    return _divided(_binned(staged(spans), half).withColumn("_level", F.lit(0)), half, most, deepest, part_us)


def split_dense(listed: DataFrame, half: float = HALF_BOX, most: int = DENSE,
                deepest: int = DEEPEST) -> tuple[DataFrame, list[int]]:
    """Boxes listed under bins, with cells that more than ``most`` boxes' borders cross split into
    four, up to ``deepest`` times: (the listing with ``_level``, the levels in it).

    Only borders ask for a comparison: boxes around a whole cell are one in what they say of
    it, and what is left of them is when any of them runs, as spans that do not meet. A box whose
    border crosses the cell while such a span lasts says nothing more, and goes: so what is split
    further lies along the outline of all boxes, and does not grow with the square of their number.
    A point meets ``most`` boxes at most, and those spans, while every point has one cell
    with a listing. Whether a box is around a cell is asked in whole cells, never by rounded borders.
    """
    leveled = listed.withColumn("_level", F.lit(0))
    if not _crowded(leveled, most).take(1):
        return leveled, [0]
    out, splits = _divided(leveled, half, most, deepest, 0)
    return out.select(leveled.columns), list(range(len(splits) + 1))


def _divided(listed: DataFrame, half: float, most: int, deepest: int, part_us: int
             ) -> tuple[DataFrame, list[DataFrame]]:
    """The listing after the splits, and for each level the cells split in it. A level is staged without
    the boxes that its covered spans outlast; what its stages shuffle goes as they end."""
    columns, parts, splits, now = listed.columns, [], [], [listed]
    for level in range(deepest + 1):
        if level:
            first = {c: _cell(F.col(c), level, half) for c in ("south", "north", "west", "east")}
            around = ((first["south"] < F.col("_row")) & (F.col("_row") < first["north"])
                      & (first["west"] < F.col("_col")) & (F.col("_col") < first["east"]))
            spans = staged(_spans(below.where(around)).select(columns))
            now = [staged(_uncovered(below.where(~around), spans, part_us)), spans]
        # what is around all of a cell is no reason to split it
        crowded = _sent(staged(_crowded(now[0], most).select(*CELL))) if level < deepest else None
        if crowded is None or not crowded.take(1):
            parts += now
            break
        splits.append(crowded)
        parts += [x.join(crowded, CELL, "left_anti").select(columns) for x in now]
        below = now[0]
        for more in now[1:]:
            below = below.unionByName(more)
        below = below.join(crowded, CELL, "left_semi").withColumn("_level", F.lit(level + 1))
        for name, low, high in (("_row", "south", "north"), ("_col", "west", "east")):
            start = F.greatest(F.col(name) * 2, _cell(F.col(low), level + 1, half))
            stop = F.least(F.col(name) * 2 + 1, _cell(F.col(high), level + 1, half))
            below = below.withColumn(name, F.explode(F.sequence(start, stop)))
        below = below.select(columns)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, splits


def _crowded(listed: DataFrame, most: int, cell: Sequence[str] = CELL) -> DataFrame:
    return listed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)


def _spans(rows: DataFrame) -> DataFrame:
    """Per cell, the time that the rows cover, as spans that do not meet; the sides are beyond the world."""
    rows = rows.select(*CELL, "_from", "_to").distinct()
    order = Window.partitionBy(*CELL).orderBy("_from", "_to")
    so_far = F.max("_to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("_from") > so_far + 1, F.lit(True))
    numbered = rows.withColumn("_fresh", fresh.cast("int")).withColumn("_span", F.sum("_fresh").over(order))
    spans = numbered.groupBy(*CELL, "_span").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))
    return spans.drop("_span").withColumns({"south": F.lit(-WORLD), "north": F.lit(WORLD),
                                            "west": F.lit(-WORLD), "east": F.lit(WORLD)})


def _uncovered(boxes: DataFrame, spans: DataFrame, part_us: int = 0) -> DataFrame:
    """Of the boxes those that run outside of all spans of their cell. Spans of a cell do not meet, so
    a box is covered by one of them, found by the part of ``part_us`` that the box begins in."""
    held = spans.select(*[F.col(c).alias(f"_s{c}") for c in CELL], F.col("_from").alias("_since"),
                        F.col("_to").alias("_until"))
    covered = (F.col("_since") <= F.col("_from")) & (F.col("_to") <= F.col("_until"))
    for c in CELL:
        covered = covered & (F.col(c) == F.col(f"_s{c}"))
    if part_us:
        held = held.withColumn("_part", F.explode(F.sequence(_slot("_since", part_us), _slot("_until", part_us))))
        covered = covered & (_slot("_from", part_us) == F.col("_part"))
    return boxes.join(_sent(held), covered, "left_anti")


def _sent(df: DataFrame) -> DataFrame:
    """Rows that may be sent whole to every task if they are few, and are merged otherwise."""
    return df if df.limit(MOST_SENT + 1).count() <= MOST_SENT else df.hint("merge")


def region_counts(cells: DataFrame, regions: dict = REGIONS, lat: str = "lat",
                  lng: str = "lng") -> DataFrame:
    """``(region, cells)``: rows inside each named box, in one pass."""
    names = list(regions)
    sums = cells.agg(*[
        F.count_if(in_box(F.col(lat), F.col(lng), regions[r])).alias(r) for r in names])
    return sums.unpivot([], names, "region", "cells")
