"""Send on the messages that are said inside the box of a running event."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.geo import HALF_BOX, in_any_box
from ..functions.predicates import LIVE_SLACK, has_position
from ..operators.messages import to_topic
from ..operators.spatial import messages_in_boxes
from ..session import durable
from .counts import each_batch

# ---------------------------------------------------------------- fixed values
REFRESH_SECONDS = 1800
# -----------------------------------------------------------------------------


def route_live(messages: DataFrame, events: Callable[[], DataFrame],
               send: Callable[[DataFrame, int], None], checkpoint: str,
               half: float = HALF_BOX, slack: str = LIVE_SLACK,
               every: str | None = None, refresh: float = REFRESH_SECONDS,
               ts: str = "ts") -> StreamingQuery:
    """``events`` is called again for the first batch after ``refresh`` seconds and its
    places and times are kept in the shared folder in between. A batch meets the events that run in its
    own span of time only; ``send`` gets a ``value`` column of JSON."""
    held: dict[str, object] = {}

    def catalogue() -> DataFrame:
        now = time.monotonic()
        if not held or now - held["at"] >= refresh:
            wanted = events().where(has_position())
            held.update(at=now, rows=durable(wanted.select("latitude", "longitude", "start_time_utc", "end_time_utc")))
        return held["rows"]

    def write(batch: DataFrame, batch_id: int) -> None:
        span = batch.agg(F.min(ts).alias("low"), F.max(ts).alias("high")).first()
        if span["low"] is None:
            return
        reach = F.expr(f"INTERVAL {slack}")
        running = catalogue().where(
            (F.col("end_time_utc") + reach >= F.lit(span["low"]).cast("timestamp"))
            & (F.col("start_time_utc") - reach <= F.lit(span["high"]).cast("timestamp")))
        send(to_topic(messages_in_boxes(batch, running, half, slack)), batch_id)

    return each_batch(messages, write, checkpoint, every)


def to_files(path: str) -> Callable[[DataFrame, int], None]:
    """A sink of JSON lines, one folder per batch."""
    def send(df: DataFrame, batch_id: int) -> None:
        df.select("value").write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return send


def progress_rows(query: StreamingQuery) -> list[tuple[int, int]]:
    """``(batch, rows)`` of the query's recent batches (metadata only)."""
    return [(p["batchId"], p["numInputRows"]) for p in query.recentProgress]


def in_boxes(df: DataFrame, boxes: list[tuple[float, float, float, float]]) -> DataFrame:
    """Messages inside any of a few fixed boxes."""
    return df.where(in_any_box(F.col("lat"), F.col("lng"), boxes))
