"""Messages: from lines or JSON to located rows and flat columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.geo import BATCH_PRECISION, with_cell
from ..functions.predicates import falsy_to_null
from ..functions.text import clean_text
from ..functions.times import from_epoch_ms, plain

# ---------------------------------------------------------------- fixed values
# Column order of the flat message.
FLAT = (
    "id", "id_str", "text", "retweeted", "retweet_count", "favorited", "favorite_count",
    "lang", "source", "timestamp_ms", "in_reply_to_status_id", "in_reply_to_screen_name",
    "in_reply_to_user_id", "in_reply_to_user_id_str", "possibly_sensitive", "created_at",
    "in_reply_to_status_id_str",
)
ENTITIES = ("user_mentions", "hashtags")
PLACE = ("lat", "lng", "place", "country")
USER = (
    "user-id", "user-id_str", "name", "screen_name", "verified", "description",
    "statuses_count", "followers_count", "friends_count", "listed_count", "location",
    "user-lang", "user-created_at",
)
# -----------------------------------------------------------------------------

FLAT_MESSAGE = FLAT + ENTITIES + PLACE + USER


def locate(rows: DataFrame, precision: int = BATCH_PRECISION) -> DataFrame:
    """Add the cell to ``(lat, lng, text)`` read as text; no text, no cell."""
    whole = F.col("text").isNotNull()
    return with_cell(rows.withColumn("lat", F.when(whole, F.col("lat"))),
                     precision=precision)


def locate_lines(lines: DataFrame, line: str = "value",
                 precision: int = BATCH_PRECISION) -> DataFrame:
    """The same for whole ``lat,lng,text`` lines, such as queue values."""
    fields = F.split(F.col(line), ",")
    return locate(lines.select(*[F.get(fields, F.lit(i)).alias(name)
                                 for i, name in enumerate(("lat", "lng", "text"))]),
                  precision)


def parse_messages(df: DataFrame, json_col: str = "value") -> DataFrame:
    """Queue values to message columns; control notices (no id) are left out.

    The message goes through a generator, which no filter or projection on its fields is
    pushed below: so a value is parsed once, whatever is asked of it.
    """
    m = F.from_json(F.col(json_col), schemas.MESSAGE_JSON)
    others = [c for c in df.columns if c != json_col]
    parsed = df.select(*others, F.inline(F.array(m)))
    return parsed.where(F.col("id").isNotNull())


def message_geo(messages: DataFrame, precision: int = BATCH_PRECISION) -> DataFrame:
    """Parsed messages with ``lat``, ``lng`` and their cell."""
    at = F.col("geo.coordinates")
    two = F.size(at) == 2
    placed = messages.withColumns({
        "lat": F.when(two, at.getItem(0)), "lng": F.when(two, at.getItem(1))})
    return with_cell(placed, precision=precision)


def _join_field(items: Column, name: str) -> Column:
    return F.array_join(F.transform(items, lambda x: clean_text(x[name])), " ")


def flatten_messages(messages: DataFrame) -> DataFrame:
    """Parsed messages to the 36 flat columns, empty values NULL."""
    at = F.col("geo.coordinates")
    columns: dict[str, Column] = {c: F.col(c) for c in FLAT if c != "created_at"}
    columns["created_at"] = plain(from_epoch_ms(F.col("timestamp_ms")))
    columns["user_mentions"] = _join_field(F.col("entities.user_mentions"), "screen_name")
    columns["hashtags"] = _join_field(F.col("entities.hashtags"), "text")
    columns["lat"] = F.get(at, F.lit(0))
    columns["lng"] = F.get(at, F.lit(1))
    columns["place"] = F.col("place.full_name")
    columns["country"] = F.col("place.country_code")
    for name in USER:
        columns[name] = F.col("user." + name.removeprefix("user-"))
    flat = messages.select(*[columns[c].alias(c) for c in FLAT_MESSAGE])
    # "user-id" and its like need quoting by name only where columns are looked up.
    safe = flat.toDF(*[c.replace("-", "_") for c in FLAT_MESSAGE])
    return falsy_to_null(safe, safe.columns).toDF(*FLAT_MESSAGE)


def to_topic(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON in the ``value`` column a queue sink takes."""
    cols = [F.to_json(F.struct(*df.columns)).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)
