"""Time buckets, zones and display forms. Session zone is UTC throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
HOUR_BUCKET = "yyMMddHH"
DAY_BUCKET = "yyMMdd"
PATH_DAY = "MMddyy"
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"
PLAIN = "yyyy-MM-dd HH:mm:ss"
SHOWN_DATE = "EEE, MMM dd"
SHOWN_TIME = "h:mm a"
# -----------------------------------------------------------------------------


def hour_bucket(ts: Column) -> Column:
    return F.date_format(ts, HOUR_BUCKET)


def day_bucket(ts: Column) -> Column:
    return F.date_format(ts, DAY_BUCKET)


def path_day(ts: Column) -> Column:
    return F.date_format(ts, PATH_DAY)


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("bigint"))


def parse_iso(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(ISO_UTC))


def plain(ts: Column) -> Column:
    return F.date_format(ts, PLAIN)


def to_local(ts: Column, zone: str) -> Column:
    return F.from_utc_timestamp(ts, zone)


def to_utc(ts: Column, zone: str) -> Column:
    return F.to_utc_timestamp(ts, zone)


def display_date(ts: Column) -> Column:
    return F.date_format(ts, SHOWN_DATE)


def display_time(ts: Column) -> Column:
    return F.date_format(ts, SHOWN_TIME)
