"""Explicit schemas of every input and stored table (never inferred)."""

from __future__ import annotations

# One message as it arrives on the queue.
MESSAGE_JSON = (
    "id BIGINT, id_str STRING, text STRING, retweeted BOOLEAN, retweet_count INT, "
    "favorited BOOLEAN, favorite_count INT, lang STRING, source STRING, "
    "timestamp_ms STRING, in_reply_to_status_id BIGINT, in_reply_to_screen_name STRING, "
    "in_reply_to_user_id BIGINT, in_reply_to_user_id_str STRING, "
    "possibly_sensitive BOOLEAN, in_reply_to_status_id_str STRING, "
    "entities STRUCT<user_mentions: ARRAY<STRUCT<screen_name: STRING>>, "
    "hashtags: ARRAY<STRUCT<text: STRING>>>, "
    "geo STRUCT<coordinates: ARRAY<DOUBLE>>, "
    "place STRUCT<full_name: STRING, country_code: STRING>, "
    "user STRUCT<id: BIGINT, id_str: STRING, name: STRING, screen_name: STRING, "
    "verified: BOOLEAN, description: STRING, statuses_count: INT, followers_count: INT, "
    "friends_count: INT, listed_count: INT, location: STRING, lang: STRING, "
    "created_at: STRING>"
)

# One line of a geo CSV file; coordinates stay text until they are checked.
GEO_CSV = "lat STRING, lng STRING, text STRING"

# One page of event-search results.
EVENT_JSON = (
    "id: STRING, url: STRING, logo_url: STRING, name: STRUCT<text: STRING>, "
    "description: STRUCT<text: STRING>, format: STRUCT<name_localized: STRING>, "
    "start: STRUCT<utc: STRING>, end: STRUCT<utc: STRING>, created: STRING, changed: STRING, "
    "capacity: INT, status: STRING, online_event: BOOLEAN, organizer_id: STRING, "
    "organizer: STRUCT<name: STRING, description: STRUCT<text: STRING>, num_past_events: INT>, "
    "venue_id: STRING, venue: STRUCT<name: STRING, latitude: STRING, longitude: STRING, "
    "address: STRUCT<address_1: STRING, address_2: STRING, city: STRING, region: STRING, "
    "postal_code: STRING, country: STRING>>, category: STRUCT<name_localized: STRING>, "
    "subcategory: STRUCT<name: STRING>, category_id: STRING, subcategory_id: STRING, "
    "format_id: STRING, resource_uri: STRING"
)
EVENT_PAGE_JSON = (
    "pagination STRUCT<object_count: INT, page_count: INT>, "
    f"events ARRAY<STRUCT<{EVENT_JSON}>>"
)

# Photo-search answer; attributes carry the XML reader's "_" prefix.
PHOTO_XML = (
    "photos STRUCT<photo: ARRAY<STRUCT<_farm: STRING, _server: STRING, "
    "_id: STRING, _secret: STRING>>>"
)

# Hourly tallies in long form, and in the map form other readers expect.
CELL_COUNTS = "cell_lat BIGINT, cell_lng BIGINT, word STRING, cnt BIGINT, yymmddhh STRING"
MAP_COUNTS = (
    "location STRING, key STRING, data MAP<STRING, BIGINT>, "
    "timestamp TIMESTAMP, yymmddhh STRING"
)
SPEED_COUNTS = "timestamp TIMESTAMP, lat DOUBLE, lng DOUBLE, data STRING, yymmddhh STRING"

EVENTS = (
    "eb_id STRING, url STRING, logo_url STRING, event_name STRING, event_type STRING, "
    "start_time_utc TIMESTAMP, end_time_utc TIMESTAMP, eb_created_at TIMESTAMP, "
    "eb_updated_at TIMESTAMP, capacity INT, online_event BOOLEAN, venue_id INT, "
    "venue_name STRING, latitude DOUBLE, longitude DOUBLE, category STRING, "
    "created_at TIMESTAMP"
)
CONFERENCE_STATS = (
    "tid BIGINT, eb_id STRING, event_name STRING, event_type STRING, latitude DOUBLE, "
    "longitude DOUBLE, start_time_utc TIMESTAMP, end_time_utc TIMESTAMP, tweets BIGINT, "
    "created_at TIMESTAMP, "
    + ", ".join(f"word{i} STRING" for i in range(1, 11)) + ", "
    + ", ".join(f"count{i} BIGINT" for i in range(1, 11))
)
WORDS = (
    "wid BIGINT, words STRING, latitude DOUBLE, longitude DOUBLE, count BIGINT, "
    "created_at TIMESTAMP"
)
PHOTOS = "pid BIGINT, yymmddhh STRING, word STRING, url STRING"
OFFSETS = "group_name STRING, k_partition INT, k_offset BIGINT, created_at TIMESTAMP"
