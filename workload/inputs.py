"""Logical inputs as views of the driver's tables (whole tables, no sampling).

``SQL`` states the same views for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.functions.geo import with_cell
from tallygrid.functions.times import hour_bucket
from tallygrid.operators.counts import tokens

AS_OF = "2000-01-01 12:00:00"
# Of the two weeks, when a message is said; the same in both dialects.
MINUTE = "(doc_id * 47) % 20160"
# The same without end: hours and days grow in number with the table.
LASTING = "doc_id * 47"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def as_messages(documents: DataFrame, minute: str = MINUTE) -> DataFrame:
    """Documents as messages: place by source and language, texts under 100
    characters carry none; 47 minutes apart, over and over the same two weeks, so an hour
    and a day fill as the table grows. ``LASTING`` minutes go on instead."""
    placed = F.col("n_chars") >= 100
    source = F.substring("source", 4, 9).cast("int")
    tongue = (F.when(F.col("lang") == "en", 0).when(F.col("lang") == "fr", 1)
              .when(F.col("lang") == "de", 2).otherwise(3))
    return documents.select(
        "doc_id", "text", "lang",
        F.when(placed, (source + 3000) / F.lit(100.0)).alias("lat"),
        F.when(placed, (tongue - 12000) / F.lit(100.0)).alias("lng"),
        F.expr(f"timestamp_seconds(1704067200 + 60 * ({minute}))").alias("ts"))


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return as_messages(table(spark, sf, "documents"))


def cell_messages(spark: SparkSession, sf: str) -> DataFrame:
    return with_cell(messages(spark, sf))


def located_messages(spark: SparkSession, sf: str) -> DataFrame:
    return cell_messages(spark, sf).where("cell_lat IS NOT NULL")


def located_texts(spark: SparkSession, sf: str, minute: str = MINUTE) -> DataFrame:
    """The same for readers of the text."""
    documents = table(spark, sf, "documents")
    return with_cell(as_messages(documents, minute)).where("cell_lat IS NOT NULL")


def _events(spark: SparkSession, sf: str, lat: Column, lng: Column) -> DataFrame:
    online = F.col("o_orderstatus") == "P"
    started = F.expr("CAST(o_orderdate AS TIMESTAMP)"
                     " + make_dt_interval(0, CAST(o_orderkey % 24 AS INT))")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("eb_id"),
        F.concat(F.lit("Event "), "o_orderkey").alias("event_name"),
        F.substring("o_orderpriority", 3, 20).alias("event_type"),
        F.when(F.col("o_orderstatus") != "F",
               F.concat(F.lit("http://img.example/"), "o_custkey")).alias("logo_url"),
        started.alias("start_time_utc"),
        (started + F.expr("make_dt_interval(CAST(1 + o_orderkey % 5 AS INT))")).alias("end_time_utc"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("capacity"),
        online.alias("online_event"),
        F.when(~online, F.concat(F.lit("Hall "), "o_custkey")).alias("venue_name"),
        F.when(~online, lat).alias("latitude"),
        F.when(~online, lng).alias("longitude"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"))


def conferences(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as events on the messages' grid; status P means online, so no venue."""
    c = F.col("o_custkey")
    return _events(spark, sf, (c % 20 + 3000) / F.lit(100.0), (c % 4 - 12000) / F.lit(100.0))


def spread_conferences(spark: SparkSession, sf: str) -> DataFrame:
    """The same events with venues spread out, for the box join."""
    c = F.col("o_custkey")
    return _events(spark, sf, c / F.lit(1000.0) + 30, (c % 20 - 12000) / F.lit(100.0))


def as_placed(lineitem: DataFrame) -> DataFrame:
    """Order lines as located, timed messages, for the box join."""
    return lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_partkey") / F.lit(1000.0) + 30).alias("lat"),
        ((F.col("l_linenumber") - 12000) / F.lit(100.0)).alias("lng"),
        F.expr("CAST(l_shipdate AS TIMESTAMP) + make_dt_interval(0, CAST(l_suppkey % 24 AS INT))")
        .alias("ts"))


def placed_lines(spark: SparkSession, sf: str) -> DataFrame:
    return as_placed(table(spark, sf, "lineitem"))


def speed(spark: SparkSession, sf: str) -> DataFrame:
    """Events as speed-layer rows with a text map."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf, "events").select(
        hour_bucket(F.col("ts").cast("timestamp")).alias("yymmddhh"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        ((F.col("user_id") + 30000) / F.lit(1000.0)).alias("lat"),
        ((k - 120000) / F.lit(1000.0)).alias("lng"),
        F.concat("event_type", F.lit(","), k.cast("string"), F.lit(":OVERALL_CNT,1")).alias("data"))


def photo_index(spark: SparkSession, sf: str) -> DataFrame:
    """Words of page titles and the page's address."""
    titled = table(spark, sf, "pages").select(
        "url", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"))
    return tokens(titled, ["url"], "title").distinct()


SQL = {
    "messages": f"""messages AS (
  SELECT doc_id, text, lang,
    CASE WHEN n_chars >= 100 THEN (CAST(substr(source, 4) AS INT) + 3000) / 100 END AS lat,
    CASE WHEN n_chars >= 100 THEN
      ((CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END) - 12000) / 100
    END AS lng,
    TIMESTAMP '2024-01-01' + to_minutes({MINUTE}) AS ts
  FROM documents),
cells AS (
  SELECT *, CAST(floor(lat * 100 + 0.5) AS BIGINT) AS cell_lat,
    CAST(floor(lng * 100 + 0.5) AS BIGINT) AS cell_lng FROM messages),
located AS (SELECT * FROM cells WHERE cell_lat IS NOT NULL)""",
    "conferences": """conferences AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS eb_id, o_custkey,
    'Event ' || o_orderkey AS event_name, substr(o_orderpriority, 3) AS event_type,
    CASE WHEN o_orderstatus <> 'F' THEN 'http://img.example/' || o_custkey END AS logo_url,
    o_orderdate + to_hours(o_orderkey % 24) AS start_time_utc,
    o_orderdate + to_days(CAST(1 + o_orderkey % 5 AS INT)) + to_hours(o_orderkey % 24)
      AS end_time_utc,
    CAST(floor(o_totalprice / 1000) AS INT) AS capacity, o_orderstatus = 'P' AS online_event,
    CASE WHEN o_orderstatus <> 'P' THEN 'Hall ' || o_custkey END AS venue_name,
    CASE WHEN o_orderstatus <> 'P' THEN (o_custkey % 20 + 3000) / 100 END AS latitude,
    CASE WHEN o_orderstatus <> 'P' THEN (o_custkey % 4 - 12000) / 100 END AS longitude,
    o_orderpriority AS category, o_orderdate AS created_at
  FROM orders)""",
    "spread": """spread AS (
  SELECT * EXCLUDE (latitude, longitude),
    CASE WHEN NOT online_event THEN o_custkey / 1000 + 30 END AS latitude,
    CASE WHEN NOT online_event THEN (o_custkey % 20 - 12000) / 100 END AS longitude
  FROM conferences)""",
    "lines": """lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey / 1000 + 30 AS lat,
    (l_linenumber - 12000) / 100 AS lng, l_shipdate + to_hours(l_suppkey % 24) AS ts
  FROM lineitem)""",
    "speed": """speed AS (
  SELECT strftime(ts, '%y%m%d%H') AS yymmddhh, ts AS timestamp, event_type AS word,
    CAST(json_extract_string(props, '$.k') AS INT) AS k,
    (user_id + 30000) / 1000 AS lat,
    (CAST(json_extract_string(props, '$.k') AS INT) - 120000) / 1000 AS lng
  FROM events),
speed_cells AS (
  SELECT *, CAST(floor(CAST(floor(lat * 1000 + 0.5) AS BIGINT) / 10 + 0.5) AS BIGINT) AS cell_lat,
    CAST(floor(CAST(floor(lng * 1000 + 0.5) AS BIGINT) / 10 + 0.5) AS BIGINT) AS cell_lng
  FROM speed)""",
    "photo_index": r"""titles AS (
  SELECT url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages),
photo_index AS (
  SELECT DISTINCT url, word FROM (
    SELECT url, unnest(regexp_split_to_array(
      regexp_replace(lower(title), '[^a-zA-Z0-9\s]', '', 'g'), '\s+')) AS word FROM titles)
  WHERE word <> '' AND NOT contains(word, 'http'))""",
}
SQL["lasting"] = SQL["messages"].replace(MINUTE, LASTING)
