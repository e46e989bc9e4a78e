"""Every query with its SQL twin. Times are shown as text, NULL text as ``\\N``
where an operator's own form is text."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallygrid import session
from tallygrid.functions import geo, maps, predicates as pr, text as tx, times as tm
from tallygrid.operators import (conferences as cf, counts as ct, layers, messages as ms,
                                 photos as ph, ranking as rk, regions as rg, spatial as sp, summary as su,
                                 warehouse as wh)
from tallygrid.plans import rankings
from tallygrid.sources import files, grid, keyed as ky, queue as qu, tables as tb
from tallygrid.streaming import compaction, counts as sc, hours as hr, routing

from . import inputs as inp

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

STOP = tx.stop_words(tx.FILLER_WORDS)
CELL = list(ct.CELL)
HOUR_CELL = ["yymmddhh", *CELL]
SINCE = "2024-01-15 12:00:00"
ZONE = "America/Los_Angeles"


def query(sql: str | None = None, views: str = ""):
    """Register a query under its function's name; ``views`` names the logical
    inputs the SQL reads."""
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            parts = [inp.SQL[v] for v in views.split()]
            body = sql.strip()
            if body.startswith("WITH "):
                parts.append(body[5:])
                ORACLE[fn.__name__] = "WITH " + ",\n".join(parts)
            else:
                ORACLE[fn.__name__] = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
        return fn
    return register


def _list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def words_of(source: str, text: str = "text", stop=(), http: bool = True) -> str:
    """SQL for the tokens of a view, with its own columns."""
    out = f"""SELECT * FROM (SELECT * EXCLUDE ({text}), unnest(regexp_split_to_array(
    regexp_replace(lower({text}), '[^a-zA-Z0-9\\s]', '', 'g'), '\\s+')) AS word FROM {source})
  WHERE word <> ''"""
    if http:
        out += " AND NOT contains(word, 'http')"
    if stop:
        out += f" AND word NOT IN ({_list(stop)})"
    return out


LOCATED_WORDS = f"words AS ({words_of('located', stop=STOP)})"
CELL_COUNTS_SQL = f"""{LOCATED_WORDS},
counts AS (SELECT cell_lat, cell_lng, word, count(*) AS cnt FROM words GROUP BY ALL)"""
TOP_SQL = """top AS (
  SELECT cell_lat, cell_lng, word, cnt,
    row_number() OVER (PARTITION BY cell_lat, cell_lng ORDER BY cnt DESC, word) AS rk
  FROM counts QUALIFY rk <= 10),
wide AS (SELECT cell_lat, cell_lng, """ + ", ".join(
    f"max(CASE WHEN rk = {i} THEN word END) AS word{i}, "
    f"max(CASE WHEN rk = {i} THEN cnt END) AS count{i}" for i in range(1, 11)
) + " FROM top GROUP BY cell_lat, cell_lng)"
WIDE = ", ".join(f"word{i}, count{i}" for i in range(1, 11))


def shown(df: DataFrame, *times: str) -> DataFrame:
    return df.withColumns({t: tm.plain(F.col(t)) for t in times})


def as_text(df: DataFrame) -> DataFrame:
    """Every column as the text an export writes."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(files.NULL_TEXT)).alias(c)
                       for c in df.columns])


def counts_of(spark, sf) -> DataFrame:
    return ct.cell_counts(inp.located_texts(spark, sf), CELL, stop=STOP)


def hour_counts_of(spark, sf, minute: str = inp.MINUTE) -> DataFrame:
    hours = inp.located_texts(spark, sf, minute).withColumn("yymmddhh", tm.hour_bucket(F.col("ts")))
    return ct.cell_counts(hours, HOUR_CELL, stop=STOP)


# ---------------------------------------------------------------- counts

@query(f"WITH {CELL_COUNTS_SQL} SELECT * FROM counts", "messages")
def cell_word_counts(spark, sf):
    return counts_of(spark, sf)


@query("""SELECT CASE WHEN cell_lat IS NULL THEN '0.00,0.00'
  ELSE printf('%.2f,%.2f', cell_lat / 100, cell_lng / 100) END AS location, count(*) AS tweets
FROM cells GROUP BY ALL""", "messages")
def cell_message_counts(spark, sf):
    tally = ct.cell_messages(inp.cell_messages(spark, sf))
    return tally.select(geo.cell_text(F.col("cell_lat"), F.col("cell_lng")).alias("location"),
                        "tweets")


@query(f"""WITH shown AS (
  SELECT trim(regexp_replace(regexp_replace(text, '[^@a-zA-Z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))
    AS text, cell_lat, cell_lng FROM located),
words AS ({words_of('shown', stop=STOP)})
SELECT cell_lat, cell_lng, word, count(*) AS cnt FROM words GROUP BY ALL""", "messages")
def geo_line_word_counts(spark, sf):
    """Through geo CSV files, one folder per day, and back."""
    path = session.new_dir(spark, "csv")
    files.export_geo_csv(inp.messages(spark, sf), path, ts="ts")
    return ct.cell_counts(geo.located(files.read_geo_csv(spark, path)), CELL, stop=STOP)


@query(f"""WITH shown AS (SELECT text, cell_lat, cell_lng, strftime(ts, '%m%d%y') AS day FROM located),
words AS ({words_of('shown', stop=STOP)})
SELECT cell_lat, cell_lng, word, count(*) AS cnt FROM words WHERE day = '010124' GROUP BY ALL""",
       "messages")
def day_folder_word_counts(spark, sf):
    """One day's folder of the geo CSV files."""
    path = session.new_dir(spark, "csv")
    files.export_geo_csv(inp.messages(spark, sf), path, ts="ts")
    return ct.cell_counts(geo.located(files.read_geo_csv(spark, path, "010124")), CELL, stop=STOP)


@query(f"""WITH {CELL_COUNTS_SQL} SELECT cell_lat, cell_lng, word, cnt FROM counts
ORDER BY cell_lat, cell_lng, word LIMIT 10000""", "messages")
def capped_view(spark, sf):
    """The map view's cap on rows, in a total order."""
    counts = session.durable(counts_of(spark, sf))  # read once per histogram
    return rk.first_rows(counts, ["cell_lat", "cell_lng", "word"], rk.ROW_CAP)


CORPUS_SQL = f"""WITH pieces AS (SELECT unnest(string_split(text, ' ')) AS piece FROM {{source}}),
counts AS (SELECT word, count(*) AS cnt FROM (
    SELECT regexp_replace(piece, '^\\s+|\\s+$', '', 'g') AS word FROM pieces
    WHERE lower(piece) NOT IN ({_list(tx.FILLER_WORDS)}))
  WHERE NOT regexp_matches(word, '[@#/''"]') GROUP BY word)"""


@query(CORPUS_SQL.format(source="documents") + " SELECT * FROM counts")
def corpus_word_count(spark, sf):
    return ct.word_count(inp.table(spark, sf, "documents"))


@query(CORPUS_SQL.format(source="""(
  SELECT trim(regexp_replace(regexp_replace(text, '[^@a-zA-Z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))
    AS text FROM messages)""") + " SELECT * FROM counts WHERE word <> ''", "messages")
def line_word_count(spark, sf):
    lines = inp.messages(spark, sf).select(F.concat_ws(
        ",", files.geo_csv_line(F.col("lat"), F.col("lng"), F.col("text")),
        F.col("lang")).alias("value"))
    marked = ct.line_word_count(lines)
    return marked.where(~F.col("word").isin("", files.FIELD_END))


@query(CORPUS_SQL.format(source="documents")
       + " SELECT cnt, word FROM counts ORDER BY cnt DESC, word DESC LIMIT 1")
def most_frequent_word(spark, sf):
    return ct.most_frequent(ct.word_count(inp.table(spark, sf, "documents")))


@query(f"""WITH {LOCATED_WORDS} SELECT word, count(*) AS cnt FROM words GROUP BY word
ORDER BY cnt DESC, word LIMIT 10""", "messages")
def global_top10_words(spark, sf):
    totals = ct.cell_counts(inp.located_texts(spark, sf), [], stop=STOP)
    return rk.top_k(totals, rk.by_count(), 10)


@query("""WITH totals AS (
  SELECT yymmddhh, word, CAST(sum(k) AS BIGINT) AS cnt FROM speed GROUP BY ALL)
SELECT yymmddhh, word, cnt FROM totals
QUALIFY row_number() OVER (PARTITION BY yymmddhh ORDER BY cnt DESC, word) <= 10""", "speed")
def hourly_top10_words(spark, sf):
    """Words of each hour of the speed layer, from its text maps."""
    rows = inp.speed(spark, sf).withColumn("data", maps.text_to_pairs(F.col("data")))
    words, _ = ct.split_measure(ct.merge_maps(rows, ["yymmddhh"], "data"), ["yymmddhh"])
    return rk.top_k(words, rk.by_count(), 10, ["yymmddhh"])


DAY_WORDS = f"""WITH {LOCATED_WORDS}, days AS (
  SELECT strftime(ts, '%y%m%d') AS yymmdd, word, count(*) AS cnt FROM words GROUP BY ALL)"""


def day_counts(spark, sf, minute=inp.MINUTE):
    days = inp.located_texts(spark, sf, minute).withColumn("yymmdd", tm.day_bucket(F.col("ts")))
    return ct.cell_counts(days, ["yymmdd"], stop=STOP)


@query(DAY_WORDS + """ SELECT yymmdd, word, cnt,
  rank() OVER (PARTITION BY yymmdd ORDER BY cnt DESC) AS rank FROM days""", "messages")
def daily_rankings(spark, sf):
    return rk.rank_words(day_counts(spark, sf), ["yymmdd"])


@query(ORACLE["daily_rankings"])
def kept_rankings(spark, sf):
    """The same, kept up as the hours of a day come in."""
    root = session.new_dir(spark, "rankings")
    rankings.create(spark, root, "yymmdd")
    texts = inp.located_texts(spark, sf).withColumn("yymmdd", tm.day_bucket(F.col("ts")))
    for start in range(0, 24, 8):
        part = texts.where(F.hour("ts").between(start, start + 7))
        rankings.add_part(spark, root, f"{start}", ct.cell_counts(part, ["yymmdd"], stop=STOP))
        rankings.clean(spark, root, keep=1)
    return rankings.read_ranks(spark, root)


@query(DAY_WORDS + """ SELECT yymmdd, word, cnt FROM days
QUALIFY row_number() OVER (PARTITION BY yymmdd ORDER BY cnt DESC, word) <= 10""", "lasting")
def daily_top10(spark, sf):
    return rk.top_k(day_counts(spark, sf, inp.LASTING), rk.by_count(), 10, ["yymmdd"])


@query(f"WITH {CELL_COUNTS_SQL} SELECT * FROM counts UNION ALL "
       "SELECT cell_lat, cell_lng, '(messages)', count(*) FROM located GROUP BY ALL", "messages")
def map_text_roundtrip(spark, sf):
    """Counts to maps to text, and back to counts."""
    located = inp.located_messages(spark, sf)
    packed = ct.counts_to_maps(ct.marked_counts(counts_of(spark, sf), ct.cell_messages(located)))
    text = packed.select(*CELL, maps.map_to_text(F.col("data")).alias("text"))
    back = text.select(*CELL, maps.text_to_pairs(F.col("text")).alias("data"))
    words, tweets = ct.split_measure(ct.merge_maps(back, CELL, "data"), CELL)
    return words.unionByName(tweets.select(*CELL, F.lit("(messages)").alias("word"),
                                           F.col("tweets").alias("cnt")))


# ---------------------------------------------------------------- ranking

@query(f"WITH {CELL_COUNTS_SQL}, {TOP_SQL} SELECT * FROM wide", "messages")
def cell_top10_pivot(spark, sf):
    return rk.pivot_topk(counts_of(spark, sf), CELL)


@query(f"WITH {CELL_COUNTS_SQL} SELECT * FROM counts "
       "ORDER BY cnt DESC, word, cell_lat, cell_lng LIMIT 10", "messages")
def top_pairs(spark, sf):
    return rk.top_k(counts_of(spark, sf), rk.by_count("cnt", "word", *CELL), 10)


@query(f"""WITH {CELL_COUNTS_SQL} SELECT *, row_number() OVER (PARTITION BY cell_lat, cell_lng
  ORDER BY cnt DESC, length(word) DESC, word) AS rk FROM counts QUALIFY rk <= 10""", "messages")
def representative_words(spark, sf):
    """The nested form of each cell, unnested again with its places."""
    nested = rk.nest_pairs(counts_of(spark, sf), CELL)
    return nested.select(*CELL, F.posexplode("words").alias("p", "w")).select(
        *CELL, "w.word", "w.cnt", (F.col("p") + 1).cast("bigint").alias("rk"))


@query("""SELECT eb_id, event_name, capacity FROM conferences
ORDER BY capacity DESC, eb_id LIMIT 12 OFFSET 36""", "conferences")
def paged_events(spark, sf):
    events = inp.conferences(spark, sf).select("eb_id", "event_name", "capacity")
    return rk.page(events, [F.desc("capacity"), F.asc("eb_id")], rk.LIST_PAGE, 3)


@query("""SELECT eb_id, CAST(floor((row_number() OVER (ORDER BY capacity DESC, eb_id) - 1) / 21)
  AS BIGINT) AS page FROM conferences""", "conferences")
def event_pages(spark, sf):
    events = inp.conferences(spark, sf).select("eb_id", "capacity")
    return rk.pages(events, [F.desc("capacity"), F.asc("eb_id")], rk.DETAIL_PAGE).select(
        "eb_id", "page")


@query("""SELECT eb_id, ([""" + _list(rk.LABELS) + """])[CAST(
  row_number() OVER (ORDER BY start_time_utc, eb_id) % 12 + 1 AS INT)] AS colors
FROM conferences""", "conferences")
def label_cycle(spark, sf):
    events = inp.conferences(spark, sf).select("eb_id", "start_time_utc")
    return rk.cycle_label(events, [F.asc("start_time_utc"), F.asc("eb_id")]).select(
        "eb_id", "colors")


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS eb_id, l_linenumber, l_extendedprice AS price,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS created_at FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber,
  l_partkey, l_suppkey, l_extendedprice) = 1""")
def latest_event_row(spark, sf):
    newest = rk.latest_by(inp.table(spark, sf, "lineitem"), ["l_orderkey"], [
        F.desc("l_shipdate"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey"),
        F.asc("l_extendedprice")])
    return newest.select(
        F.col("l_orderkey").cast("string").alias("eb_id"), "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        tm.plain(F.col("l_shipdate").cast("timestamp")).alias("created_at"))


# ---------------------------------------------------------------- events

def page_json(spark, sf) -> DataFrame:
    """Orders as landed search pages: each event twice, under two keywords."""
    def iso(c):
        return F.date_format(c, tm.ISO_UTC)

    c = inp.conferences(spark, sf)
    number = F.substring_index("venue_name", " ", -1)
    event = F.struct(
        F.col("eb_id").alias("id"),
        F.concat(F.lit("http://events.example/"), "eb_id").alias("url"), "logo_url",
        F.struct(F.concat(F.lit(" "), "event_name", F.lit(" ")).alias("text")).alias("name"),
        F.struct(F.col("category").alias("text")).alias("description"),
        F.struct(F.col("event_type").alias("name_localized")).alias("format"),
        F.struct(iso(F.col("start_time_utc")).alias("utc")).alias("start"),
        F.struct(iso(F.col("end_time_utc")).alias("utc")).alias("end"),
        iso(F.col("created_at")).alias("created"), iso(F.col("created_at")).alias("changed"),
        "capacity", F.lit("live").alias("status"), "online_event",
        F.struct(F.lit("Org").alias("name"), F.struct(F.lit("").alias("text")).alias("description"),
                 (F.col("capacity") % 3).alias("num_past_events")).alias("organizer"),
        F.when(F.col("venue_name").isNotNull(), number).alias("venue_id"),
        F.when(F.col("venue_name").isNotNull(), F.struct(
            F.col("venue_name").alias("name"),
            F.col("latitude").cast("string").alias("latitude"),
            F.col("longitude").cast("string").alias("longitude"),
            F.struct(F.concat(number, F.lit(" Main St")).alias("address_1"),
                     F.lit("").alias("address_2"), F.lit("US").alias("country")).alias("address"),
        )).alias("venue"),
        F.struct(F.col("category").alias("name_localized")).alias("category"))
    page = F.struct(F.struct(F.lit(1).alias("object_count"), F.lit(1).alias("page_count"))
                    .alias("pagination"), F.array(event).alias("events"))
    keywords = F.explode(F.array(F.lit("art"), F.lit("music"))).alias("keyword")
    return c.select(F.to_json(page).alias("value")).select(keywords, "value")


def _texts(pairs: dict[str, str]) -> str:
    return ", ".join(f"coalesce(CAST({sql} AS VARCHAR), '\\N') AS \"{name}\""
                     for name, sql in pairs.items())


BOTH_KEYWORDS = "(SELECT *, unnest(['art', 'music']) AS keyword FROM conferences)"


@query("SELECT " + _texts({
    "eb_id": "eb_id", "url": "'http://events.example/' || eb_id", "logo_url": "logo_url",
    "event_name": "event_name", "event_type": "event_type", "start_time_utc": "start_time_utc",
    "end_time_utc": "end_time_utc", "eb_created_at": "created_at", "eb_updated_at": "created_at",
    "capacity": "nullif(capacity, 0)", "online_event": "nullif(online_event, false)",
    "venue_id": "CASE WHEN online_event THEN -1 ELSE nullif(o_custkey, 0) END",
    "venue_name": "venue_name", "latitude": "latitude", "longitude": "longitude",
    "category": "keyword", "created_at": f"TIMESTAMP '{inp.AS_OF}'",
}) + f" FROM {BOTH_KEYWORDS}", "conferences")
def flatten_events(spark, sf):
    return as_text(cf.flatten_events(cf.page_events(page_json(spark, sf)), inp.as_of()))


@query("SELECT " + _texts({
    **{c: "NULL" for c in ("resource_uri", "organizer_id", "category_id", "subcategory_id",
                           "format_id", "organizer_description", "subcategory",
                           "venue_address2", "venue_city", "venue_region", "venue_postal_code")},
    "id": "eb_id", "url": "'http://events.example/' || eb_id", "logo_url": "logo_url",
    "created": "strftime(created_at, '%Y-%m-%dT%H:%M:%SZ')",
    "changed": "strftime(created_at, '%Y-%m-%dT%H:%M:%SZ')",
    "capacity": "CASE WHEN capacity = 0 THEN -1 ELSE capacity END", "status": "'live'",
    "venue_id": "CASE WHEN NOT online_event THEN o_custkey END",
    "name": "' ' || event_name || ' '", "description": "category",
    "start": "strftime(start_time_utc, '%Y-%m-%dT%H:%M:%SZ')",
    "end": "strftime(end_time_utc, '%Y-%m-%dT%H:%M:%SZ')", "organizer_name": "'Org'",
    "organizer_num_past_events": "nullif(capacity % 3, 0)", "category": "category",
    "format": "event_type", "venue_name": "venue_name",
    "venue_address1": "CASE WHEN NOT online_event THEN o_custkey || ' Main St' END",
    "venue_country": "CASE WHEN NOT online_event THEN 'US' END",
    "venue_latitude": "latitude", "venue_longitude": "longitude", "search_keyword": "keyword",
}) + f" FROM {BOTH_KEYWORDS}", "conferences")
def archive_events(spark, sf):
    return as_text(cf.archive_events(cf.page_events(page_json(spark, sf))))


STATS_SQL = f"""{CELL_COUNTS_SQL}, {TOP_SQL},
tweets AS (SELECT cell_lat, cell_lng, count(*) AS tweets FROM located GROUP BY ALL),
recent AS (SELECT *, CAST(floor(latitude * 100 + 0.5) AS BIGINT) AS cell_lat,
    CAST(floor(longitude * 100 + 0.5) AS BIGINT) AS cell_lng
  FROM conferences WHERE end_time_utc > TIMESTAMP '{inp.AS_OF}' - INTERVAL 7 DAY
    AND latitude IS NOT NULL AND longitude IS NOT NULL),
stats AS (
  SELECT row_number() OVER (ORDER BY substr(md5(eb_id), 1, 3), eb_id) AS tid, eb_id, event_name,
    event_type, latitude, longitude, strftime(start_time_utc, '%Y-%m-%d %H:%M:%S')
    AS start_time_utc, strftime(end_time_utc, '%Y-%m-%d %H:%M:%S') AS end_time_utc, tweets,
    '{inp.AS_OF}' AS created_at, {WIDE}
  FROM recent JOIN tweets USING (cell_lat, cell_lng) LEFT JOIN wide USING (cell_lat, cell_lng))"""


def stats_of(spark, sf):
    located = inp.located_messages(spark, sf)
    return cf.conference_stats(inp.conferences(spark, sf), counts_of(spark, sf),
                               ct.cell_messages(located), inp.as_of())


@query(f"WITH {STATS_SQL} SELECT * FROM stats", "messages conferences")
def conference_stats(spark, sf):
    return shown(stats_of(spark, sf), "start_time_utc", "end_time_utc", "created_at")


@query(f"""WITH {STATS_SQL}
SELECT r.eb_id, r.event_name, r.event_type, coalesce(r.logo_url, '') AS logo_url,
  strftime(timezone('{ZONE}', timezone('UTC', r.start_time_utc)), '%Y-%m-%d %H:%M:%S')
    AS start_time,
  strftime(timezone('{ZONE}', timezone('UTC', r.end_time_utc)), '%Y-%m-%d %H:%M:%S') AS end_time,
  r.capacity, r.venue_name, r.latitude, r.longitude, coalesce(s.tweets, 0) AS tweets
FROM recent r LEFT JOIN stats s ON r.eb_id = s.eb_id""", "messages conferences")
def conference_list(spark, sf):
    listed = cf.event_list(inp.conferences(spark, sf), stats_of(spark, sf), inp.as_of(), ZONE)
    return pr.fill_defaults(listed, {"logo_url": ""})


@query(f"""WITH {STATS_SQL}
SELECT eb_id, CAST(rk AS INT) AS rk, word, cnt FROM recent
JOIN top USING (cell_lat, cell_lng)""", "messages conferences")
def conference_detail_words(spark, sf):
    """The words of every recent event's detail page."""
    detail = cf.event_detail(inp.conferences(spark, sf).where(pr.has_position()),
                             stats_of(spark, sf), None, inp.as_of())
    return cf.detail_words(detail)


@query(f"""WITH e AS (SELECT *, CAST(end_time_utc AS DATE) < DATE '2000-01-01' AS past,
    CAST(start_time_utc AS DATE) > DATE '2000-01-01' AS future,
    start_time_utc <= TIMESTAMP '{inp.AS_OF}' AND end_time_utc >= TIMESTAMP '{inp.AS_OF}'
      AS running, length(event_type) AS tweets FROM conferences)
SELECT count(*) FILTER (past) AS last7days, count(*) FILTER (NOT past AND future) AS tomorrow,
  count(*) FILTER (NOT past AND NOT future) AS today, count(*) FILTER (running) AS live_conf,
  CAST(coalesce(sum(tweets) FILTER (running), 0) AS BIGINT) AS live_tweets,
  CAST(coalesce(sum(capacity) FILTER (running), 0) AS BIGINT) AS capacity FROM e""", "conferences")
def schedule_dashboard(spark, sf):
    events = inp.conferences(spark, sf).withColumn("tweets", F.length("event_type"))
    return cf.dashboard(events, inp.as_of())


@query("""SELECT eb_id, event_name, event_type FROM conferences
WHERE regexp_matches(event_name, '(?i)ev[A-Za-z]nt 1') AND regexp_matches(event_type, '(?i)h[A-Za-z]g')""",
       "conferences")
def text_filter(spark, sf):
    events = inp.conferences(spark, sf).select("eb_id", "event_name", "event_type")
    return events.where(tx.match_all({"event_name": "ev*nt 1", "event_type": "h*g"}))


@query("SELECT eb_id, capacity FROM conferences WHERE capacity < 400 AND capacity > 100",
       "conferences")
def numeric_filter(spark, sf):
    events = inp.conferences(spark, sf).select("eb_id", "capacity")
    return events.where(pr.match_number(F.col("capacity"), "400>>100"))


@query(f"""SELECT eb_id FROM conferences WHERE start_time_utc <= TIMESTAMP '{inp.AS_OF}' + INTERVAL 30 MINUTE
  AND end_time_utc >= TIMESTAMP '{inp.AS_OF}' - INTERVAL 30 MINUTE""", "conferences")
def live_events(spark, sf):
    return inp.conferences(spark, sf).where(pr.live(inp.as_of())).select("eb_id")


@query("""SELECT eb_id, keyword FROM (SELECT *, unnest(['art', 'music']) AS keyword FROM conferences)
WHERE start_time_utc >= TIMESTAMP '2000-01-02' AND start_time_utc < TIMESTAMP '2000-01-03'""",
       "conferences")
def landing_window(spark, sf):
    """Landed events that start tomorrow."""
    found = cf.starting_between(cf.page_events(page_json(spark, sf)), F.to_date(inp.as_of()))
    return found.select(F.col("e.id").alias("eb_id"), F.col("search_keyword").alias("keyword"))


@query("SELECT count(*) AS n FROM conferences WHERE online_event", "conferences")
def row_count(spark, sf):
    return tb.row_count(inp.conferences(spark, sf), F.col("online_event"))


# ---------------------------------------------------------------- photos

PHOTO_WORDS = f"""{CELL_COUNTS_SQL}, recent AS (
  SELECT DISTINCT CAST(floor(latitude * 100 + 0.5) AS BIGINT) AS cell_lat,
    CAST(floor(longitude * 100 + 0.5) AS BIGINT) AS cell_lng
  FROM conferences WHERE end_time_utc > TIMESTAMP '{inp.AS_OF}' - INTERVAL 7 DAY
    AND latitude IS NOT NULL),
said AS (SELECT DISTINCT word FROM counts JOIN recent USING (cell_lat, cell_lng)),
found AS (SELECT word, url FROM photo_index WHERE word IN (SELECT word FROM said)),
photos AS (SELECT row_number() OVER (
    ORDER BY substr(md5(word || chr(31) || url), 1, 3), word, url) AS pid,
  '00010112' AS yymmddhh, word, url FROM found)"""


def photos_of(spark, sf):
    words = ph.event_words(inp.conferences(spark, sf), counts_of(spark, sf), inp.as_of())
    return ph.keyword_photos(words, inp.photo_index(spark, sf), inp.as_of())


@query(f"WITH {PHOTO_WORDS} SELECT * FROM photos", "messages conferences photo_index")
def keyword_photos(spark, sf):
    return photos_of(spark, sf)


@query("""WITH wanted AS (SELECT DISTINCT word FROM words)
SELECT word, url FROM photo_index WHERE word IN (SELECT word FROM wanted)
ORDER BY md5(word || ' ' || url || '0'), word || ' ' || url LIMIT 200""".replace(
    "WITH wanted", f"WITH {LOCATED_WORDS}, wanted"), "messages photo_index")
def sampled_photos(spark, sf):
    return ph.photos_for(counts_of(spark, sf), inp.photo_index(spark, sf))


@query("""SELECT page_id, 'https://farm' || farm || '.staticflickr.com/' || length(html) || '/'
  || page_id || '_' || substr(md5(url), 1, 10) || '_n.jpg' AS url
FROM (SELECT *, unnest(['1', '2']) AS farm FROM pages)""")
def photo_urls_xml(spark, sf):
    """Two photos per page, written as a search answer and read back."""
    def photo(farm: str):
        return F.format_string(
            '<photo id="%s" server="%s" farm="' + farm + '" secret="%s" title="a &amp; b"/>',
            F.col("page_id").cast("string"), F.length("html").cast("string"),
            F.substring(F.md5("url"), 1, 10))

    answers = inp.table(spark, sf, "pages").select("page_id", F.concat(
        F.lit('<rsp stat="ok"><photos page="1">'), photo("1"), photo("2"),
        F.lit("</photos></rsp>")).alias("xml"))
    return ph.photos_from_xml(answers, ["page_id"])


# ---------------------------------------------------------------- space

BOX_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lines m WHERE EXISTS (
  SELECT 1 FROM spread e WHERE m.lat BETWEEN e.latitude - 0.05::DOUBLE AND e.latitude + 0.05::DOUBLE
    AND m.lng BETWEEN e.longitude - 0.05::DOUBLE AND e.longitude + 0.05::DOUBLE
    AND m.ts BETWEEN e.start_time_utc - INTERVAL 30 MINUTE AND e.end_time_utc + INTERVAL 30 MINUTE)"""


@query(BOX_SQL, "conferences spread lines")
def live_box_messages(spark, sf):
    hits = sp.messages_in_boxes(inp.placed_lines(spark, sf), inp.spread_conferences(spark, sf))
    return hits.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""SELECT l_orderkey, l_linenumber FROM (
    SELECT *, 37 + (l_partkey * 7919 % 1000) / 5000.0::DOUBLE AS la, -122 + (l_suppkey * 104729 % 1000) / 5000.0::DOUBLE AS ln
    FROM lines) m
  WHERE EXISTS (SELECT 1 FROM (
      SELECT 37 + (o_orderkey * 15485863 % 1000) / 5000.0::DOUBLE AS a, -122 + (o_orderkey * 32452843 % 997) / 5000.0::DOUBLE AS b,
        CAST(o_orderdate AS TIMESTAMP) AS s FROM orders WHERE o_orderstatus <> 'P') e
    WHERE m.ts BETWEEN e.s AND e.s + INTERVAL 12 HOUR AND m.la BETWEEN e.a - 0.05::DOUBLE AND e.a + 0.05::DOUBLE
      AND m.ln BETWEEN e.b - 0.05::DOUBLE AND e.b + 0.05::DOUBLE)""", "lines")
def dense_box_messages(spark, sf):
    """All events within a few boxes' width, a season to a slot, so that bins are split."""
    def spread(key: str, by: int, of: int, start: int) -> Column:
        return F.lit(start) + F.pmod(F.col(key) * by, F.lit(of)) / F.lit(5000.0)

    start = F.col("o_orderdate").cast("timestamp")
    events = inp.table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(
        spread("o_orderkey", 15485863, 1000, 37).alias("latitude"), spread("o_orderkey", 32452843, 997, -122).alias("longitude"),
        start.alias("start_time_utc"), (start + F.expr("INTERVAL 12 HOURS")).alias("end_time_utc"))
    lines = inp.placed_lines(spark, sf).withColumns({
        "lat": spread("l_partkey", 7919, 1000, 37), "lng": spread("l_suppkey", 104729, 1000, -122)})
    hits = sp.messages_in_boxes(lines, events, slack="0 minutes", slot_seconds=90 * 86_400, most=200)
    return hits.select("l_orderkey", "l_linenumber")


BOX_TEXT = """round(longitude - 0.05::DOUBLE, 4) || ',' || round(latitude - 0.05::DOUBLE, 4) || ','
  || round(longitude + 0.05::DOUBLE, 4) || ',' || round(latitude + 0.05::DOUBLE, 4)"""


@query(f"SELECT eb_id, {BOX_TEXT} AS box FROM conferences WHERE latitude IS NOT NULL", "conferences")
def box_strings(spark, sf):
    return sp.box_strings(inp.conferences(spark, sf))


@query(f"""WITH boxes AS (SELECT {BOX_TEXT} AS box,
    row_number() OVER (ORDER BY substr(md5(eb_id), 1, 3), eb_id) AS id
  FROM conferences WHERE latitude IS NOT NULL)
SELECT CAST(floor((id - 1) / 100) AS BIGINT) AS request, string_agg(box, ',' ORDER BY id) AS boxes
FROM boxes GROUP BY 1""", "conferences")
def box_requests(spark, sf):
    return sp.box_requests(sp.box_strings(inp.conferences(spark, sf)))


@query("""SELECT eb_id FROM conferences WHERE latitude IN (30.01, 30.05, 30.1)
  AND longitude > -120::DOUBLE AND longitude < -119.97::DOUBLE""", "conferences")
def geo_in_range(spark, sf):
    return geo.geo_in_range(inp.conferences(spark, sf), [30.01, 30.05, 30.1], -120.0, -119.97,
                            "latitude", "longitude").select("eb_id")


BOXES = {"west": (30.0, 30.1, -120.0, -119.99), "east": (30.05, 30.15, -119.98, -119.97),
         "sf": geo.REGIONS["sf"]}


@query("""WITH days AS (SELECT strftime(timestamp, '%y%m%d') AS yymmdd, * FROM speed_cells),
fullest AS (SELECT yymmdd FROM days GROUP BY yymmdd ORDER BY count(*) DESC, yymmdd LIMIT 1)
SELECT yymmdd, cell_lat, cell_lng, word, count(*) AS n FROM days WHERE yymmdd = (SELECT yymmdd FROM fullest)
  AND cell_lat IN (3001, 3002, 3004) AND cell_lng > -12000 AND cell_lng < -11995 GROUP BY ALL""", "speed")
def stored_range(spark, sf):
    """A day, latitudes out of a list and an open range of longitudes, of a table stored along
    a Morton curve. The day is the one with most rows."""
    path = session.new_dir(spark, "grid")
    rows = geo.coarsen(geo.with_cell(inp.speed(spark, sf), precision=3)).select(
        F.date_format("timestamp", "yyMMdd").alias("yymmdd"), "cell_lat", "cell_lng",
        F.substring_index("data", ",", 1).alias("word"))
    grid.write_grid(rows, path)
    stored = grid.read_grid(spark, path, rows.schema)
    top = stored.groupBy("yymmdd").count().orderBy(F.desc("count"), "yymmdd").first()
    found = grid.in_range(stored, [top["yymmdd"]] if top else [], [3001, 3002, 3004], -12000, -11995)
    return found.groupBy("yymmdd", "cell_lat", "cell_lng", "word").agg(F.count(F.lit(1)).alias("n"))


REGION_SQL = """regions AS (
  SELECT c_custkey AS region, 30 + (c_custkey % 1999) / 1000 - half AS south, 30 + (c_custkey % 1999) / 1000 + half AS north,
    -120 + (c_custkey % 7) / 100 - 3 * half AS west, -120 + (c_custkey % 7) / 100 + 3 * half AS east
  FROM (SELECT *, 0.0005::DOUBLE * (1 << (c_custkey % 8)) AS half FROM customer))"""


@query(f"""WITH {REGION_SQL}
SELECT region, count(l_orderkey) AS n FROM regions LEFT JOIN lines
  ON lat >= south AND lat <= north AND lng >= west AND lng <= east GROUP BY region""", "lines")
def region_table_counts(spark, sf):
    """Lines inside each of a table of boxes of eight sizes, which overlap."""
    half = F.lit(0.0005) * F.pow(F.lit(2.0), F.col("c_custkey") % 8)
    lat = F.lit(30) + (F.col("c_custkey") % 1999) / F.lit(1000)
    lng = F.lit(-120) + (F.col("c_custkey") % 7) / F.lit(100)
    boxes = inp.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("region"), (lat - half).alias("south"), (lat + half).alias("north"),
        (lng - F.lit(3) * half).alias("west"), (lng + F.lit(3) * half).alias("east"))
    return rg.counts_per_region(inp.placed_lines(spark, sf), boxes, "region")


def _box_sql(lat: str, lng: str, box) -> str:
    south, north, west, east = box
    return (f"({lat} BETWEEN {south}::DOUBLE AND {north}::DOUBLE"
            f" AND {lng} BETWEEN {west}::DOUBLE AND {east}::DOUBLE)")


@query("WITH tally AS (SELECT DISTINCT cell_lat / 100 AS lat, cell_lng / 100 AS lng FROM located) "
       + " UNION ALL ".join(
           f"SELECT '{n}' AS region, count(*) FILTER ({_box_sql('lat', 'lng', b)}) AS cells FROM tally"
           for n, b in BOXES.items()), "messages")
def region_counts(spark, sf):
    cells = ct.cell_messages(inp.located_messages(spark, sf)).select(
        geo.cell_degrees(F.col("cell_lat")).alias("lat"),
        geo.cell_degrees(F.col("cell_lng")).alias("lng"))
    return sp.region_counts(cells, BOXES)


@query("SELECT doc_id FROM messages WHERE " + " OR ".join(
    _box_sql("lat", "lng", b) for b in BOXES.values()), "messages")
def messages_in_any_box(spark, sf):
    return routing.in_boxes(inp.messages(spark, sf), list(BOXES.values())).select("doc_id")


# ---------------------------------------------------------------- summary

SPEED_TWEETS = "tally AS (SELECT cell_lat, cell_lng, count(*) AS tweets FROM speed_cells GROUP BY ALL)"


def speed_views(spark, sf):
    return layers.updates(inp.speed(spark, sf))


@query(f"""WITH {SPEED_TWEETS} SELECT count(*) AS locations, CAST(sum(tweets) AS BIGINT) AS total,
  round(avg(tweets), 2) AS average, round(var_pop(tweets), 2) AS variance,
  round(stddev_pop(tweets), 2) AS stdev FROM tally""", "speed")
def cell_summary(spark, sf):
    return su.summary(speed_views(spark, sf)[1])


@query(f"""WITH {SPEED_TWEETS}, s AS (SELECT avg(tweets) AS mu, stddev_pop(tweets) AS sd FROM tally)
SELECT cell_lat, cell_lng, tweets, CASE WHEN tweets < mu THEN 'below_avg'
  WHEN tweets < mu + sd THEN 'one_std' WHEN tweets < mu + 2 * sd THEN 'two_std'
  ELSE 'three_std' END AS fill_key FROM tally, s""", "speed")
def sigma_buckets(spark, sf):
    return su.sigma_bucket(speed_views(spark, sf)[1])


# ---------------------------------------------------------------- layers

@query(f"""WITH {CELL_COUNTS_SQL} SELECT cell_lat, cell_lng, word, CAST(sum(cnt) AS BIGINT) AS cnt
FROM (SELECT * FROM counts UNION ALL SELECT cell_lat, cell_lng, word, k FROM speed_cells)
GROUP BY ALL""", "messages speed")
def merged_view(spark, sf):
    words, tweets = speed_views(spark, sf)
    batch = ct.cell_messages(inp.located_messages(spark, sf))
    return layers.merge_layers(counts_of(spark, sf), words, batch, tweets)[0]


@query("""SELECT cell_lat, cell_lng, count(*) AS tweets
FROM (SELECT cell_lat, cell_lng FROM located UNION ALL SELECT cell_lat, cell_lng FROM speed_cells)
GROUP BY ALL""", "messages speed")
def merged_tweets(spark, sf):
    words, tweets = speed_views(spark, sf)
    batch = ct.cell_messages(inp.located_messages(spark, sf))
    return layers.merge_layers(words, words, batch, tweets)[1]


@query(f"""SELECT cell_lat, cell_lng, word, CAST(sum(k) AS BIGINT) AS cnt FROM speed_cells
WHERE timestamp > TIMESTAMP '{SINCE}' GROUP BY ALL""", "speed")
def updates_since(spark, sf):
    changed = layers.changes_since(inp.speed(spark, sf), F.lit(SINCE).cast("timestamp"))
    return layers.updates(changed)[0]


@query("""SELECT yymmddhh, word, CAST(sum(k) AS BIGINT) AS cnt FROM speed
WHERE yymmddhh = (SELECT max(yymmddhh) FROM speed WHERE yymmddhh IN ('24013100', '24013023'))
GROUP BY ALL""", "speed")
def latest_hour_words(spark, sf):
    """Just after midnight: the new hour is empty, so the last one of the day before."""
    rows = layers.latest_bucket(inp.speed(spark, sf),
                                F.lit("2024-01-31 00:10:00").cast("timestamp"))
    merged = ct.merge_maps(rows.withColumn("data", maps.text_to_pairs(F.col("data"))),
                           ["yymmddhh"], "data")
    return ct.split_measure(merged, ["yymmddhh"])[0]


@query(f"""WITH {LOCATED_WORDS} SELECT strftime(ts, '%y%m%d%H') AS yymmddhh, cell_lat, cell_lng,
  word, count(*) AS cnt FROM words GROUP BY ALL""", "lasting")
def hour_buckets(spark, sf):
    """Hourly counts written as a bucketed table and read back."""
    path = session.new_dir(spark, "hours")
    files.write_buckets(hour_counts_of(spark, sf, inp.LASTING), path, sort=["cell_lat", "cell_lng"], folder=4)
    return files.read_buckets(spark, path)


@query(f"""WITH {LOCATED_WORDS} SELECT cell_lat, cell_lng, word, count(*) AS cnt FROM words
WHERE strftime(ts, '%y%m%d%H') = '24010112' GROUP BY ALL""", "messages")
def one_bucket(spark, sf):
    """One hour of the bucketed table; the others are not read."""
    path = session.new_dir(spark, "hours")
    files.write_buckets(hour_counts_of(spark, sf), path)
    return layers.bucket(files.read_buckets(spark, path), "24010112").drop("yymmddhh")


@query("""SELECT DISTINCT printf('%.2f,%.2f', cell_lat / 100, cell_lng / 100) AS location,
  cell_lat / 100 AS lat, cell_lng / 100 AS lng FROM located""", "messages")
def split_locations(spark, sf):
    """Cells shown as text and split again."""
    shown_at = geo.cell_text(F.col("cell_lat"), F.col("cell_lng"))
    cells = inp.located_messages(spark, sf).select(shown_at.alias("location")).distinct()
    return cells.select("location", geo.split_cell(F.col("location")).alias("at")).select(
        "location", "at.lat", "at.lng")


@query(f"""WITH {LOCATED_WORDS.replace(_list(STOP), "'the'")}, stops AS ({words_of('benchmark')})
SELECT cell_lat, cell_lng, word, count(*) AS cnt FROM words
WHERE word NOT IN (SELECT word FROM stops) GROUP BY ALL""", "messages")
def stop_table_counts(spark, sf):
    """Without the words of a stop table: those of the benchmark."""
    stop = ct.tokens(inp.table(spark, sf, "benchmark"), []).distinct()
    words = ct.cell_counts(inp.located_texts(spark, sf), CELL, stop=stop)
    return ct.without_words(words, ["the"])


@query(f"""WITH linked AS (SELECT page_id % 7 AS page, url || ' ' || html AS text FROM pages),
words AS ({words_of('linked')})
SELECT page, word, count(*) AS cnt FROM words GROUP BY ALL""")
def page_words_without_links(spark, sf):
    """Words of addresses and pages; those that hold a link are left out."""
    linked = inp.table(spark, sf, "pages").select(
        (F.col("page_id") % 7).alias("page"), F.concat_ws(" ", "url", "html").alias("text"))
    return ct.cell_counts(linked, ["page"])


@query(r"""WITH raw AS (SELECT CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS lat, CAST(c_custkey % 9 AS VARCHAR)
  || CASE WHEN c_custkey % 3 > 0 THEN '.5' ELSE '' END AS lng FROM customer),
cells AS (SELECT CASE WHEN regexp_matches(lat, '^-?[0-9]+\.[0-9]+$') AND lng LIKE '%.%'
  THEN CAST(floor(CAST(lat AS DOUBLE) * 100 + 0.5) AS BIGINT) END AS cell_lat,
  CASE WHEN regexp_matches(lat, '^-?[0-9]+\.[0-9]+$') AND lng LIKE '%.%'
  THEN CAST(floor(CAST(lng AS DOUBLE) * 100 + 0.5) AS BIGINT) END AS cell_lng FROM raw)
SELECT cell_lat, cell_lng, count(*) AS tweets FROM cells GROUP BY ALL""")
def cells_of_coordinate_texts(spark, sf):
    """Coordinates as text, a third of them without a decimal point and so no place."""
    raw = inp.table(spark, sf, "customer").select(
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("lat"),
        F.concat((F.col("c_custkey") % 9).cast("string"),
                 F.when(F.col("c_custkey") % 3 > 0, ".5").otherwise("")).alias("lng"))
    return ct.cell_messages(geo.with_cell(raw))


# ---------------------------------------------------------------- tables

@query("""WITH newest AS (SELECT l_orderkey AS id, l_extendedprice AS price, l_shipdate AS stamp
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC,
    l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1),
stored AS (SELECT o_orderkey AS id, o_totalprice AS price, o_orderdate AS stamp FROM orders
  WHERE o_orderstatus <> 'P')
SELECT id, price, strftime(stamp, '%Y-%m-%d %H:%M:%S') AS stamp FROM (
  SELECT * FROM stored WHERE id NOT IN (SELECT id FROM newest) UNION ALL SELECT * FROM newest)""")
def upsert_result(spark, sf):
    """Lines put into the stored orders; repeated keys count once, the newest."""
    stored, lines, order = upsert_inputs(spark, sf)
    return shown(wh.upsert(stored, lines, ["id"], order), "stamp")


def upsert_inputs(spark, sf):
    stored = inp.table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").cast("timestamp").alias("stamp"))
    lines = inp.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").cast("timestamp").alias("stamp"), "l_linenumber", "l_partkey", "l_suppkey")
    order = [F.desc("stamp"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey"),
             F.asc("price")]
    return stored, lines, order


def new_table(spark, kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex}"


@query(ORACLE["upsert_result"])
def table_upsert(spark, sf):
    """The same through a stored table of buckets."""
    name = new_table(spark, "upserted")
    tb.ensure_table(spark, name, "id BIGINT, price DOUBLE, stamp TIMESTAMP", buckets=8)
    stored, lines, order = upsert_inputs(spark, sf)
    tb.upsert_table(spark, name, stored, ["id"])
    tb.upsert_table(spark, name, lines, ["id"], order)
    return shown(tb.read_table(spark, name).drop(tb.BUCKET), "stamp")


@query(ORACLE["upsert_result"])
def keyed_upsert(spark, sf):
    """The same through files sorted by key, of which those with such keys are rewritten: first
    for the lines of a few spread orders, then for all."""
    root = session.new_dir(spark, "keyed")
    stored, lines, order = upsert_inputs(spark, sf)
    ky.create_keyed(spark, root, stored, ["id"], file_rows=max(1, stored.count() // 20))
    ky.upsert_keyed(spark, root, lines.where("id % 1000 = 7"), order)
    ky.upsert_keyed(spark, root, lines, order)
    ky.clean_keyed(spark, root, keep=1)
    return shown(ky.read_keyed(spark, root), "stamp")


@query("SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'")
def table_swap(spark, sf):
    """A table, partitioned, whose rows another table's take the place of."""
    live, staged = new_table(spark, "live"), new_table(spark, "staged")
    rows = inp.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"),
                                                 F.col("o_orderstatus").alias("status"))
    for name in (live, staged):
        tb.ensure_table(spark, name, "id BIGINT, status STRING", partition_by=["status"])
    tb.replace_table(spark, live, rows.where("status <> 'F'"))
    tb.replace_table(spark, staged, rows.where("status <> 'P'"))
    tb.swap_table(spark, live, staged)
    return tb.read_table(spark, live)


@query("""SELECT yymmddhh, count(*) AS n FROM speed WHERE yymmddhh > '24010812' GROUP BY ALL""",
       "speed")
def retention(spark, sf):
    cutoff = tm.hour_bucket(F.lit(SINCE).cast("timestamp") - F.expr("INTERVAL 7 DAYS"))
    return wh.expire(inp.speed(spark, sf), cutoff).groupBy("yymmddhh").agg(
        F.count(F.lit(1)).alias("n"))


@query("""SELECT max(o_orderkey) FILTER (o_orderdate = (SELECT max(o_orderdate) FROM orders))
  AS last_value, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_ts FROM orders""")
def last_value(spark, sf):
    return shown(wh.high_water(inp.table(spark, sf, "orders"), "o_orderkey", "o_orderdate"),
                 "last_ts")


@query("SELECT max(o_orderkey) AS last_value FROM orders")
def last_id(spark, sf):
    return wh.high_water(inp.table(spark, sf, "orders"), "o_orderkey")


@query("""WITH rows AS (SELECT o_orderdate, o_orderkey FROM orders
  ORDER BY o_orderdate, o_orderkey LIMIT 10000)
SELECT (SELECT count(*) FROM rows) AS row_count, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  AS o_orderdate, o_orderkey FROM rows ORDER BY 2 DESC, 3 DESC LIMIT 1""")
def capped_export(spark, sf):
    """Where an export of at most 10000 rows ended."""
    orders = inp.table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return shown(wh.capped(orders, ["o_orderdate", "o_orderkey"], 10_000)[1], "o_orderdate")


@query("""SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, l_orderkey, l_linenumber, l_extendedprice AS price FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 5000""")
def dearest_lines(spark, sf):
    """A long list, falling by a price that repeats: histograms of the price leave it and little more."""
    lines = inp.table(spark, sf, "lineitem")
    found = rk.first_rows(lines, ["-l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"], 5000)
    return found.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), "l_orderkey", "l_linenumber",
                        F.col("l_extendedprice").alias("price"))


EXPORT = ["eb_id", "event_name", "event_type", "logo_url", "start_time_utc", "capacity",
          "online_event", "venue_name", "latitude", "longitude"]


def export_rows(spark, sf):
    events = inp.conferences(spark, sf)
    return pr.falsy_to_null(events, ["capacity", "online_event", "latitude", "longitude"])


@query("SELECT " + " || chr(7) || ".join(
    f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in EXPORT).replace(
        "CAST(online_event AS", "CAST(nullif(online_event, false) AS").replace(
        "CAST(capacity AS", "CAST(nullif(capacity, 0) AS") + " AS value FROM conferences",
       "conferences")
def delimited_export(spark, sf):
    return files.delimited(export_rows(spark, sf), EXPORT)


@query("SELECT " + _texts({c: {"online_event": "nullif(online_event, false)",
                               "capacity": "nullif(capacity, 0)"}.get(c, c) for c in EXPORT})
       + " FROM conferences", "conferences")
def delimited_load(spark, sf):
    """Written as delimited text and loaded again under the strict schema."""
    path = session.new_dir(spark, "delimited")
    files.export_delimited(export_rows(spark, sf), EXPORT, path)
    schema = ("eb_id STRING, event_name STRING, event_type STRING, logo_url STRING, "
              "start_time_utc TIMESTAMP, capacity INT, online_event BOOLEAN, venue_name STRING, "
              "latitude DOUBLE, longitude DOUBLE")
    return as_text(files.load_delimited(spark, path, schema))


@query("""SELECT coalesce(CAST(lat AS VARCHAR), chr(7)) || ',' || coalesce(CAST(lng AS VARCHAR), chr(7))
  || ',' || coalesce(nullif(trim(regexp_replace(regexp_replace(text, '[^@a-zA-Z0-9\\s]', '', 'g'),
    '\\s+', ' ', 'g')), ''), chr(7)) AS value FROM messages""", "messages")
def geo_csv(spark, sf):
    return inp.messages(spark, sf).select(
        files.geo_csv_line(F.col("lat"), F.col("lng"), F.col("text")).alias("value"))


@query("""WITH stored AS (SELECT max(o_orderkey) AS top FROM orders)
SELECT c_custkey, (SELECT top FROM stored) + row_number() OVER (
  ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3), c_custkey) AS id FROM customer""")
def append_with_ids(spark, sf):
    stored = inp.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    rows = inp.table(spark, sf, "customer").select("c_custkey")
    return wh.with_next_ids(rows, stored, "id", ["c_custkey"], recompute=True)


@query(f"""WITH {CELL_COUNTS_SQL} SELECT row_number() OVER (ORDER BY
    substr(md5(concat_ws(chr(31), cell_lat, cell_lng, word)), 1, 3), cell_lat, cell_lng, word) AS wid,
  word AS words, cell_lat / 100 AS latitude, cell_lng / 100 AS longitude, cnt AS count,
  '{inp.AS_OF}' AS created_at FROM counts""", "messages")
def word_rows(spark, sf):
    return shown(cf.word_rows(counts_of(spark, sf), inp.as_of()), "created_at")


@query("""SELECT greatest(max(doc_id * 10), (SELECT max(l_orderkey) FROM lineitem)) AS k_offset
FROM documents""")
def offsets_audit(spark, sf):
    names = inp.table(spark, sf, "documents").select(F.concat(
        F.lit("topic/010124/topic_offset_"), (F.col("doc_id") * 10).cast("string"), F.lit("_"),
        F.col("n_chars").cast("string"), F.lit(".txt")).alias("path"))
    log = inp.table(spark, sf, "lineitem").select(F.lit("files").alias("group_name"),
                                                  F.col("l_orderkey").alias("k_offset"))
    return wh.next_offset(names, log, "files")


# ---------------------------------------------------------------- messages

def message_json(spark, sf) -> DataFrame:
    """Documents as queue messages, and a deletion notice per toxic label."""
    m = inp.messages(spark, sf)
    short = F.substring_index("text", " ", 2)
    body = F.struct(
        F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("id_str"), "text",
        F.lit(False).alias("retweeted"), (F.col("doc_id") % 3).cast("int").alias("retweet_count"),
        "lang", F.unix_millis("ts").cast("string").alias("timestamp_ms"),
        F.struct(F.array(F.struct(F.lit("a_b").alias("screen_name")),
                         F.struct(F.col("lang").alias("screen_name"))).alias("user_mentions"),
                 F.array().cast("array<struct<text:string>>").alias("hashtags")).alias("entities"),
        F.when(F.col("lat").isNotNull(), F.struct(F.array("lat", "lng").alias("coordinates")))
        .alias("geo"),
        F.struct((F.col("doc_id") % 7).alias("id"), short.alias("name"),
                 (F.col("doc_id") % 2 == 1).alias("verified"),
                 F.lit("Mon Jan 01").alias("created_at")).alias("user"))
    notices = inp.table(spark, sf, "labels").where("toxic = 1").select(
        F.to_json(F.struct(F.struct(F.struct(F.col("doc_id").alias("id")).alias("status"))
                           .alias("delete"))).alias("value"))
    return m.select(F.to_json(body).alias("value")).unionByName(notices)


@query("SELECT " + _texts({
    **{c: "NULL" for c in ms.FLAT_MESSAGE},
    "id": "nullif(doc_id, 0)", "id_str": "doc_id", "text": "text",
    "retweet_count": "nullif(doc_id % 3, 0)", "lang": "lang",
    "timestamp_ms": "epoch_ms(ts)", "created_at": "ts",
    "user_mentions": "'ab ' || lang", "lat": "lat", "lng": "lng",
    "user-id": "nullif(doc_id % 7, 0)", "name": "array_to_string(string_split(text, ' ')[1:2], ' ')",
    "verified": "CASE WHEN doc_id % 2 = 1 THEN true END", "user-created_at": "'Mon Jan 01'",
}) + " FROM messages", "messages")
def flatten_messages(spark, sf):
    return as_text(ms.flatten_messages(ms.parse_messages(message_json(spark, sf))))


def drained(spark, sf) -> str:
    """The messages put in a queue of two partitions and drained in batches of a fifth of
    them; the job stops after the second batch and is run again. The second partition
    grows before the last batches."""
    queue, out = session.new_dir(spark, "queue"), session.new_dir(spark, "drained")
    values = message_json(spark, sf).select("value", F.crc32("value").alias("c"))
    for part in (0, 1):
        qu.append_messages(spark, values.where(F.col("c") % 3 == part), queue, ["c", "value"], part)
    batch = max(1, sum(qu.end_offsets(spark, queue).values()) // 5)
    qu.drain(spark, queue, out, "files", inp.as_of(), batch, most_batches=2)
    qu.append_messages(spark, values.where(F.col("c") % 3 == 2), queue, ["c", "value"], 1)
    qu.drain(spark, queue, out, "files", inp.as_of(), batch)
    return out


@query("SELECT " + ", ".join(f"coalesce({c}, '\\N') AS {a}" for c, a in (
    ("CAST(nullif(doc_id, 0) AS VARCHAR)", "id"), ("replace(nullif(text, ''), chr(10), '')", "text"),
    ("CAST(nullif(doc_id % 3, 0) AS VARCHAR)", "retweet_count"), ("lang", "lang"),
    ("strftime(ts, '%Y-%m-%d %H:%M:%S')", "created_at"), ("CAST(lat AS VARCHAR)", "lat"),
    ("CASE WHEN doc_id % 2 = 1 THEN 'true' END", "verified"))) + " FROM messages", "messages")
def drained_messages(spark, sf):
    flat = qu.read_flat(spark, drained(spark, sf))
    return flat.select("id", "text", "retweet_count", "lang", "created_at", "lat", "verified").fillna("\\N")


@query("""SELECT strftime(ts, '%m%d%y') AS day, coalesce(CAST(lat AS VARCHAR), chr(7)) || ','
  || coalesce(CAST(lng AS VARCHAR), chr(7)) AS at, count(*) AS n FROM messages GROUP BY ALL""", "messages")
def drained_days(spark, sf):
    """Geo CSV lines of the drained batches by day and place."""
    lines = qu.read_geo(spark, drained(spark, sf))
    at = F.substring_index("value", ",", 2)
    return lines.groupBy("day", at.alias("at")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH fine AS (SELECT CAST(floor(lat * 1000 + 0.5) AS BIGINT) AS cell_lat,
    CAST(floor(lng * 1000 + 0.5) AS BIGINT) AS cell_lng, text FROM messages WHERE lat IS NOT NULL),
words AS ({words_of('fine', stop=STOP)})
SELECT cell_lat, cell_lng, word, count(*) AS cnt FROM words GROUP BY ALL""", "messages")
def queue_word_counts(spark, sf):
    """From JSON values to counts on the fine grid."""
    placed = ms.message_geo(ms.parse_messages(message_json(spark, sf)), geo.STREAM_PRECISION)
    return ct.cell_counts(geo.located(placed), CELL, stop=STOP)


@query("""SELECT doc_id, CAST(to_json({doc_id: doc_id, text: text, lang: lang, source: source,
  n_chars: n_chars}) AS VARCHAR) AS value FROM documents""")
def topic_values(spark, sf):
    """Whole messages as a topic's values."""
    docs = inp.table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return ms.to_topic(docs, "doc_id").select(F.col("key").cast("bigint").alias("doc_id"), "value")


# ---------------------------------------------------------------- times

@query(f"""SELECT eb_id,
  strftime(timezone('{ZONE}', timezone('UTC', start_time_utc)), '%Y-%m-%d %H:%M:%S') AS local_time,
  strftime(start_time_utc, '%a, %b %d') AS shown_date,
  ltrim(strftime(start_time_utc, '%I:%M %p'), '0') AS shown_time,
  strftime(start_time_utc, '%m%d%y') AS path_day, strftime(start_time_utc, '%y%m%d%H') AS yymmddhh,
  regexp_replace('id ' || eb_id || '!', '[^0-9.]+', '', 'g') AS digits FROM conferences""",
       "conferences")
def local_times(spark, sf):
    start = F.col("start_time_utc")
    local = tm.to_local(start, ZONE)
    return inp.conferences(spark, sf).select(
        "eb_id", tm.plain(local).alias("local_time"),
        tm.display_date(start).alias("shown_date"), tm.display_time(start).alias("shown_time"),
        tm.path_day(start).alias("path_day"), tm.hour_bucket(start).alias("yymmddhh"),
        tx.digits_only(F.concat(F.lit("id "), "eb_id", F.lit("!"))).alias("digits"))


# ---------------------------------------------------------------- streams

STREAM_PARTS = 3


def in_batches(spark, rows: DataFrame, order: Column, run: Callable[[DataFrame], StreamingQuery],
               parts: int = STREAM_PARTS) -> None:
    """Rows land in parts, in the order of a number (those without one in the first), and the
    stream that ``run`` starts on the folder is run to its end after each: a batch a part."""
    path = session.new_dir(spark, "landed")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    low, high = rows.agg(F.min(order), F.max(order)).first()
    part = F.lit(0)
    if low is not None:
        part = F.coalesce(F.floor((order - low) * parts / F.lit(high - low + 1)), F.lit(0))
    for i in range(parts):
        rows.where(part == i).write.mode("append").parquet(path)
        run(sc.read_stream(spark, path, schema)).awaitTermination()


def _later(parts: int, least: int) -> str:
    """SQL of the messages that land in the parts from ``least`` on."""
    return f"""late AS (SELECT * FROM located JOIN (
    SELECT doc_id, {inp.MINUTE} AS m, min(m) OVER () AS low, max(m) OVER () AS high FROM documents) USING (doc_id)
  WHERE floor((m - low) * {parts} / (high - low + 1)) >= {least})"""


def message_batches(spark, sf, run: Callable[[DataFrame], StreamingQuery], parts: int = STREAM_PARTS) -> None:
    """Documents as a stream of located messages."""
    def placed(docs: DataFrame) -> StreamingQuery:
        return run(geo.located(geo.with_cell(inp.as_messages(docs))))

    in_batches(spark, inp.table(spark, sf, "documents"), F.expr(inp.MINUTE), placed, parts)


@query(f"WITH {CELL_COUNTS_SQL} SELECT * FROM counts", "messages")
def stream_cell_counts(spark, sf):
    """Counts of each micro-batch, summed by the reader."""
    path, state = session.new_dir(spark, "counts"), session.new_dir(spark, "state")
    message_batches(spark, sf, lambda m: sc.micro_batch_counts(m, path, state, stop=STOP))
    return sc.sum_batches(spark, path)


@query(f"WITH {CELL_COUNTS_SQL} SELECT * FROM counts", "messages")
def compacted_counts(spark, sf):
    """The same, the batches merged two by two as they come, and what is merged removed."""
    path, state = session.new_dir(spark, "counts"), session.new_dir(spark, "state")

    def run(messages):
        sc.compact_counts(spark, path, fanout=2)
        compaction.clean(spark, path, keep=1)
        return sc.micro_batch_counts(messages, path, state, stop=STOP)

    message_batches(spark, sf, run, parts=6)
    return sc.sum_batches(spark, path)


@query(f"WITH {CELL_COUNTS_SQL} SELECT * FROM counts", "messages")
def stream_speed_rows(spark, sf):
    """Speed rows of each micro-batch, read back the way updates are."""
    path, state = session.new_dir(spark, "speed"), session.new_dir(spark, "state")
    message_batches(spark, sf, lambda m: sc.micro_batches(m, path, state, stop=STOP, stamp=inp.as_of(),
                                                          precision=2))
    return layers.updates(sc.read_speed(spark, path))[0]


@query(f"""WITH {_later(3, 1)},
words AS ({words_of('late', stop=STOP)})
SELECT cell_lat, cell_lng, word, count(*) AS cnt FROM words GROUP BY ALL""", "messages")
def speed_retention(spark, sf):
    """Each batch in an hour of its own; the first hour is expired, the others are read."""
    path, state = session.new_dir(spark, "speed"), session.new_dir(spark, "state")

    message_batches(spark, sf, lambda m: sc.micro_batches(m, path, state, stop=STOP, stamp=hour_of_batch,
                                                          precision=2))
    files.expire_buckets(spark, path, "00010112")
    kept = layers.changes_since(sc.read_speed(spark, path), inp.as_of())
    return layers.updates(kept)[0]


def hour_of_batch(batch: int) -> Column:
    return inp.as_of() + F.expr(f"INTERVAL {batch} HOURS")


@query(f"""WITH {_later(5, 2)},
words AS ({words_of('late', stop=STOP)})
SELECT cell_lat, cell_lng, word, count(*) AS cnt FROM words GROUP BY ALL""", "messages")
def compacted_speed(spark, sf):
    """Five batches of speed rows in an hour each, four of them merged; then two hours, which
    lie in the merged run, expire."""
    path, state = session.new_dir(spark, "speed"), session.new_dir(spark, "state")

    def run(messages):
        sc.compact_speed(spark, path, fanout=2)
        return sc.micro_batches(messages, path, state, stop=STOP, stamp=hour_of_batch, precision=2)

    message_batches(spark, sf, run, parts=5)
    compaction.clean(spark, path, keep=1)
    files.expire_buckets(spark, path, "00010113")
    return layers.updates(sc.read_speed(spark, path))[0]


@query(f"""WITH {LOCATED_WORDS} SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour,
  cell_lat, cell_lng, word, count(*) AS cnt FROM words GROUP BY ALL""", "messages")
def stream_hourly_windows(spark, sf):
    path, state = session.new_dir(spark, "hours"), session.new_dir(spark, "state")
    message_batches(spark, sf, lambda m: sc.event_hours(sc.hour_windows(m, stop=STOP), path, state))
    return shown(sc.latest_windows(spark, path), "hour")


# Each fiftieth message lands two weeks late, in the last two of three parts.
LATE_MINUTE = f"{inp.MINUTE} + CASE WHEN doc_id % 50 = 7 THEN 20160 ELSE 0 END"
LATE_SQL = f"""landed AS (
  SELECT *, floor((m - min(m) OVER ()) * 3 / (max(m) OVER () - min(m) OVER () + 1)) AS part
  FROM (SELECT *, {LATE_MINUTE} AS m FROM cells)),
placed AS (SELECT * FROM landed WHERE cell_lat IS NOT NULL),
marks AS (SELECT part + 1 AS part, max(max(ts)) OVER (ORDER BY part) - INTERVAL 1 HOUR AS mark
  FROM placed GROUP BY part),
judged AS (SELECT p.* EXCLUDE (m, part), coalesce(date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark, false) AS late
  FROM placed p LEFT JOIN marks USING (part))"""


def closed(spark, sf) -> str:
    path, state = session.new_dir(spark, "closing"), session.new_dir(spark, "state")
    in_batches(spark, inp.table(spark, sf, "documents"), F.expr(LATE_MINUTE), lambda docs: hr.close_hours(
        geo.located(geo.with_cell(inp.as_messages(docs))), path, state, stop=STOP))
    return path


@query(f"""WITH {LATE_SQL}, timed AS (SELECT * EXCLUDE (late) FROM judged WHERE NOT late
  AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM placed)
  AND strftime(ts, '%y%m%d%H') > '24010205'),
words AS ({words_of('timed', stop=STOP)})
SELECT strftime(ts, '%y%m%d%H') AS yymmddhh, cell_lat, cell_lng, word, count(*) AS cnt FROM words GROUP BY ALL""",
       "messages")
def closed_hours(spark, sf):
    """Hours written once they are behind the watermark, without late messages; old hours
    have expired."""
    path = closed(spark, sf)
    files.expire_buckets(spark, f"{path}/closed", "24010205")
    return hr.read_closed(spark, path)


@query(f"WITH {LATE_SQL} SELECT doc_id, lang FROM judged WHERE late", "messages")
def late_messages(spark, sf):
    return hr.read_late(spark, closed(spark, sf), "doc_id BIGINT, lang STRING")


@query(BOX_SQL, "conferences spread lines")
def stream_routed_messages(spark, sf):
    """Messages near a running event, sent on as JSON and read back."""
    path, state = session.new_dir(spark, "routed"), session.new_dir(spark, "state")
    lines = inp.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    in_batches(spark, lines, F.col("l_orderkey"), lambda rows: routing.route_live(
        inp.as_placed(rows), lambda: inp.spread_conferences(spark, sf), routing.to_files(path), state))
    keys = "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_suppkey BIGINT"
    return spark.read.schema(keys).json(path).drop("batch_id")
