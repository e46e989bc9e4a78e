import datetime as dt
import json

from pyspark.sql import functions as F

from tallygrid import schemas
from tallygrid.operators import conferences as cf, counts as ct, messages as ms, photos as ph
from tallygrid.operators import ranking as rk

def as_of():
    return F.lit("2015-02-04 12:00:00").cast("timestamp")



def at(text):
    return dt.datetime.fromisoformat(text)


def message(**over):
    base = {"id": 5, "id_str": "5", "text": "Hi there", "retweet_count": 0, "retweeted": False,
            "timestamp_ms": "1423051659018", "entities": {
                "user_mentions": [{"screen_name": "a!b"}, {"screen_name": "@c"}], "hashtags": []},
            "geo": {"coordinates": [24.561, -81.799]},
            "place": {"full_name": "Key West", "country_code": "US"},
            "user": {"id": 9, "name": "N", "lang": "en", "followers_count": 3}}
    return json.dumps({**base, **over})


def parsed(spark, *values):
    return ms.parse_messages(spark.createDataFrame([(v,) for v in values], "value string"))


def test_control_notices_are_left_out(spark):
    got = parsed(spark, message(), '{"delete": {"status": {"id": 1}}}', message(id=0), "{bad")
    assert sorted(r.id for r in got.collect()) == [0, 5]


def test_flat_message(spark):
    flat = ms.flatten_messages(parsed(spark, message()))
    assert flat.columns == list(ms.FLAT_MESSAGE) and len(flat.columns) == 36
    r = flat.first()
    assert (r["id"], r["text"], r["created_at"]) == (5, "Hi there", "2015-02-04 12:07:39")
    assert (r["retweet_count"], r["retweeted"], r["hashtags"]) == (None, None, None)
    assert (r["user_mentions"], r["lat"], r["lng"]) == ("ab @c", 24.561, -81.799)
    assert (r["user-id"], r["user-lang"], r["followers_count"]) == (9, "en", 3)
    assert ms.flatten_messages(parsed(spark, '{"id": 1}')).first()["user-id"] is None


def test_message_geo(spark):
    df = parsed(spark, message(), message(geo=None), message(geo={"coordinates": [1.0]}))
    got = [(r.cell_lat, r.cell_lng) for r in ms.message_geo(df, 3).collect()]
    assert got == [(24561, -81799), (None, None), (None, None)]


def test_escaped_line_end_is_no_letter(spark):
    df = ms.message_geo(parsed(spark, message(text="lol\nok")), 3)
    assert sorted(r.word for r in ct.cell_counts(df).collect()) == ["lol", "ok"]


def test_to_topic(spark):
    df = spark.createDataFrame([(1, "x")], "id int, t string")
    assert json.loads(ms.to_topic(df).first()["value"]) == {"id": 1, "t": "x"}
    assert ms.to_topic(df, "id").first()["key"] == "1"


EVENT = {"id": "7", "url": "u", "name": {"text": " Big show "}, "format": {"name_localized": "Expo"},
         "start": {"utc": "2015-02-05T10:00:00Z"}, "end": {"utc": "2015-02-05T12:00:00Z"},
         "created": "2015-01-01T00:00:00Z", "changed": "2015-01-02T00:00:00Z", "capacity": 0,
         "online_event": False, "venue_id": None, "status": "live",
         "organizer": {"name": "O", "num_past_events": 0}, "category": {"name_localized": "Tech"}}


def pages(spark, **by_keyword):
    data = [(k, json.dumps({"pagination": {"object_count": len(e), "page_count": 1}, "events": e}))
            for k, e in by_keyword.items()]
    return spark.createDataFrame(data, "keyword string, value string")


def test_flatten_and_archive(spark):
    venue = {"name": "Hall", "latitude": "37.5", "longitude": "-122.1",
             "address": {"city": "SF", "country": "US"}}
    found = cf.page_events(pages(spark, art=[EVENT], music=[{**EVENT, "id": "8", "venue": venue,
                                                              "capacity": 9}], solar=[]))
    flat = {r.eb_id: r for r in cf.flatten_events(found, as_of()).collect()}
    assert sorted(flat) == ["7", "8"] and len(flat["7"]) == 17
    assert (flat["7"].event_name, flat["7"].latitude, flat["7"].capacity) == ("Big show", None, None)
    assert (flat["7"].venue_id, flat["7"].online_event, flat["7"].category) == (-1, None, "art")
    assert (flat["8"].latitude, flat["8"].longitude, flat["8"].capacity) == (37.5, -122.1, 9)
    assert flat["8"].start_time_utc == at("2015-02-05 10:00:00")
    kept = cf.archive_events(found)
    assert len(kept.columns) == 33
    r = {x.id: x for x in kept.collect()}
    assert (r["7"].capacity, r["7"].category, r["7"].search_keyword) == ("-1", "Tech", "art")
    assert (r["8"].venue_city, r["8"].organizer_num_past_events) == ("SF", None)
    window = cf.starting_between(found, F.lit("2015-02-04").cast("date"))
    assert window.count() == 2
    assert cf.starting_between(found, F.lit("2015-02-03").cast("date")).count() == 0


def events(spark, *extra):
    data = [("1", "One", 24.561, -81.799, at("2015-02-04 10:00:00"), at("2015-02-04 13:00:00")),
            ("1", "One", 24.561, -81.799, at("2015-02-04 10:00:00"), at("2015-02-04 13:00:00")),
            ("old", "Old", 24.56, -81.8, at("2015-01-01 10:00:00"), at("2015-01-28 12:00:00")),
            ("half", "Half", 24.56, None, at("2015-02-04 10:00:00"), at("2015-02-05 12:00:00")),
            ("far", "Far", 1.0, 1.0, at("2015-02-06 10:00:00"), at("2015-02-07 12:00:00")), *extra]
    return spark.createDataFrame(
        [(i, n, "T", None, s, e, 10, None, la, ln, "art", at("2015-02-01 00:00:00"))
         for i, n, la, ln, s, e in data],
        "eb_id string, event_name string, event_type string, logo_url string, "
        "start_time_utc timestamp, end_time_utc timestamp, capacity int, venue_name string, "
        "latitude double, longitude double, category string, created_at timestamp")


def tallies(spark):
    words = spark.createDataFrame([(2456, -8180, "b", 2), (2456, -8180, "a", 2), (5, 5, "z", 9)],
                                  "cell_lat long, cell_lng long, word string, cnt long")
    tweets = spark.createDataFrame([(2456, -8180, 3), (5, 5, 9)],
                                   "cell_lat long, cell_lng long, tweets long")
    return words, tweets


def test_conference_stats(spark):
    stats = cf.conference_stats(events(spark), *tallies(spark), as_of(), start_id=4)
    assert sorted(stats.columns) == sorted(
        c.split()[0] for c in schemas.CONFERENCE_STATS.split(", "))
    (r,) = stats.collect()
    assert (r.tid, r.eb_id, r.tweets, r.word1, r.word2, r.word3, r.count1) == (
        5, "1", 3, "a", "b", None, 2)


def test_list_and_detail(spark, rows):
    stats = cf.conference_stats(events(spark), *tallies(spark), as_of())
    listed = {r.eb_id: r for r in cf.event_list(events(spark), stats, as_of(), "America/New_York").collect()}
    assert sorted(listed) == ["1", "far"]
    assert (listed["1"].tweets, listed["1"].venue_name, listed["far"].tweets) == (3, " ", 0)
    assert listed["1"].start_time == "2015-02-04 05:00:00"
    detail = cf.event_detail(events(spark), stats, "1", as_of())
    assert detail.count() == 1
    assert rows(cf.detail_words(detail), "rk", "word", "cnt") == [(1, "a", 2), (2, "b", 2)]


def test_dashboard(spark):
    def board(*spans):
        df = spark.createDataFrame([(at(s), at(e), 5, 7) for s, e in spans],
                                   "start_time_utc timestamp, end_time_utc timestamp, "
                                   "tweets int, capacity int")
        return tuple(cf.dashboard(df, as_of()).first())

    assert board(("2015-02-03 10:00:00", "2015-02-03 11:00:00"),
                 ("2015-02-05 10:00:00", "2015-02-05 11:00:00"),
                 ("2015-02-04 12:00:00", "2015-02-04 14:00:00")) == (1, 1, 1, 1, 5, 7)
    # Over the end of a month the whole date counts.
    assert board(("2015-01-31 10:00:00", "2015-01-31 11:00:00")) == (1, 0, 0, 0, 0, 0)


def test_photos(spark, rows):
    words = ph.event_words(events(spark), tallies(spark)[0], as_of())
    assert rows(words) == [("a",), ("b",)]
    index = spark.createDataFrame([("a", "u1"), ("a", "u2"), ("a", "u2"), ("z", "u3")],
                                  "word string, url string")
    found = ph.keyword_photos(words, index, as_of(), start_id=7)
    assert rows(found, "yymmddhh", "word", "url") == [("15020412", "a", "u1"), ("15020412", "a", "u2")]
    assert sorted(r.pid for r in found.collect()) == [8, 9]
    assert rows(ph.photos_for(words, index.distinct(), 1)) != []
    shown = ph.shown_photos(index.distinct()).orderBy("word", "url").collect()
    assert [r.colors for r in shown] == list(rk.LABELS[1:4])


def test_photo_xml(spark, rows):
    xml = ('<rsp><photos><photo id="1" farm="2" server="3" secret="ab"/>'
           '<photo id="2" farm="2" server="3" secret="cd"/></photos></rsp>')
    df = spark.createDataFrame([("w", xml), ("v", "<rsp><photos/></rsp>")], "word string, xml string")
    assert rows(ph.photos_from_xml(df, ["word"])) == [
        ("w", "https://farm2.staticflickr.com/3/1_ab_n.jpg"),
        ("w", "https://farm2.staticflickr.com/3/2_cd_n.jpg")]
