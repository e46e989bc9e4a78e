import math

import pytest
from pyspark.sql import functions as F

from tallygrid.functions import geo, maps, predicates as pr, text as tx, times as tm
from tallygrid.operators import counts as ct, messages as ms


def one(spark, value, column, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(column(F.col("x")).alias("y")).first()["y"]


def words(spark, text, **kw):
    df = spark.createDataFrame([(text,)], "text string")
    return [r["word"] for r in ct.tokens(df, [], **kw).collect()]


def test_tokens(spark):
    assert words(spark, "Hello,\tW-orld  #x ") == ["hello", "world", "x"]
    assert words(spark, " a") == ["a"]
    assert words(spark, "") == []
    assert words(spark, "see http://t.co/x") == ["see"]
    assert words(spark, "see http://t.co/x", drop_http=False) == ["see", "httptcox"]
    assert words(spark, "Ça_va été\nno-one") == ["ava", "t", "noone"]


def test_stop_words_take_token_form(spark):
    stop = tx.stop_words(["isn't", "it"])
    assert stop == ["isnt", "it"]
    df = spark.createDataFrame([("Isn't it so",)], "text string")
    assert [r.word for r in ct.without_words(ct.tokens(df, []), stop).collect()] == ["so"]
    table = spark.createDataFrame([(w,) for w in stop], "stop string")
    by_list = ct.cell_counts(df, [], stop=stop).collect()
    assert by_list == ct.cell_counts(df, [], stop=table).collect()
    assert {"the", "isnt"} <= set(tx.default_stop_words())


def test_clean_text(spark):
    assert one(spark, "  Hi, @you!\n a\tb ", tx.clean_text) == "Hi @you a b"
    assert one(spark, "id 12.5-x", tx.digits_only) == "12.5"


@pytest.mark.parametrize("pattern,value,hit", [
    ("s*f", "soft", True), ("s*f", "sf", False), ("s*f", "SAFE", True), ("", "x", True),
    ("a.b", "axb", False), ("a.b", "A.B", True), ("x", None, False), ("", None, True),
    ("[^]", "a[^]b", True), ("*", "1", False)])
def test_match_text(spark, pattern, value, hit):
    assert one(spark, value, lambda c: tx.match_text(c, pattern)) is hit


@pytest.mark.parametrize("text,hit", [
    (">5", False), ("<5", False), ("9>>2", True), ("2<<9", True), ("5", True), ("", True),
    ("<", True), (">", True), (">=5", True), ("<=4", False), ("5>>2", False), (None, True)])
def test_match_number(spark, text, hit):
    assert one(spark, 5, lambda c: pr.match_number(c, text), "int") is hit


@pytest.mark.parametrize("text", ["abc", ">x", "1>>", "=5"])
def test_match_number_rejects(text):
    with pytest.raises(ValueError):
        pr.match_number(F.lit(1), text)


@pytest.mark.parametrize("line,cell", [
    ("12.5,-3.25,hi", (1250, -325)), ("12,-3.25,hi", None), ("\x07,1.5,hi", None),
    ("1.5,2.5", None), ("abc.5,1.5,hi", None), ("1.2.3,1.5,hi", None),
    (".5,-.25,hi,more", (50, -25)), ("", None)])
def test_locate_lines(spark, line, cell):
    df = spark.createDataFrame([(line,)], "value string")
    r = ms.locate_lines(df).first()
    assert (None if r.cell_lat is None else (r.cell_lat, r.cell_lng)) == cell


@pytest.mark.parametrize("value", [0.125, -0.001, 2.675, -81.805, 24.555, 1e-9])
def test_cell_is_plain_arithmetic(spark, value):
    want = math.floor(value * 100.0 + 0.5)
    assert one(spark, value, geo.cell_index, "double") == want


def test_cells_need_both_coordinates(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (1.0, float("nan")), (1.0, 2.0)],
                               "lat double, lng double")
    got = [(r.cell_lat, r.cell_lng) for r in geo.with_cell(df).collect()]
    assert got == [(None, None)] * 3 + [(100, 200)]


def test_coarsen_and_text(spark):
    df = spark.createDataFrame([(37774, -80240), (37775, -80245)],
                               "cell_lat bigint, cell_lng bigint")
    got = [(r.cell_lat, r.cell_lng) for r in geo.coarsen(df).collect()]
    assert got == [(3777, -8024), (3778, -8024)]
    text = df.select(geo.cell_text(F.lit(2456), F.lit(-8180)).alias("t"),
                     geo.cell_text(F.lit(None), F.lit(None)).alias("u")).first()
    assert tuple(text) == ("24.56,-81.80", "0.00,0.00")
    at = df.select(geo.split_cell(F.lit("24.56,-81.80")).alias("s")).first()["s"]
    assert (at.lat, at.lng) == (24.56, -81.8)


def test_boxes(spark):
    sf, ny = geo.REGIONS["sf"], geo.REGIONS["ny"]
    pts = spark.createDataFrame([(40.0, -74.0), (36.8, -122.75), (36.79, -122.0), (0.0, 0.0)],
                                "lat double, lng double")
    got = pts.select(geo.in_box(F.col("lat"), F.col("lng"), ny),
                     geo.in_any_box(F.col("lat"), F.col("lng"), [sf, ny])).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, True), (False, False), (False, False)]
    box = pts.select(geo.box_text(F.lit(37.0), F.lit(-122.0)).alias("b")).first()["b"]
    assert box == "-122.05,36.95,-121.95,37.05"


def test_geo_in_range(spark):
    rows = [(1.0, 20.0, "ces", "best", 100), (1.0, 20.0, "ces", "great", 94),
            (1.0, 20.0, "ces2", "magnificent", 40), (1.0, 20.0, "ces2", "amazing", 9),
            (20.0, 1.0, "sec", "super", 11), (20.0, 1.0, "sec", "bad", 34),
            (2.0, 20.0, "gac", "awesome", 56)]
    df = spark.createDataFrame(rows, "lat double, lng double, conference string, "
                                     "word string, count bigint")
    assert geo.geo_in_range(df, [1, 0, 2], 5, 10).count() == 0
    assert geo.geo_in_range(df, [1, 0, 2], 5, 25).count() == 5


def test_times(spark):
    ts = F.lit("2015-02-04 21:05:09").cast("timestamp")
    r = spark.range(1).select(
        tm.hour_bucket(ts), tm.day_bucket(ts), tm.path_day(ts), tm.display_date(ts),
        tm.display_time(ts), tm.plain(tm.to_local(ts, "America/New_York")),
        tm.plain(tm.to_utc(ts, "America/New_York")),
        tm.plain(tm.from_epoch_ms(F.lit("1423051659018"))),
        tm.plain(tm.parse_iso(F.lit("2015-01-29T21:05:00Z"))),
        tm.parse_iso(F.lit("nonsense"))).first()
    assert tuple(r) == ("15020421", "150204", "020415", "Wed, Feb 04", "9:05 PM",
                        "2015-02-04 16:05:09", "2015-02-05 02:05:09", "2015-02-04 12:07:39",
                        "2015-01-29 21:05:00", None)


def test_maps(spark):
    df = spark.sql("SELECT map('b', 2L, 'a', 1L) AS m")
    assert df.select(maps.map_to_text(F.col("m")).alias("t")).first()["t"] == "a,1:b,2"
    pairs = lambda text: [tuple(p) for p in one(spark, text, maps.text_to_pairs)]
    assert pairs("a,1:b,2:a,3") == [("a", 1), ("b", 2), ("a", 3)]
    assert pairs("") == [] and pairs("a,x:,1") == []


def test_falsy_to_null(spark):
    df = spark.createDataFrame([(0, "", False, 5, 0.0)],
                               "a int, b string, c boolean, d int, e double")
    got = pr.falsy_to_null(df, df.columns).first()
    assert tuple(got) == (None, None, None, 5, None)
    kept = pr.falsy_to_null(df, ["b"]).first()
    assert tuple(kept) == (0, None, False, 5, 0.0)
    filled = pr.fill_defaults(pr.falsy_to_null(df, ["b"]), {"b": "N/A"}).first()
    assert filled.b == "N/A"
