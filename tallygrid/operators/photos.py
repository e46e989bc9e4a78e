"""Photos found for words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.geo import with_cell
from ..functions.predicates import has_position, recent
from ..functions.times import hour_bucket
from .counts import CELL
from .ids import dense_ids
from .ranking import cycle_label, sample_rows
from .skew import lookup_join

# ---------------------------------------------------------------- fixed values
PHOTOS_SHOWN = 200
# -----------------------------------------------------------------------------


def photo_url(farm: Column, server: Column, photo: Column, secret: Column) -> Column:
    return F.concat(F.lit("https://farm"), farm, F.lit(".staticflickr.com/"), server,
                    F.lit("/"), photo, F.lit("_"), secret, F.lit("_n.jpg"))


def photos_from_xml(df: DataFrame, keep: list[str], xml_col: str = "xml") -> DataFrame:
    """Photo-search answers to ``(*keep, url)``, one row per photo."""
    parsed = F.from_xml(F.col(xml_col), schemas.PHOTO_XML)
    rows = df.select(*keep, F.explode(parsed["photos"]["photo"]).alias("p"))
    url = photo_url(*[F.col("p")[a] for a in ("_farm", "_server", "_id", "_secret")])
    return rows.select(*keep, url.alias("url"))


def event_words(events: DataFrame, counts: DataFrame, as_of: Column) -> DataFrame:
    """Distinct words said in the cell of a recent event. Cells are made distinct
    first: the words of a cell are read once however many events it hosts. Counts
    hold a word once per cell, so even a busy cell is only its vocabulary."""
    cells = with_cell(events.where(recent(as_of) & has_position()),
                      "latitude", "longitude").select(*CELL).distinct()
    return counts.join(cells, list(CELL), "left_semi").select("word").distinct()


def found_photos(words: DataFrame, index: DataFrame) -> DataFrame:
    """``(word, url)``: every photo of every distinct word, each word looked up
    once."""
    wanted = words.select("word").where(F.col("word") != "").distinct()
    return lookup_join(index.select("word", "url").distinct(), wanted, ["word"], "left_semi")


def keyword_photos(words: DataFrame, index: DataFrame, as_of: Column,
                   start_id: Column | int = 0) -> DataFrame:
    """``(pid, yymmddhh, word, url)`` of the photos found."""
    return (dense_ids(found_photos(words, index), "pid", ["word", "url"], start_id)
            .select("pid", hour_bucket(as_of).alias("yymmddhh"), "word", "url"))


def photos_for(words: DataFrame, photos: DataFrame, n: int = PHOTOS_SHOWN,
               seed: str = "0") -> DataFrame:
    """A repeatable sample of ``n`` photos of any of the words."""
    return sample_rows(found_photos(words, photos), F.concat_ws(" ", "word", "url"), n, seed)


def shown_photos(photos: DataFrame) -> DataFrame:
    """Photos with their colour label, in word order."""
    return cycle_label(photos, [F.asc("word"), F.asc("url")])
