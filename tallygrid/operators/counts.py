"""Word and message tallies.

Tokens are never gathered into lists: they are exploded and counted, so Spark
counts on the map side first and a cell with a third of all rows costs each map
task one row per distinct word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import maps, text as tx
from ..functions.geo import cell_text

CELL = ("cell_lat", "cell_lng")
# Rows a cell's words are spread over in map form, whatever their number.
MAP_PARTS = 16
# Bytes of a map row, and what an entry takes beside its word.
MAP_BYTES, ENTRY_BYTES = 1 << 20, 16


def tokens(df: DataFrame, keep: Sequence[str], text: str = "text",
           drop_http: bool = True) -> DataFrame:
    """One row per word of each text, with the ``keep`` columns."""
    out = (df.select(*keep, F.explode(tx.word_list(F.col(text))).alias("word"))
             .where(F.col("word") != ""))
    return out.where(~F.contains(F.col("word"), F.lit(tx.LINK))) if drop_http else out


def without_words(df: DataFrame, stop: DataFrame | Sequence[str] | None,
                  word: str = "word") -> DataFrame:
    """Drop stop words: a set test for a list, an anti join for a table (whose
    size then decides between broadcast and shuffle)."""
    if stop is None:
        return df
    if isinstance(stop, DataFrame):
        return df.join(stop.select(F.col(stop.columns[0]).alias(word)), word, "left_anti")
    return df.where(~F.col(word).isin(list(stop))) if len(stop) else df


def cell_counts(df: DataFrame, by: Sequence[str] = CELL, text: str = "text",
                stop: DataFrame | Sequence[str] | None = None,
                drop_http: bool = True) -> DataFrame:
    """``(*by, word, cnt)``. A stop table is joined after counting, where each
    word is down to one row per group."""
    words = tokens(df, by, text, drop_http)
    if not isinstance(stop, DataFrame):
        words = without_words(words, stop)
    counted = words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("cnt"))
    return without_words(counted, stop) if isinstance(stop, DataFrame) else counted


def cell_messages(df: DataFrame, by: Sequence[str] = CELL) -> DataFrame:
    """``(*by, tweets)``: messages per group. Reads no text."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("tweets"))


def word_count(df: DataFrame, text: str = "text",
               filler: Sequence[str] = tx.FILLER_WORDS) -> DataFrame:
    """Plain corpus count: cut at single spaces, case kept, filler and marked
    words left out. Filler is tested before the word is trimmed."""
    piece = F.explode(F.split(F.col(text), " ")).alias("piece")
    words = (df.select(piece)
               .where(~F.lower("piece").isin(list(filler)))
               .select(F.btrim("piece", F.lit(tx.BLANKS)).alias("word"))
               .where(~tx.has_mark(F.col("word"))))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def line_word_count(lines: DataFrame, line: str = "value",
                    filler: Sequence[str] = tx.FILLER_WORDS) -> DataFrame:
    """The same over ``lat,lng,text,…`` lines; lines of three fields or fewer
    are left out."""
    fields = F.split(F.col(line), ",")
    texts = lines.where(F.size(fields) > 3).select(fields.getItem(2).alias("text"))
    return word_count(texts, "text", filler)


def most_frequent(counts: DataFrame) -> DataFrame:
    """The largest ``(cnt, word)``."""
    return counts.agg(F.max(F.struct("cnt", "word")).alias("m")).select("m.cnt", "m.word")


def merge_maps(df: DataFrame, by: Sequence[str], map_col: str) -> DataFrame:
    """Sum word maps, or lists of word and count, of the same group:
    ``(*by, word, cnt)``."""
    if isinstance(df.schema[map_col].dataType, T.MapType):
        pairs = df.select(*by, F.explode(map_col).alias("word", "n"))
    else:
        pairs = df.select(*by, F.inline(map_col).alias("word", "n"))
    return pairs.groupBy(*by, "word").agg(F.sum("n").alias("cnt"))


def split_measure(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Part merged maps into words ``(*by, word, cnt)`` and messages
    ``(*by, tweets)``, the latter being what the reserved key counts."""
    marker = F.col("word") == maps.MESSAGES_KEY
    return (df.where(~marker),
            df.where(marker).select(*by, F.col("cnt").alias("tweets")))


def marked_counts(counts: DataFrame, messages: DataFrame, by: Sequence[str] = CELL) -> DataFrame:
    """Long form of both tallies ``(*by, word, cnt)``, the message count under its
    reserved key."""
    return counts.select(*by, "word", "cnt").unionByName(
        messages.select(*by, F.lit(maps.MESSAGES_KEY).alias("word"), F.col("tweets").alias("cnt")))


def cell_tallies(df: DataFrame, by: Sequence[str] = CELL, text: str = "text",
                 stop: Sequence[str] = ()) -> DataFrame:
    """The same from the messages in one pass: a message counts as one more item beside
    its words. No word is like the reserved key, which is in upper case."""
    words = F.filter(tx.word_list(F.col(text)), lambda w: (w != "") & ~F.contains(w, F.lit(tx.LINK)))
    if len(stop):
        words = F.filter(words, lambda w: ~w.isin(list(stop)))
    items = F.concat(F.array(F.lit(maps.MESSAGES_KEY)), F.coalesce(words, F.array().cast("array<string>")))
    return (df.select(*by, F.explode(items).alias("word"))
            .groupBy(*by, "word").agg(F.count(F.lit(1)).alias("cnt")))


def counts_to_maps(marked: DataFrame, by: Sequence[str] = CELL, parts: int = MAP_PARTS,
                   most_bytes: int = MAP_BYTES) -> DataFrame:
    """Map form ``(*by, part, data)`` of marked counts, in rows of a bounded size whose maps do
    not overlap; readers sum them (``merge_maps``).

    A group is dealt by the word's hash to ``parts`` tasks at most. There a running sum of
    bytes over the words in order cuts it where the sum passes a multiple of ``most_bytes``:
    a map has ``most_bytes`` and one word more at most, however many words a group has. The
    sums and the maps need the one shuffle that dealt the words out.
    """
    dealt = marked.select(*by, F.pmod(F.xxhash64("word"), F.lit(parts)).alias("_deal"), "word", "cnt")
    size = F.octet_length("word") + ENTRY_BYTES
    before = Window.partitionBy(*by, "_deal").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    cut = F.floor(F.coalesce(F.sum(size).over(before), F.lit(0)) / F.lit(most_bytes))
    pairs = F.sort_array(F.collect_list(F.struct("word", "cnt")))
    return (dealt.withColumn("_cut", cut).groupBy(*by, "_deal", "_cut")
            .agg(F.map_from_entries(pairs).alias("data"))
            .select(*by, (F.col("_cut") * parts + F.col("_deal")).alias("part"), "data"))


def batch_rows(map_counts: DataFrame, bucket: str, as_of: Column,
               precision: int = 2) -> DataFrame:
    """``(yymmddhh, location, key, data, timestamp)``. The key is the map's text,
    as it identifies equal content."""
    return map_counts.select(
        F.col(bucket).alias("yymmddhh"),
        cell_text(F.col("cell_lat"), F.col("cell_lng"), precision).alias("location"),
        maps.map_to_text(F.col("data")).alias("key"),
        "data",
        as_of.alias("timestamp"),
    )


def speed_rows(map_counts: DataFrame, bucket: str, as_of: Column,
               precision: int = 3) -> DataFrame:
    """``(yymmddhh, timestamp, lat, lng, data)`` with the map as text."""
    scale = F.lit(float(10 ** precision))
    return map_counts.select(
        F.col(bucket).alias("yymmddhh"),
        as_of.alias("timestamp"),
        (F.col("cell_lat") / scale).alias("lat"),
        (F.col("cell_lng") / scale).alias("lng"),
        maps.map_to_text(F.col("data")).alias("data"),
    )
