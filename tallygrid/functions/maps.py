"""Word maps and their text form ``"word,count:word,count"``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
PAIR = ","
ENTRY = ":"
MESSAGES_KEY = "OVERALL_CNT"
# -----------------------------------------------------------------------------


def map_to_text(m: Column) -> Column:
    """Entries in word order, so equal maps give equal text."""
    entries = F.sort_array(F.map_entries(m))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit(PAIR), e["value"])), ENTRY)


def text_to_pairs(text: Column) -> Column:
    """Words and counts of a map's text, in its order. A word may come twice; what has no
    word or no count is left out, so an empty text has no pairs."""
    entries = F.transform(F.split(text, ENTRY), lambda e: F.struct(
        F.substring_index(e, PAIR, 1).alias("word"),
        F.element_at(F.split(e, PAIR), -1).try_cast("bigint").alias("n")))
    return F.filter(entries, lambda p: (p["word"] != "") & p["n"].isNotNull())
