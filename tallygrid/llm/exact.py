"""Exact deduplication by skew-safe combining.

Equal texts are found in three stages, each of which compares whole texts:

1. every map task groups its own rows by (digest, salt, text);
2. the salted groups of a digest are merged, a hot text in ``salts`` places at once;
3. the winners of the salts, at most ``salts`` a text, are combined.

All three are Spark's grouped aggregation over (digest, ..., text): the digest deals the
rows out, the grouping itself compares texts byte by byte, so texts whose digests collide
stay apart. Nothing is collected per group: a stage keeps one row (largest id, count).

The classes are then looked up per document by digest and a second hash, not by text; if
two classes should agree in both, the lookup compares texts as well.

Defined cases: a NULL text is the empty text; equality is that of the texts after A-Z are
lowered, nothing else; ties and repeated rows count each time; a NULL id loses to any
other id, and a class with only NULL ids keeps NULL; input columns called like the added
ones are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, replace_columns, staged, text_of, unused

SALTS = 8


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def text_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                 salts: int = SALTS, digest: Callable[[Column], Column] = sha256,
                 second: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per distinct text: digest, variant, text, keep_id (largest id), group_size."""
    rows = df.select(F.col(id_col).alias("id"), ascii_lower(text_of(text_col)).alias("text"))
    salted = (rows.withColumn("digest", digest(F.col("text")))
              .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
              .groupBy("digest", "salt", "text")
              .agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("n")))
    return (salted.groupBy("digest", "text")
            .agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))
            .withColumn("variant", second(F.col("text"))))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                salts: int = SALTS, digest: Callable[[Column], Column] = sha256,
                second: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Every row of ``df`` with keep_id, group_size, kept and text_sha256 (of the lowered
    text, lower-case hex). ``kept`` marks the rows whose id is the class's largest; a row
    repeated with its id is marked each time (``survivors`` keeps one of them)."""
    classes, ambiguous = _classes(df, id_col, text_col, salts, digest, second)
    d, v, t, x, k, n = unused(df, "_digest", "_variant", "_text", "_sha", "_keep", "_size")
    lowered = ascii_lower(text_of(text_col))
    rows = df.withColumns({d: digest(lowered), v: second(lowered), x: F.sha2(lowered, 256)})
    if ambiguous:
        rows = rows.withColumn(t, lowered)
    found = rows.join(classes.select(*_named(d, v, t)[:2 + ambiguous],
                                     F.col("keep_id").alias(k), F.col("group_size").alias(n)),
                      [d, v, t][:2 + ambiguous])
    return found.select(*replace_columns(df, {
        "keep_id": F.col(k), "group_size": F.col(n),
        "kept": F.col(id_col).eqNullSafe(F.col(k)), "text_sha256": F.col(x)}))


def survivors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
              salts: int = SALTS, digest: Callable[[Column], Column] = sha256,
              second: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One whole row of ``df`` per distinct text: that with the largest id.

    The id is part of the join key, so the copies of a hot text are spread over all
    tasks. Of a row repeated with its id one stays, any if they differ elsewhere.
    """
    classes, ambiguous = _classes(df, id_col, text_col, salts, digest, second)
    d, v, t, k = unused(df, "_digest", "_variant", "_text", "_keep")
    lowered = ascii_lower(text_of(text_col))
    rows = df.withColumns({d: digest(lowered), v: second(lowered)})
    if ambiguous:
        rows = rows.withColumn(t, lowered)
    wanted = classes.select(*_named(d, v, t)[:2 + ambiguous], F.col("keep_id").alias(k))
    same = [rows[c].eqNullSafe(wanted[c]) if c == t else rows[c] == wanted[c]
            for c in [d, v, t][:2 + ambiguous]]
    on = rows[id_col].eqNullSafe(wanted[k])
    for one in same:
        on = on & one
    kept = rows.join(wanted, on, "left_semi")
    return kept.dropDuplicates([d, v, id_col, *([t] if ambiguous else [])]).select(
        *[f"`{c}`" for c in df.columns])


def _named(d: str, v: str, t: str) -> list[Column]:
    return [F.col("digest").alias(d), F.col("variant").alias(v), F.col("text").alias(t)]


def _classes(df, id_col, text_col, salts, digest, second) -> tuple[DataFrame, bool]:
    """The classes, staged without their texts, unless two agree in digest and variant."""
    whole = text_classes(df, id_col, text_col, salts=salts, digest=digest, second=second)
    short = staged(whole.drop("text"))
    twice = short.groupBy("digest", "variant").count().where("count > 1")
    return (whole, True) if twice.take(1) else (short, False)
