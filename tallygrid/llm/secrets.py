"""Secrets in texts: patterns, and character Markov models for what no pattern names.

Everything is a DataFrame expression. Texts are scanned by regular expressions once; a pattern's
matches and the pieces between them (``regexp_extract_all`` and ``split`` see the same matches)
give every match its place by running sums of lengths, in windows over one text's matches.

Besides the patterns' spans a scan finds candidates: runs of identifier characters that meet no
such span. Two first-order character models are trained from labelled samples, one of random
strings and one of ordinary identifiers. A candidate with a digit and a letter whose
log-likelihood ratio reaches ``threshold`` is a secret too. Equal samples are brought to one before
their characters are counted, and the two models meet in one table of 69 x 69 ratios, the only
thing that is carried to all tasks.

Defined cases: a NULL text is empty; offsets count code points, ends are exclusive; matches of a
kind do not overlap, those of different kinds may; every row is returned, repeated rows each for
itself; an empty table gives an empty result, and models without samples are what smoothing
alone gives; only the id and the text are read, so other columns may have any names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, text_of

# ---------------------------------------------------------------- fixed values
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_VALUE = 12
KINDS = ("assign", "access", "hex", "random")
# -----------------------------------------------------------------------------
RANDOM = KINDS.index("random")
# What may be an identifier; from how many characters it is judged, not only learned from.
CANDIDATE = r"[A-Za-z0-9+/_=-]{12,}"
LEAST_JUDGED = 16
# Nats by which the random model must win: the odds before are put at a million to one against.
THRESHOLD = math.log(1e6)
# Place 0 is the start of a string.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"
WIDE = len(ALPHABET) + 1
# Pairs that the single characters' shares count for, in a context.
PRIOR = 4.0


def _matches(kind: int, text: Column, pattern: str, group: int, maybe: Column) -> Column:
    """Every match of a pattern: (kind, number, characters since the one before, characters, the
    group's text); looked for where ``maybe`` holds."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("token"))
    sized = F.transform(found, lambda m, at: F.struct(
        F.lit(kind).alias("kind"), at.alias("at"), F.length(m["gap"]).alias("gap"),
        F.length(m["whole"]).alias("size"), m["token"].alias("token")))
    # behind the last piece there is no match
    return F.when(maybe, F.filter(sized, lambda m: m["size"].isNotNull())).otherwise(
        F.array().cast("array<struct<kind:int,at:int,gap:int,size:int,token:string>>"))


def scanned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, id, kind, start, stop, token)`` of every span and candidate (kind ``RANDOM``); a row
    without any comes once, with a NULL kind."""
    text = F.col("text")
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                     text_of(text_col).alias("text"))
    rows = rows.select("row", "id", F.explode_outer(F.concat(
        _matches(0, text, ASSIGN, 2, text.rlike("[:=]")),
        _matches(1, text, ACCESS, 0, text.contains("AKIA")),
        _matches(2, text, HEX, 0, text.rlike(HEX)),
        _matches(RANDOM, text, CANDIDATE, 0, text.rlike(CANDIDATE)))).alias("m")).select("row", "id", "m.*")
    line = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.repartition("row").withColumn("stop", F.sum(F.col("gap") + F.col("size")).over(line))
    rows = rows.withColumn("start", F.col("stop") - F.col("size"))
    named = (F.col("kind") < RANDOM) & ((F.col("kind") > 0) | (F.length("token") >= LEAST_VALUE))
    text_order = Window.partitionBy("row").orderBy("start")
    reach = F.max(F.when(named, F.col("stop"))).over(text_order.rangeBetween(Window.unboundedPreceding, 0))
    next_start = F.min(F.when(named, F.col("start"))).over(text_order.rangeBetween(0, Window.unboundedFollowing))
    apart = (F.coalesce(reach <= F.col("start"), F.lit(True))
             & F.coalesce(next_start >= F.col("stop"), F.lit(True)))
    kept = F.when(named, F.col("kind")).when((F.col("kind") == RANDOM) & apart, F.col("kind"))
    return rows.select("row", "id", kept.alias("kind"), "start", "stop", "token")


def labelled(found: DataFrame) -> DataFrame:
    """Samples ``(token, secret)`` that a scan gives: keys and digests are random, candidates are
    ordinary. Assigned values are neither: people choose some of them."""
    return found.where("kind > 0").select("token", (F.col("kind") < RANDOM).alias("secret"))


def random_strings(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Samples that are random by construction, 43 characters from each id's digest."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    drawn = F.base64(F.unhex(F.sha2(F.concat(F.lit("random:"), text), 256)))
    return df.select(F.rtrim(drawn, F.lit("=")).alias("token"), F.lit(True).alias("secret"))


def _codes(token: Column) -> Column:
    """The places of a token's characters in the alphabet; others are left out."""
    return F.filter(F.transform(_letters(token), _code), lambda code: code > 0)


def _letters(token: Column) -> Column:
    return F.filter(F.split(token, ""), lambda c: c != "")


def _code(letter: Column) -> Column:
    return F.instr(F.lit(ALPHABET), letter)


def trained(samples: DataFrame) -> list[float]:
    """The log-likelihood ratio (random over ordinary) of each pair of characters, at
    ``before * WIDE + after``, from samples ``(token, secret)``. A pair counts once a distinct
    string, so neither copies nor one long string make a model. Among the ordinary ones it counts
    once less: a string that is judged is among them itself, and must not vouch for itself."""
    spark: SparkSession = samples.sparkSession
    tokens = samples.select("token", "secret").distinct()
    pairs = tokens.select("secret", F.explode(F.array_distinct(F.zip_with(
        F.concat(F.array(F.lit(0)), _codes(F.col("token"))), _codes(F.col("token")),
        lambda before, after: before * WIDE + after))).alias("pair")).where("pair IS NOT NULL")
    counts = pairs.groupBy("secret", "pair").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("n", F.when(F.col("secret"), F.col("n")).otherwise(F.col("n") - 1))
    grid = spark.range(2 * WIDE * WIDE).select((F.col("id") >= WIDE * WIDE).alias("secret"),
                                               (F.col("id") % (WIDE * WIDE)).cast("int").alias("pair"))
    cells = (grid.join(counts, ["secret", "pair"], "left").fillna(0, ["n"])
             .withColumns({"before": F.floor(F.col("pair") / WIDE), "after": F.col("pair") % WIDE}))
    of_label = F.sum("n").over(Window.partitionBy("secret"))
    single = (F.sum("n").over(Window.partitionBy("secret", "after")) + 1) / (of_label + len(ALPHABET))
    context = F.sum("n").over(Window.partitionBy("secret", "before"))
    chance = F.log((F.col("n") + PRIOR * single) / (context + PRIOR))
    ratios = cells.withColumn("chance", chance).groupBy("pair").agg(
        F.sum(F.when(F.col("secret"), F.col("chance")).otherwise(-F.col("chance"))).alias("ratio"))
    return [r["ratio"] for r in ratios.orderBy("pair").collect()]


def ratio(token: Column, ratios: list[float]) -> Column:
    """The log-likelihood ratio of a token, in nats."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    start = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))
    return F.aggregate(_letters(token), start, lambda acc, c: F.struct(
        _code(c).alias("before"), (acc["sum"] + F.get(table, acc["before"] * WIDE + _code(c))).alias("sum")),
        lambda acc: acc["sum"])


def is_secret(token: Column, ratios: list[float], threshold: float = THRESHOLD) -> Column:
    """Whether a candidate is long enough, mixed, and likelier random than ordinary."""
    mixed = token.rlike("[0-9]") & token.rlike("[A-Za-z]") & (F.length(token) >= LEAST_JUDGED)
    return F.when(mixed, ratio(token, ratios) >= threshold).otherwise(False)


def spans(found: DataFrame, ratios: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """``(id, spans)`` per row: an array of (start, kind, stop) in order, the patterns' spans and the
    candidates that are secrets; ``kind`` is a place in ``KINDS``."""
    kept = (F.col("kind") < RANDOM) | (F.col("kind") == RANDOM) & is_secret(F.col("token"), ratios, threshold)
    rows = found.select("row", "id", F.when(kept, F.struct("start", "kind", "stop")).alias("span"))
    return rows.groupBy("row").agg(F.first("id").alias("id"),
                                   F.sort_array(F.collect_list("span")).alias("spans")).drop("row")


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD, samples: DataFrame | None = None) -> DataFrame:
    """Scan, train and judge: ``(id, spans)`` per row. ``samples`` (token, secret) take the place of
    those that the scan and the ids give; of the latter, ordinary ones that a first training judges
    secret change sides for a second."""
    found = staged(scanned(df, id_col, text_col))
    if samples is not None:
        return spans(found, trained(samples), threshold)
    samples = labelled(found).unionByName(random_strings(df, id_col))
    first = is_secret(F.col("token"), trained(samples), threshold)
    return spans(found, trained(samples.select("token", (F.col("secret") | first).alias("secret"))), threshold)


def span_text(of: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(of, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def counted(of: Column, kind: str) -> Column:
    return F.size(F.filter(of, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
