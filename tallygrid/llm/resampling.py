"""Target-distribution importance resampling over hashed word n-grams.

A feature is a run of consecutive words, hashed to a bucket by the CRC-32 of its UTF-8
bytes. A document's weight adds up, over its features, how much commoner their buckets are in the
target than in the corpus; documents are drawn by weight plus Gumbel noise that depends on
the id alone, so a repeated run draws the same rows.

Prefix-CRC substrings: a document is brought to words parted by one space and scanned once;
the running CRC before and after each word is kept. The CRC of any n-gram follows from the
two prefixes at its ends: CRC(B) = CRC(AB) xor shift(CRC(A), |B|), where the shift by |B| zero
bytes is linear over GF(2) and is put together from shifts by powers of two. So the
n-grams of all lengths cost a look-up each, not a scan each.

Tasks count buckets, so a counting task sends at most ``buckets`` rows; the gains, one whole
number a bucket, go to every task. All else is per row, but for the order of the scores,
which is numbered by ranges.

Defined cases: a NULL text has no words, hence no features and weight 0; words are lower-cased in
A-Z only; a NULL id is the empty text in the noise and comes last among ties; repeated rows
count and are drawn each for itself; an empty corpus gives an empty result and an empty target gains
that follow from zero counts; columns beyond the id and the text are not read, whatever
they are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.operators.ids import ordered_ids

from .common import staged

BUCKETS = 10_000
# Bytes of a text cut into words at a time, and of a batch of texts.
CHUNK = 1 << 22
BLANK = 0x20

_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
# A-Z to a-z, other word bytes as they are, all else to a blank.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEEP else BLANK for b in range(256))


def _byte_table() -> np.ndarray:
    """The CRC-32 of one zero byte after a register that holds 0..255."""
    at = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        at = np.where(at & 1, (at >> 1) ^ np.uint32(0xEDB88320), at >> 1)
    return at


TABLE = _byte_table()


def _applied(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255]
            ^ tables[3][crc >> 24])


def _shifts(count: int) -> list[np.ndarray]:
    """Tables (byte of the register, its value) of the shift by 1, 2, 4, … zero bytes."""
    values = np.arange(256, dtype=np.uint32)
    one = np.stack([TABLE] + [values << np.uint32(8 * k - 8) for k in range(1, 4)])
    out = [one]
    while len(out) < count:
        out.append(np.stack([_applied(out[-1], row) for row in out[-1]]))
    return out


SHIFTS = _shifts(40)


def shifted(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Registers moved past ``size`` zero bytes each."""
    out = crc.copy()
    for bit in range(int(size.max(initial=0)).bit_length()):
        where = np.flatnonzero(size >> bit & 1)
        out[where] = _applied(SHIFTS[bit], out[where])
    return out


def prefix_crcs(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word of a text: the CRC of all before it (with the blank), the CRC up to its
    end, and where it starts and ends in the normalised text."""
    normal, crc, ends, sizes, at = text.translate(NORMAL), None, [], [], 0
    while at < len(normal):
        stop = normal.find(b" ", at + CHUNK)
        stop = len(normal) if stop < 0 else stop
        words = normal[at:stop].split()
        at = stop
        if not words:
            continue
        sizes.append(np.fromiter(map(len, words), np.int64, len(words)))
        run = accumulate(words, lambda before, word: crc32(word, crc32(b" ", before)),
                         initial=crc) if crc is not None else _first(words)
        found = np.fromiter(run, np.uint32)
        ends.append(found if crc is None else found[1:])
        crc = int(found[-1])
    if not ends:
        none = np.empty(0, np.int64)
        return none.astype(np.uint32), none.astype(np.uint32), none, none
    after, size = np.concatenate(ends), np.concatenate(sizes)
    before = np.zeros_like(after)
    # the blank's step is done on the register itself, the inverse of the CRC
    before[1:] = ~(TABLE[(~after[:-1] ^ BLANK) & 255] ^ (~after[:-1] >> 8))
    end = np.cumsum(size) + np.arange(len(size))
    return before, after, end - size, end


def _first(words: list[bytes]):
    return accumulate(words[1:], lambda before, word: crc32(word, crc32(b" ", before)),
                      initial=crc32(words[0]))


def ngram_crcs(text: bytes, longest: int) -> np.ndarray:
    """The CRC-32 of every run of 1 to ``longest`` words, from pairs of prefixes."""
    before, after, start, end = prefix_crcs(text)
    out = []
    for n in range(1, min(longest, len(after)) + 1):
        last = slice(n - 1, None)
        first = slice(0, len(after) - n + 1)
        out.append(after[last] ^ shifted(before[first], end[last] - start[first]))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    values = batch.column(column).cast(pa.large_binary())
    for i in range(len(values)):
        yield values[i].as_py() or b""


def bucket_counts(df: DataFrame, text_col: str = "text", longest: int = 1,
                  buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)`` of all features of all rows."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in _texts(batch, 0):
                total += np.bincount(ngram_crcs(text, longest) % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": used, "n": total[used]})

    rows = df.select(F.col(text_col).cast("string")).mapInArrow(counted, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln of the smoothed share in the target over that in the corpus) per bucket.
    Both counts have at most ``buckets`` rows."""
    def held(counts: DataFrame) -> list[int]:
        out = [0] * buckets
        for bucket, n in counts.collect():
            out[bucket] = n
        return out

    s, t = held(corpus), held(target)
    all_s, all_t = sum(s) + buckets, sum(t) + buckets
    return np.array([math.floor(scale * math.log(float((b + 1) * all_s) / float((a + 1) * all_t)))
                     for a, b in zip(s, t)], np.int64)


def weighed(df: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
            longest: int = 1) -> DataFrame:
    """``(id, n_features, n_words, weight)`` per row."""
    buckets = len(gain)
    kind = df.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, words, weights = [], [], []
            for text in _texts(batch, 1):
                crcs = ngram_crcs(text, longest)
                features.append(len(crcs))
                words.append(_words(len(crcs), longest))
                weights.append(int(gain[crcs % buckets].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v, pa.int64()) for v in (features, words, weights)]],
                names=["id", "n_features", "n_words", "weight"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string"))
    return rows.mapInArrow(weigh, f"id {kind}, n_features long, n_words long, weight long")


def _words(features: int, longest: int) -> int:
    """How many words have so many runs of 1 to ``longest`` words."""
    full = longest * (longest - 1) // 2
    if features >= longest * (longest + 1) // 2:
        return (features + full) // longest
    return round((math.isqrt(8 * features + 1) - 1) / 2)


def noise(id_col: str, seed: int, scale: int = 1000) -> Column:
    """floor(scale * Gumbel noise) from the first 32 bits of sha256(seed:id)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((bits + 0.5) / F.lit(4294967296.0))))


def resampled(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              target_text: str = "text", *, longest: int = 1, buckets: int = BUCKETS, seed: int = 2024,
              percent: int = 10, least_words: int = 20, part_rows: int = 1_000_000) -> DataFrame:
    """One row per row of ``df``: ``id``, ``n_features``, ``weight``, ``score`` and ``rank``: 1, 2, … for
    the drawn ones, ``percent`` of those with ``least_words`` words, by score, then id."""
    gain = gains(bucket_counts(df, text_col, longest, buckets),
                 bucket_counts(target, target_text, longest, buckets), buckets)
    rows = staged(weighed(df, gain, id_col, text_col, longest)
                  .withColumn("score", F.col("weight") + noise("id", seed)))
    able = rows.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    ranked = ordered_ids(able, "rank", [F.desc("score"), F.asc_nulls_last("id")], recompute=True,
                         part_rows=part_rows)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("id", "n_features", "weight", "score", "rank")
