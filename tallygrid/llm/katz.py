"""A Katz backoff bigram model: counted, normalised, stored and evaluated as Spark jobs.

Tokens are the words between white space, A-Z lowered, and one end token a text. With c a
count in the training texts, N all tokens, h the token before (a start mark for the first):

    P(w | h) = g(h) d(c(h,w)) c(h,w) / c(h)    if the bigram is kept
             = a(h) P(w)                       otherwise
    P(w)     = d(c(w)) c(w) / N,   P(unknown) = what that leaves

d are Good-Turing discounts for counts up to ``K`` (absolute discounts where the counts of
counts give none). ``min_count`` says which bigrams are kept: all of them for 1; those seen
fewer times have no probability of their own, and their mass is part of what h leaves. g is 1, but for
histories that would leave less than 1 / (c(h) + 1). a(h) is exact: what h leaves over one
minus the unigram mass of the words kept after h.

The recursion is additive in logarithms. A text's score is, over its tokens, the sum of
log P(w) and log a(h), and for each kept bigram the sum of
    k(h,w) = log P(w | h) - log a(h) - log P(w).
So the model is a table (key, score, base, known) whose keys are hashes of words and of
bigrams, stored in ``parts`` files by the keys' leading bits; evaluation adds up the
entries of a text's tokens.

Scale. Counts are combined within map tasks, and travel packed: bigrams by a hash of the
pair for the most frequent words (``HOT_WORDS`` at most, whose counts are broadcast) and by
the second word otherwise, so that no task gets all bigrams of a frequent word and each knows
its words' counts; then by the first word, and by a hash of the pair where that is one of the
most frequent, whose sums are added up and broadcast; last, scored, by their keys. In evaluation the most frequent entries (``HOT_KEYS`` at most) and a bit
map of ``2 ** BITMAP`` bits, which tells most keys the table does not hold, are broadcast;
all other look-ups go, packed, to the task that reads the key's file, and the sums for a
chunk of documents come back packed: one row for each chunk and partition it asked.

Words are known by 48-bit hashes, bigrams by 64-bit ones.

Defined cases: a NULL or empty text has the end token only; a NULL id is held out or not
like the empty id; rows that repeat id and text are scored each; without training texts
every token is unknown, P(unknown) = 1 and the base score is that of N = V = 0; an empty
table gives an empty result. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (drop_staged, folder_uri, freed, new_file, open_file, slices, small_batches, staged,
                     text_of)
from .wordhash import mixed, space_words

K, MIN_COUNT = 5, 2
HOT_WORDS, HOT_KEYS, BITMAP = 65_536, 393_216, 27
PART_PAIRS, PART_KEYS = 2_000_000, 2_000_000
CHUNK_PAIRS = 2_000_000
END, START = 0, 1  # word ids no word gets
STEP, WORD_KEY = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x632BE59BD9B4E019)
CHUNK_ROWS, CUT_ROWS = 1000, 200


# -- tokens, keys, packing ----------------------------------------------------

def tokens(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """(token before, token, tokens per text) over a batch, as word ids. Hashing takes some numbers
    of eight bytes for each byte of text, so some texts are cut at a time."""
    parts = [_tokens(texts.slice(i, CUT_ROWS)) for i in range(0, max(1, len(texts)), CUT_ROWS)]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words, n = space_words(texts)
    words = np.maximum(words >> np.uint64(16), np.uint64(2))
    ends = np.cumsum(n)
    return np.insert(words, ends - n, np.uint64(START)), np.insert(words, ends, np.uint64(END)), n + 1


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(mixed(before) * STEP + word)


def word_keys(word: np.ndarray) -> np.ndarray:
    return mixed(word + WORD_KEY)


def planes(values: np.ndarray) -> bytes:
    """The bytes of whole numbers, all first bytes first: what is alike lies together."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def from_planes(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def narrow(values: np.ndarray) -> bytes:
    """The planes of whole numbers from 0, without the highest bytes that none has."""
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def widened(raw: bytes, size: int, kind: str) -> np.ndarray:
    out = np.zeros((size, 8), np.uint8)
    if raw:
        width = len(raw) // size
        out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, size).T
    return out.view(kind).ravel()


def _concatenated(held: list) -> list[np.ndarray]:
    """The columns of ``held`` (lists of columns) one after the other; ``held`` is emptied, so that
    no more than a column is there twice."""
    out = []
    for i in range(len(held[0])):
        out.append(np.concatenate([x[i] for x in held]))
        for x in held:
            x[i] = None
    held.clear()
    return out


def _ordered(columns: list[np.ndarray], order: np.ndarray) -> list[np.ndarray]:
    """The columns in another order, each given up as it is copied."""
    for i in range(len(columns)):
        columns[i] = columns[i][order]
    return columns


def _groups(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(value, where it is) of an array in order."""
    begin = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
    for b, e in zip(begin, [*begin[1:], len(part)]):
        yield int(part[b]), slice(int(b), int(e))


class Lookup:
    """Columns by key, found by binary search."""

    def __init__(self, keys: np.ndarray, *columns: np.ndarray):
        order = np.argsort(keys)
        self.keys = keys[order]
        self.columns = [c[order] for c in columns]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether found, place)."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, at


def _numbers(df: DataFrame, *names: str) -> list[np.ndarray]:
    """Columns of a frame of bounded size, on the driver."""
    table = df.select(*names).toArrow()
    return [table.column(n).to_numpy() for n in names]


def _most_frequent(df: DataFrame, most: int) -> DataFrame:
    """The rows with the highest counts ``c``, ``most`` at most; whole counts only."""
    top = F.least("c", F.lit(1_000_000))
    steps = sorted(df.groupBy(top.alias("c")).count().collect(), key=lambda r: -r["c"])
    total, least = 0, None
    for r in steps:
        total += r["count"]
        if total > most:
            break
        least = r["c"]
    return df.where(F.lit(False) if least is None else F.col("c") >= least)


# -- counts -------------------------------------------------------------------

def unigrams(train: DataFrame) -> DataFrame:
    """(w, c) over all training texts, the start mark not among them."""

    def count(batches):
        for batch in slices(batches, CHUNK_ROWS):
            w, c = np.unique(tokens(batch.column("text"))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(c)], ["w", "c"])

    return train.select("text").mapInArrow(freed(count), "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


FOUND = ("kind int, h binary, ch binary, n binary, w binary, c binary, cw binary, "
         "key long, v array<double>")
ROW_PAIRS = 100_000


def bigrams(train: DataFrame, hot: Lookup, heavy: np.ndarray, n: int, p, least: int = 1) -> DataFrame:
    """All bigrams, packed by history and stored, in rows of kind 0: histories ``h``, their counts ``ch``
    and numbers ``n`` of bigrams seen ``least`` times or more, and of these the words ``w``,
    counts ``c`` and counts of words ``cw``. A history is whole in one row, but for the
    ``heavy`` ones; of these rows of kind 2 have, by part, the count, the numbers of bigrams
    kept seen 1 to ``K`` times, the counts above, and the unigram mass. Rows of kind 1 have
    the numbers of all bigrams seen r = ``key`` times, and for r = 0 of those kept."""
    parts = max(1, -(-n // PART_PAIRS))

    def blocks(part, h, *columns):
        """One row a part; within it the histories are in order."""
        order = np.lexsort((h, part))
        part, h, *columns = _ordered([part, h, *columns], order)
        out = [(q, planes(np.diff(h[at], prepend=np.uint64(0))), *(narrow(c[at]) for c in columns))
               for q, at in _groups(part)]
        return pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int32())]
            + [pa.array([o[i] for o in out], pa.binary()) for i in range(1, len(columns) + 2)],
            ["part", *("h", "w", "c", "cw")[:len(columns) + 1]])

    def unpacked(batches, names, kinds):
        held = []
        for batch in batches:
            for r in zip(*(batch.column(x).to_pylist() for x in names)):
                held.append([np.cumsum(from_planes(r[0], "<u8"), dtype=np.uint64),
                             *(widened(x, len(r[0]) // 8, k) for x, k in zip(r[1:], kinds))])
        return _concatenated(held) if held else None

    def pack(batches):
        held, size = [], 0

        def flush():
            whole = _concatenated(held)
            h, w = _ordered(whole, np.lexsort((whole[1], whole[0])))
            whole.clear()
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])]))
            c = np.diff(np.append(new, len(h)))
            h, w = h[new], w[new]
            salted = np.where(hot.find(w)[0], pair_keys(h, w), mixed(w))
            return blocks((salted % np.uint64(parts)).astype(np.int64), h, w, c)

        for batch in slices(batches, CHUNK_ROWS):
            h, w, _ = tokens(batch.column("text"))
            held.append([h, w])
            size += len(h)
            if size >= CHUNK_PAIRS:
                yield flush()
                size = 0
        if size:
            yield flush()

    def merge(batches):
        whole = unpacked(batches, "hwc", ("<u8", "<i8"))
        if not whole:
            return
        h, w, c = _ordered(whole, np.lexsort((whole[0], whole[1])))
        whole.clear()
        new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])]))
        h, w, c = h[new], w[new], np.add.reduceat(c, new)
        known, at = hot.find(w)  # other words have all their bigrams here
        first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        here = np.repeat(np.add.reduceat(c, first), np.diff(np.append(first, len(w))))
        cw = np.where(known, hot.columns[0][at], here) if len(hot.keys) else here
        salted = np.where(np.isin(h, heavy), pair_keys(h, w), mixed(h))
        yield blocks((salted % np.uint64(parts)).astype(np.int64), h, w, c, cw)

    schema = pa.schema([("kind", pa.int32()), *[(x, pa.binary()) for x in ("h", "ch", "n", "w", "c", "cw")],
                        ("key", pa.int64()), ("v", pa.list_(pa.float64()))])

    def rows(size, **columns):
        return pa.RecordBatch.from_arrays(
            [columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)

    def numbers(kind, keys, columns):
        width, flat = len(columns), np.stack(columns, 1).astype(np.float64).ravel()
        values = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * width, pa.int32()), pa.array(flat))
        return rows(len(keys), kind=pa.array(np.full(len(keys), kind, np.int32)),
                    key=pa.array(np.asarray(keys).astype(np.int64)), v=values)

    def gather(batches):
        whole = unpacked(batches, ("h", "w", "c", "cw"), ("<u8", "<i8", "<i8"))
        if not whole:
            return
        h, w, c, cw = _ordered(whole, np.lexsort((whole[1], whole[0])))
        whole.clear()
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        kept = c >= least
        seen = np.bincount(np.minimum(c, K + 2), minlength=K + 3)[:K + 2]
        seen[0] = kept.sum()
        none = np.zeros(K + 2)
        yield numbers(1, np.arange(K + 2), [seen] + [none] * (K + 2))
        history, ch = h[first], np.add.reduceat(c, first)
        size = np.add.reduceat(kept.astype(np.int64), first)
        many = np.isin(history, heavy)
        if many.any():
            of = lambda x: np.add.reduceat(np.where(kept, x, 0), first)[many]
            yield numbers(2, history[many], [ch[many], *(of(c == r) for r in range(1, K + 1)),
                                             of(np.where(c > K, c, 0)), of(p(cw))])
        if not kept.all():
            w, c, cw = w[kept], c[kept], cw[kept]
        edge = np.concatenate([[0], np.cumsum(size)])
        for _, at in _groups(first // ROW_PAIRS):
            own = slice(int(edge[at.start]), int(edge[at.stop]))
            yield rows(1, kind=pa.array([0], pa.int32()),
                       h=pa.array([planes(np.diff(history[at], prepend=np.uint64(0)))], pa.binary()),
                       **{name: pa.array([narrow(x)], pa.binary()) for name, x in (
                           ("ch", ch[at]), ("n", size[at]), ("w", w[own]), ("c", c[own]), ("cw", cw[own]))})

    packed = train.select("text").mapInArrow(freed(pack), "part int, h binary, w binary, c binary")
    # stored, so that the first shuffle's files are gone before the second one's are written
    merged = staged(packed.repartitionById(parts, F.col("part")).select("h", "w", "c")
                    .mapInArrow(freed(merge), "part int, h binary, w binary, c binary, cw binary"))
    found = staged(merged.repartitionById(parts, F.col("part")).select("h", "w", "c", "cw")
                   .mapInArrow(freed(gather), FOUND))
    drop_staged(merged)
    return found


def discounts(seen: dict[int, int], k: int = K) -> list[float]:
    """d for counts 1 to ``k`` from numbers of n-grams seen r times: Good-Turing, scaled so
    that counts above ``k`` need none; absolute discounts where that gives none in (0, 1)."""
    n = [seen.get(r, 0) for r in range(k + 2)]
    if all(n[1:]):
        spill = (k + 1) * n[k + 1] / n[1]
        found = [((r + 1) * n[r + 1] / (r * n[r]) - spill) / (1 - spill) if spill < 1 else 0
                 for r in range(1, k + 1)]
        if all(0 < d < 1 for d in found):
            return found
    part = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return [(r - part) / r for r in range(1, k + 1)]


def _discounted(count: np.ndarray, d: list[float]) -> np.ndarray:
    less = np.concatenate([[0.0], np.arange(1, K + 1) * d])
    return np.where(count <= K, less[np.minimum(count, K)], count.astype(np.float64))


def _left(own, p, ch) -> tuple[np.ndarray, np.ndarray]:
    """(g, a) of histories seen ``ch`` times, from the sums of discounted counts and of
    unigram probabilities over the bigrams kept."""
    share, most = own / ch, ch / (ch + 1)
    g = np.minimum(1.0, np.divide(most, share, out=np.ones(len(share)), where=share > 0))
    return g, (1 - np.minimum(share, most)) / (1 - p)


# -- the model ----------------------------------------------------------------

class Model:
    """A trained model: its stored table and the numbers evaluation needs."""

    def __init__(self, table: DataFrame, parts_bits: int, n: int, v: int, unknown: float,
                 start: float, bitmap: np.ndarray, hot: Lookup):
        self.table, self.parts_bits, self.n, self.v = table, parts_bits, n, v
        self.unknown, self.start, self.bitmap, self.hot = unknown, start, bitmap, hot


def fit(df: DataFrame, text_col: str = "text", *, min_count: int = MIN_COUNT,
        hot_words: int = HOT_WORDS, hot_keys: int = HOT_KEYS, bitmap: int = BITMAP) -> Model:
    """The model of the texts of ``df``."""
    spark = df.sparkSession
    small_batches(spark)  # texts, and rows that hold up to 100,000 pairs
    train = df.select(text_of(text_col).alias("text"))
    counts = staged(unigrams(train))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    if not n:
        none = np.zeros(0)
        return Model(None, 0, 0, 0, 0.0, 0.0, np.zeros(1 << max(0, bitmap - 3), np.uint8),
                     Lookup(none.astype(np.uint64), none, none, none))
    seen = {r["c"]: r["count"] for r in counts.where(F.col("c") <= K + 1).groupBy("c").count().collect()}
    d1 = discounts(seen)
    left = sum((1 - d) * r * seen.get(r, 0) for r, d in enumerate(d1, 1)) / n
    unknown, scale = (left, 1.0) if left > 0 else (1 / (n + 1), n / (n + 1))
    p = lambda c: _discounted(c, d1) * (scale / n)

    hot_w, hot_c = _numbers(_most_frequent(counts, hot_words), "w", "c")
    hot = Lookup(hot_w.view(np.uint64), hot_c)
    texts = counts.where(F.col("w") == END).first()["c"]
    heavy = hot.keys[(hot.columns[0] > PART_PAIRS // 20) & (hot.keys != np.uint64(END))]
    heavy = np.append(heavy, np.uint64(START))
    found = bigrams(train, hot, heavy, n, p, min_count)
    sums = {1: {}, 2: {}}
    for r in (found.where("kind > 0").groupBy("kind", "key")
              .agg(*[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(K + 3)]).collect()):
        sums[r["kind"]][r["key"]] = r[2:]
    d2 = discounts({r: int(v[0]) for r, v in sums[1].items() if r})
    v2 = np.array([sums[2][int(h)] for h in heavy])
    heavy_own = v2[:, 1:K + 1] @ (np.arange(1, K + 1) * d2) + v2[:, K + 1]
    heavy_g, heavy_a = _left(heavy_own, v2[:, K + 2], v2[:, 0])
    start = math.log10(heavy_a[-1])
    fixed = Lookup(heavy, heavy_g, heavy_a, v2[:, 0])

    entries = v + int(sums[1][0][0])
    bits = min(bitmap, max(0, math.ceil(math.log2(max(1, entries / PART_KEYS)))))
    of_word = lambda c, a: np.log10(p(c)) + np.log10(a) - math.log10(unknown)

    def score(batches):
        held, size = [], 0
        for batch in slices(batches, 4):
            for r in zip(*(batch.column(x).to_pylist() for x in ("h", "ch", "n", "w", "c", "cw"))):
                h = np.cumsum(from_planes(r[0], "<u8"), dtype=np.uint64)
                ch, n = (widened(x, len(h), "<i8") for x in r[1:3])
                w, c, cw = (widened(x, int(n.sum()), k) for x, k in zip(r[3:], ("<u8", "<i8", "<i8")))
                own, mass = _discounted(c, d2), p(cw)
                place = np.repeat(np.arange(len(h)), n)
                g, a = _left(*(np.bincount(place, x, minlength=len(h)) for x in (own, mass)), ch)
                known, at = fixed.find(h)
                g, a, ch = (np.where(known, x[at], y) for x, y in zip(fixed.columns, (g, a, ch)))
                of = (np.log10(g / ch) - np.log10(a))[place]
                held.append([pair_keys(h[place], w), of + np.log10(own) - np.log10(mass), c,
                             np.zeros(len(c), np.uint8)])
                word = ~known
                ch = ch[word].astype(np.int64)
                held.append([word_keys(h[word]), of_word(ch, a[word]), ch, np.ones(len(ch), np.uint8)])
                size += len(c) + len(h)
                if size >= CHUNK_PAIRS // 4:
                    yield _blocks(held, bits)
                    size = 0
        if size:
            yield _blocks(held, bits)

    last = np.append(heavy[:-1], np.uint64(END))  # words whose histories are in many rows, or none
    count = np.append(v2[:-1, 0], texts).astype(np.int64)
    words = _blocks([[word_keys(last), of_word(count, np.append(heavy_a[:-1], 1.0)), count,
                      np.ones(len(last), np.uint8)]], bits)
    keyed = found.where("kind = 0").select("h", "ch", "n", "w", "c", "cw").mapInArrow(freed(score), BLOCKS).union(
        spark.createDataFrame([tuple(r.values()) for r in words.to_pylist()], BLOCKS))
    table = staged(_stored(keyed, bits, bitmap, folder_uri(spark, "katz")))
    drop_staged(found, counts)
    slices_ = table.where("bits IS NOT NULL").select("part", "bits").toArrow().to_pylist()
    joined = np.frombuffer(b"".join(r["bits"] for r in sorted(slices_, key=lambda r: r["part"])), np.uint8)
    if len(joined) != 1 << max(0, bitmap - 3):  # a part without any key
        whole = {r["part"]: r["bits"] for r in slices_}
        size = (1 << max(0, bitmap - 3)) >> bits
        joined = np.frombuffer(b"".join(whole.get(i, bytes(size)) for i in range(1 << bits)), np.uint8)
    top = _most_frequent(table.where("bits IS NULL AND c IS NOT NULL").select(
        F.col("hot_key").alias("key"), "c", "score", "base", "known"), hot_keys)
    key, score, base, known = _numbers(top, "key", "score", "base", "known")
    return Model(table.where("file IS NOT NULL").select("part", "file"), bits, n, v,
                 math.log10(unknown), start, joined, Lookup(key.view(np.uint64), score, base, known))


BLOCKS = "part int, keys binary, scores binary, counts binary, knowns binary"
# Scores are kept as whole multiples of this, in 48 bits.
UNIT, MIDDLE = 2.0 ** -40, 1 << 47


def _packed(keys, scores, counts, knowns) -> tuple[bytes, ...]:
    """Entries in the order of their keys."""
    whole = (np.rint(scores / UNIT).astype(np.int64) + MIDDLE).astype(np.uint64)
    return planes(np.diff(keys, prepend=np.uint64(0))), narrow(whole), narrow(counts), knowns.tobytes()


def _unpacked(keys: bytes, scores: bytes, counts: bytes, knowns: bytes) -> tuple[np.ndarray, ...]:
    return (np.cumsum(from_planes(keys, "<u8"), dtype=np.uint64),
            (widened(scores, len(knowns), "<i8") - MIDDLE) * UNIT, widened(counts, len(knowns), "<i8"),
            np.frombuffer(knowns, np.uint8))


def _entries(file: str) -> Iterator[list[np.ndarray]]:
    """The columns (key, score, base, known) of a stored partition, some entries at a time."""
    with open_file(file) as source, pq.ParquetFile(source) as packed:
        for batch in packed.iter_batches(batch_size=1):
            keys, scores, counts, knowns = _unpacked(*(c[0].as_py() for c in batch.columns))
            yield [keys, scores, _base(counts, knowns), knowns]


def _blocks(held: list, bits: int) -> pa.RecordBatch:
    """Entries (key, score, c, known), a row for each part."""
    columns = _concatenated(held)
    columns = _ordered(columns, np.argsort(columns[0]))
    out = [(part, *_packed(*(c[at] for c in columns))) for part, at in _groups(_part(columns[0], bits))]
    return pa.RecordBatch.from_arrays(
        [pa.array([o[0] for o in out], pa.int32())]
        + [pa.array([o[i] for o in out], pa.binary()) for i in range(1, 5)],
        ["part", "keys", "scores", "counts", "knowns"])


def _part(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(63) >> np.uint64(1) if not bits else keys >> np.uint64(64 - bits)).astype(np.int32)


STORED = "part int, file string, bits binary, hot_key long, c long, score double, base double, known int"
ENTRIES = pa.schema([(c, pa.binary()) for c in ("keys", "scores", "counts", "knowns")])
# Entries this frequent may be among the hot ones, and are also kept as plain rows.
HOT_COUNT = 8


def _base(c: np.ndarray, known: np.ndarray) -> np.ndarray:
    return np.where(known > 0, np.log10((c + 0.1) / 0.1), 0.0)


def _stored(keyed: DataFrame, bits: int, bitmap: int, folder: str) -> DataFrame:
    """The table's partitions: the file of packed entries in ``folder``, their slice of the bit map,
    and the entries seen ``HOT_COUNT`` times as rows."""
    schema = pa.schema([
        ("part", pa.int32()), ("file", pa.string()), ("bits", pa.binary()), ("hot_key", pa.int64()), ("c", pa.int64()), ("score", pa.float64()), ("base", pa.float64()),
        ("known", pa.int32())])

    def rows(n, **columns):
        return pa.RecordBatch.from_arrays(
            [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def store(batches):
        here, part, held = np.zeros((1 << bitmap) >> bits, bool), None, []
        for batch in slices(batches, 64):
            for r in batch.to_pylist():
                part = r["part"]
                held.append(list(_unpacked(r["keys"], r["scores"], r["counts"], r["knowns"])))
        if part is None:
            return
        columns = _concatenated(held)
        columns = _ordered(columns, np.argsort(columns[0]))
        here[((columns[0] << np.uint64(bits)) >> np.uint64(64 - bitmap + bits)).astype(np.int64)] = True
        with new_file(folder, ".parquet") as (file, out), pq.ParquetWriter(out, ENTRIES, compression="zstd") as to:
            for start in range(0, len(columns[0]), 200_000):
                packed = _packed(*(c[start:start + 200_000] for c in columns))
                to.write_batch(pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed], schema=ENTRIES))
        yield rows(1, part=pa.array([part], pa.int32()), file=pa.array([file]))
        for start in range(0, len(columns[0]), 200_000):
            own = [c[start:start + 200_000] for c in columns]
            hot = own[2] >= HOT_COUNT
            if hot.any():
                key, score, c, known = (x[hot] for x in own)
                yield rows(len(key), part=pa.array(np.full(len(key), part, np.int32)),
                           hot_key=pa.array(key.view(np.int64)), c=pa.array(c), score=pa.array(score),
                           base=pa.array(_base(c, known)), known=pa.array(known.astype(np.int32)))
        yield rows(1, part=pa.array([part], pa.int32()),
                   bits=pa.array([np.packbits(here, bitorder="little").tobytes()], pa.binary()))

    return keyed.repartitionById(1 << bits, F.col("part")).mapInArrow(freed(store), STORED)


# -- evaluation ---------------------------------------------------------------

REQUESTS = "part int, kind int, a binary, b binary, c binary"
PARTIAL = "chunk long, kind int, names binary, docs binary, sums binary"
SUMS = "id long, n_tokens long, n_known long, base_score double, score double"


def evaluate(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row's whole text."""
    spark = df.sparkSession
    small_batches(spark)
    text = text_of(text_col)
    rows = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"),
                     F.xxhash64(text).alias("tie"))
    shared = spark.sparkContext.broadcast((model.hot, model.bitmap))
    bits, bitmap, unknown, start = model.parts_bits, len(model.bitmap) * 8, model.unknown, model.start
    shift = np.uint64(64 - (bitmap.bit_length() - 1))
    zero = math.log10(0.1 / (model.n + 0.1 * (model.v + 1)))
    schema = pa.schema([("part", pa.int32()), ("kind", pa.int32()), *[(c, pa.binary()) for c in "abc"]])

    def ask(batches):
        hot, bitmap = shared.value
        for number, batch in enumerate(slices(batches, CHUNK_ROWS)):
            before, word, n = tokens(batch.column("text"))
            doc = np.repeat(np.arange(len(n)), n)
            sums = np.stack([n * unknown + start, n * zero, np.zeros(len(n))])
            out = []
            keys, docs = [], []
            for found in (word_keys(word), pair_keys(before, word)):
                at = (found >> shift).astype(np.int64)
                maybe = np.flatnonzero(bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                found, own = found[maybe], doc[maybe]
                known, place = hot.find(found)
                for i, column in enumerate(hot.columns):
                    if known.any():
                        sums[i] += np.bincount(own[known], column[place[known]], minlength=len(n))
                keys.append(found[~known])
                docs.append(own[~known])
            keys, docs = np.concatenate(keys), np.concatenate(docs).astype(np.uint16)
            order = np.lexsort((docs, keys))
            keys, docs = keys[order], docs[order]
            ids = batch.column("id")
            names = [np.array([i or 0 for i in ids.to_pylist()], np.int64).tobytes(),
                     np.array([not i.is_valid for i in ids], np.uint8).tobytes(),
                     batch.column("tie").to_numpy().tobytes()]
            whole = b"".join(names)
            chunk = hashlib.blake2b(whole, digest_size=8).digest()
            for part, at in _groups(_part(keys, bits)):
                out.append((part, 1, chunk, planes(np.diff(keys[at], prepend=np.uint64(0))), planes(docs[at])))
            own_part = int(mixed(np.array([number], np.uint64) + batch.column("tie")[0].as_py() % 2 ** 32)[0]
                           % np.uint64(1 << bits))
            out.append((own_part, 2, whole, n.astype(np.int64).tobytes(), sums.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], f.type) for i, f in enumerate(schema)], schema=schema)

    asked = rows.mapInArrow(freed(ask), REQUESTS)
    if model.table is not None:
        asked = asked.union(model.table.select(
            "part", F.lit(0).alias("kind"), F.col("file").cast("binary").alias("a"),
            F.lit(None).cast("binary").alias("b"), F.lit(None).cast("binary").alias("c")))

    def answer(batches):
        held, table = [], None
        for batch in slices(batches, 64):
            out = []
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    held += _entries(r["a"].decode())
                    continue
                if table is None:
                    held.append([np.zeros(0, kind) for kind in ("<u8", "<f8", "<f8", "u1")])
                    table = Lookup(*_concatenated(held))
                chunk = r["a"] if r["kind"] == 1 else hashlib.blake2b(r["a"], digest_size=8).digest()
                chunk = int.from_bytes(chunk, "little", signed=True)
                if r["kind"] == 2:
                    out.append((chunk, 2, r["a"], r["b"], r["c"]))
                    continue
                keys = np.cumsum(from_planes(r["b"], "<u8"), dtype=np.uint64)
                own = from_planes(r["c"], "<u2").astype(np.int64)
                known, place = table.find(keys)
                docs, own = np.unique(own[known], return_inverse=True)
                sums = np.stack([np.bincount(own, c[place[known]], minlength=len(docs)) for c in table.columns])
                out.append((chunk, 1, None, docs.astype(np.uint16).tobytes(), sums.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(
                    (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                    ["chunk", "kind", "names", "docs", "sums"])

    def total(batches):
        """The parts of a chunk's sums follow each other, its documents' names first. A
        chunk whose rows come again, alike, has the sums of both, and is given twice."""
        now, size, times = None, 0, 0

        def rows():
            ids = np.frombuffer(names, "<i8", size)
            null = np.frombuffer(names, np.uint8, size, 8 * size).astype(bool)
            whole = pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=null), pa.array(n // times), pa.array(np.rint(sums[2] / times).astype(np.int64)),
                 pa.array(sums[1] / times), pa.array(sums[0] / times)],
                ["id", "n_tokens", "n_known", "base_score", "score"])
            return [whole] * times

        for batch in slices(batches, 64):
            for r in batch.to_pylist():
                if r["chunk"] != now:
                    if times:
                        yield from rows()
                    now, times, names = r["chunk"], 0, r["names"]
                    size = len(names) // 17
                    n, sums = np.zeros(size, np.int64), np.zeros((3, size))
                if r["kind"] == 2:
                    times += 1
                    n = n + np.frombuffer(r["docs"], "<i8")
                    sums += np.frombuffer(r["sums"], "<f8").reshape(3, -1)
                else:
                    docs = np.frombuffer(r["docs"], "<u2")
                    sums[:, docs] += np.frombuffer(r["sums"], "<f8").reshape(3, -1)
        if times:
            yield from rows()

    parts = (asked.repartitionById(1 << bits, F.col("part")).sortWithinPartitions("kind")
             .mapInArrow(freed(answer), PARTIAL))
    sums = (parts.repartition("chunk").sortWithinPartitions("chunk", F.desc("kind"))
            .mapInArrow(freed(total), SUMS))
    return sums.select(F.col("id").alias(id_col), "n_tokens", "n_known",
                       F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")
