"""Toxicity scores of deobfuscated texts.

1. A character language model (trigrams of the bytes of words) is counted over all texts.
2. Spans that look obfuscated are decoded by a noisy channel: a lattice has, for each
   character, the letters it may stand for (leetspeak), nothing (a separator between single
   letters, a repeat in a run), or itself; Viterbi finds the likeliest letters under channel
   and language model. Suspect are words with a digit or sign used as a letter, with a letter
   three times in a row, with signs between single letters, and single letters set apart
   by blanks. Words that only have a digit, a sign within, or a doubled letter the model finds
   unlikely are read too, but stay as they are unless the reading is likelier and looks like
   a word. All other text stays as it is.
3. Features of a restored text are its words, and beginnings of 4 to 7 bytes that many
   different words of toxic texts share. Their log odds come from labelled texts; a logistic
   model of the largest weight and the number of weighty words gives the score.

Bounds: the language model has at most 92^3 entries; at most ``sample`` labelled texts, the
first by a hash of their id, teach the classifier, and ``features`` words and beginnings,
those in the most toxic of these, are weighed. Only these tables are broadcast. Everything
else is counted over all texts, and every whole text is scored.

Defined cases: a NULL or empty text has no features and the score of a text without any;
a NULL label, or one whose document is missing, teaches nothing; of repeated labels the
largest counts, and of a repeated document the first text in order; without labels of both
kinds every score is the share of toxic labels (0 if none); repeated rows score alike; ties
go by hash; an empty table gives an empty result. Of ``labels`` only the id and the label
are read; an input column called ``score`` is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import freed, slices, staged, text_of, with_field
from .wordhash import buffer_of, hashes, lowered, runs

SAMPLE = 20_000
FEATURES = 8192
BEGINNINGS = (4, 5, 6, 7)
LEAST_SHARING = 5  # different words that must share a beginning
LEAST_Z = 2.8
LONGEST_SPAN = 64  # a longer span is decoded in pieces of this size
CACHE_SPANS = 200_000

# What a sign may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "*": "aeiou"}
SEPARATORS = ".-_/,~: "
LEAST_GAIN = 2.0  # of a reading that only takes doubled letters for one: words have them too
LEAST_MEAN = -4.5  # per symbol; a reading less likely than this is no word


def _symbols() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[97:123] = np.arange(1, 27)
    table[65:91] = np.arange(1, 27)
    table[0xC3] = 27
    table[0x80:0xC0] = np.arange(28, 92)
    return table


SYMBOL, N = _symbols(), 92


def _flags(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


IS_LEET, IS_SEPARATOR, ALWAYS_LEET = _flags("".join(LEET)), _flags(SEPARATORS.strip()), _flags("@$")


# -- the character model ------------------------------------------------------

def trigram_counts(df: DataFrame, text_col: str) -> DataFrame:
    """(code, n): trigrams of symbols, word borders being symbol 0; a task adds up first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N ** 3, np.int64)
        for batch in slices(batches, 200):  # some numbers of eight bytes for each byte of text
            data, at = buffer_of(batch.column("text"))
            s = np.zeros(len(data) + len(at) + 2, np.int64)  # a border before every text
            s[2 + np.arange(len(data)) + np.repeat(np.arange(len(at) - 1), np.diff(at))] = SYMBOL[data]
            code = (s[:-2] * N + s[1:-1]) * N + s[2:]
            total += np.bincount(code[(s[1:-1] > 0) | (s[2:] > 0)], minlength=N ** 3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["code", "n"])

    return (df.select(text_of(text_col).alias("text")).mapInArrow(freed(count), "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")))


class CharModel:
    """Interpolated trigram model over the symbols."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        three = np.zeros(N ** 3)
        three[codes] = counts
        three = three.reshape(N, N, N)
        two, one = three.sum(0), three.sum((0, 1))
        p1 = (one + 1) / (one.sum() + N)
        p2 = (two + 20 * p1) / (two.sum(1, keepdims=True) + 20)
        p3 = (three + 20 * p2) / (three.sum(2, keepdims=True) + 20)
        self.log = np.log(p3).astype(np.float32)


class Decoder:
    """Restores texts; keeps up to ``CACHE_SPANS`` decoded spans."""

    def __init__(self, model: CharModel):
        self.log, self.cache, self.weighed_cache = model.log, {}, {}
        # what a letter costs on average, so that long readings are not worse as such
        self.bonus = 2.5

    def _steps(self, span: str) -> list[tuple[list[str], float | None]]:
        """Per place: what may stand there, and the cost of its being nothing (None: no)."""
        letters = sum(c.isalpha() or c in LEET for c in span)
        stars = span.count("*")
        apart = letters and (sum(c in SEPARATORS for c in span) >= letters - 1 > 0
                             or stars >= letters - stars - 1 > 0)
        steps, i = [], 0
        while i < len(span):
            c, j = span[i], i
            while j < len(span) and span[j] == c:
                j += 1
            if c.isalpha():
                options, nothing = [c], None
            elif c in LEET:
                options, nothing = [*LEET[c], c], ((0.1 if apart else 1.5) if c == "*" else None)
            elif c in SEPARATORS:
                options, nothing = [c], (0.1 if apart else 1.5)
            else:
                options, nothing = [c], None
            steps.append((options, nothing))
            if j - i > 1:  # a run reads as one, or as two
                steps.append((options, 0.7 if j - i == 2 else 0.4))
            i = j
        return steps

    def decode(self, span: str) -> str:
        """The likeliest reading of a lower-case span."""
        if len(span) > LONGEST_SPAN:
            return "".join(self.decode(span[i:i + LONGEST_SPAN]) for i in range(0, len(span), LONGEST_SPAN))
        return self._read(span)[1]

    def _read(self, span: str) -> tuple[float, str]:
        """(score, reading)."""
        found = self.cache.get(span)
        if found is not None:
            return found
        best = {(0, 0): (0.0, "")}
        for options, nothing in self._steps(span):
            after: dict[tuple[int, int], tuple[float, str]] = {}

            def offer(state, score, text):
                old = after.get(state)
                if old is None or score > old[0] or (score == old[0] and text < old[1]):
                    after[state] = (score, text)

            for (a, b), (score, text) in best.items():
                if nothing is not None:
                    offer((a, b), score - nothing, text)
                for c in options:
                    x, y, cost = a, b, score
                    for byte in c.encode():
                        s = int(SYMBOL[byte])
                        cost += float(self.log[x, y, s]) + (self.bonus if s else 0)
                        x, y = (y, s) if s else (0, 0)
                    offer((x, y), cost - (1.5 if c in LEET else 0), text + c)
            best = after
        score, text = max(((s + float(self.log[a, b, 0]), t) for (a, b), (s, t) in best.items()),
                          key=lambda x: (x[0], x[1]))
        if len(self.cache) >= CACHE_SPANS:
            self.cache.clear()
        self.cache[span] = score, text
        return score, text

    def _as_it_stands(self, span: str) -> tuple[float, float]:
        """(score, mean over symbols) of the words of a span, whatever is between them."""
        x = y = n = letters = 0
        score = 0.0
        for byte in [*span.encode(), 0]:
            s = int(SYMBOL[byte])
            if s or x or y:
                score += float(self.log[x, y, s])
                n, letters = n + 1, letters + (s > 0)
            x, y = (y, s) if s else (0, 0)
        return score + self.bonus * letters, score / max(1, n)

    def weighed(self, span: str) -> str:
        """The reading of a span that may well be none, if it is likelier than the span."""
        if len(span) > LONGEST_SPAN:
            return "".join(self.weighed(span[i:i + LONGEST_SPAN]) for i in range(0, len(span), LONGEST_SPAN))
        found = self.weighed_cache.get(span)
        if found is None:
            score, text = self._read(span)
            found = text
            least = self._as_it_stands(span)[0] + (LEAST_GAIN if span.isalpha() else 0)
            if text != span and (score <= least or self._as_it_stands(text)[1] < LEAST_MEAN):
                found = span
            if len(self.weighed_cache) >= CACHE_SPANS:
                self.weighed_cache.clear()
            self.weighed_cache[span] = found
        return found

    def restore(self, texts: pa.Array) -> pa.Array:
        """The texts, suspect spans replaced by their readings."""
        data, at = buffer_of(texts)
        begin, end, sure = suspects(data, at, self.log, self.bonus)
        if not len(begin):
            return texts.cast(pa.large_string()).fill_null("")
        raw, pieces, done, moved = data.tobytes(), [], 0, np.zeros(len(begin), np.int64)
        for i, (b, e, known) in enumerate(zip(begin.tolist(), end.tolist(), sure.tolist())):
            span = raw[b:e].decode(errors="replace")
            low = span.lower()
            word = self.decode(low) if known else self.weighed(low)
            word = (word if known or word != low else span).encode()
            pieces += [raw[done:b], word]
            moved[i] = len(word) - (e - b)
            done = e
        pieces.append(raw[done:])
        total = np.concatenate([[0], np.cumsum(moved)])
        offsets = at + total[np.searchsorted(begin, at)]
        return pa.LargeStringArray.from_buffers(
            len(at) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(b"".join(pieces)))


def unlikely_twice(symbols: np.ndarray, at: np.ndarray, log: np.ndarray, bonus: float) -> np.ndarray:
    """Where a letter that comes twice in a row reads better once. No other place of a word
    has a say in this: all other trigrams are the same."""
    place = np.flatnonzero((symbols[1:] == symbols[:-1]) & (symbols[1:] > 0))
    out = np.zeros(len(symbols), bool)
    border = np.zeros(len(symbols) + 1, bool)
    border[at] = True
    place = place[~border[place + 1]]
    around = np.concatenate([[0], symbols, [0]])  # of a place i, i + 1 here
    x = symbols[place]
    before = np.where(border[place], 0, around[place])
    after = np.where(border[np.minimum(place + 2, len(symbols))], 0, around[np.minimum(place + 3, len(symbols) + 1)])
    out[place] = log[before, x, x] + bonus + log[x, x, after] < log[before, x, after] - 0.7
    return out


def suspects(data: np.ndarray, at: np.ndarray, log: np.ndarray, bonus: float
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, whether they look obfuscated for sure) of the spans of a batch's bytes to
    read, in order."""
    low = lowered(data)
    letter = SYMBOL[data] > 0
    shown = (data != 32) & ((data < 9) | (data > 13))
    begin, end, per_text = runs(shown, at)
    if not len(begin):
        return begin, end, np.zeros(0, bool)
    follows = np.concatenate([letter[1:], [False]])
    before = np.concatenate([[False], letter[:-1]])
    sign = IS_LEET[data]
    again = np.concatenate([[False, False], (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]), [False, False]])
    thrice_here = (again[:-2] | again[1:-1] | again[2:])[:len(data)]  # $$$ is no letter
    worded = letter | ALWAYS_LEET[data] & ~thrice_here | (data >= 48) & (data <= 57)
    marks = [sign & (follows | ALWAYS_LEET[data]),  # a sign before a letter
             letter & np.concatenate([[False, False], (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2])])[:len(low)],
             IS_SEPARATOR[data] & before & follows, letter,
             sign & (follows | worded),  # of a run of @ or $ two at most
             IS_SEPARATOR[data] & np.concatenate([[False], worded[:-1]]) & np.concatenate([worded[1:], [False]]),
             unlikely_twice(SYMBOL[data], at, log, bonus)]
    signs, thrice, parted, letters, leet, inner, twice = (
        (t := np.concatenate([[0], np.cumsum(m)]))[end] - t[begin] for m in marks)
    digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
    many = (digits[end] - digits[begin]) * 3 > 2 * (end - begin)  # numbers and keys
    size = end - begin
    suspect = ((signs > 0) & (letters > 1) & ~many | (thrice > 0)
               | (parted > 1) & (parted * 2 + 1 >= letters))
    sure = suspect.copy()
    suspect |= (letters > 0) & (size > 1) & (leet + inner + twice > 0)
    single = (size == 1) & (letter | sign)[begin]
    text = np.repeat(np.arange(len(per_text)), per_text)
    joined = single[1:] & single[:-1] & (begin[1:] == end[:-1] + 1) & (text[1:] == text[:-1])
    # runs of single characters, of three at least
    start = np.flatnonzero(np.concatenate([joined, [False]]) & ~np.concatenate([[False], joined]))
    stop = np.flatnonzero(np.concatenate([[False], joined]) & ~np.concatenate([joined, [False]]))
    long = stop - start >= 2
    start, stop = start[long], stop[long]
    inside = np.zeros(len(begin) + 1, np.int64)
    np.add.at(inside, start, 1)
    np.add.at(inside, stop + 1, -1)
    suspect &= np.cumsum(inside[:-1]) == 0
    core = np.flatnonzero(worded)  # what is before and after a word is not read with it
    faint = suspect & ~sure
    first, last = begin.copy(), end.copy()
    first[faint] = core[np.searchsorted(core, begin[faint])]
    last[faint] = core[np.searchsorted(core, end[faint]) - 1] + 1
    b = np.concatenate([first[suspect], begin[start]])
    e = np.concatenate([last[suspect], end[stop]])
    known = np.concatenate([sure[suspect], np.ones(len(start), bool)])
    order = np.argsort(b)
    return b[order], e[order], known[order]


# -- features and weights -----------------------------------------------------

def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text of each word, its hash and those of its beginnings, 0 where it is shorter)."""
    import pyarrow.compute as pc

    data, at = buffer_of(pc.utf8_lower(texts.cast(pa.large_string())))
    begin, end, n = runs(SYMBOL[data] > 0, at)
    columns = [hashes(data, begin, end)]
    for size in BEGINNINGS:
        stop = np.minimum(begin + size, end)
        columns.append(np.where(end - begin > size, hashes(data, begin, stop) + np.uint64(size), np.uint64(0)))
    return np.repeat(np.arange(len(n)), n), np.stack(columns, 1)


class Weights:
    """Feature weights, sorted by hash."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(keys.shape)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], 0.0)

    def inputs(self, texts: pa.Array) -> np.ndarray:
        """Per text: its largest weight, and log(1 + words with a weight)."""
        text, keys = word_features(texts)
        out = np.zeros((len(texts), 2))
        if len(text):
            unique, back = np.unique(keys[:, 0], return_index=True)[1], np.unique(keys[:, 0], return_inverse=True)[1]
            best = self.of(keys[unique]).max(1)[back]
            np.maximum.at(out[:, 0], text, best)
            out[:, 1] = np.log1p(np.bincount(text, best > 0, minlength=len(texts)))
        return out


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, with a small penalty."""
    x = np.concatenate([np.ones((len(x), 1)), x], 1)
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6, 0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _document_counts(train: DataFrame, model: CharModel, candidates: np.ndarray | None) -> DataFrame:
    """Without candidates: per word of toxic texts (word, begin4..7, n texts); with them:
    (key, label, n texts) for those features alone. A task adds up before the shuffle."""

    def words(batches):
        decoder = Decoder(model)
        for batch in slices(batches, 1000):
            text, keys = word_features(decoder.restore(batch.column("text")))
            pair = np.unique(np.stack([text.astype(np.uint64), np.arange(len(text), dtype=np.uint64) * 0
                                       + keys[:, 0]], 1), axis=0) if len(text) else np.zeros((0, 2), np.uint64)
            found, n = np.unique(pair[:, 1], return_counts=True)
            at = np.searchsorted(np.sort(keys[:, 0]), found) if len(text) else found
            rows = keys[np.argsort(keys[:, 0], kind="stable")][at] if len(text) else keys
            rows = rows.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(rows.shape[1])] + [pa.array(n)],
                ["word", "b4", "b5", "b6", "b7", "n"])

    def counts(batches):
        decoder = Decoder(model)
        known = np.sort(candidates)
        total = np.zeros((2, len(known)), np.int64)
        for batch in slices(batches, 1000):
            text, keys = word_features(decoder.restore(batch.column("text")))
            label = batch.column("label").to_numpy()
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit, column = np.nonzero(known[at] == keys)
            pair = np.unique(text[hit] * len(known) + at[hit, column])
            np.add.at(total, (label[pair // len(known)], pair % len(known)), 1)
        for label in (0, 1):
            seen = np.flatnonzero(total[label])
            yield pa.RecordBatch.from_arrays(
                [pa.array(known[seen].view(np.int64)), pa.array(np.full(len(seen), label, np.int32)),
                 pa.array(total[label][seen])], ["key", "label", "n"])

    if candidates is None:
        toxic = train.where("label = 1").select("text")
        return (toxic.mapInArrow(freed(words), "word long, b4 long, b5 long, b6 long, b7 long, n long")
                .groupBy("word").agg(*[F.first(c).alias(c) for c in ("b4", "b5", "b6", "b7")], F.sum("n").alias("n")))
    return (train.select("text", "label").mapInArrow(freed(counts), "key long, label int, n long")
            .groupBy("key", "label").agg(F.sum("n").alias("n")))


def fitted(train: DataFrame, model: CharModel, features: int = FEATURES) -> tuple[Weights, np.ndarray]:
    """(feature weights, logistic coefficients) from rows (text, label); ``train`` is read
    several times. The driver gets counts of at most ``features`` features, and two numbers
    and a label per row, of which there are at most ``sample``."""
    share = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    none = Weights(np.zeros(0, np.uint64), np.zeros(0))
    if len(share) < 2:
        rate = 1.0 if share.get(1) else 0.0
        return none, np.array([60 * rate - 30, 0.0, 0.0])
    words = staged(_document_counts(train, model, None))
    whole = words.select(F.col("word").alias("key"), "n")
    begins = (words.select(F.explode(F.array("b4", "b5", "b6", "b7")).alias("key"), "n").where("key <> 0")
              .groupBy("key").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words"))
              .where(F.col("words") >= LEAST_SHARING).select("key", "n"))
    top = [x.orderBy(F.desc("n"), "key").limit(features // 2).select("key").collect() for x in (whole, begins)]
    candidates = np.unique(np.array([r["key"] for rows in top for r in rows], np.int64)).view(np.uint64)
    if not len(candidates):
        return none, np.array([math.log(share[1] / share[0]), 0.0, 0.0])
    n = np.zeros((2, len(candidates)))
    known = np.sort(candidates)
    for r in _document_counts(train, model, candidates).collect():
        n[r["label"], np.searchsorted(known, np.array([r["key"]], np.int64).view(np.uint64)[0])] = r["n"]
    odds = np.log((n[1] + 0.5) / (share[1] + 1)) - np.log((n[0] + 0.5) / (share[0] + 1))
    weighty = odds / np.sqrt(1 / (n[1] + 0.5) + 1 / (n[0] + 0.5)) > LEAST_Z
    weights = Weights(known[weighty], odds[weighty])

    def inputs(batches):
        decoder = Decoder(model)
        for batch in slices(batches, 1000):
            x = weights.inputs(decoder.restore(batch.column("text")))
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), batch.column("label")],
                                             ["a", "b", "label"])

    rows = train.select("text", "label").mapInArrow(freed(inputs), "a double, b double, label int").collect()
    return weights, _fit(np.array([[r["a"], r["b"]] for r in rows]), np.array([r["label"] for r in rows]))


def char_model(df: DataFrame, text_col: str = "text") -> CharModel:
    rows = trigram_counts(df, text_col).collect()  # at most 92^3
    return CharModel(np.array([r["code"] for r in rows], np.int64), np.array([r["n"] for r in rows], float))


def restored(df: DataFrame, model: CharModel, text_col: str = "text") -> DataFrame:
    """``df`` with the text column's suspect spans replaced by their readings; NULL: empty."""
    names = df.columns
    place = names.index(text_col)

    def restore(batches):
        decoder = Decoder(model)
        for batch in slices(batches, 1000):
            columns = batch.columns
            columns[place] = decoder.restore(batch.column(place)).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return df.withColumn(text_col, text_of(text_col)).mapInArrow(freed(restore), df.schema)


def scored(df: DataFrame, labels: DataFrame, teach: Column | None = None, *, id_col: str = "doc_id",
           text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE,
           features: int = FEATURES) -> DataFrame:
    """Every row of ``df`` with its ``score``. ``teach`` says, of a row of ``labels``,
    whether it may teach."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    known = labels if teach is None else labels.where(teach)
    picked = (known.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    train = staged(rows.join(F.broadcast(staged(picked)), "id").groupBy("id", "label")
                   .agg(F.min("text").alias("text")).select("text", "label"))
    model = char_model(df, text_col)
    weights, coefficients = fitted(train, model, features)
    shared = spark.sparkContext.broadcast((model, weights, coefficients))

    names = [c for c in df.columns if c.lower() != "score"]
    place = names.index(text_col)

    def score(batches):
        model, weights, w = shared.value
        decoder = Decoder(model)
        for batch in slices(batches, 1000):
            x = weights.inputs(decoder.restore(batch.column(place)))
            p = 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*names, "score"])

    whole = df.select(*[f"`{c}`" for c in names])
    return whole.mapInArrow(freed(score), with_field(whole.schema, "score", "double"))
