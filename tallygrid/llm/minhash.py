"""Near-duplicates by ProbMinHash of weighted word shingles, banding and verification.

A document is the weighted set of its runs of five words (lower case; weight: how often).
Similarity is probability Jaccard of these, which is plain Jaccard where no run repeats.

Sketch: every shingle is a Poisson process whose rate is its weight; each arrival goes to a
random register, and a register keeps the shingle that reaches it first. Two registers agree
with a chance that is the similarity. A shingle stops once its next arrival is later than
what all registers hold, so a sketch costs about as much as the document is long. All
documents of a batch advance together, arrival by arrival, in array operations.

Candidates: documents with the same weighted set are one node. Nodes meet in a bucket when
all registers of a band agree; with 25 bands of 5 a pair at 0.8 meets with a chance of
0.99995, one further up more surely. Nodes of a bucket are compared inside tasks, sketch with
sketch, block by block; of each node the few most agreeing partners are verified. Buckets whose
nodes are not all of one class by then are met once more, with the nodes' weighted sets: there the
tasks verify all that may be similar themselves, each pair in the first bucket it shares, and
give only the links that join classes. Every pair of a bucket has then been compared, or is known to
be of one class, and what leaves the tasks is few a node, however large a group is.
Two sketches keep what cannot be similar from being verified: 128 bits of the registers (at
similarity 0.8 fewer than 96 agree with a chance of 3e-7), and a parity sketch of the set, of
whose bits no more can differ than shingles do, which bounds the similarity from above
without error (``most_similar``). All other pairs are verified on whole texts. Classes are the
connected components of verified pairs.

What is shuffled per document: its node and 25 bucket numbers, and, for those that share a
bucket with another node, the sketches and the text. Buckets are counted before they are
shuffled, and blocks of a bucket are keys of their own, so that a hot bucket is split.

Defined cases: a NULL text, or one without a word, is in a class of its own; of a text of
under five words the only shingle is all its words; ties and repeated rows are copies; a
NULL id is never a class's name unless all are; input columns are replaced when called like
added ones; an empty table gives an empty result; a text of any length is used whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, drop_staged, freed, slices, small_batches, staged, text_of, unused
from .wordhash import mixed, plain_words

WORDS, SIMILARITY = 5, 0.8
REGISTERS, BANDS, ROWS = 128, 25, 5
FEWEST_BITS = 96  # of 128: at similarity 0.8 the mean is 115.2 and the deviation 3.4
PARTNERS = 3  # most agreeing partners of a node that the first round tests
BLOCK = 2048  # nodes of a bucket whose sketches a task holds
SET_BLOCK, SET_SHINGLES = 512, 1 << 20  # the same, and their shingles in all, where it holds their sets
PARITY = 512  # bits of the parity sketch, a multiple of 64
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, weight) of the distinct shingles, ordered by text and hash."""
    hashed, n = plain_words(texts)
    ends = np.cumsum(n)
    count = np.where(n >= words, n - words + 1, n > 0)
    text = np.repeat(np.arange(len(n)), count)
    start = np.repeat(ends - n - (np.cumsum(count) - count), count) + np.arange(count.sum())
    padded = np.concatenate([hashed, np.zeros(words, np.uint64)])
    total = np.zeros(len(start), np.uint64)
    for j in range(words):
        word = np.where(start + j < ends[text], padded[start + j], np.uint64(0))
        total = total * STEP + word
    total = mixed(total)
    order = np.lexsort((total, text))
    text, total = text[order], total[order]
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (total[1:] != total[:-1])])
                         if len(text) else [])
    return text[new], total[new], np.diff(np.append(new, len(text)))


def prob_minhash(text: np.ndarray, key: np.ndarray, weight: np.ndarray, texts: int,
                 registers: int = REGISTERS) -> np.ndarray:
    """Registers (texts x registers) of the weighted sets; ``registers`` a power of two."""
    first = np.full(texts * registers, np.inf)
    held = np.zeros(texts * registers, np.uint64)
    latest = np.full(texts, np.inf)
    time, step = np.zeros(len(key)), 0
    weight = weight.astype(np.float64)
    while len(key):
        step = (step + int(STEP)) % 2 ** 64
        draw = mixed(key + np.uint64(step))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        live = time < latest[text]
        text, key, weight, time, draw = (x[live] for x in (text, key, weight, time, draw))
        at = text * registers + (draw & np.uint64(registers - 1)).astype(np.int64)
        better = np.flatnonzero(time < first[at])
        better = better[np.argsort(-time[better])]  # of several, the earliest is written last
        first[at[better]] = time[better]
        held[at[better]] = key[better]
        changed = np.unique(text[better])
        latest[changed] = first.reshape(texts, registers)[changed].max(1)
    return held.reshape(texts, registers)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two weighted sets (sorted distinct hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    x, y = a[1][i].astype(float), b[1][j].astype(float)
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    above = np.cumsum(x[::-1])[::-1]
    below = np.cumsum(y) - y
    return float((x / (only_a + ratio * only_b + above + ratio * below)).sum())


def sketches(df: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """(id, text_key, node, buckets, bits0, bits1, parity, size, mass) per row; node is a digest
    of the whole weighted set, NULL for a text without words; size counts the shingles, mass
    adds up their weights."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):  # some 30 numbers of eight bytes for each shingle
            text, key, weight = shingles(batch.column("text"), words)
            n = batch.num_rows
            bounds = np.searchsorted(text, np.arange(n + 1)).tolist()
            nodes = [hashlib.blake2b(key[b:e].tobytes() + weight[b:e].tobytes(), digest_size=16).digest()
                     if e > b else None for b, e in zip(bounds, bounds[1:])]
            held = prob_minhash(text, key, weight, n)
            total = np.zeros((n, BANDS), np.uint64)
            for r in range(ROWS):
                total = mixed(total * STEP + held[:, r:BANDS * ROWS:ROWS])
            total = mixed(total + np.arange(1, BANDS + 1, dtype=np.uint64) * STEP).view(np.int64)
            place = text * PARITY + (mixed(key ^ STEP) % np.uint64(PARITY)).astype(np.int64)
            odd = np.bincount(place, minlength=n * PARITY) & 1
            parity = np.packbits(odd.astype(bool).reshape(n, PARITY), axis=1).view("<i8")
            size, mass = np.bincount(text, minlength=n), np.bincount(text, weight, minlength=n)
            register = np.arange(REGISTERS, dtype=np.uint64) * STEP  # a shingle has a bit of its own in each
            bits = np.packbits((mixed(held + register) >> np.uint64(63)).astype(bool), axis=1).view("<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(nodes, pa.binary()),
                 pa.ListArray.from_arrays(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32), total.ravel()),
                 pa.array(bits[:, 0]), pa.array(bits[:, 1]),
                 pa.ListArray.from_arrays(np.arange(0, parity.size + 1, PARITY // 64, dtype=np.int32),
                                          parity.ravel()), pa.array(size.astype(np.int32)),
                 pa.array(mass.astype(np.int64))],
                ["id", "text_key", "node", "buckets", "bits0", "bits1", "parity", "size", "mass"])

    rows = _keyed(df, id_col, text_col)
    return rows.mapInArrow(freed(sketch), "id long, text_key binary, node binary, buckets array<long>, "
                                   "bits0 long, bits1 long, parity array<long>, size int, mass long")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"),
                     F.unhex(F.md5(text)).alias("text_key"))


def most_similar(differ, size_a, size_b, mass_a, mass_b) -> tuple:
    """Two upper bounds of the similarity of two weighted sets, of whose supports ``differ`` elements
    at least are not shared; numbers, arrays or Columns. The second holds where no weight is over 1.

    The elements of only one set, p and q of them, are at least (differ + size_a - size_b) / 2
    and (differ - size_a + size_b) / 2, and weigh as much. A shared element's term is
    1 / D with D >= A/x + q/y and D >= B/y + p/x for masses A, B and weights x, y, so at most
    the mean of x / (A + p) and y / (B + q); these add up to the first bound.
    """
    over_a, over_b = (differ + size_a - size_b) / 2, (differ - size_a + size_b) / 2
    first = ((mass_a - over_a) / (mass_a + over_a) + (mass_b - over_b) / (mass_b + over_b)) / 2
    return first, (size_a + size_b - differ) / (size_a + size_b + differ)


def _verified(pairs: DataFrame, pool: DataFrame, least: float, words: int) -> DataFrame:
    """The pairs (a, b) whose texts are at least ``least`` similar."""

    def verify(batches):
        for batch in slices(batches, 200):
            sides = []
            for name in ("text_a", "text_b"):
                text, key, weight = shingles(batch.column(name), words)
                bounds = np.searchsorted(text, np.arange(batch.num_rows + 1))
                sides.append([(key[b:e], weight[b:e]) for b, e in zip(bounds, bounds[1:])])
            keep = [similarity(x, y) >= least for x, y in zip(*sides)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])

    both = (pairs.join(pool.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .join(pool.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(freed(verify), "a binary, b binary")


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) of all linked nodes, after ``links`` on top of the components known before.

    Only links between components are followed again, so the later round costs what it finds.
    """
    if labels is None:
        return staged(components(links))
    if not links.take(1):
        return labels
    for end in ("a", "b"):
        known = labels.select(F.col("node").alias(end), F.col("component").alias("up"))
        links = links.join(known, end, "left").withColumn(end, F.coalesce("up", end)).drop("up")
    above = staged(components(links))
    moved = labels.join(above.select(F.col("node").alias("component"), F.col("component").alias("top")),
                        "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return staged(moved.union(above.join(labels, "node", "left_anti").select("node", "component")))


def _linked(nodes: DataFrame, df: DataFrame, id_col: str, text_col: str, least: float,
            words: int) -> DataFrame:
    """(node, component) of the nodes with a verified link, by links enough for the components of all."""
    rows = nodes.select("node", F.explode("buckets").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = staged(rows.join(shared, "bucket").join(
        nodes.select("node", "bits0", "bits1", "parity", "size", "mass"), "node"))
    wanted = members.select("node").distinct().join(nodes.select("node", "id", "text_key"), "node")
    texts = _keyed(df, id_col, text_col)
    pool = staged(texts.join(wanted.withColumnRenamed("id", "own"),
                             [texts.text_key == wanted.text_key, texts.id.eqNullSafe(F.col("own"))])
                  .select("node", "text").dropDuplicates(["node"]))
    found = staged(_best(_close(members.withColumn("label", F.col("node")), least, PARTNERS), PARTNERS))
    labels = _merged(None, _verified(found.where("best").select("a", "b"), pool, least, words))
    if found.where("more OR NOT best").take(1):  # else every pair that may be similar has been tested
        known = labels.withColumnRenamed("component", "label")
        labelled = members.join(known, "node", "left").withColumn("label", F.coalesce("label", "node"))
        labels = _merged(labels, staged(_missing(labelled, nodes.select("node", "buckets"), pool, least, words)))
    return labels


def _best(found: DataFrame, partners: int) -> DataFrame:
    """(a, b, more, best): the pairs once each, and whether one of its ends has no more than
    ``partners`` that agree better."""
    once = found.groupBy("a", "b").agg(F.max("agree").alias("agree"), F.max("more").alias("more"))

    def place(end: str, other: str):
        return F.row_number().over(Window.partitionBy(end).orderBy(F.desc("agree"), other))

    placed = once.withColumns({"in_a": place("a", "b"), "in_b": place("b", "a")})
    return placed.select("a", "b", "more", (F.least("in_a", "in_b") <= partners).alias("best"))


COMPARED = ("node", "label", "bits0", "bits1", "parity", "size", "mass")


def _close(labelled: DataFrame, least: float, partners: int) -> DataFrame:
    """(a, b, agree, more): in each bucket, of each node the ``partners`` most agreeing nodes of other labels
    that may be similar, smaller node first; ``more`` where there were further ones. Nodes are compared
    inside tasks, and only what passes leaves them."""
    rows = _in_blocks(_mixed(labelled, F.ceil(F.count(F.lit(1)) / BLOCK)), COMPARED)
    task = _meeting(lambda bucket, *sides, **k: _between(*sides, least, partners, **k))
    return rows.mapInArrow(freed(task), "a binary, b binary, agree int, more boolean")


def _missing(labelled: DataFrame, buckets: DataFrame, pool: DataFrame, least: float, words: int) -> DataFrame:
    """Links (a, b) that join the labels of nodes with a similar partner in a bucket, all pairs of
    which are compared, similar ones by their weighted sets. Of links that join the same labels
    a task gives one: of n nodes met in a block fewer than n."""

    def weighted(batches):
        for batch in slices(batches, 200):
            text, key, weight = shingles(batch.column("text"), words)
            bounds = np.searchsorted(text, np.arange(batch.num_rows + 1)).tolist()
            sets = [(key[b:e].tobytes(), weight[b:e].astype("<i8").tobytes() if (weight[b:e] > 1).any() else None)
                    for b, e in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("buckets"), *(pa.array([x[i] for x in sets], pa.binary())
                                                                  for i in range(2))],
                ["node", "buckets", "keys", "weights"])

    by_nodes, by_shingles = F.count(F.lit(1)) / SET_BLOCK, F.sum("size") / SET_SHINGLES
    mixed_up = staged(_mixed(labelled, F.ceil(F.greatest(by_nodes, by_shingles))))
    wanted = pool.join(mixed_up.select("node").distinct(), "node").join(buckets, "node")
    sets = wanted.select("node", "buckets", "text").mapInArrow(
        freed(weighted), "node binary, buckets array<long>, keys binary, weights binary")
    rows = _in_blocks(mixed_up.join(staged(sets), "node"), (*COMPARED, "buckets", "keys", "weights"))
    task = _meeting(lambda bucket, *sides, **k: _joining(bucket, *sides, least, **k))
    return rows.mapInArrow(freed(task), "a binary, b binary").distinct()


def _mixed(labelled: DataFrame, blocks) -> DataFrame:
    """The rows of buckets with several labels, and in how many ``blocks`` each is cut; buckets of
    one label have nothing to add."""
    mixed_up = (labelled.groupBy("bucket").agg(blocks.alias("blocks"), F.min("label").alias("low"),
                                               F.max("label").alias("high"))
                .where("low <> high").select("bucket", "blocks"))
    return labelled.join(mixed_up, "bucket")


def _in_blocks(rows: DataFrame, columns: tuple) -> DataFrame:
    """Rows dealt by bucket and block: a block's own first, then those of the later blocks as guests."""
    rows = rows.withColumn("home", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("home"))))
    rows = rows.select("bucket", "block", (F.col("home") != F.col("block")).alias("guest"), *columns)
    return rows.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "guest")


def _meeting(meet):
    """A task that holds a block and streams its guests past it. ``meet(bucket, homes, guests)`` gives what it
    finds among them."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def within():
            if held:
                own = _joined(held)
                yield from meet(key[0], own, own, ordered=True)

        for batch in batches:
            for own, guest, part in _runs(batch):
                if own != key:
                    yield from within()
                    held, key = [], own
                if not guest:
                    held.append(part)
                    continue
                if len(held) > 1:
                    held = [_joined(held)]
                yield from meet(key[0], held[0], part) if held else ()
        yield from within()

    # a block's own pairs are compared once all of it is there: at the end of its group
    return compare


def _runs(batch: pa.RecordBatch):
    """The batch in runs of one block and side: (bucket, block), guest, columns."""
    bucket, block = batch.column("bucket").to_numpy(), batch.column("block").to_numpy()
    guest = batch.column("guest").to_numpy(zero_copy_only=False)
    digest = {c: np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u8").reshape(-1, 2) for c in ("node", "label")}
    parity = batch.column("parity").flatten().to_numpy().reshape(-1, PARITY // 64).view(np.uint64)
    bits = np.stack([batch.column(c).to_numpy() for c in ("bits0", "bits1")], axis=1).view(np.uint64)
    size, mass = (batch.column(c).to_numpy().astype(np.float64) for c in ("size", "mass"))
    columns = [digest["node"], digest["label"], bits, parity, size, mass]
    if "keys" in batch.schema.names:
        columns.append(batch.column("buckets").flatten().to_numpy().reshape(-1, BANDS))
        columns += [_objects(batch.column(c).to_pylist()) for c in ("keys", "weights")]
    change = (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1]) | (guest[1:] != guest[:-1])
    bounds = np.concatenate([[0], np.flatnonzero(change) + 1, [len(bucket)]])
    for start, stop in zip(bounds, bounds[1:]):
        if stop > start:
            yield ((int(bucket[start]), int(block[start])), bool(guest[start]),
                   tuple(x[start:stop] for x in columns))


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def _joined(parts: list) -> tuple:
    return tuple(np.concatenate(x) for x in zip(*parts)) if len(parts) > 1 else parts[0]


def _similar(homes: tuple, guests: tuple, least: float, ordered: bool
             ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(home, guest, registers' bits that agree) of other labels that may be similar, the most agreeing guests of
    a home first, some homes at a time; ``ordered``: of a block with itself."""
    nodes, labels, bits, parity, size, mass = homes[:6]
    step = max(1, (1 << 19) // max(1, len(guests[0])))
    for start in range(0, len(nodes), step):
        stop = min(start + step, len(nodes))
        agree = 128 - sum(np.bitwise_count(bits[start:stop, None, i] ^ guests[2][None, :, i]).astype(np.int16)
                          for i in range(2))
        may = agree >= FEWEST_BITS
        may &= (labels[start:stop, None] != guests[1][None]).any(axis=2)
        if ordered:
            may &= np.arange(start, stop)[:, None] < np.arange(len(guests[0]))[None]
        row, col = np.nonzero(may)
        agreeing = agree[row, col]
        row = row + start
        differ = np.bitwise_count(parity[row] ^ guests[3][col]).sum(axis=1, dtype=np.int64)
        differ = np.maximum(differ, np.abs(size[row] - guests[4][col]))
        weighted, plain = most_similar(differ, size[row], guests[4][col], mass[row], guests[5][col])
        heavy = (mass > size)[row] | (guests[5] > guests[4])[col]
        fits = (weighted >= least - 1e-9) & (heavy | (plain >= least - 1e-9))
        row, col, agreeing = row[fits], col[fits], agreeing[fits]
        order = np.lexsort((-agreeing, row))
        if len(row):
            yield row[order], col[order], agreeing[order]


def _between(homes: tuple, guests: tuple, least: float, partners: int,
             ordered: bool = False) -> Iterator[pa.RecordBatch]:
    """The candidates among homes and guests, ``partners`` of each home."""
    for row, col, agreeing in _similar(homes, guests, least, ordered):
        keep = np.arange(len(row)) - np.searchsorted(row, row) < partners
        more = np.full(int(keep.sum()), bool((~keep).any()))
        ends = _sorted_ends(homes[0][row[keep]], guests[0][col[keep]])
        yield pa.RecordBatch.from_arrays(
            [*ends, pa.array(agreeing[keep].astype(np.int32)), pa.array(more)], ["a", "b", "agree", "more"])


def _joining(bucket: int, homes: tuple, guests: tuple, least: float,
             ordered: bool = False) -> Iterator[pa.RecordBatch]:
    """Of the similar pairs of homes and guests those that join labels not joined before. Pairs that share
    an earlier bucket are met there."""
    size, mass = (np.concatenate([homes[i], guests[i]]) for i in (4, 5))
    heavy, n = mass > size, len(homes[0])
    label = np.unique(np.concatenate([homes[1], guests[1]]), axis=0, return_inverse=True)[1].ravel()
    root = np.arange(label.max() + 1)  # of each label

    def weighted(side, i):
        keys = np.frombuffer(side[7][i], "<u8")
        return keys, np.ones(len(keys), np.int64) if side[8][i] is None else np.frombuffer(side[8][i], "<i8")

    words = None
    for row, col, _ in _similar(homes, guests, least, ordered):
        same = homes[6][row] == guests[6][col]
        here = homes[6][row, same.argmax(axis=1)] == bucket
        row, col = row[here & same.any(axis=1)], col[here & same.any(axis=1)]
        if words is None and len(row):
            words, place = np.unique(np.frombuffer(b"".join(guests[7]), "<u8"), return_inverse=True)
            begin = np.concatenate([[0], np.cumsum([len(k) // 8 for k in guests[7]])[:-1]])
            has = np.zeros(len(words) + 1, np.int64)
        out = []
        for i, at in _groups(row):
            other = col[at]
            other = other[root[label[n + other]] != root[label[i]]]
            if not len(other):
                continue
            own = weighted(homes, i)[0]
            found = np.minimum(np.searchsorted(words, own), len(words) - 1)
            found = found[words[found] == own]
            has[found] = 1
            shared = np.add.reduceat(has[place], begin)[other]
            has[found] = 0
            a, b = size[i], size[n + other]
            unlike = a + b - 2 * shared
            bound = most_similar(unlike, a, b, mass[i], mass[n + other])[0]
            plain = np.where(heavy[i] | heavy[n + other], bound, shared / (a + b - shared))
            sure = (plain >= least + 1e-9) & ~heavy[i] & ~heavy[n + other]
            for j, known in zip(other[plain >= least - 1e-9].tolist(), sure[plain >= least - 1e-9].tolist()):
                x, y = root[label[i]], root[label[n + j]]
                if x != y and (known or similarity(weighted(homes, i), weighted(guests, j)) >= least):
                    root[root == y] = x
                    out.append((i, j))
        if out:
            pairs = np.array(out)
            yield pa.RecordBatch.from_arrays(_sorted_ends(homes[0][pairs[:, 0]], guests[0][pairs[:, 1]]), ["a", "b"])


def _groups(row: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(value, where it is) of an array in order."""
    begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else []
    for b, e in zip(begin, [*begin[1:], len(row)]):
        yield int(row[b]), slice(int(b), int(e))


def _sorted_ends(a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    """Digests of pairs, the smaller first in the order of bytes."""
    x, y = a.astype("<u8").view(np.uint8).reshape(-1, 16), b.astype("<u8").view(np.uint8).reshape(-1, 16)
    ends = [(p, q) if p < q else (q, p) for p, q in zip((r.tobytes() for r in x), (r.tobytes() for r in y))]
    return [pa.array([e[i] for e in ends], pa.binary()) for i in range(2)]


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    least: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """Per row: id, class_id (the smallest id of its class), class_size (rows), kept (whether
    it names the class), text_key (md5 of the text)."""
    small_batches(df.sparkSession)  # of texts and weighted sets
    sketch = staged(sketches(df, id_col, text_col, words))
    best = F.min(F.struct(F.col("id").isNull(), "id", "text_key"))
    nodes = staged(sketch.where("node IS NOT NULL").groupBy("node").agg(
        best.alias("best"), F.count(F.lit(1)).alias("n"), *[
            F.first(c).alias(c) for c in ("buckets", "bits0", "bits1", "parity", "size", "mass")])
        .select("node", "best", "best.id", "best.text_key", "n", "buckets", "bits0", "bits1", "parity",
                "size", "mass"))
    linked = _linked(nodes, df, id_col, text_col, least, words)
    named = (nodes.select("node", "best", "n").join(linked, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    classes = named.groupBy("component").agg(F.min("best").alias("top"), F.sum("n").alias("class_size"))
    per_node = staged(named.join(classes, "component").select("node", "top", "class_size"))
    own = F.struct(F.col("id").isNull(), "id", "text_key")
    found = sketch.join(per_node, "node").select(
        "id", F.col("top.id").alias("class_id"), "class_size", own.eqNullSafe(F.col("top")).alias("kept"),
        "text_key")
    alone = sketch.where("node IS NULL").select(
        "id", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("kept"), "text_key")
    return found.union(alone).withColumnRenamed("id", id_col)


def survivors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
              least: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """One whole row of ``df`` per class: that with the smallest id; of a row repeated with
    its id and text one stays."""
    found = near_duplicates(df, id_col, text_col, least=least, words=words)
    key, own = unused(df, "_key", "_own")
    kept = found.where("kept").select(F.col(id_col).alias(own), F.col("text_key").alias(key)).distinct()
    rows = df.withColumn(key, F.unhex(F.md5(text_of(text_col))))
    on = (rows[key] == kept[key]) & rows[id_col].cast("long").eqNullSafe(kept[own])
    return (rows.join(kept, on, "left_semi").dropDuplicates([key, id_col])
            .select(*[f"`{c}`" for c in df.columns]))
