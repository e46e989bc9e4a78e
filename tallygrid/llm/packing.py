"""Best-fit decreasing packing of token sequences into fixed windows.

Documents are dealt to groups of about ``group_bytes`` of text by a hash, so each group is
a fair mix, is bounded and has a task of its own. In the task texts are encoded, documents
longer than a window are cut into full windows first, and what is left, longest first, goes
to the open window with the least room that suffices. A segment tree over remaining
capacities, counting the open windows of each, finds it in log2(capacity) steps.

Output: one row per window. ``ids`` holds little-endian unsigned 32-bit ids, padded with
``pad_id`` to ``capacity``, unless the number of its tokens is a power of two; ``pieces``
says which part of which document lies where.

Defined cases: a NULL or empty text has the end id only; documents with a NULL or repeated
id are packed like any other, each row by itself; ties are dealt in (id, text hash) order;
a document of any length is cut, never shortened; an empty table gives no window. Only the
two named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, slices, text_of
from .tokens import encoder, with_end

CAPACITY = 4096
GROUP_BYTES = 16 << 20
# Windows are laid out when so many tokens have gathered, whatever a group's size.
LAYOUT_TOKENS = 12_000_000
PIECE = "struct<doc_id:long,start:long,length:long,doc_tokens:long,offset:long>"
SCHEMA = f"sequence_id long, n_tokens int, ids binary, pieces array<{PIECE}>"


class CapacityTree:
    """Numbers of open windows by remaining capacity, as a segment tree of counts."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        at = self.leaves + capacity
        while at:
            self.counts[at] += n
            at >>= 1

    def tightest(self, size: int) -> int | None:
        """The least capacity of at least ``size`` that an open window has."""
        at, counts = self.leaves + size, self.counts
        if counts[at]:
            return size
        while at > 1:
            if not at & 1 and counts[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if counts[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit(lengths: Sequence[int], capacity: int) -> tuple[list[int], list[int], int]:
    """Best-fit decreasing of lengths of 1 to ``capacity``: (window of each, its offset
    there, number of windows)."""
    tree, rooms = CapacityTree(capacity), [[] for _ in range(capacity + 1)]
    window, offset, n = [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[i]
        room = tree.tightest(size)
        if room is None:
            room, at = capacity, n
            n += 1
        else:
            at = rooms[room].pop()
            tree.add(room, -1)
        window[i], offset[i] = at, capacity - room
        if room > size:
            rooms[room - size].append(at)
            tree.add(room - size, 1)
    return window, offset, n


def _layout(ids: np.ndarray, lengths: np.ndarray, docs: list, capacity: int, pad_id: int,
            first: int) -> pa.RecordBatch:
    """The windows of documents whose ids stand in ``ids`` one after the other."""
    begins = np.cumsum(lengths) - lengths
    doc, start = [], []
    for d, n in enumerate(lengths.tolist()):
        for s in range(0, n, capacity):
            doc.append(d)
            start.append(s)
    doc, start = np.array(doc, np.int64), np.array(start, np.int64)
    size = np.minimum(lengths[doc] - start, capacity)
    window, offset, n = best_fit(size.tolist(), capacity)
    window, offset = np.array(window, np.int64), np.array(offset, np.int64)
    order = np.lexsort((offset, window))
    doc, start, size, window, offset = (x[order] for x in (doc, start, size, window, offset))
    moved = ids[np.repeat(begins[doc] + start - (np.cumsum(size) - size), size) + np.arange(size.sum())]
    used = np.bincount(window, weights=size, minlength=n).astype(np.int64)
    ends = np.cumsum(used)
    width = np.where(used & (used - 1) == 0, used, capacity)
    padded = [moved[e - u:e].tobytes() + np.full(w - u, pad_id, "<u4").tobytes()
              for e, u, w in zip(ends.tolist(), used.tolist(), width.tolist())]
    pieces = pa.StructArray.from_arrays(
        [pa.array([docs[d] for d in doc], pa.int64()), pa.array(start), pa.array(size),
         pa.array(lengths[doc]), pa.array(offset)],
        ["doc_id", "start", "length", "doc_tokens", "offset"])
    bounds = np.concatenate([[0], np.cumsum(np.bincount(window, minlength=n))]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(first + np.arange(n)), pa.array(used.astype(np.int32)),
         pa.array(padded, pa.binary()), pa.ListArray.from_arrays(bounds, pieces)],
        ["sequence_id", "n_tokens", "ids", "pieces"])


def packed(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *,
           end_id: int = 2, pad_id: int = 0, capacity: int = CAPACITY,
           group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Windows of the texts' ids, each text followed by ``end_id``."""
    size = df.agg(F.sum(F.octet_length(text_of(text_col)) + 4).alias("n")).first()["n"] or 0
    groups = max(1, -(-size // group_bytes))
    rows = df.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("id", "text"))
    dealt = rows.repartitionById(groups, F.pmod(F.col("tie"), F.lit(groups)).cast("int"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, first = encoder(tokenizer).encode, TaskContext.get().partitionId() << 40
        held, docs, n = [], [], 0

        def layout():
            return _layout(np.concatenate([i for i, _ in held]), np.concatenate([k for _, k in held]),
                           docs, capacity, pad_id, first)

        for batch in slices(batches, 1200):
            ids, lengths = with_end(*encode(batch.column("text")), end_id)
            held.append((ids, lengths))
            docs += batch.column("id").to_pylist()
            n += len(ids)
            if n >= LAYOUT_TOKENS:
                out = layout()
                yield from slices([out], 500)
                first += out.num_rows
                held, docs, n = [], [], 0
        if held:
            yield from slices([layout()], 500)

    return dealt.sortWithinPartitions("id", "tie").select("id", "text").mapInArrow(freed(pack, encoder), SCHEMA)


def piece_rows(windows: DataFrame) -> DataFrame:
    """One row per piece, with the crc32 of its ids as they lie in its window."""
    part = "substring(ids, CAST(4 * p.offset + 1 AS INT), CAST(4 * p.length AS INT))"
    return windows.select("sequence_id", "n_tokens", F.expr(
        "transform(pieces, p -> struct(p.doc_id, p.start, p.length, p.doc_tokens, p.offset, "
        f"crc32({part}) AS ids_crc32))").alias("p")).select(
        "sequence_id", "n_tokens", F.inline("p"))
