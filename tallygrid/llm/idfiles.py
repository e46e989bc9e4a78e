"""Token ids as files: frequency-ranked, byte-aligned variable-length code.

Every id is replaced by its rank by corpus frequency, so the most frequent take one byte.
A rank takes one to four bytes, little-endian; its length less one is a two-bit code, and
the codes of four ranks make one control byte. Control bytes and data bytes lie apart, so
a block is decoded by looking control bytes up in a table of byte masks.

A file: magic, length and zlib form of the ids in rank order, then blocks. A block: header
(documents, ids, control and data bytes, crc32 of what follows), document ids as int64,
one byte each that tells NULL ids, code of the documents' lengths, code of the ranks.
Files hold ranges of document ids in ascending order; the manifest (one row a file) is
written by Spark, so files of failed or repeated task attempts are never read.

Defined cases: a NULL or empty text has the end id only; NULL document ids come first;
rows that repeat an id follow each other in the order of a hash of their ids; a text of
any length stays whole; an empty table gives no file and no row. Only the two named
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import folder_uri, new_file, open_file, slices, staged, text_of
from .tokens import encoder, with_end

MAGIC = b"VARIDS01"
HEAD = struct.Struct("<4sIIIII")
FILE_IDS = 16_000_000
BLOCK_IDS = 1_000_000
# Per control byte: the lengths of its four ranks, and the bytes present of their 4 x 4.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) % 4 + 1
MASKS = (np.arange(4) < LENGTHS[..., None]).reshape(256, 16)
MANIFEST = "part int, file string, n_docs long, n_ids long, n_bytes long"
ROWS = "doc_id long, start long, ids binary"


def pack_ranks(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    codes = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    four = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    four[:len(codes)] = codes
    control = (four.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]]
    return control.tobytes(), data.tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values that ``pack_ranks`` coded."""
    mask = MASKS[np.frombuffer(control, np.uint8)].reshape(-1, 4)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[mask] = np.frombuffer(data, np.uint8)
    return out.view("<u4").ravel()


def _sized(control: bytes, data: bytes) -> bytes:
    return struct.pack("<II", len(control), len(data)) + control + data


def write_block(out, doc_ids: list, lengths: np.ndarray, ranks: np.ndarray) -> None:
    null = np.array([d is None for d in doc_ids], np.uint8)
    control, data = pack_ranks(ranks)
    body = (np.array([d or 0 for d in doc_ids], "<i8").tobytes() + null.tobytes()
            + _sized(*pack_ranks(lengths)) + control + data)
    out.write(HEAD.pack(b"BLCK", len(doc_ids), len(ranks), len(control), len(data), zlib.crc32(body)))
    out.write(body)


def read_blocks(source) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(document ids, ids per document, ids) of each block of an open file."""
    if source.read(8) != MAGIC:
        raise ValueError("not an id file")
    (n,) = struct.unpack("<I", source.read(4))
    by_rank = np.frombuffer(zlib.decompress(source.read(n)), "<u4")
    while head := source.read(HEAD.size):
        magic, docs, n, controls, datas, crc = HEAD.unpack(head)
        at, sized = 9 * docs, struct.Struct("<II")
        body = source.read(at + sized.size)
        c, d = sized.unpack_from(body, at)
        body += source.read(c + d + controls + datas)
        if magic != b"BLCK" or zlib.crc32(body) != crc:
            raise ValueError("damaged block")
        null = np.frombuffer(body, np.uint8, docs, 8 * docs)
        ids = [None if x else i for i, x in zip(np.frombuffer(body, "<i8", docs).tolist(), null)]
        at += sized.size
        lengths = unpack_ranks(body[at:at + c], body[at + c:at + c + d], docs).astype(np.int64)
        at += c + d
        ranks = unpack_ranks(body[at:at + controls], body[at + controls:], n)
        yield ids, lengths, by_rank[ranks]


def token_rows(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *,
               end_id: int) -> DataFrame:
    """(doc_id, ids, n): each text's ids and the end id, in two or four bytes an id."""

    def encode(batches):
        tool = encoder(tokenizer)
        kind = "<u2" if max(tool.vocabulary, end_id + 1) <= 1 << 16 else "<u4"
        for batch in slices(batches, 1200):
            ids, lengths = with_end(*tool.encode(batch.column("text")), end_id)
            raw, width = ids.astype(kind).tobytes(), int(kind[-1])
            ends = np.cumsum(lengths) * width
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([raw[e - n * width:e] for e, n in zip(ends.tolist(), lengths.tolist())], pa.binary()),
                 pa.array(lengths)], ["doc_id", "ids", "n"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")
                     ).mapInArrow(encode, "doc_id long, ids binary, n long")


def _read_ids(column: pa.Array, lengths: list[int]) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * sum(lengths) else "<u4")


def id_counts(rows: DataFrame) -> DataFrame:
    """(id, n) over all token rows; a task adds its rows up before the shuffle."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in slices(batches, 2000):
            found = np.bincount(_read_ids(batch.column("ids"), batch.column("n").to_pylist()))
            if len(found) > len(total):
                found, total = total, found
            total[:len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    return rows.select("ids", "n").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(rows: DataFrame, *, file_ids: int = FILE_IDS, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write token rows as id files in ascending document order; returns the manifest.

    ``rows`` is read several times, so it should be staged. What the driver holds is the
    table of ranks, one entry for each id of the vocabulary at most.
    """
    spark = rows.sparkSession
    counts = id_counts(rows).collect()
    total = sum(r["n"] for r in counts)
    by_rank = np.array([r["id"] for r in sorted(counts, key=lambda r: (-r["n"], r["id"]))], "<u4")
    rank = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, "<u4")
    rank[by_rank] = np.arange(len(by_rank), dtype="<u4")
    table = zlib.compress(by_rank.tobytes())
    folder = folder_uri(spark, "ids")
    tie = F.xxhash64("ids")
    ranged = (rows.repartitionByRange(max(1, -(-total // file_ids)), F.col("doc_id"), tie)
              .sortWithinPartitions(F.col("doc_id"), tie))

    def write(batches):
        from pyspark import TaskContext

        docs = ids = 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        with new_file(folder, ".varids") as (address, out):
            out.write(MAGIC + struct.pack("<I", len(table)) + table)
            held, n = [], 0

            def flush():
                write_block(out, [d for b in held for d in b.column("doc_id").to_pylist()],
                            np.concatenate([b.column("n").to_numpy() for b in held]),
                            np.concatenate([rank[_read_ids(b.column("ids"), b.column("n").to_pylist())]
                                            for b in held]))

            for batch in slices((b for part in ([first], batches) for b in part), 200):
                held.append(batch)
                size = int(batch.column("n").to_numpy().sum())
                n, docs, ids = n + size, docs + batch.num_rows, ids + size
                if n >= block_ids:
                    flush()
                    held, n = [], 0
            if held:
                flush()
            size = out.tell()
        yield pa.RecordBatch.from_pylist([{
            "part": TaskContext.get().partitionId(), "file": address, "n_docs": docs,
            "n_ids": ids, "n_bytes": size}])

    schema = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()),
                        ("n_ids", pa.int64()), ("n_bytes", pa.int64())])

    def typed(batches):
        for b in write(batches):
            yield b.cast(schema)

    return staged(ranged.mapInArrow(typed, MANIFEST))


def read_ids(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids) from the files of a manifest; start counts the ids of all
    documents before, ids are little-endian unsigned 32-bit."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                at = row["start"]
                with open_file(row["file"]) as source:
                    for docs, lengths, ids in read_blocks(source):
                        raw, ends = ids.astype("<u4").tobytes(), np.cumsum(lengths)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(docs, pa.int64()), pa.array(at + ends - lengths),
                             pa.array([raw[4 * (e - n):4 * e] for e, n in
                                       zip(ends.tolist(), lengths.tolist())], pa.binary())],
                            ["doc_id", "start", "ids"])
                        at += int(ends[-1])

    parts = max(1, manifest.count())
    numbered = files.withColumn("part", F.row_number().over(Window.orderBy("start", "file")) - 1)
    return numbered.repartitionById(parts, F.col("part").cast("int")).select("file", "start").mapInArrow(read, ROWS)
