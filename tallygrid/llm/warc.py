"""WARC archives in Zstandard form (``.warc.zst``): writing, and reading them back.

An archive begins with its dictionary, compressed, in a skippable frame; then each record
is a frame of its own. The dictionary is trained on the archive's first records
(``sample_bytes`` of them at most); it changes sizes only, never contents. The reader loads
it from that frame, finds each frame's end from its block headers, decodes one frame at a
time and checks version, headers, lengths, block ends and digests.

Of records with equal payloads of at least ``min_revisit`` bytes, that with the smallest
id is a response and the others are revisits that refer to it and carry no payload. The
smallest id per digest is combined within map tasks before the shuffle, and the records
of a hot payload meet it in a plain shuffle join that Spark can split.

Defined cases: a NULL payload is empty; a NULL address leaves the header out; control
characters, blanks and non-ASCII characters of an address are percent-encoded in the
header; rows that repeat an id are records each, and refer to the same response; a NULL id
never becomes a response others refer to, unless all ids of that payload are NULL; an
empty table gives no archive and no record. Only the three named columns are read, so
other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import struct
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import folder_uri, new_file, open_file, slices, staged

MIN_REVISIT = 100
ARCHIVE_BYTES = 64 << 20
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 32 << 10
SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "file string, n_records long, n_bytes long"
RECORDS = ("record_id string, record_type string, url string, refers_to string, "
           "payload_digest string, payload_bytes long, payload binary")


# -- one record ---------------------------------------------------------------

def record_uri(page_id) -> str:
    return f"urn:x-page:{'null' if page_id is None else page_id}"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """The bytes of a response, or of a revisit where ``refers_to`` is given."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to else http + payload
    lines = [f"WARC-Type: {'revisit' if refers_to else 'response'}",
             f"WARC-Record-ID: <{record_uri(page_id)}>", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha256:{digest}",
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The record in ``raw``; ValueError says what is wrong with a bad one."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version not in ("WARC/1.0", "WARC/1.1") or not gap:
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in fields:
            raise ValueError(f"bad header line {line[:80]!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name}")
    if not fields["content-length"].isdigit():
        raise ValueError("bad content-length")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{len(rest) - 4} bytes of block, {size} announced")
    block, kind = rest[:size], fields["warc-type"]
    _check_digest(fields.get("warc-block-digest"), block)
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [int(v.split(b":")[1]) for v in http.split(b"\r\n") if v.lower().startswith(b"content-length:")]
    announced = sizes[0] if sizes else len(payload)
    digest = fields.get("warc-payload-digest")
    if kind == "response":
        if announced != len(payload):
            raise ValueError(f"{len(payload)} bytes of payload, {announced} announced")
        _check_digest(digest, payload)
    elif kind == "revisit":
        if "warc-refers-to" not in fields or digest is None:
            raise ValueError("a revisit that does not say of what")
        payload = None
    return {"record_id": fields["warc-record-id"].strip("<>"), "record_type": kind,
            "url": fields.get("warc-target-uri"),
            "refers_to": fields["warc-refers-to"].strip("<>") if kind == "revisit" else None,
            "payload_digest": digest.removeprefix("sha256:") if digest else None,
            "payload_bytes": announced, "payload": payload}


def _check_digest(stated: str | None, data: bytes) -> None:
    if stated and stated.startswith("sha256:") and stated[7:] != hashlib.sha256(data).hexdigest():
        raise ValueError("digest does not match")


# -- one archive --------------------------------------------------------------

def dictionary_frame(samples: list[bytes]) -> tuple[zstandard.ZstdCompressionDict | None, bytes]:
    """(dictionary, skippable frame that holds it); none where there is too little to learn."""
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return None, struct.pack("<II", SKIPPABLE, 0)
    body = zstandard.ZstdCompressor(level=9).compress(trained.as_bytes())
    return trained, struct.pack("<II", SKIPPABLE, len(body)) + body


def frame_size(buffer, at: int) -> int | None:
    """Bytes of the Zstandard frame at ``at``; None if the buffer ends before it does."""
    if at + 5 > len(buffer):
        return None
    (magic,) = struct.unpack_from("<I", buffer, at)
    if magic != FRAME:
        raise ValueError("not a Zstandard frame")
    flags = buffer[at + 4]
    single, checksum = flags >> 5 & 1, flags >> 2 & 1
    end = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
    while True:
        if end + 3 > len(buffer):
            return None
        header = int.from_bytes(buffer[end:end + 3], "little")
        end += 3 + (1 if header >> 1 & 3 == 1 else header >> 3)
        if header & 1:
            break
    end += 4 * checksum
    return end - at if end <= len(buffer) else None


def read_archive(source, chunk: int = 1 << 20) -> Iterator[dict]:
    """The records of an open archive; holds a chunk and one record at a time."""
    head = source.read(8)
    if not head:
        return
    magic, size = struct.unpack("<II", head)
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    body = source.read(size)
    if len(body) != size:
        raise ValueError("cut off in the dictionary")
    known = None
    if size:
        if body[:4] == struct.pack("<I", FRAME):
            body = zstandard.ZstdDecompressor().decompress(body)
        known = zstandard.ZstdCompressionDict(body)
    tool = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    buffer, at = b"", 0
    while True:
        size = frame_size(buffer, at) if at < len(buffer) else None
        if size is None:
            more = source.read(max(chunk, len(buffer) - at))
            if not more:
                if at < len(buffer):
                    raise ValueError("cut off in a record")
                return
            buffer, at = buffer[at:] + more, 0
            continue
        yield parse(tool.decompressobj().decompress(buffer[at:at + size]))
        at += size


# -- as Spark jobs ------------------------------------------------------------

def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", *, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is NULL for responses."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = staged(rows.where(F.octet_length("payload") >= min_revisit).groupBy("digest")
                    .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1 AND first IS NOT NULL").drop("n"))
    found = rows.join(firsts, "digest", "left")
    return found.select("page_id", "url", "payload", "digest", F.when(
        ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, *, archive_bytes: int = ARCHIVE_BYTES,
                   sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Write the records of ``with_revisits`` to archives of about ``archive_bytes`` of
    uncompressed records each; returns their manifest, one row an archive."""
    folder = folder_uri(records.sparkSession, "warc")

    def rows(batches):
        for batch in slices(batches, 200):
            for r in batch.to_pylist():
                refers_to = None if r["refers_to"] is None else record_uri(r["refers_to"])
                yield record(r["page_id"], r["url"], r["payload"], r["digest"], refers_to)

    def write(batches):
        source = rows(batches)
        done = False
        while not done:
            held, size = [], 0
            while size < sample_bytes and not done:
                one = next(source, None)
                done = one is None
                if not done:
                    held.append(one)
                    size += len(one)
            if not held:
                break
            known, frame = dictionary_frame(held)
            tool = (zstandard.ZstdCompressor(level=3, dict_data=known, write_checksum=True) if known
                    else zstandard.ZstdCompressor(level=3, write_checksum=True))
            with new_file(folder, ".warc.zst") as (address, out):
                out.write(frame)
                n = len(held)
                for one in held:
                    out.write(tool.compress(one))
                while size < archive_bytes and not done:
                    one = next(source, None)
                    done = one is None
                    if not done:
                        out.write(tool.compress(one))
                        n, size = n + 1, size + len(one)
                stored = out.tell()
            yield pa.RecordBatch.from_pylist([{"file": address, "n_records": n, "n_bytes": stored}])

    return staged(records.mapInArrow(write, MANIFEST))


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """The records of the archives of a manifest, a task for each archive."""
    schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
                        for n, t in (x.split() for x in RECORDS.split(", "))])

    def read(batches):
        for batch in batches:
            for address in batch.column("file").to_pylist():
                with open_file(address) as source:
                    held, size = [], 0
                    for one in read_archive(source):
                        held.append(one)
                        size += one["payload_bytes"]
                        if size > 4 << 20 or len(held) >= 2000:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    return manifest.select("file").repartition(max(1, manifest.count()), "file").mapInArrow(read, RECORDS)


def page_id(column: str):
    """The page id in a record name, as a column; NULL for the NULL id."""
    return F.expr(f"try_cast(substring_index({column}, ':', -1) AS long)")
