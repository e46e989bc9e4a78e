import hashlib
import io
import struct

import pytest
import zstandard

from tallygrid.llm import warc

PAGE = "page_id long, url string, html string, digest string, first long, n long"
BIG = "<p>" + "payload " * 30 + "</p>"
ROWS = [(5, "http://a/é b?x=1#y", BIG), (3, "http://b/", BIG), (4, None, BIG), (6, "u\r\nInjected: 1", "short"),
        (7, "http://c/", "short"), (8, "http://d/", None), (9, "http://e/", ""), (3, "http://b/", BIG),
        (None, "http://f/", BIG), (10, "http://g/", "ü" * 60), (11, "http://h/", "ü" * 60),
        (12, "http://i/", "x\r\n\r\ny" * 50_000), (None, "http://j/", "only null ids " * 20)]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], PAGE)


def expected(rows):
    firsts = {}
    for i, _, t in rows:
        t = (t or "").encode()
        if i is not None and len(t) >= 100:
            firsts[t] = min(firsts.get(t, i), i)
    out = []
    for i, _, t in rows:
        t = (t or "").encode()
        first = firsts.get(t)
        again = first is not None and first != i and sum((x[2] or "").encode() == t for x in rows) > 1
        out.append((i, len(t), hashlib.sha256(t).hexdigest(), "revisit" if again else "response",
                    first if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [2_000, 64 << 20])
def test_round_trip(cluster, rows, size):
    manifest = warc.write_archives(warc.with_revisits(pages(cluster, ROWS)), archive_bytes=size, sample_bytes=size)
    back = warc.read_archives(cluster, manifest)
    assert sorted(rows(back.select(warc.page_id("record_id"), "payload_bytes", "payload_digest", "record_type",
                                   warc.page_id("refers_to"))), key=repr) == expected(ROWS)
    held = {r.payload_digest: bytes(r.payload) for r in back.where("record_type = 'response'").collect()}
    assert held == {hashlib.sha256((t or "").encode()).hexdigest(): (t or "").encode() for _, _, t in ROWS}
    urls = [r.url for r in back.collect()]
    assert urls.count(None) == 1 and "u%0D%0AInjected:%201" in urls and "http://a/%C3%A9%20b?x=1#y" in urls


def test_no_pages(cluster):
    manifest = warc.write_archives(warc.with_revisits(pages(cluster, [])))
    assert manifest.count() == 0 and warc.read_archives(cluster, manifest).count() == 0


def archive(records, samples=None):
    known, frame = warc.dictionary_frame(samples or records)
    tool = zstandard.ZstdCompressor(dict_data=known, write_checksum=True) if known else zstandard.ZstdCompressor()
    return known, frame + b"".join(tool.compress(r) for r in records)


def some(n=300):
    digest = lambda p: hashlib.sha256(p).hexdigest()
    payloads = [f"<html>{i} {'text ' * (i % 50)}</html>".encode() for i in range(n)]
    return payloads, [warc.record(i, f"http://x/{i}", p, digest(p), None) for i, p in enumerate(payloads)]


@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_the_dictionary_is_needed_and_found(chunk):
    payloads, records = some()
    known, raw = archive(records)
    assert known and struct.unpack("<I", raw[:4])[0] == warc.SKIPPABLE
    assert [r["payload"] for r in warc.read_archive(io.BytesIO(raw), chunk)] == payloads
    size = struct.unpack("<I", raw[4:8])[0]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.read_archive(io.BytesIO(struct.pack("<II", warc.SKIPPABLE, 0) + raw[8 + size:])))


def test_plain_dictionaries_and_frames_of_every_form():
    payloads, records = some(40)
    known = zstandard.ZstdCompressionDict(b"".join(records)[:5000], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    body = known.as_bytes()
    frames = b""
    for i, r in enumerate(records):
        tool = zstandard.ZstdCompressor(dict_data=known, write_checksum=bool(i % 2), write_content_size=bool(i % 3))
        frames += tool.compress(r) if i % 5 else tool.compressobj().compress(b"") + (
            lambda o: o.compress(r) + o.flush())(tool.compressobj())
    raw = struct.pack("<II", warc.SKIPPABLE, len(body)) + body + frames
    assert [r["payload"] for r in warc.read_archive(io.BytesIO(raw))] == payloads


def test_damage_is_noticed():
    payloads, records = some(3)
    good = records[0]
    for bad in (good.replace(b"WARC/1.1", b"WARC/9"), good[:-1], good + b"x", good.replace(b"<html>0", b"<html>1"),
                good.replace(b"WARC-Type", b"X-Type"), good.replace(b"Content-Length: ", b"Content-Length: 1", 1),
                good.replace(b"WARC-Date", b"WARC-Type")):
        with pytest.raises(ValueError):
            warc.parse(bad)
    _, raw = archive(records)
    for cut in (raw[:-2], raw[:20], b"\0" * 8 + raw[8:]):
        with pytest.raises(ValueError):
            list(warc.read_archive(io.BytesIO(cut)))
