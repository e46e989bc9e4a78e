import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallygrid.llm import idfiles, packing
from tallygrid.llm.common import staged
from tallygrid.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", None, "It's DON'T we'll ''s x's! 't '''re", "12³½ ª", "é́ İ Σας", "<|endoftext|> hi", "你好 world",
       "foo\x1cbar\x85baz", "a" * 5000, "Ångström ß STRASSE ÿ Ÿ × ÷", "x\x00y", "'lL 'Ve 's", "naïve – “quote”"]


@pytest.fixture(scope="module")
def tool():
    return Encoder(PATH)


def same_as_library(tool, texts):
    ids, lengths = tool.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(lengths)
    want = [e.ids for e in tool.library.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[e - n:e].tolist() for e, n in zip(ends, lengths)] == want


def test_odd_texts_alone_and_together(tool):
    assert tool.by_words
    same_as_library(tool, ODD)
    for text in ODD:
        same_as_library(tool, [text])
    same_as_library(tool, ["plain words, only: 'tis"] * 3)
    assert len(tool.encode(pa.array([], pa.string()))[1]) == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sStvermld 1é\n.É×<|"), max_size=30), max_size=5))
def test_any_text(tool, texts):
    same_as_library(tool, texts)


def test_parts_of_long_batches(tool, monkeypatch):
    monkeypatch.setattr("tallygrid.llm.tokens.PART_BYTES", 50)
    monkeypatch.setattr("tallygrid.llm.tokens.CACHE_WORDS", 20)
    random.seed(1)
    same_as_library(tool, [" ".join(random.choices(["the", "it's", "é", "x" * 80, "12"], k=60)) for _ in range(20)])


def test_other_tokenizers_encode_whole():
    tool = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not tool.by_words
    same_as_library(tool, ["Hello  world", "", None])


ROWS = [(3, "the cat sat"), (1, None), (1, "the cat sat"), (None, "a null id"), (5, "word " * 30_000), (4, ""),
        (2, "the cat sat"), (-9, "negative"), (2, "the cat sat")]


def ids_of(tool, text, end):
    return tool.library.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_cover_every_document_once(documents, tool):
    windows = packing.packed(documents(ROWS), PATH, end_id=2, capacity=256, group_bytes=40_000)
    held = windows.collect()
    got = []
    for w in held:
        ids = np.frombuffer(w.ids, "<u4")
        power = w.n_tokens & (w.n_tokens - 1) == 0
        assert w.n_tokens <= 256 and len(ids) == (w.n_tokens if power else 256)
        at = 0
        for p in w.pieces:
            assert p.offset == at
            got.append((p.doc_id, p.start, p.doc_tokens, ids[at:at + p.length].tolist()))
            at += p.length
        assert at == w.n_tokens
    assert len({w.sequence_id for w in held}) == len(held)
    want = []
    for i, t in ROWS:
        ids = ids_of(tool, t, 2)
        want += [(i, s, len(ids), ids[s:s + 256]) for s in range(0, len(ids), 256)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    rows = packing.piece_rows(windows).collect()
    assert sorted((r.ids_crc32 for r in rows)) == sorted(crc(w[3]) for w in want)
    assert packing.packed(documents([]), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_takes_the_tightest_window(lengths):
    window, offset, n = packing.best_fit(lengths, 64)
    open_, want = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [room for room in open_ if room >= lengths[i]]
        room = min(fits) if fits else 64
        if fits:
            open_.remove(room)
        want[i] = 64 - room
        open_.append(room - lengths[i])
    assert n == len(open_) and offset == [want[i] for i in range(len(lengths))]
    used = [0] * n
    for w, x in zip(window, lengths):
        used[w] += x
    assert all(0 < u <= 64 for u in used)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), max_size=60))
def test_rank_code_round_trip(values):
    control, data = idfiles.pack_ranks(np.array(values, "<u4"))
    assert len(control) == -(-len(values) // 4)
    assert idfiles.unpack_ranks(control, data, len(values)).tolist() == values


def test_id_files_round_trip_in_order(cluster, documents, tool):
    rows = staged(idfiles.token_rows(documents(ROWS), PATH, end_id=1))
    manifest = idfiles.write_ids(rows, file_ids=20_000, block_ids=100)
    assert manifest.count() > 1
    back = idfiles.read_ids(cluster, manifest).orderBy("start").collect()
    assert [r.doc_id for r in back] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in back:
        assert r.start == at
        at += len(r.ids) // 4
    want = sorted(((i, crc(ids_of(tool, t, 1))) for i, t in ROWS), key=repr)
    assert sorted(((r.doc_id, zlib.crc32(r.ids)) for r in back), key=repr) == want
    sizes = manifest.agg({"n_ids": "sum", "n_docs": "sum"}).first()
    assert sizes["sum(n_ids)"] == at and sizes["sum(n_docs)"] == len(ROWS)


def test_no_documents_no_files(cluster, documents):
    rows = staged(idfiles.token_rows(documents([]), PATH, end_id=1))
    manifest = idfiles.write_ids(rows)
    assert manifest.count() == 0 and idfiles.read_ids(cluster, manifest).count() == 0


def test_damage_is_noticed(tmp_path):
    import struct
    table = zlib.compress(np.arange(10, dtype="<u4").tobytes())
    with open(tmp_path / "f", "wb") as out:
        out.write(idfiles.MAGIC + struct.pack("<I", len(table)) + table)
        idfiles.write_block(out, [1, None], np.array([2, 1]), np.array([3, 4, 5], "<u4"))
    raw = bytearray((tmp_path / "f").read_bytes())
    with open(tmp_path / "f", "rb") as source:
        [(docs, lengths, ids)] = idfiles.read_blocks(source)
    assert docs == [1, None] and lengths.tolist() == [2, 1] and ids.tolist() == [3, 4, 5]
    raw[-1] ^= 1
    (tmp_path / "f").write_bytes(raw)
    with open(tmp_path / "f", "rb") as source, pytest.raises(ValueError):
        list(idfiles.read_blocks(source))
