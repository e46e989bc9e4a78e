import itertools
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tallygrid.llm import sentencepieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", None, "  Hello   world\n\tfoo ﬁ Ⅷ é 你好 🤖  ", "a▁b", "aaaa" * 400, "It's DON'T     we'll", "\x00\x01 x",
         "ААА привет мир Καλημέρα", "http://foo.bar/baz?x=1 1234567890", "=" * 300 + "-" * 77, " " * 100 + "x",
         "http" * 100 + "日本語テキスト" * 50, "</s> <unk> <0x41>", "x\r\ny"]


@pytest.fixture(scope="module")
def tool():
    return sp.Coder(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(tool, library, texts):
    ids, lengths = tool.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(lengths)
    got = [ids[e - n:e].tolist() for e, n in zip(ends, lengths)]
    want = library.encode([t or "" for t in texts])
    assert got == want
    assert [tool.decode(i) for i in got] == [library.decode(i) for i in want]


def test_ids_and_texts_are_the_library_s(tool, library):
    same(tool, library, TEXTS)
    for text in TEXTS:
        same(tool, library, [text])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab etlohisr.\n▁é=-1你"), max_size=50), max_size=3))
def test_any_text(tool, library, texts):
    same(tool, library, texts)


def best_by_trying(text, scores, floor):
    best = None
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        parts, last = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(text[last:i])
                last = i
        parts.append(text[last:])
        if all(p in scores or len(p) == 1 for p in parts):
            total = sum(scores.get(p, floor) for p in parts)
            if best is None or total > best[0]:
                best = (total, parts)
    return best


def test_unigram_search_finds_the_best_and_holds_a_window():
    rng = random.Random(5)
    names = {c for c in "abc"} | {"".join(rng.choices("abcd", k=rng.randint(2, 4))) for _ in range(30)}
    scores = {n: -rng.uniform(1, 5) * len(n) ** .5 for n in sorted(names)}
    model = sp.Pieces({n: i for i, n in enumerate(scores)}, scores, sp.UNIGRAM, None, 99)
    for _ in range(60):
        text = "".join(rng.choices("abcd", k=rng.randint(1, 11)))
        search = sp.Search(model)
        found = search.push(text) + search.finish()
        total, _ = best_by_trying(text, scores, model.floor)
        assert "".join(found) == text
        assert abs(sum(scores.get(p, model.floor) for p in found) - total) < 1e-9
    text = "".join(rng.choices("abcd", k=5000))
    whole, early = sp.Search(model), []
    out = whole.push(text)
    assert len(out) > 100 and whole.most_held < 200  # ids come out on the way
    early = out + whole.finish()
    at = [0.0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        at[end] = max(at[s] + scores.get(text[s:end], model.floor) for s in range(max(0, end - 4), end)
                      if text[s:end] in scores or end - s == 1)
    assert abs(sum(scores.get(p, model.floor) for p in early) - at[-1]) < 1e-6
    assert model.ids_of("d") == [99]


def test_a_long_text_without_blanks_is_streamed(tool, library):
    text = "abcdefghij" * 3000
    search = sp.Search(tool.model)
    pieces = search.push(sp.BLANK + text)
    assert pieces and search.most_held < 200
    pieces += search.finish()
    assert [i for p in pieces for i in tool.model.ids_of(p)] == library.encode(text)


def test_over_a_table(cluster, documents, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3])]
    frame = documents(rows).withColumnRenamed("node", "decoded")
    back = sp.decoded(sp.encoded(frame, PATH), PATH).collect()
    assert sorted(r.doc_id for r in back) == sorted(i for i, _ in rows)
    for r in back:
        text = TEXTS[r.doc_id] or ""
        assert r.ids == library.encode(text) and r.decoded == library.decode(r.ids)
        assert r.text == TEXTS[r.doc_id] and r.digest == "x" and r.score == "y"
    assert sp.decoded(sp.encoded(documents([]), PATH), PATH).count() == 0
    nulls = cluster.createDataFrame([(None,), ([],), ([300, 13],)], "ids array<int>")
    assert [r.decoded for r in sp.decoded(nulls, PATH).collect()] == ["", "", library.decode([300, 13])]
