import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallygrid.llm import katz
from tallygrid.llm.common import LOWER, UPPER
from tallygrid.llm.wordhash import space_words

TO_LOWER = str.maketrans(UPPER, LOWER)


def cut(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(TO_LOWER)) + [None]


class Plain:
    """The same model in dictionaries."""

    def __init__(self, texts, least=2):
        self.c1, self.c2, self.after = Counter(), Counter(), Counter()
        for text in texts:
            before = 0
            for w in cut(text):
                self.c1[w] += 1
                self.c2[before, w] += 1
                self.after[before] += 1
                before = w
        self.n, self.v = sum(self.c1.values()), len(self.c1)
        self.d1, self.d2 = (katz.discounts(Counter(c.values())) for c in (self.c1, self.c2))
        left = sum((1 - self.d1[c - 1]) * c for c in self.c1.values() if c <= katz.K) / self.n
        self.unknown, scale = (left, 1) if left > 0 else (1 / (self.n + 1), self.n / (self.n + 1))
        self.p1 = {w: self._less(c, self.d1) * scale / self.n for w, c in self.c1.items()}
        self.kept = {k: c for k, c in self.c2.items() if c >= least}
        own, seen = defaultdict(float), defaultdict(float)
        for (h, w), c in self.kept.items():
            own[h] += self._less(c, self.d2)
            seen[h] += self.p1[w]
        self.g, self.a = {}, {}
        for h in own:
            share, most = own[h] / self.after[h], self.after[h] / (self.after[h] + 1)
            self.g[h], self.a[h] = min(1, most / share), (1 - min(share, most)) / (1 - seen[h])

    @staticmethod
    def _less(c, d):
        return c * d[c - 1] if c <= katz.K else c

    def p(self, h, w):
        if (h, w) in self.kept:
            return self.g[h] * self._less(self.kept[h, w], self.d2) / self.after[h]
        return self.a.get(h, 1) * self.p1.get(w, self.unknown)

    def score(self, text):
        before, total, base, known, n = 0, 0.0, 0.0, 0, 0
        for w in cut(text):
            total += math.log10(self.p(before, w))
            base += math.log10((self.c1.get(w, 0) + .1) / (self.n + .1 * (self.v + 1)))
            known, n, before = known + (w in self.c1), n + 1, w
        return n, known, self.n, round(base, 6), round(total, 6)


def texts(n, seed):
    rng = random.Random(seed)
    words = ["The", "the", "cat", "dog", "É", "é", "|", "ran"] + [f"w{i}" for i in range(80)]
    weights = [30, 30, 9, 9, 3, 3, 40, 9] + [80 / (i + 1) for i in range(80)]
    return [" ".join(rng.choices(words, weights, k=rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    return [(i, t) for i, t in enumerate(texts(300, 1))] + [
        (300, None), (301, ""), (302, "  \t\n\v\f\r "), (303, "The the cat " * 20_000), (5, "the cat"), (5, "the cat"),
        (None, "the dog"), (304, "entirely unheard of"), (305, "a\x00b\x1fc\x85d\xa0e\x1cf")]


def test_probabilities_add_up_to_one(rows):
    model = Plain([t for i, t in rows if i is not None and i % 3])
    for h in [0, *list(model.a)[:20], "unseen"]:
        total = sum(model.p(h, w) for w in model.c1) + model.a.get(h, 1) * model.unknown
        assert abs(total - 1) < 1e-9


@pytest.mark.parametrize("small", [False, True])
def test_equals_the_plain_model(documents, rows, monkeypatch, small):
    if small:  # many chunks, parts and cold keys
        for name, value in (("PART_PAIRS", 200), ("PART_KEYS", 100), ("CHUNK_PAIRS", 500), ("CHUNK_ROWS", 7)):
            monkeypatch.setattr(katz, name, value)
    frame = documents(rows)
    model = katz.fit(frame.where("doc_id % 3 > 0"), **({"hot_words": 3, "hot_keys": 20, "bitmap": 14} if small else {}))
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                  for r in katz.evaluate(frame, model).collect()), key=repr)
    plain = Plain([t for i, t in rows if i is not None and i % 3])
    want = sorted(((i, *plain.score(t)) for i, t in rows), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=1e-4, rel=1e-9)


@pytest.mark.parametrize("least,small", [(1, False), (1, True), (3, False)])
def test_bigrams_seen_once_are_kept_if_asked_for(documents, rows, monkeypatch, least, small):
    if small:
        for name, value in (("PART_PAIRS", 200), ("PART_KEYS", 100), ("CHUNK_PAIRS", 500), ("CHUNK_ROWS", 7)):
            monkeypatch.setattr(katz, name, value)
    frame = documents(rows)
    model = katz.fit(frame.where("doc_id % 3 > 0"), min_count=least,
                     **({"hot_words": 3, "hot_keys": 20, "bitmap": 14} if small else {}))
    got = sorted(((r.doc_id, r.n_tokens, r.score) for r in katz.evaluate(frame, model).collect()), key=repr)
    plain = Plain([t for i, t in rows if i is not None and i % 3], least)
    want = sorted(((i, plain.score(t)[0], plain.score(t)[-1]) for i, t in rows), key=repr)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in want], abs=1e-4, rel=1e-9)


def test_the_query_keeps_every_bigram(cluster, monkeypatch):
    from tallygrid.llm import queries

    asked, fit = [], katz.fit
    monkeypatch.setattr(katz, "fit", lambda *a, **k: asked.append(k.get("min_count")) or fit(*a, **k))
    queries.QUERIES["op9_katz"](cluster, "/root/testdata/sf0.001")
    assert asked == [1]


def test_held_out_texts_beat_the_base(documents):
    rng = random.Random(9)
    follow = {f"w{i}": [f"w{rng.randrange(80)}" for _ in range(3)] for i in range(80)}

    def walk():
        word, out = "w0", []
        for _ in range(40):
            word = rng.choice(follow[word]) if rng.random() < .9 else f"w{rng.randrange(80)}"
            out.append(word)
        return " ".join(out)

    frame = documents([(i, walk()) for i in range(300)])
    scores = katz.evaluate(frame.where("doc_id % 3 = 0"), katz.fit(frame.where("doc_id % 3 > 0")))
    total = scores.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert total.s > total.b


def test_without_texts(documents):
    model = katz.fit(documents([]))
    [r] = katz.evaluate(documents([(1, "two words")]), model).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.score) == (3, 0, 0, 0.0)
    assert katz.evaluate(documents([]), katz.fit(documents([(1, "a b a b")]))).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB é\t\n\x0b\x1c\x85\xa0ß|"), max_size=20), max_size=6))
def test_words_are_cut_as_defined(lines):
    hashed, n = space_words(pa.array(lines, pa.string()))
    own = [cut(t)[:-1] for t in lines]
    assert n.tolist() == [len(w) for w in own]
    flat = [w for ws in own for w in ws]
    assert len(set(zip(flat, hashed.tolist()))) == len(set(flat)) == len(set(hashed.tolist()))


def test_cutting_holds_few_texts_at_a_time():
    """Beside what it returns; it was over 60 bytes for each byte of text."""
    texts = pa.array([" ".join(f"word{(i * 31 + j) % 977}" for j in range(400)) for i in range(katz.CHUNK_ROWS)])
    katz.tokens(texts.slice(0, 2))
    tracemalloc.start()
    out = katz.tokens(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak - 2 * sum(x.nbytes for x in out) < 16 * texts.nbytes
    alone = [katz.tokens(texts.slice(i, 1)) for i in range(len(texts))]
    assert all((a == np.concatenate(b)).all() for a, b in zip(out, zip(*alone)))


def test_the_table_stays_in_its_files(documents):
    """Evaluation is told where the entries are; they are not shuffled again beside the requests."""
    model = katz.fit(documents([(i, f"a b{i % 3} c") for i in range(30)]))
    files = [r.file for r in model.table.collect()]
    assert model.table.columns == ["part", "file"] and len(files) == len(set(files)) > 0
    assert sum(len(keys) for f in files for keys, *_ in katz._entries(f)) > 0


def test_columns_are_given_up_as_they_are_joined():
    held = [[np.arange(3), np.arange(3.0)], [np.arange(2), np.arange(2.0)]]
    first = held[0]
    joined = katz._concatenated(held)
    assert [x.tolist() for x in joined] == [[0, 1, 2, 0, 1], [0.0, 1.0, 2.0, 0.0, 1.0]]
    assert held == [] and first == [None, None]


def test_planes_round_trip():
    values = np.array([0, 1, 2 ** 40, 2 ** 64 - 1], np.uint64)
    assert katz.from_planes(katz.planes(values), "<u8").tolist() == values.tolist()
    assert katz.from_planes(b"", "<u8").tolist() == []
