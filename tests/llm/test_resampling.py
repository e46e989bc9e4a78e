import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallygrid.llm import resampling

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
KIND = "doc_id long, text string, id string, rank int, n long, bucket long"


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def features(text, longest):
    w = words(text)
    return [" ".join(w[i:i + n]).encode() for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet=st.sampled_from("abZ9é漢😀 .,-\n\x7f`{"), max_size=60), st.integers(1, 4))
def test_crcs_of_runs_from_prefixes(text, longest):
    got = resampling.ngram_crcs(text.encode(), longest)
    assert got.tolist() == [crc32(f) for f in features(text, longest)]


def test_long_words_and_texts_cut_in_chunks(monkeypatch):
    text = "x" * 70_000 + " " + " ".join(f"w{i % 97}" for i in range(20_000)) + " " + "é" * 30_000
    monkeypatch.setattr(resampling, "CHUNK", 1000)
    assert resampling.ngram_crcs(text.encode(), 3).tolist() == [crc32(f) for f in features(text, 3)]


def expected(docs, target, longest, buckets, percent, least):
    s, t = Counter(), Counter()
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            counts.update(crc32(f) % buckets for f in features(text, longest))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for i, text in docs:
        found = features(text, longest)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
                     for b in (crc32(f) % buckets for f in found))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None])
    able = [r for r, d in zip(out, docs) if len(words(d[1])) >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[:len(able) * percent // 100]):
        row[4] = place + 1
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("longest, buckets, part", [(1, 10_000, 1_000_000), (3, 97, 7)])
def test_scores_and_ranks_equal_plain_ones(cluster, rows, longest, buckets, part):
    vocabulary = [f"word{i}" for i in range(40)] + ["Été", "漢字", "x-y"]
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 60)))) for i in range(200)]
    docs += [(900, None), (901, ""), (902, "?!"), (None, "word1 " * 30), (903, "long " * 30_000),
             (5, docs[5][1]), (5, docs[5][1]), (904, "word1 word2 " * 10), (905, "word1 " * 19)]
    target = ["word1 word2 word3", "word2 Été", None, "漢字 word5"]
    df = cluster.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in docs], KIND)
    other = cluster.createDataFrame([(t, 1) for t in target], "text string, id int")
    got = resampling.resampled(df, other, longest=longest, buckets=buckets, percent=50, least_words=20,
                               part_rows=part)
    assert rows(got) == expected(docs, target, longest, buckets, 50, 20)


def test_empty_tables(cluster, rows):
    none = cluster.createDataFrame([], KIND)
    assert resampling.resampled(none, none).collect() == []
    docs = [(1, "a b c " * 10), (2, "d e f " * 10)]
    df = cluster.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in docs], KIND)
    assert rows(resampling.resampled(df, none, percent=50)) == expected(docs, [], 1, 10_000, 50, 20)
