import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallygrid.llm import toxicity as tx

GOOD = "the garden was quiet and many people walked along river while children played music".split()
BAD = "idiot moron stupid trash loser".split()


def decoder(texts):
    counts = Counter()
    for text in texts:
        codes = [0, 0] + [int(tx.SYMBOL[b]) for b in text.lower().encode()] + [0, 0]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            if b or c:
                counts[(a * tx.N + b) * tx.N + c] += 1
    return tx.Decoder(tx.CharModel(np.array(list(counts)), np.array(list(counts.values()), float)))


@pytest.fixture(scope="module")
def tool():
    return decoder([" ".join(GOOD + BAD)] * 50)


@pytest.mark.parametrize("hidden,shown", [
    ("1d10t", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("tr4sh", "trash"), ("l0s3r", "loser"),
    ("i d i o t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooooot", "idiot"), ("l-o-s-e-r", "loser"),
    ("m o r 0 n", "moron"), ("StuUupid", "stupid"), ("id!ot", "idiot")])
def test_spans_are_restored(tool, hidden, shown):
    text = f"The garden {hidden} was quiet."
    assert tool.restore(pa.array([text])).to_pylist() == [f"The garden {shown} was quiet."]


@pytest.fixture(scope="module")
def wide():
    return decoder([" ".join(GOOD + BAD + "shit kill ass well known vacuum letter".split())] * 50)


@pytest.mark.parametrize("hidden,shown", [
    ("idi07", "idiot"), ("sh17", "shit"), ("ki11", "kill"), ("a55", "ass"), ("a$$", "ass"), ("5h17", "shit"),
    ("1d107", "idiot"), ("id-iot", "idiot"), ("st-upid", "stupid"), ("1.d.1.0.t", "idiot"), ("stuupid", "stupid"),
    ("iddiioott", "idiot"), ("i:d:i:o:t", "idiot"), ("i*d*i*o*t", "idiot"), ("m*r*n", "moron")])
def test_fainter_marks_are_read_too(wide, hidden, shown):
    text = f"The garden {hidden} was quiet."
    assert wide.restore(pa.array([text])).to_pylist() == [f"The garden {shown} was quiet."]


def test_words_the_model_knows_stay(wide):
    texts = ["A Letter, children!! and vacuum", "well-known Garden 12345", "Kill", "quiet! 3 people: walked.", "a$$$ quiet*** walked!!!"]
    assert wide.restore(pa.array(texts)).to_pylist() == texts


def test_other_text_is_left_alone(tool):
    texts = ["The garden, was quiet!! 12 people (and 3) a@b", "", "a b", "12345 1,000.50 2024-01-01", "Ärger über ß",
             "line\nline", "x" * 2 + "y"]
    kept = texts[:1] + texts[1:]
    found = tool.restore(pa.array([*kept, None])).to_pylist()
    assert found[1:] == [*kept[1:], ""]
    assert found[0].startswith("The garden, was quiet!! 12 people (and 3) ")


def test_the_best_reading_is_found_among_all(tool):
    """Against scoring every reading of small lattices."""
    def readings(steps):
        out = [("", 0.0)]
        for options, nothing in steps:
            out = [(t + c, s - (1.5 if c in tx.LEET else 0)) for t, s in out for c in options] + (
                [(t, s - nothing) for t, s in out] if nothing is not None else [])
        return out

    def score(text):
        a = b = 0
        total = 0.0
        for byte in text.encode():
            s = int(tx.SYMBOL[byte])
            total += float(tool.log[a, b, s]) + (tool.bonus if s else 0)
            a, b = (b, s) if s else (0, 0)
        return total + float(tool.log[a, b, 0])

    for span in ("1d10t", "m00n", "a.b.c", "$$t", "i d i"):
        best = max(s + score(t) for t, s in readings(tool._steps(span)))
        found = [s for t, s in readings(tool._steps(span)) if t == tool.decode(span)]
        assert abs(max(found) + score(tool.decode(span)) - best) < 1e-4


def corpus(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(GOOD, k=30)
        toxic = rng.random() < .3
        if toxic:
            bad = rng.choice(BAD)
            if rng.random() < .3:
                bad = bad.translate(str.maketrans("oia", "01@"))
            words[rng.randrange(30)] = bad
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_texts_are_told_apart(cluster, documents):
    rows, labels = corpus(600, 1)
    table = cluster.createDataFrame(labels + [(9999, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    odd = [(5000, None), (5001, ""), (5002, "quiet " * 50_000), (5002, "an idiot " * 3), (None, "moron")]
    found = tx.scored(documents(rows + odd), table, F.col("doc_id") % 3 > 0)
    assert set(found.columns) == set(documents([]).columns)
    held = {(r.doc_id, r.text): r.score for r in found.collect()}
    assert len(held) == len(rows) + len(odd) and all(0 <= s <= 1 for s in held.values())
    wrong = [i for (i, t), (_, y) in zip(rows, labels) if i % 3 == 0 and (held[i, t] >= .5) != y]
    assert len(wrong) <= 4
    assert held[5000, None] == held[5001, ""] < .5 and held[5002, "quiet " * 50_000] < .5
    assert held[None, "moron"] >= .5 and held[5002, "an idiot " * 3] >= .5


def test_without_labels_of_both_kinds(cluster, documents):
    rows, _ = corpus(20, 2)
    none = cluster.createDataFrame([], "doc_id long, toxic int")
    assert {round(r.score, 6) for r in tx.scored(documents(rows), none).collect()} == {0.0}
    one = cluster.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert {round(r.score, 6) for r in tx.scored(documents(rows), one).collect()} == {1.0}
    assert tx.scored(documents([]), one).count() == 0


def test_restored_texts_over_a_table(cluster, documents):
    rows = [(1, "the garden"), (2, "quiet m0r0n"), (3, None)] + [(i, "a moron walked") for i in range(10, 60)]
    model = tx.char_model(documents(rows))
    found = {r.doc_id: r.text for r in tx.restored(documents(rows), model).collect()}
    assert (found[1], found[2], found[3]) == ("the garden", "quiet moron", "")
