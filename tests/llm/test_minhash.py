import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallygrid.llm import minhash


def words(n, seed):
    rng = random.Random(seed)
    return ["w%d" % rng.randrange(10_000) for _ in range(n)]


def test_registers_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(0)
    a = {int(k): int(w) for k, w in zip(rng.integers(1, 2 ** 62, 60), rng.integers(1, 6, 60))}
    b = {k: w for k, w in list(a.items())[15:]} | {int(k): 3 for k in rng.integers(1, 2 ** 62, 12)}
    for k in list(b)[:10]:
        b[k] += 2
    exact = sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a | b) for d in a.keys() & b.keys())
    arrays = [(np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)])) for s in (a, b)]
    assert abs(minhash.similarity(*arrays) - exact) < 1e-12
    m = 1 << 14
    held = [minhash.prob_minhash(np.zeros(len(k), np.int64), k, w, 1, m)[0] for k, w in arrays]
    assert abs((held[0] == held[1]).mean() - exact) < 4 * (exact * (1 - exact) / m) ** .5


def test_no_similarity_is_over_its_bounds():
    rng = np.random.default_rng(8)
    for _ in range(500):
        n, top = rng.integers(1, 60), rng.choice([1, 2, 6])
        base = {int(k): int(w) for k, w in zip(rng.integers(1, 2 ** 62, n), rng.integers(1, top + 1, n))}
        other = {k: w if rng.random() < .8 else int(rng.integers(1, top + 1)) for k, w in base.items() if rng.random() < .85}
        other |= {int(k): int(rng.integers(1, top + 1)) for k in rng.integers(1, 2 ** 62, rng.integers(0, 8))}
        if not other:
            continue
        sides = [(np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)])) for s in (base, other)]
        differ = len(base.keys() ^ other.keys())
        differ = int(rng.integers(abs(len(base) - len(other)), differ + 1))  # parities may show less
        bounds = minhash.most_similar(differ, len(base), len(other), sum(base.values()), sum(other.values()))
        found = minhash.similarity(*sides)
        assert found <= bounds[0] + 1e-12 and (top > 1 or found <= bounds[1] + 1e-12)


def test_early_termination_changes_nothing():
    text, key, weight = minhash.shingles(pa.array([" ".join(words(300, 1)), "", "two words", " ".join(words(30, 2))]))
    alone = [minhash.prob_minhash(np.zeros((text == t).sum(), np.int64), key[text == t], weight[text == t], 1)[0]
             for t in (0, 2, 3)]
    assert (minhash.prob_minhash(text, key, weight, 4)[[0, 2, 3]] == np.stack(alone)).all()


def test_shingles_count_runs_of_five():
    text, key, weight = minhash.shingles(pa.array(["a b c d e f", "A, b! c d e", "x y", None, "a b c d e a b c d e"]))
    per = [sorted(weight[text == t].tolist()) for t in range(5)]
    assert per == [[1, 1], [1], [1], [], [1, 1, 1, 1, 2]]
    assert set(key[text == 1]) < set(key[text == 0]) and not set(key[text == 2]) & set(key[text == 0])


def brute(rows):
    sets = []
    for _, t in rows:
        w = "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()
        sets.append(Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else None)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and len(a.keys() & b.keys()) * 2 > len(a):
                if max(a.values()) == max(b.values()) == 1:  # plain Jaccard
                    s = len(a.keys() & b.keys()) / len(a.keys() | b.keys())
                else:
                    s = sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in a | b) for d in a.keys() & b.keys())
                if s >= .8:
                    root[find(i)] = find(j)
    names = {}
    for i, (n, _) in enumerate(rows):
        names.setdefault(find(i), []).append(n)
    return sorted([(n, min((x for x in names[find(i)] if x is not None), default=None), len(names[find(i)]))
                   for i, (n, _) in enumerate(rows)], key=repr)


def edited(base, n, rng):
    out = list(base)
    for _ in range(n):
        out[rng.randrange(len(out))] = "e%d" % rng.randrange(10 ** 6)
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows, n = [], 0
    for g in range(12):
        base = words(120, g)
        for _ in range(rng.choice([1, 2, 5])):
            rows.append((n, edited(base, rng.choice([0, 1, 2, 3, 8]), rng)))
            n += 1
    loose = words(150, 77)  # a large loose group, some only near to some
    for _ in range(60):
        rows.append((n, edited(loose, rng.choice([1, 2, 3, 4]), rng)))
        n += 1
    chain = words(130, 78)
    for _ in range(8):
        rows.append((n, " ".join(chain)))
        chain[rng.randrange(130)] = "c%d" % n
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "two words"), (n + 3, "Two, words!"), (n + 4, "..."),
             (n + 5, " ".join(words(30_000, 5))), (n + 6, " ".join(words(30_000, 5)) + " end"), (0, rows[0][1]),
             (None, rows[0][1]), (None, "null id only"), (n + 7, "same same same same same same same"),
             (n + 8, "same same same same same same same same")]
    return rows


def test_classes_equal_all_pairs(documents, rows, corpus):
    found = minhash.near_duplicates(documents(corpus))
    assert rows(found, "doc_id", "class_id", "class_size") == brute(corpus)


def test_one_whole_row_of_each_class_stays(documents, corpus):
    kept = minhash.survivors(documents(corpus))
    want = {c for _, c, _ in brute(corpus) if c is not None}
    got = [r.doc_id for r in kept.collect()]
    assert kept.columns == documents(corpus).columns
    assert sorted(i for i in got if i is not None) == sorted(want) and got.count(None) == 1


def test_no_documents(documents):
    assert minhash.near_duplicates(documents([])).count() == 0
    assert minhash.survivors(documents([])).count() == 0
    assert minhash.near_duplicates(documents([(1, None), (2, "")])).count() == 2


def test_few_shingles_do_not_hide_similar_texts(documents):
    """Of texts of 8 words against the same and one more, 0.8 similar, none may be ruled out."""
    rows = []
    for i in range(2000):
        words = [f"w{i}x{j}" for j in range(9)]
        rows += [(2 * i, " ".join(words[:8])), (2 * i + 1, " ".join(words))]
    bits = {r.id: (r.bits0, r.bits1) for r in minhash.sketches(documents(rows), "doc_id", "text").collect()}
    lost = [i for i in range(0, len(rows), 2) if 128 - sum(
        bin((a ^ b) % 2 ** 64).count("1") for a, b in zip(bits[i], bits[i + 1])) < minhash.FEWEST_BITS]
    assert not lost


@pytest.mark.parametrize("block", [512, 7])
def test_pairs_of_a_large_loose_group_do_not_leave_the_tasks(documents, rows, monkeypatch, block):
    """Near the threshold and not linked: each pair is compared, where its buckets are."""
    monkeypatch.setattr(minhash, "SET_BLOCK", block)
    rng, base = random.Random(5), words(180, 99)
    docs = [(i, edited(base, 2, rng)) for i in range(250)]  # most pairs are 0.796 similar
    docs += [(300 + i, " ".join([*docs[i][1].split(), "same", "same"] + ["x y z x y z"] * (i % 2))) for i in range(6)]
    tested, verified = [], minhash._verified

    def counted(pairs, *rest):
        tested.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(minhash, "_verified", counted)
    met, missing = [], minhash._missing

    def kept(*args):
        met.append(missing(*args))
        return met[-1]

    monkeypatch.setattr(minhash, "_missing", kept)
    found = minhash.near_duplicates(documents(docs))
    assert rows(found, "doc_id", "class_id", "class_size") == brute(docs)
    assert sum(tested) <= 2 * minhash.PARTNERS * len(docs) and len(met) == 1 and met[0].count() <= len(docs) * minhash.BANDS


def test_a_pair_is_verified_in_the_first_bucket_it_shares_alone(documents):
    rng, base = random.Random(6), words(200, 55)
    [a, b] = documents([(1, " ".join(base)), (2, edited(base, 1, rng))]).transform(
        lambda d: minhash.sketches(d, "doc_id", "text")).collect()
    keys = [minhash.shingles(pa.array([t])) for t in (" ".join(base), edited(base, 1, random.Random(6)))]
    sides = [(np.frombuffer(r.node, "<u8").reshape(1, 2), np.frombuffer(r.node, "<u8").reshape(1, 2),
              np.array([[r.bits0, r.bits1]]).view(np.uint64), np.array([r.parity]).view(np.uint64),
              np.array([float(r.size)]), np.array([float(r.mass)]), np.array([r.buckets]),
              minhash._objects([k[1].tobytes()]), minhash._objects([None])) for r, k in zip((a, b), keys)]
    shared = [x for x, y in zip(a.buckets, b.buckets) if x == y]
    given = [sum(out.num_rows for out in minhash._joining(x, *sides, 0.8)) for x in shared]
    assert len(shared) > 1 and given == [1] + [0] * (len(shared) - 1)


def test_sketching_holds_few_texts_at_a_time(monkeypatch):
    """The arrays of a sketch take many times the text: of a batch of 1000 rows not all at once."""
    class Frame:
        def mapInArrow(self, task, schema):
            return task

    monkeypatch.setattr(minhash, "_keyed", lambda *a: Frame())
    monkeypatch.setattr(minhash, "freed", lambda task: task)
    texts = [" ".join(words(400, seed)) for seed in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array([b"k"] * 1000), pa.array(texts)],
                                       ["id", "text_key", "text"])
    tracemalloc.start()
    found = sum(b.num_rows for b in minhash.sketches(None, "id", "text")(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 1000 and most < 40e6


def test_little_is_held_out_of_a_file_and_pairs_are_written_once(documents, monkeypatch):
    """The reader of files holds few whole texts at a time, and verified pairs go straight to the components."""
    staged, written = minhash.staged, []
    monkeypatch.setattr(minhash, "staged", lambda df: written.append(df.columns) or staged(df))
    text = " ".join(f"w{i}" for i in range(60))
    df = documents([(3, text), (1, f"{text} more"), (2, "some other words that are not alike"), (None, None)])
    df.sparkSession.conf.set("spark.sql.parquet.columnarReaderBatchSize", "4096")
    got = {(r.doc_id, r.class_id) for r in minhash.near_duplicates(df).collect()}
    assert got == {(3, 1), (1, 1), (2, 2), (None, None)}
    assert int(df.sparkSession.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512
    assert ["a", "b"] not in written
