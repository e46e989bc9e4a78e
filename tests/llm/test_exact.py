import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tallygrid.llm import exact

ROWS = [(1, "Same text"), (2, "same TEXT"), (3, "same text "), (4, None), (5, ""), (6, "É a"), (7, "é a"),
        (8, "long " * 40_000), (9, "LONG " * 40_000), (10, "alone"), (2, "same TEXT"), (None, "alone"),
        (None, "nameless"), (11, "İx"), (12, "i̇x")]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = []
    for i, t in rows:
        own = groups[lower(t)]
        keep = max((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_every_row_gets_its_class(documents, rows):
    found = exact.exact_dedup(documents(ROWS))
    assert set(documents(ROWS).columns) < set(found.columns)
    assert rows(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected(ROWS)


def test_colliding_digests_are_told_apart_by_content(documents, rows):
    weak = {"digest": lambda t: F.lit(b"d"), "second": lambda t: F.lit(1).cast("long")}
    found = exact.exact_dedup(documents(ROWS), salts=3, **weak)
    assert rows(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected(ROWS)
    kept = exact.survivors(documents(ROWS), salts=3, **weak)
    assert rows(kept, "doc_id", "text") == rows(exact.survivors(documents(ROWS)), "doc_id", "text")


def test_survivors_are_whole_rows(documents, rows):
    kept = exact.survivors(documents(ROWS))
    assert kept.columns == documents(ROWS).columns
    want = {(k, lower(t)) for (i, k, *_), (_, t) in zip(
        [next(e for e in expected(ROWS) if e[0] == i and e[4] == hashlib.sha256(lower(t).encode()).hexdigest())
         for i, t in ROWS], ROWS)}
    assert sorted(((i, lower(t)) for i, t in rows(kept, "doc_id", "text")), key=repr) == sorted(want, key=repr)


def test_a_hot_text_and_an_empty_table(documents, rows):
    hot = [(i, "copy" if i % 3 else f"own {i}") for i in range(3000)]
    found = rows(exact.exact_dedup(documents(hot)), "group_size", "kept")
    assert found.count((2000, True)) == 1 and found.count((2000, False)) == 1999
    assert exact.exact_dedup(documents([])).count() == 0
    assert exact.survivors(documents([])).count() == 0
