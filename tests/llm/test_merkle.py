import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallygrid.llm import merkle

KIND = "doc_id long, source string, text string, h string, kids int, grp string, rank int, block long"
FIELDS = ["doc_id", "source", "text"]


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, arity):
    """The root, and for each node its path of (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = place // arity * arity
            paths[i].append(("".join(nodes[run:place]), "".join(nodes[place + 1:run + arity])))
        at = [p // arity for p in at]
        nodes = [digest(*nodes[i:i + arity]) for i in range(0, len(nodes), arity)]
    return nodes[0], paths


def expected(rows, arity):
    groups = defaultdict(list)
    for i, source, text in rows:
        groups[source].append((i is not None, i, digest(field(i), field(source), field(text))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(groups[s]), tree([x[2] for x in sorted(groups[s])], arity)) for s in order}
    root, over = tree([trees[s][1][0] for s in order], arity)
    out = []
    for s, above in zip(order, over):
        leaves, (subroot, paths) = trees[s]
        out += [(i, s, leaf, subroot, root, path + above) for (_, i, leaf), path in zip(leaves, paths)]
    return sorted(out, key=repr)


def found(df, **how):
    rows = merkle.manifest(df, FIELDS, "doc_id", "source", **how).collect()
    return sorted([(r["id"], r["group"], r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["proof"]])
                   for r in rows], key=repr)


@pytest.fixture
def table(cluster):
    def make(rows):
        return cluster.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in rows], KIND)
    return make


@pytest.mark.parametrize("arity, depth", [(3, 2), (2, 1), (3, 6)])
def test_trees_of_many_sizes(table, arity, depth, monkeypatch):
    monkeypatch.setattr(merkle, "RUN", 5)
    rows = [(i * 7 % 101, f"s{n:02d}", f"text {i}") for n in (1, 2, 3, 4, 9, 10, 28, 82) for i in range(n)]
    rows += [(None, "s10", "no id"), (None, "s10", None), (4, None, "no source"), (5, None, ""), (5, None, None),
             (6, "", "é😀"), (6, "", "é😀"), (6, "", "é😀"), (7, "É", "long " * 50_000), (8, "z\n", "a")]
    assert found(table(rows), arity=arity, depth=depth, part_rows=11) == expected(rows, arity)


def test_one_hot_group(table):
    rows = [(i, "hot" if i % 3 else "cold", str(i)) for i in range(400)]
    assert found(table(rows), depth=3, part_rows=50) == expected(rows, 3)


def test_lone_rows_and_an_empty_table(table):
    assert found(table([(1, "s", "t")])) == expected([(1, "s", "t")], 3)
    assert found(table([(1, "s", "t")]))[0][5] == []
    assert merkle.manifest(table([]), FIELDS, "doc_id", "source").collect() == []


def test_proofs_show_what_was_altered(table):
    rows = [(i, f"s{i % 4}", f"line {i}\nline") for i in range(50)]
    altered = merkle.leaf_of(F.col("doc_id"), F.col("source"), F.replace("text", F.lit("\n"), F.lit("")))
    proofs = merkle.manifest(table(rows), FIELDS, "doc_id", "source",
                             carry={"other": F.when(F.col("doc_id") % 2 == 0, altered)})
    folded = merkle.fold(F.coalesce("other", "leaf"), F.col("proof"))
    got = proofs.select("id", (folded == F.col("root")).alias("sound"), "root",
                        merkle.siblings(F.col("proof")).alias("text"), "proof").collect()
    assert all(r["sound"] == (r["id"] % 2 == 1) for r in got) and len(got) == 50
    assert all(r["text"] == "".join(a + b for a, b in r["proof"]) for r in got)


def test_bad_parameters(table):
    with pytest.raises(ValueError):
        merkle.manifest(table([]), FIELDS, "doc_id", "source", arity=1)
