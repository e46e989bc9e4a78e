import math

import numpy as np
import pytest

from tallygrid.llm import vectors
from tallygrid.llm.common import components

SCHEMA = "vec_id long, embedding array<float>, id long, n long, unit string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "u") for r in rows], SCHEMA)


def expected(rows, least):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
          for _, v in rows]
    units = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if o else None
             for (_, v), o in zip(rows, ok)]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    names = {}
    for i, (v, _) in enumerate(rows):
        names.setdefault(find(i), []).append(v)
    out = []
    for i, (v, _) in enumerate(rows):
        name = min((x for x in names[find(i)] if x is not None), default=None)
        out.append((v, links[i], name, v == name))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block,dims", [(16, 3), (40, 8), (4096, 8)])
def test_equals_all_pairs(cluster, rows, block, dims):
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(20, dims))
    data = [(int(i), [float(x) for x in centres[i % 20] * rng.uniform(.1, 9) + rng.normal(size=dims) * .15])
            for i in rng.permutation(400)]
    data += [(1000 + i, data[7][1]) for i in range(60)]  # a hot vector
    found = vectors.near_vectors(frame(cluster, data), block=block)
    assert rows(found, "vec_id", "n_links", "component_id", "kept") == expected(data, .95)


def test_no_batch_grows_with_the_blocks(cluster, rows, monkeypatch):
    """Where no bound prunes, a vector still leaves a task once, not once for every block."""
    kind = type(cluster.range(0))
    plain = kind.mapInArrow

    def checked(frame, task, schema):
        def run(batches):
            for batch in task(batches):
                if batch.num_rows > 2000:
                    raise ValueError(f"{batch.num_rows} rows at once")
                yield batch

        return plain(frame, run, schema)

    monkeypatch.setattr(kind, "mapInArrow", checked)
    rng = np.random.default_rng(3)
    data = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(600, 24)))]
    data += [(1000 + i, [x * 1.01 for x in data[7 * i][1]]) for i in range(20)]
    found = vectors.near_vectors(frame(cluster, data).coalesce(1), block=30)
    assert rows(found, "vec_id", "n_links", "component_id", "kept") == expected(data, .95)


def test_odd_vectors(cluster, rows):
    data = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
            (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1e-38, 0.0]),
            (11, [3e38, 0.0]), (None, [1.0, 0.0]), (12, [-1.0, 0.0]), (2, [0.0, 1.0]), (13, [0.0, 2.0])]
    found = vectors.near_vectors(frame(cluster, data))
    assert rows(found, "vec_id", "n_links", "component_id", "kept") == expected(data, .95)


def test_no_vectors(cluster):
    assert vectors.near_vectors(frame(cluster, [])).count() == 0
    only = vectors.near_vectors(frame(cluster, [(1, None)])).collect()
    assert [tuple(r) for r in only] == [(1, 0, 1, True)]


def test_components_of_paths_stars_and_cycles(cluster):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 800)]
    links += [(900, 901), (901, 902), (902, 900), (5, 5), (None, 3), (900, 901)]
    found = {r.node: r.component for r in components(cluster.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 800)} | {i: 900 for i in (900, 901, 902)}
    assert found == want
    assert components(cluster.createDataFrame([], "a long, b long")).count() == 0
