from __future__ import annotations

import numpy as np
import pytest
from peerbench.llm.embeddings import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def made(seed, groups=6, size=12, dims=32):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = rng.normal(size=dims)
        for _ in range(size):
            rows.append((base + rng.normal(size=dims) * rng.choice([0.0, 0.05, 0.2, 0.3]), g % 2))
    rows += [(rng.normal(size=dims), 0) for _ in range(60)]
    order = rng.permutation(len(rows))
    return [(int(i) * 2, [float(x) for x in np.float32(v)], lab) for i, (v, lab) in zip(order, rows)]


def brute(rows):
    good = [r for r in rows if r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    near: dict[int, set] = {id(r): set() for r in good}
    for i, a in enumerate(good):
        for b in good[:i]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    near[id(a)].add(id(b))
                    near[id(b)].add(id(a))
    low = {id(r): r[0] for r in good}
    for _ in good:
        low = {k: min([low[k], *(low[j] for j in near[k])]) for k in low}
    return [(r[0], len(near.get(id(r), ())), low.get(id(r), r[0])) for r in rows]


def found(spark, rows, **how):
    return sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in near_vectors(spark.createDataFrame(rows, SCHEMA), **how).collect())


@pytest.mark.parametrize("block", [1024, 5])
def test_recall_and_blocks(spark, block):
    rows = made(1)
    rows += [(1001, rows[0][1], rows[0][2]), (1003, rows[0][1], 1 - rows[0][2]), (1005, [2 * x for x in rows[1][1]], rows[1][2])]
    want, got = sorted(brute(rows)), found(spark, rows, block=block)
    assert sum(w[1] for w in want) > 100
    assert all(g[1] <= w[1] for g, w in zip(got, want)) and sum(g[1] for g in got) >= 0.95 * sum(w[1] for w in want)
    assert sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.97 * len(want)


def test_edge_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, one, 0), (2, one, None), (3, None, 0), (4, [], 0), (5, [0.0, 0.0, 0.0], 0), (6, [1.0, None, 3.0], 0), (7, [1.0, float("nan"), 3.0], 0), (8, [float("inf"), 2.0, 3.0], 0), (9, [1.0, 2.0], 0), (10, one, 0), (10, one, 0)]
    assert found(spark, rows) == sorted([(1, 2, 1), (10, 2, 1), (10, 2, 1)] + [(i, 0, i) for i in range(2, 10)])
    assert found(spark, []) == []


def test_kept_and_clashing_names(spark):
    odd = spark.createDataFrame([(1, [1.0], 0, "x"), (2, [3.0], 0, "y")], SCHEMA + ", vector string")
    assert sorted((r["vec_id"], r["kept"]) for r in near_vectors(odd).collect()) == [(1, True), (2, False)]
