from __future__ import annotations

import random

import numpy as np
import pytest
from peerbench.llm.frames import Bits, components


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(200, 200), (-5, 300)]
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}


def test_components_of_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_bitmap_misses_no_key(spark):
    keys = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 500)
    bits = Bits(spark.createDataFrame([(int(k),) for k in keys], "key long"), "key", 12)
    assert bits.have(keys.view(np.uint64)).all()
    assert not Bits(spark.createDataFrame([], "key long"), "key", 12).have(keys.view(np.uint64)).any()
