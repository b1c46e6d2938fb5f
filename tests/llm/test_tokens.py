from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from peerbench.llm.tokens import ALNUM, SOLID, cut, grams, slices, sliding_min


@pytest.mark.parametrize("kind,pattern,lower", [(ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True), (SOLID, r"[^\x20\x09-\x0D]+", False)])
def test_words_equal_the_pattern(kind, pattern, lower):
    rng = random.Random(1)
    texts = ["".join(rng.choices("aZ09 \t\n\x0b\x1c\x85\xa0é中🙂[`{~_-.", k=rng.randint(0, 40))) for _ in range(300)] + [None, "", "x" * 5000, " "]
    column = pa.array(texts).slice(3)
    found = cut(column, kind, lower)
    fold = lambda t: t.translate({c: c + 32 for c in range(65, 91)}) if lower else t
    want = [re.findall(pattern, fold(t or "")) for t in column.to_pylist()]
    assert [[w.decode() for w in found.row_words(i)] for i in range(len(column))] == want
    hashes = found.hashes()
    flat = [w for row in want for w in row]
    assert len(set(flat)) == len(set(hashes.tolist())) and len(set(zip(flat, hashes.tolist()))) == len(set(flat))


def test_hashes_do_not_depend_on_the_slice():
    texts = pa.array(["alpha beta gamma", "beta", None, "gamma alpha " * 50])
    whole = cut(texts, SOLID).hashes()
    parts = np.concatenate([cut(texts.slice(lo, hi - lo), SOLID).hashes() for lo, hi in slices(texts, 20)])
    assert (whole == parts).all() and list(slices(texts, 20))[-1][1] == 4


def test_grams_and_sliding_minimum():
    values = np.random.default_rng(2).integers(0, 1 << 63, 200).astype(np.uint64)
    for size in (1, 2, 5, 9, 13):
        assert (sliding_min(values, size) == [values[i : i + size].min() for i in range(200 - size + 1)]).all()
    assert len(grams(values, 201)) == 0 and len(set(grams(values, 3).tolist())) == 198
    assert (grams(values, 3) != grams(values, 3, lane=1)).all()
