from __future__ import annotations

import random

import numpy as np
import pytest
from peerbench.llm import ngram_join
from peerbench.llm.ngram_join import Likeness, _bands, jaccard_components, part_values
from tests.llm.corpus import SCHEMA, corpus, words


def shingles(text, size):
    w = words(text, lower=True)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(docs, like):
    sets = [shingles(d[1], like.words) for d in docs]
    low = {d[0]: d[0] for d in docs if d[0] is not None}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and docs[i][0] is not None and docs[j][0] is not None and 100 * len(a & b) >= like.percent * len(a | b):
                x, y = sorted((root(docs[i][0]), root(docs[j][0])))
                low[y] = x
    return sorted(((d[0], len(s), None if d[0] is None else root(d[0])) for d, s in zip(docs, sets)), key=repr)


def found(spark, docs, like):
    got = jaccard_components(spark.createDataFrame(docs, SCHEMA), like).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr)


@pytest.mark.parametrize("like", [Likeness(), Likeness(words=2, percent=50)])
def test_equals_brute_force(spark, like):
    docs = corpus(5, rows=70, longest=90)
    assert found(spark, docs, like) == brute(docs, like)


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(120)] = f"x{rng.randrange(9)}"
        docs.append((i, " ".join(own), None, None, 0))
    docs += [(200 + i, " ".join(base[:40] + [f"y{i}_{k}" for k in range(60)]), None, None, 0) for i in range(40)]
    assert found(spark, docs, Likeness()) == brute(docs, Likeness())


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_sets_that_reach_the_similarity_share_a_part(percent):
    rng = np.random.default_rng(percent)
    for n in (1, 2, 5, 6, 7, 20, 33, 300, 2000):
        for _ in range(20):
            larger = int(n * 100 / percent)
            tokens = np.unique(rng.integers(0, 1 << 63, larger).astype(np.uint64) * np.uint64(2))
            a = np.sort(rng.permutation(tokens)[: max(1, -(-len(tokens) * percent // 100))])
            assert len(np.intersect1d(part_values(a, percent), part_values(tokens, percent)))


def test_bands_reach_only_the_next_band():
    first, parts, _ = _bands(85)
    for n in range(1, 3000):
        assert np.searchsorted(first, n * 100 // 85, "right") <= np.searchsorted(first, n, "right") + 1
    assert (np.diff(parts) >= 0).all()


def test_empty_table_and_one_long_text(spark):
    assert found(spark, [], Likeness()) == []
    text = " ".join(f"t{i}" for i in range(60_000))
    docs = [(4, text, None, None, 0), (9, text + " end", None, None, 0), (11, "short", None, None, 0)]
    assert found(spark, docs, Likeness()) == [(11, 1, 11), (4, 59_997, 4), (9, 59_998, 4)]


@pytest.mark.parametrize("percent", [50, 80, 85])
def test_sets_without_a_common_token_share_no_part(percent):
    rng, seen = np.random.default_rng(percent), []
    for n in [*range(1, 40), 200]:
        for _ in range(20):
            seen.append(np.unique(part_values(np.unique(rng.integers(0, 1 << 64, n, np.uint64)), percent)))
    assert len(np.unique(np.concatenate(seen))) == sum(map(len, seen))


@pytest.mark.parametrize("percent", [50, 80, 85])
def test_small_sets_that_reach_the_similarity_share_a_part(percent):
    rng = np.random.default_rng(percent)
    for n in range(1, 25):
        for _ in range(150):
            larger = np.unique(rng.integers(0, 1 << 64, max(1, n * 100 // percent), np.uint64))
            if rng.random() < 0.5:  # all in few parts
                larger = np.unique(larger >> np.uint64(8))
            a = np.sort(rng.permutation(larger)[: max(1, -(-len(larger) * percent // 100))])
            assert len(np.intersect1d(part_values(a, percent), part_values(larger, percent)))


def test_copies_of_two_texts_are_joined_as_two_rows(spark, monkeypatch):
    base = [f"w{i}" for i in range(100)]
    near = base[:92] + [f"y{i}" for i in range(8)]  # 89 of 105 shingles in common, just below 0.85
    docs = [(i, " ".join(base if i < 30 else near), None, None, 0) for i in range(60)]
    most, keep = [], ngram_join.stored

    def watched(df, label):
        df = keep(df, label)
        if label == "open":
            most.extend(r["count"] for r in df.groupBy("part").count().collect())
        return df

    monkeypatch.setattr(ngram_join, "stored", watched)
    assert found(spark, docs, Likeness()) == brute(docs, Likeness())
    assert most and max(most) == 2


def test_few_texts_at_once(spark, monkeypatch):
    key, seen, plain = "spark.sql.execution.arrow.maxRecordsPerBatch", [], ngram_join.stored
    before = spark.conf.get(key)
    monkeypatch.setattr(ngram_join, "stored", lambda df, label: seen.append(int(spark.conf.get(key))) or plain(df, label))
    docs = spark.createDataFrame([(i, f"some words of text {i % 7}") for i in range(30)], "doc_id long, text string")
    rows = jaccard_components(docs).collect()
    assert {r["component_id"] for r in rows} == set(range(7)) and seen and max(seen) <= 1_000
    assert spark.conf.get(key) == before
