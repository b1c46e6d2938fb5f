from __future__ import annotations

import random

import pytest
from peerbench.llm.substring import SuffixAutomaton, remove_reference, remove_repeats
from tests.llm.corpus import SCHEMA, corpus, words


def drop(w, starts, size):
    gone = {k for i in starts for k in range(i, i + size)}
    return len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)


def brute(docs, size):
    first: dict[tuple, int] = {}
    for doc_id, text, *_ in sorted((d for d in docs if d[0] is not None), key=lambda d: d[0]):
        w = words(text)
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), doc_id)
    out = []
    for doc_id, text, *_ in docs:
        w = words(text)
        starts = [i for i in range(len(w) - size + 1) if doc_id is not None and first[tuple(w[i : i + size])] < doc_id]
        out.append((doc_id, *drop(w, starts, size)))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted(((r["doc"]["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("seed,size", [(1, 13), (2, 13), (3, 3)])
def test_equals_brute_force(spark, seed, size):
    docs = corpus(seed, rows=60)
    assert rows_of(remove_repeats(spark.createDataFrame(docs, SCHEMA), size=size)) == brute(docs, size)


def test_a_passage_in_many_documents_and_a_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, f"a{i} {passage} b{i}", None, None, 0) for i in range(80)] + [(99, " ".join(f"q{i % 40_000}" for i in range(90_000)), None, None, 0)]
    got = {r[0]: r for r in rows_of(remove_repeats(spark.createDataFrame(docs, SCHEMA)))}
    assert got[0][2] == 0 and all(got[i][2:] == (60, f"a{i} b{i}") for i in range(1, 80)) and got[99][2] == 0


def test_empty_table_and_clashing_names(spark):
    assert rows_of(remove_repeats(spark.createDataFrame([], SCHEMA))) == []
    odd = spark.createDataFrame([(1, "a  b", 5, 6)], "doc_id long, text string, own int, n_words int")
    row = remove_repeats(odd, odd.columns).first()
    assert row["doc"].asDict() == {"doc_id": 1, "text": "a  b", "own": 5, "n_words": 6} and row["text"] == "a b"


def test_matching_statistics():
    rng = random.Random(4)
    for _ in range(30):
        texts = [[rng.randrange(3) for _ in range(rng.randint(1, 15))] for _ in range(3)]
        automaton = SuffixAutomaton()
        for t in texts:
            automaton.add(t)
        known = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        query = [rng.randrange(4) for _ in range(20)]
        want = [max((k for k in range(1, e + 1) if tuple(query[e - k : e]) in known), default=0) for e in range(1, 21)]
        assert list(automaton.matches(query)) == want and len(automaton.next) <= 2 * sum(map(len, texts)) + 1


@pytest.mark.parametrize("shard_words", [100_000, 30])
def test_reference_form_equals_brute_force(spark, shard_words):
    docs, reference = corpus(6), [d for d in corpus(7) if d[1]] + [(500, corpus(6)[3][1], None, None, 0)]
    known = {tuple(w[i : i + 6]) for d in reference for w in [words(d[1])] for i in range(len(w) - 5)}
    want = sorted(((d[0], *drop(w, [i for i in range(len(w) - 5) if tuple(w[i : i + 6]) in known], 6)) for d in docs for w in [words(d[1])]), key=repr)
    got = remove_reference(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(reference, SCHEMA), size=6, shard_words=shard_words)
    assert rows_of(got) == want
