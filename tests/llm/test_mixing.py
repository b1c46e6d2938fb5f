from __future__ import annotations

import random

import pytest
from peerbench.llm.mixing import apportion, mix_sources
from pyspark.sql import functions as F
from tests.llm.corpus import SCHEMA, corpus, words


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_ = dict.fromkeys(names, 0.0), [s for s in names if sizes[s]]
    rest = 1.5 * sum(sizes.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * level > 2 * sizes[s]]
        for s in full or open_:
            target[s] = 2.0 * sizes[s] if full else weight[s] * level
        if not full:
            break
        rest -= sum(2 * sizes[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return target


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken_words(spark, seed):
    rng = random.Random(seed)
    docs = [(i, " ".join(["w"] * rng.randint(0, 90)), None, rng.choice("aaaaaabcdefg") if i % 9 else None, 0) for i in range(600)] + [(None, "x y", None, "b", 0), (5, None, None, "b", 0)]
    docs += [docs[7]]
    frame = spark.createDataFrame(docs, SCHEMA)
    got = mix_sources(frame, ["doc_id", "source"], shard_words=500).collect()
    assert len(got) == len(docs)
    sizes: dict = {}
    for d in docs:
        sizes[d[3]] = sizes.get(d[3], 0) + len(words(d[1]))
    want = brute_targets(sizes)
    taken: dict = {}
    for r in got:
        s = r["doc"]["source"]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 64
    again = mix_sources(frame.repartition(3), ["doc_id", "source"], shard_words=500).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


@pytest.mark.parametrize("seed", range(3))
def test_apportionment_equals_dealing_seat_by_seat(spark, seed):
    rng = random.Random(seed)
    rows, want = [], {}
    for group in ("x", None):
        votes = {i: rng.choice([0, 1, 7, rng.randint(1, 5000)]) for i in range(rng.randint(1, 12))}
        seats = {i: 0 for i in votes}
        for _ in range(37 if any(votes.values()) else 0):
            seats[max((i for i in votes if votes[i]), key=lambda i: (votes[i] / (2 * seats[i] + 1), -i))] += 1
        rows += [(group, i, v) for i, v in votes.items()]
        want |= {(group, i): n for i, n in seats.items()}
    got = apportion(spark.createDataFrame(rows, "g string, i long, votes long"), ("g",), ("i",), "votes", F.lit(37))
    assert {(r["g"], r["i"]): r["seats"] for r in got.collect()} == want


def test_no_words_no_rows_and_clashing_names(spark):
    assert [r["taken"] for r in mix_sources(spark.createDataFrame([(1, None, None, None, 0), (2, " ", None, "a", 0)], SCHEMA)).collect()] == [0, 0]
    assert mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(1, "a b", "s", 3, 4, 5.0)], "doc_id long, text string, source string, size long, shard int, target double")
    row = mix_sources(odd, odd.columns).first()
    assert row["doc"]["size"] == 3 and row["doc"]["target"] == 5.0 and row["size"] == 2
    assert mix_sources(spark.createDataFrame(corpus(4), SCHEMA)).count() == len(corpus(4))
