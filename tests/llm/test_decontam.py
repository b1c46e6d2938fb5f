from __future__ import annotations

import random

import pytest
from peerbench.llm.decontam import decontaminate
from tests.llm.corpus import SCHEMA, corpus, words

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(docs, items):
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text, ALNUM, True)
        if item is not None:
            for i in range(max(1, len(w) - 12) if w else 0):
                windows.setdefault(tuple(w[i : i + 13]), set()).add(item)
    out = []
    for doc_id, text, *_ in docs:
        w, hit, owners = words(text, ALNUM, True), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if found := windows.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    owners |= found
        out.append((doc_id, len(w), len(hit), sorted(map(str, owners)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def found(spark, docs, items, **how):
    got = decontaminate(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), **how)
    return sorted(((r["doc"]["doc_id"], r["n_words"], r["n_hit"], list(r["item_ids"]), r["contaminated"]) for r in got.collect()), key=repr)


@pytest.mark.parametrize("seed,shard_rows", [(1, 100_000), (2, 7)])
def test_equals_brute_force(spark, seed, shard_rows):
    docs, rng = corpus(seed), random.Random(seed)
    some = [words(d[1]) for d in docs if d[1]]
    items = [(i, "; ".join(w[k : k + rng.randint(1, 25)])) for i, w in enumerate(rng.choices([w for w in some if w], k=12)) for k in [rng.randrange(len(w))]]
    items += [items[0], (90, None), (91, ""), (None, items[1][1]), (92, items[2][1].upper()), (93, "never seen words " * 9)]
    assert found(spark, docs, items, shard_rows=shard_rows) == brute(docs, items)


def test_empty_tables_and_clashing_names(spark):
    docs = [(1, "one two three", None, None, 1)]
    assert found(spark, docs, []) == [(1, 3, 0, [], False)]
    assert found(spark, [], [(1, "one")]) == []
    odd = spark.createDataFrame([(1, "A one two", 7, 8, "x")], "doc_id long, text string, n_hit int, items int, doc string")
    row = decontaminate(odd, spark.createDataFrame([(5, "one TWO")], "item_id long, text string"), odd.columns).first()
    assert row["doc"].asDict() == {"doc_id": 1, "text": "A one two", "n_hit": 7, "items": 8, "doc": "x"} and (row["n_hit"], list(row["spans"])) == (2, [1, 3])


def test_very_long_text(spark):
    text = "word " * 200_000 + "the hidden passage of a test item that stands at the very end here"
    assert found(spark, [(1, text, None, None, 1)], [(3, text[-66:])])[0][2] == 14


def test_items_without_an_id_hit_but_are_not_counted(spark):
    big = (1 << 53) + 1
    docs = [(1, "a passage of no known item", None, None, 1), (2, "one two and three four", None, None, 1)]
    items = [(None, "no known item"), (None, "one two"), (big, "three four")]
    assert found(spark, docs, items) == [(1, 6, 3, [], True), (2, 5, 4, [str(big)], True)]
