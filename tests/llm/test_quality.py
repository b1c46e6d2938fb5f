from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from peerbench.llm.quality import FEATURES, fit, passage_features, score, train

LABELS = "doc_id long, quality int, toxic int"


def made(seed, rows):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(rows):
        good = i % 3 != 0
        w = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(rng.randint(70, 300))]
        if not good:  # junk in one passage only
            at = rng.randrange(len(w) - 40)
            w[at : at + 40] = ["spam!!"] * 40 if i % 2 else [f"{x}###" for x in w[at : at + 40]]
        docs.append((i, " ".join(w)))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy_and_attention(spark):
    docs, labels = made(1, 300)
    model = train(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS))
    test, truth = made(2, 120)
    got = {r["doc"]["doc_id"]: r for r in score(spark.createDataFrame(test, "doc_id long, text string"), model).collect()}
    assert sum(got[i]["predicted"] == q for i, q, _ in truth) >= 108
    features, counts = passage_features(pa.array([t for _, t in test]))
    weight = model.attention(features, counts)
    assert np.allclose(np.add.reduceat(weight, np.concatenate([[0], np.cumsum(counts)[:-1]])), 1, atol=1e-4)


def test_gradient_lowers_the_loss():
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 5, 80)
    x = rng.normal(size=(counts.sum(), FEATURES)).astype(np.float32)
    y = (np.add.reduceat(x[:, 0], np.concatenate([[0], np.cumsum(counts)[:-1]])) > 0).astype(float)
    loss = lambda m: -np.mean(y * np.log(m.scores(x, counts) + 1e-9) + (1 - y) * np.log(1 - m.scores(x, counts) + 1e-9))
    assert loss(fit(x, counts, y, steps=200)) < 0.5 * loss(fit(x, counts, y, steps=1))


def test_passages_and_features():
    texts = pa.array([" ".join(["aa"] * 64 + ["Bb", "c9"]), None, "", "  \n ", "x"])
    features, counts = passage_features(texts)
    assert counts.tolist() == [2, 1, 1, 1, 1] and (features[2:5] == 0).all() and (features[5] != 0).any()
    whole, parts = passage_features(texts)[0], [passage_features(texts.slice(i, 1))[0] for i in range(5)]
    assert np.allclose(whole, np.concatenate(parts))


def test_labels_that_teach_nothing_and_edge_rows(spark):
    docs, labels = made(3, 30)
    frame = spark.createDataFrame(docs + [(None, "x"), (3, docs[3][1])], "doc_id long, text string")
    assert score(frame, train(frame, spark.createDataFrame([], LABELS))).first()["score"] == 0.5
    good = train(frame, spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(None, 0, 0), (5, None, 0)], LABELS))
    assert {r["predicted"] for r in score(frame, good).collect()} == {1}
    model = train(frame, spark.createDataFrame(labels, LABELS))
    odd = [(1, None), (2, ""), (None, "a b"), (4, "word " * 100_000), (4, "word " * 100_000)]
    rows = score(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows) and rows[0]["score"] == rows[1]["score"] and rows[3]["score"] == rows[4]["score"]
    assert score(frame.limit(0), model).count() == 0
    clash = spark.createDataFrame([(1, "a", 3, "d")], "doc_id long, text string, score int, doc string")
    assert score(clash, model, clash.columns).first()["doc"]["score"] == 3
