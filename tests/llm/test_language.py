from __future__ import annotations

import random

import numpy as np
from peerbench.llm.language import codewords, identify, train
from tests.llm.corpus import SCHEMA

SOUNDS = {"aa": "ka to mi ru", "bb": "sch ein ung ber", "cc": "ción los qué ado", "dd": "же ст во пр", "ee": "oui eau aux ère", "ff": "wij een sch oen"}


def made(seed, rows, languages):
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        lang = languages[i % len(languages)]
        text = " ".join("".join(rng.choices(SOUNDS[lang].split(), k=rng.randint(1, 3))) for _ in range(rng.randint(8, 60)))
        out.append((i, text, lang, None, 0))
    return out


def test_codewords_differ():
    for languages in (2, 3, 4, 5, 6, 9, 40):
        code = codewords(languages)
        assert set(np.unique(code)) == {-1.0, 1.0} and (np.abs(code.sum(0)) < languages).all()
        assert min((code[i] != code[j]).sum() for i in range(languages) for j in range(i)) >= (2 ** (languages - 2) if languages <= 5 else 4)


def test_held_out_accuracy(spark):
    for languages in (["aa", "bb", "cc", "dd"], list(SOUNDS)):
        model = train(spark.createDataFrame(made(1, 240, languages), SCHEMA))
        rows = made(2, 120, languages)
        got = {r["doc"]["doc_id"]: r for r in identify(spark.createDataFrame(rows, SCHEMA), model).collect()}
        assert sum(got[r[0]]["lang_pred"] == r[2] for r in rows) >= 118
        assert all(0 <= r["score"] <= 1 for r in got.values())


def test_edge_rows(spark):
    docs = made(3, 40, ["aa", "bb"]) + [(900, None, "aa", None, 0), (None, "ka", "aa", None, 0)]
    model = train(spark.createDataFrame(docs, SCHEMA))
    odd = [(1, None), (2, ""), (3, "12 34 !?"), (None, "kato miru kato"), (5, "中文"), (5, "schein ung " * 50_000)]
    got = [(r["doc"]["doc_id"], r["lang_pred"]) for r in identify(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()]
    assert got[:4] == [(1, "und"), (2, "und"), (3, "und"), (None, "aa")] and got[4][1] in ("aa", "bb") and got[5][1] == "bb"
    assert identify(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0
    clash = spark.createDataFrame([(1, "kato", "x", 1.0)], "doc_id long, text string, lang_pred string, score double")
    assert identify(clash, model, clash.columns).first()["doc"]["lang_pred"] == "x"


def test_nothing_or_one_language_to_learn(spark):
    none = train(spark.createDataFrame([(1, "text", None, None, 0)], SCHEMA))
    assert none is None and identify(spark.createDataFrame([(1, "text")], "doc_id long, text string"), none).first()["lang_pred"] == "und"
    one = train(spark.createDataFrame(made(4, 9, ["aa"]), SCHEMA))
    row = identify(spark.createDataFrame([(1, "text")], "doc_id long, text string"), one).first()
    assert (row["lang_pred"], row["score"]) == ("aa", 1.0)
