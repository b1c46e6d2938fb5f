from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from peerbench.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string"


def counted(rows):
    """Number of every phrase of up to four words per language, and of all words."""
    found, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({k: k + 32 for k in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    found[lang, tuple(words[i : i + m])] += 1
    return found, total


def brute(rows, support, top, covered=80):
    found, total = counted(rows)
    frequent = {k: n for k, n in found.items() if n >= support}
    covers = {}
    for (lang, words), n in frequent.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                key = (lang, words[i : i + m])
                covers[key] = max(covers.get(key, 0), n)
    out = {}
    for (lang, words), a in frequent.items():
        if len(words) > 1 and not (100 * covers.get((lang, words), 0) >= covered * a):
            cuts = [(2_000_000 * a // (found[lang, words[:k]] + found[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), found[lang, words[:k]], found[lang, words[k:]]))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, total[lang], -score)
        for lang, rows in out.items() for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1))


def corpus(seed, docs=150):
    rng, out = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(14)] + ["É", "é", "Zug", "zug", "x-y", "(a", "ü)"]
    idioms = ["point of no return", "by and large", "new york city hall", "É Zug"]
    for i in range(docs):
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts.append(rng.choice(idioms) if rng.random() < 0.3 else rng.choice(vocabulary))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\r", " ! "]))
        out.append((i, "".join(parts), rng.choice(["en", "de", None, "und"])))
    return [*out, out[0], out[0], (None, out[1][1], "en"), (70, None, "en"), (71, "", "fr"), (72, " ,\t.", "fr"), (73, "only", "it")]


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("seed,sample,seen,top", [(1, 1, 1, 2000), (2, 3, 2, 2000), (3, 4, 1, 7), (4, 10**9, 1, 2000)])
def test_equals_brute_force_whatever_the_sample_proposes(spark, seed, sample, seen, top):
    rows = corpus(seed)
    got = c.collocations(spark.createDataFrame(rows, SCHEMA).repartition(4), 5, top, sample=sample, seen=seen)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, 5, top)
    assert found(got) == want and len(want) > 18


def test_all_frequent_phrases_with_their_numbers(spark):
    rows = corpus(9)
    got = c.frequent_phrases(spark.createDataFrame(rows, SCHEMA), 4, sample=5, seen=2).where("length > 0").collect()
    phrases, total = counted(rows)
    assert {(r["lang"], tuple(r["phrase"].split(" "))): r["n"] for r in got} == {k: n for k, n in phrases.items() if n >= 4}
    assert len(got) == len({(r["lang"], r["phrase"]) for r in got})


def test_a_long_text_is_cut_between_pieces(spark, monkeypatch):
    text = "one two three four five.\n" * 400_000  # 10 MB, several slices
    docs = spark.createDataFrame([(1, text, "en"), (2, "x " * 1_500_000, "en")], SCHEMA)
    got = {r["phrase"]: r["n"] for r in c.frequent_phrases(docs, 1000, sample=1).collect()}
    assert got["two three four five"] == 400_000 and "five one" not in got
    assert got["x"] == 1_500_000 and got["x x x x"] == 1_499_997 and got[""] == 3_500_000


def test_portions_hold_all_text():
    monster = "a b. " * 1_000_000
    column = pa.array(["short", None, monster, ""])
    parts = [(lo, hi, p.to_pylist()) for lo, hi, p in c._portions(column)]
    assert "".join(x or "" for _, _, p in parts for x in p) == "short" + monster and len(parts) > 2


def test_empty_table_and_other_columns(spark):
    odd = spark.createDataFrame([(1, "a b " * 40, "en", "z", 3)], SCHEMA + ", phrase string, n int")
    assert found(c.collocations(odd)) == brute([(1, "a b " * 40, "en")], 30, 2000)
    nothing = c.collocations(odd.limit(0))
    assert nothing.count() == 0 and dict(nothing.dtypes)["score"] == "bigint"
    assert c.collocations(odd.drop("doc_id")).count() == len(brute([(1, "a b " * 40, "en")], 30, 2000))


def test_scores_are_exact_beyond_64_bits(spark):
    values = [(10**13 + 7, 10**13 + 9, 10**14 + 3), (2**53 + 1, 2**53 + 1, 2**53 + 1), (9 * 10**17, 9 * 10**18, 9 * 10**18), (30, 45, 61)]
    got = spark.createDataFrame(values, "a long, l long, r long").selectExpr("a", f"{c.SCORE} as score").collect()
    assert {r["a"]: r["score"] for r in got} == {a: 2_000_000 * a // (left + right) for a, left, right in values}
