from __future__ import annotations

import hashlib
import random

import pytest
from corpus_pipeline import drop_repeated_lines
from peerbench.llm.linededup import dedup_lines, dedup_passages


def cut(text, divisor=3):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:15], 16) % 1_000_003 for x in lines]
    starts = [i for i in range(len(lines)) if i == 0 or i > 1 and (h[i - 2] * 31 + h[i - 1]) % 1_000_003 % divisor == 0]
    return [lines[a:b] for a, b in zip(starts, starts[1:] + [len(lines)])]


def brute(rows):
    first = {}
    multi = lambda c: sum(bool(x.strip(" ")) for x in c) >= 2
    for doc_id, text in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0])):
        for place, c in enumerate(cut(text)):
            if multi(c):
                first.setdefault("\n".join(c), (doc_id, place))
    out = []
    for doc_id, text in rows:
        kept = None if text is None else [c for p, c in enumerate(cut(text)) if not multi(c) or first["\n".join(c)] == (doc_id, p)]
        out.append((doc_id, None if kept is None else "\n".join(x for c in kept for x in c)))
    return sorted(out, key=repr)


def found(spark, rows):
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return sorted(((r["doc"]["doc_id"], r["text"]) for r in got), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    lines = [f"line {i} é" for i in range(12)] + ["", "  "]
    block = [f"shared {i}" for i in range(9)]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 8)) + (block if i % 3 == 0 else []) + rng.choices(lines, k=3))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n\n"), rows[3], (None, rows[5][1]), (103, "\n".join(f"x{i % 700}" for i in range(5000)))]
    want = brute(rows)
    assert found(spark, rows) == want
    assert sum(len(t or "") for _, t in want) < sum(len(t or "") for _, t in rows)


def test_a_moved_passage_is_cut_at_the_same_places():
    block = [f"passage {i}" for i in range(40)]
    inner = lambda text: {"\n".join(c) for c in cut(text)}
    assert len(inner("\n".join(["a", "b"] + block)) & inner("\n".join(["c"] + block + ["d"]))) >= 5


def test_empty_table_and_clashing_names(spark):
    assert found(spark, []) == []
    odd = spark.createDataFrame([(1, "a\nb", "x", 2)], "doc_id long, text string, chunk string, removed int")
    row = dedup_lines(odd, odd.columns).first()
    assert row["doc"].asDict() == {"doc_id": 1, "text": "a\nb", "chunk": "x", "removed": 2} and row["text"] == "a\nb"


def brute_passages(rows):
    """What stays of each row, pair by pair of successive lines that are not blank."""
    first, own = {}, {}
    for doc_id, text in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = text.split("\n")
        solid = [i for i, x in enumerate(lines) if x.strip(" \t\n\v\f\r")]
        gone = set()
        for place, (lo, hi) in enumerate(zip(solid, solid[1:])):
            at = first.setdefault("\n".join(lines[lo : hi + 1]), (doc_id, place))
            if at[0] != doc_id or place >= at[1] + 2:
                gone.update(range(lo, hi + 1))
        own[doc_id, text] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return sorted(((d, None if t is None else own[d, t]) for d, t in rows), key=repr)


def passages_found(spark, rows):
    got = dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return sorted(((r["doc"]["doc_id"], r["text"]) for r in got), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    lines = [f"line {i} é" for i in range(25)] + ["", "  ", "\t"]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 8)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n\n"), rows[3], (None, rows[5][1]), (103, "\n".join(f"x{i % 700}" for i in range(5000)))]
    rows += [(104, "q\nq\nq"), (105, "r\nr\nr\nr\nr"), (106, "q\nq\nq")]
    want = brute_passages(rows)
    assert passages_found(spark, rows) == want
    assert (104, "q\nq\nq") in want and (105, "r\nr") in want and (106, "") in want
    # the first occurrence of each line stays
    kept = {x for _, t in want for x in (t or "").split("\n")}
    assert {x for _, t in rows for x in (t or "").split("\n") if x.strip()} <= kept


def test_the_stage_removes_every_short_passage(spark):
    rng = random.Random(5)
    rows, blocks, fresh = [], {}, lambda: " ".join(f"w{rng.randrange(10**9)}" for _ in range(30))
    for k in range(180):
        size = 2 + k % 9
        blocks[k] = [fresh() for _ in range(size)]
        for doc in (2 * k, 2 * k + 1):
            rows.append((doc, "\n".join([fresh(), *blocks[k], fresh()])))
    after = drop_repeated_lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    left = {r["doc_id"]: r["text"] for r in after.collect()}
    for k, block in blocks.items():
        assert left[2 * k] == dict(rows)[2 * k]
        before = dict(rows)[2 * k + 1].split("\n")
        assert left[2 * k + 1].split("\n") == [before[0], before[-1]]


def brute_grown(rows):
    """What stays of each row without the chunks and the pairs of lines that stand earlier."""
    multi = lambda c: sum(bool(x.strip(" ")) for x in c) >= 2
    chunk_at, pair_at, own = {}, {}, {}
    for doc_id, text in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines, gone, lo = text.split("\n"), set(), 0
        for place, c in enumerate(cut(text)):
            if multi(c) and chunk_at.setdefault("\n".join(c), (doc_id, place)) != (doc_id, place):
                gone.update(range(lo, lo + len(c)))
            lo += len(c)
        solid = [i for i, x in enumerate(lines) if x.strip(" \t\n\v\f\r")]
        for place, (lo, hi) in enumerate(zip(solid, solid[1:])):
            at = pair_at.setdefault("\n".join(lines[lo : hi + 1]), (doc_id, place))
            if at[0] != doc_id or place >= at[1] + 2:
                gone.update(range(lo, hi + 1))
        own[doc_id, text] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return sorted(((d, None if t is None else own[d, t]) for d, t in rows), key=repr)


def test_the_stage_removes_chunks_and_grows_them(spark):
    rng = random.Random(4)
    lines = [f"line {i} é" for i in range(12)] + ["", "", "  ", "\t"]
    block = [x for i in range(12) for x in (f"shared {i}", "", "\t")]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 8)) + (block if i % 3 == 0 else []) + rng.choices(lines, k=3))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n\n"), rows[3], (None, rows[5][1]), (103, "\n".join(f"x{i % 70}" for i in range(500)))]
    after = drop_repeated_lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    want = brute_grown(rows)
    assert sorted((tuple(r) for r in after.collect()), key=repr) == want
    # blank lines around a repeated passage go with its chunk
    assert want != brute_passages(rows)
    kept = {x for _, t in want for x in (t or "").split("\n")}
    assert {x for _, t in rows for x in (t or "").split("\n") if x.strip()} <= kept
