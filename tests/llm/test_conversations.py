from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from peerbench.llm import conversations as c

SHAPE = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def enumerated(rows):
    """Cost, letters and result of the best of all edit lists with up to two insertions at each place."""
    best = None
    per_row = []
    for role, _, fault in rows:
        ways = [("D", None, 3)]
        if fault not in ("blank", "duplicate"):
            more = fault == "truncated"
            ways += [("K", role, more), ("R", "user", 2 + more), ("R", "assistant", 2 + more)]
        per_row.append(ways)
    gaps = [tuple(g) for k in range(3) for g in itertools.product(("user", "assistant"), repeat=k)]
    for picked in itertools.product(*per_row):
        for filled in itertools.product(gaps, repeat=len(rows) + 1):
            letters, out, cost = "", [], 0
            for at in range(len(rows) + 1):
                letters += "I" * len(filled[at])
                out += [(role, "") for role in filled[at]]
                cost += 2 * len(filled[at])
                if at < len(rows):
                    letter, role, price = picked[at]
                    letters, cost = letters + letter, cost + price
                    out += [(role, rows[at][1])] if role is not None else []
            if SHAPE.fullmatch("".join(role[:1] or "?" for role, _ in out)) and (best is None or (cost, letters) < best[:2]):
                best = (cost, letters, out)
    return best


def tabled(rows):
    """The same by a table of (cost, letters) pairs."""
    state_of = {"": 0, "s": 1, "u": 2, "a": 3}
    step = {(0, "s"), (0, "u"), (1, "u"), (3, "u"), (2, "a")}

    def best(at, state, inserts, memo):
        key = (at, state, inserts)
        if key not in memo:
            want = "assistant" if state == 2 else "user"
            ways = []
            if inserts < 2:
                ways.append(((2, "I"), (want, ""), (at, state_of[want[0]], inserts + 1)))
            if at < len(rows):
                role, text, fault = rows[at]
                ways.append(((3, "D"), None, (at + 1, state, 0)))
                if fault not in ("blank", "duplicate"):
                    more = fault == "truncated"
                    ways.append(((2 + more, "R"), (want, text), (at + 1, state_of[want[0]], 0)))
                    if (state, role[:1]) in step:
                        ways.append(((int(more), "K"), (role, text), (at + 1, state_of[role[0]], 0)))
            found = [(0, "", [])] if at == len(rows) and state in (0, 3) else []
            for (cost, letter), row, then in ways:
                rest = best(*then, memo)
                if rest:
                    found.append((cost + rest[0], letter + rest[1], ([row] if row else []) + rest[2]))
            memo[key] = min(found, default=None, key=lambda f: f[:2])
        return memo[key]

    memo = {}
    for at in reversed(range(len(rows))):  # from the end, so that the calls stay shallow
        for state in range(4):
            best(at, state, 0, memo)
    return best(0, 0, 0, memo)


def brute(rows, solve=tabled, damage=True):
    """Result per conversation of rows (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        kept += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, judged = set(), []
        for _, role, text in kept:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = {t for t, _, _ in kept if t is not None}
        initials = [role[:1] for role, _, _ in judged]
        cost, letters, left = solve(judged)
        count = lambda f: sum(j[2] == f for j in judged)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, count("blank"), count("duplicate"), count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, letters,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())
    return out


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def found(frame):
    return {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in frame.collect()}


def messages(seed, convs, longest, roles=("system", "user", "assistant", "user", "assistant", "tool", "", None)):
    rng, out = random.Random(seed), []
    texts = ["Fine.", "Cut off", "", " \n\t", "Why?  ", "Nö!\n", None, "x" * 50 + ".", "..."]
    for conv in range(convs):
        for turn in range(rng.randint(0, longest)):
            at = None if rng.random() < 0.05 else turn + (turn > 3) * 2
            text = rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.randrange(10**6)}."
            out += [(conv if conv else None, at, rng.choice(roles), text)] * (2 if rng.random() < 0.05 else 1)
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", range(60))
def test_integers_equal_all_edit_lists(seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["system", "user", "assistant", "tool"]), f"t{i}", rng.choice(["", "", "truncated", "blank", "duplicate"])) for i in range(rng.randint(0, 3))]
    faults = {"": c.FINE, "blank": c.BLANK, "duplicate": c.DUPLICATE, "truncated": c.TRUNCATED}
    cost, letters, left = enumerated(rows)
    marks = [(role[:1], faults[fault]) for role, _, fault in rows]
    assert c.cheapest(marks) == (cost, letters) == tabled(rows)[:2]
    assert c.carried_out(letters, [r[:2] for r in rows])[0] == left
    for cut in range(len(rows) + 1):
        assert c.together([c.crossings(marks[:cut]), c.crossings([]), c.crossings(marks[cut:])]) == (cost, letters)


@pytest.mark.parametrize("seed", range(20))
def test_parts_equal_the_whole(seed):
    rng = random.Random(seed)
    marks = [(rng.choice("suaa "), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 60))]
    size = rng.randint(1, 9)
    parts = [c.crossings(marks[i : i + size]) for i in range(0, len(marks), size)]
    assert c.together(parts) == c.cheapest(marks)


@pytest.mark.parametrize("seed,part", [(1, c.PART), (2, 3), (3, 1)])
def test_equals_brute_force(spark, seed, part):
    rows = messages(seed, 150, 9)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(c.digests(c.repair(c.damaged(frame), part))) == brute(rows)


def test_a_long_conversation_among_others(spark):
    rng = random.Random(4)
    texts = ["Yes.", "No.", "Cut", "Same text here."]
    rows = [(7, i // 2, rng.choice(["user", "assistant", "system"]), rng.choice(texts) if i % 3 else f"Own {i}.") for i in range(1200)]
    rows += messages(5, 20, 6)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert found(c.digests(c.repair(c.damaged(frame), 50))) == brute(rows)


def test_many_identical_messages(spark):
    rows = [(1, 5, "user", "Same.")] * 3000 + [(1, 6, "assistant", "Answer."), (1, 7, "user", "Same."), (2, None, "user", None)]
    got = found(c.digests(c.repair(spark.createDataFrame(rows, SCHEMA), 1000)))
    want = brute(rows, damage=False)
    assert got == want and got[1][2] == 3000


def test_dropped_empty_and_other_columns(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(9, gone, "user", "Lost.", 1)], SCHEMA + ", key int")
    assert found(c.digests(c.repair(c.damaged(frame)))) == {9: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    nothing = c.digests(c.repair(c.damaged(frame.limit(0))))
    assert nothing.columns == ["conv_id", *FIELDS] and nothing.count() == 0


def test_ids_may_be_text_and_messages_come_out(spark):
    rows = [("a", 1, "system", "Be brief."), ("a", 2, "assistant", "Hello."), ("a", 3, "user", "x" * 300_000 + ".")]
    got = c.repair(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).collect()
    assert [tuple(m) for r in got for m in r["messages"]] == [("system", "Be brief."), ("user", ""), ("assistant", "Hello."), ("user", rows[2][3]), ("assistant", "")]
    assert [r["summary"]["audit"] for r in got if r["summary"]] == ["KIKKI"]


def test_sql_equals_brute_force():
    rows = messages(11, 200, 9)
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = db.execute(c.SQL).fetchall()
    assert {r[0]: r[1:] for r in got} == brute(rows)
