from __future__ import annotations

import random
import re
from datetime import datetime

from pyspark.sql import functions as F

from peerbench.llm.surrogates import assign_surrogates, replace_private, surrogate


def texts(spark, rows, key="k"):
    got = replace_private(spark.createDataFrame(rows, "doc_id long, text string"), key).collect()
    return {r["doc"]["doc_id"]: (r["text"], r["n_entities"]) for r in got}


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def test_types_and_formats(spark):
    text = "x +1 (836) 555-9331 y a.Bob7@mail8.example.com z 53.121.55.90 10.1.2.3 c 4111 1111 1111 1111 s 123-45-6789 token = \"839756d1d951091d9155cd2a457ceedd23acaf1e\" password=c1f6c02f845bf3028d end"
    got, n = texts(spark, [(1, text)])[1]
    form = r'x \+1 \([2-9]\d\d\) [2-9]\d\d-\d{4} y [a-z]\.[a-z]{3}\d@[a-z]{4}\d\.[a-z]{7}\.com z \d+\.\d+\.\d+\.\d+ 10\.\d+\.\d+\.\d+ c 4\d{3} \d{4} \d{4} \d{4} s \d{3}-\d\d-\d{4} token = "[0-9a-f]{40}" password=[0-9a-f]{18} end'
    assert n == 8 and re.fullmatch(form, got), got
    assert luhn(re.search(r"c ([\d ]{19})", got)[1].replace(" ", ""))
    assert not set(re.findall(r"[\w@.]{8,}", text)) & set(re.findall(r"[\w@.]{8,}", got)) - {"password"}


def test_coreference_gender_and_script(spark):
    got = texts(spark, [(1, "Mr. John Smith met Mrs. Anna Smith and Mr SMITH, Dr. Smith"), (2, "Mrs. Anna Smith; г-н Иван Петров и г-жа Мария Петров"), (3, "+1 (836) 555-9331 or +1-836-555-9331, a@b.com A@B.COM")])
    (john, smith), anna = re.match(r"Mr\. (\w+) (\w+) met", got[1][0]).groups(), re.search(r"Mrs\. (\w+)", got[1][0])[1]
    assert got[1][0] == f"Mr. {john} {smith} met Mrs. {anna} {smith} and Mr {smith.upper()}, Dr. {smith}"
    assert anna.endswith("a") and not john.endswith("a") and got[2][0].startswith(f"Mrs. {anna} {smith};")
    assert re.search(r"г-н [А-Я][а-я]+ ([А-Я][а-я]+) и г-жа [А-Я][а-я]+а \1$", got[2][0])
    one, two = re.findall(r"\+1[ -].*?\d{4}", got[3][0])
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", two)
    mails = got[3][0].split(", ")[1].split(" ")
    assert mails[0].upper() == mails[1]


def test_surrogates_are_distinct_and_no_real_entities(spark):
    # few forms, so that first attempts collide with each other and with the entities themselves
    rows = [("email", f"{a}{b}@x.com") for a in "abcdefghijklmnop" for b in "abcdefghijklm"] + [("ip", f"10.0.{i}.{j}") for i in range(20) for j in range(20)]
    rows += [("name:latin:n", f"name{i}") for i in range(400)] + [("email", "aa@x.com")]
    got = assign_surrogates(spark.createDataFrame(rows, "kind string, core string"), "k").collect()
    assert len(got) == len(set(rows)) == len({(r["kind"], r["surrogate"]) for r in got})
    assert not {(r["kind"], r["surrogate"]) for r in got} & set(rows)


def test_key_and_reruns(spark):
    rows = [(1, "mail bob@example.com"), (2, "bob@example.com again")]
    one, two = texts(spark, rows), texts(spark, rows)
    assert one == two and one[1][0].split(" ")[1] == one[2][0].split(" ")[0]
    assert texts(spark, rows, key="other")[1] != one[1]


def test_edge_rows_and_clashing_names(spark):
    rows = [(1, None), (2, ""), (3, "nothing to see, 12 items at 3.50"), (None, "a@b.com"), (5, "a@b.com x"), (5, "y a@b.com"), (6, "w " * 50_000 + "1.2.3.4")]
    got = replace_private(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    out = [(r["doc"]["doc_id"], r["n_entities"], r["text"]) for r in got]
    assert len(out) == 7 and {(1, 0, None), (2, 0, ""), (3, 0, rows[2][1])} <= set(out)
    mails = {re.search(r"\S+@\S+", t)[0] for _, n, t in out if t and "@" in t}
    assert len(mails) == 1 and "a@b.com" not in mails and not any(t and t.endswith("1.2.3.4") for _, _, t in out)
    assert replace_private(spark.createDataFrame([], "doc_id long, text string"), "k").count() == 0
    odd = spark.createDataFrame([(1, "a@b.com", "f", 2)], "doc_id long, text string, found string, tk int")
    assert replace_private(odd, "k", odd.columns).first()["doc"].asDict() == {"doc_id": 1, "text": "a@b.com", "found": "f", "tk": 2}


def test_every_mention_of_a_name_goes(spark):
    text = "Mr. John Smith met Bob. Later Smith said hi to John; SMITH's dog and John’s cat, johnson and smithy. Dr. John Smith left. Miss Ann O'Neil, O'Neil's."
    got, n = texts(spark, [(1, text), (2, "John and Smith without a title"), (3, "Mrs. John Doe")])[1]
    form = r"Mr\. (\w+) (\w+) met Bob\. Later \2 said hi to \1; (\w+)'s dog and \1’s cat, johnson and smithy\. Dr\. \1 \2 left\. Miss (\w+) (\w+), \5's\."
    m = re.fullmatch(form, got)
    assert m and m[3] == m[2].upper() and not re.search(r"\b(John|Smith|Ann|Neil)\b", got, re.I), got
    assert n == 8
    out = texts(spark, [(1, text), (2, "John and Smith without a title"), (3, "Mrs. John Doe")])
    # one John, of neither gender, since titles disagree
    assert out[2] == ("John and Smith without a title", 0) and out[3][0].startswith(f"Mrs. {m[1]} ") and m[1][-1] in "yehm"


def test_no_recognised_core_is_left(spark):
    rng = random.Random(4)
    given, family = ["Anna", "Boris", "Carla", "Dave", "Иван"], ["Miller", "Jones", "O'Hara", "Петров", "Smith-Jones"]
    rows = []
    for i in range(60):
        g, f = rng.choice(given), rng.choice(family)
        words = [rng.choice([g, f, f.upper(), f + "'s", "and", "so,", "(" + g + ")", "4711", "a@b.de", "\n"]) for _ in range(30)]
        at = rng.randrange(30)
        rows.append((i, " ".join(words[:at] + [rng.choice(["Mr.", "Mrs", "Dr.", "г-н"]), g, f + rng.choice(["", ","])] + words[at:]), g, f))
    got = texts(spark, [r[:2] for r in rows])
    seen = {}
    for i, text, g, f in rows:
        new = got[i][0]
        assert not re.search(rf"(?<!\w)({g}|{f})(?!\w)", new, re.I), (text, new)
        # the plain form of the same replacement: every mention by what stands after the title
        title = re.search(r"(Mr\.|Mrs|Dr\.|г-н) (\S+) ([^ ,]+)", new)
        want = re.sub(rf"(?<!\w){f}(?!\w)", title[3], text)
        want = re.sub(rf"(?<!\w){f.upper()}(?!\w)", title[3].upper(), want)
        want = re.sub(rf"(?<!\w){g}(?!\w)", title[2], want)
        assert want.replace("a@b.de", "") == re.sub(r"\w@\w\.de", "", new), (want, new)
        for real, made in ((g, title[2]), (f, title[3])):
            assert seen.setdefault(real, made) == made
    assert len(set(seen.values())) == len(seen)


def rest97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def test_ibans_birth_dates_and_long_addresses(spark):
    text = "to GB29 NWBK 6016 1331 9268 19 or DE89370400440532013000, born on 12.03.1985, DOB: 1985-03-12, at 2001:db8::ff00:42:8329 or fe80::1; 1985-03-12, 7536784127813051"
    got, n = texts(spark, [(1, text)])[1]
    m = re.fullmatch(r"to (GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d) or (DE\d{20}), born on (\d\d\.\d\d\.\d{4}), DOB: (\d{4}-\d\d-\d\d), at (2001:[0-9a-f]{3}::[0-9a-f]{4}:[0-9a-f]{2}:[0-9a-f]{4}) or (fe80::[0-9a-f]); 1985-03-12, 7536784127813051", got)
    assert m and n == 6, got
    assert rest97(m[1].replace(" ", "")) == rest97(m[2]) == 1 and not any(part in text for part in m.groups()[:5])
    datetime.strptime(m[3], "%d.%m.%Y"), datetime.strptime(m[4], "%Y-%m-%d")


def test_short_spaces_do_not_run_out(spark):
    # all shortened link addresses, all short numbers: none is free in its usual form
    rows = [("ip6", f"fe80::{i:x}") for i in range(1, 16)] + [("secret", f"{i}") for i in range(10)] + [("email", f"{a}@x.de") for a in "abcdefghijklmnopqrstuvwxyz"]
    got = assign_surrogates(spark.createDataFrame(rows, "kind string, core string"), "k").collect()
    made = {(r["kind"], r["surrogate"]) for r in got}
    assert len(got) == len(rows) == len(made) and not made & set(rows)
    assert all(r["surrogate"].startswith("fe80:") for r in got if r["kind"] == "ip6")
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.de", r["surrogate"]) for r in got if r["kind"] == "email")
    # private ranges: the narrow one, then the widest, then public ones
    tried = spark.createDataFrame([("ip", "192.168.3.4", a) for a in (0, 8, 9, 16, 17)], "kind string, core string, attempt int")
    ips = [r[0] for r in tried.select(surrogate(F.col("kind"), F.col("core"), F.col("attempt"), "k")).collect()]
    assert [i.startswith("192.168.") for i in ips] == [True, True, False, False, False] and [i.startswith("10.") for i in ips[2:]] == [True, True, False]
