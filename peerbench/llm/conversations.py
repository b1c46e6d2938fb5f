"""Repair of the structure of conversations: the cheapest edits that make the roles ``(s?(ua)+)?``, by integers alone.

Between the messages of a conversation lie nodes (messages read, state of the roles); an edit is an edge between them. The
weight of a path is one integer: its high digits are the cost, and below them stand as many octal digits as an edit list can
have letters, the first edit in the highest one, filled up with zeros at the end. So the smaller of two integers is
the cheaper list, and of equally dear lists the one that comes first in ASCII order; a minimum over plain integers decides
everything. The table is filled from the last message backwards; stepping back moves the letters of the rest one
digit down. More than two insertions at one place never pay, as they come back to a state.

Messages are dealt out by ranges of (conversation, turn), so that a conversation of any size is spread over tasks. One that
lies inside a range is solved there. Others are cut into parts of ``PART`` messages, each with its integers from every
state to every state; the parts of a conversation are put together two by two (concatenated lists keep their order,
because the lists of a part that join the same states end with the same number of messages), and the resulting edits are
carried out part by part. A digest of a whole conversation is taken part after part, as a digest has to be.

Nulls in role and text are read as one space. Messages of one turn are ordered by role and then by the digest of the
text; null turns come first, null ids are one conversation. A role's initial is its first character. Identical messages are
counted where they are read, and an equal earlier message is found by joining the first turns per (conversation, role,
text digest). An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerbench.llm.frames import arrow_map, stored, table

#: Messages and bytes of text from which a conversation is cut into parts.
PART, PART_BYTES = 256, 8 << 20

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a role's initial leads to, and the one that an inserted or renamed message leads to.
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
LETTERS = " DIKR"
DELETE, INSERT, KEEP, RENAME = 1, 2, 3, 4
COST = {DELETE: 3, INSERT: 2, KEEP: 0, RENAME: 2}
#: What has to follow when all messages are read.
CLOSING = {START: (0, ""), SYSTEM: (4, "II"), USER: (2, "I"), ASSISTANT: (0, "")}

FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL = {"su", "ua", "au"}


def backwards(messages: Sequence[tuple[str, int]], ends: Sequence[int | None], width: int) -> list[int | None]:
    """The least weight from each state before ``messages`` (initial, fault) on, given those behind them; None: no way."""
    shift, top = 3 * width, 3 * width - 3
    letters = (1 << shift) - 1

    def edge(rest: int | None, letter: int, more: int = 0) -> int | None:
        if rest is None:
            return None
        return (((rest >> shift) + COST[letter] + more) << shift) | (letter << top) | ((rest & letters) >> 3)

    def least(*ways: int | None) -> int | None:
        return min((w for w in ways if w is not None), default=None)

    behind = list(ends)
    for initial, fault in reversed(messages):
        read = []
        for state in range(4):
            ways = [edge(behind[state], DELETE)]
            if fault not in (BLANK, DUPLICATE):
                more = int(fault == TRUNCATED)
                ways.append(edge(behind[NEXT[state]], RENAME, more))
                if (state, initial) in STEP:
                    ways.append(edge(behind[STEP[state, initial]], KEEP, more))
            read.append(least(*ways))
        once = [least(read[s], edge(read[NEXT[s]], INSERT)) for s in range(4)]
        behind = [least(read[s], edge(once[NEXT[s]], INSERT)) for s in range(4)]
    return behind


def spelled(weight: int, width: int) -> tuple[int, str]:
    """Cost and letters of a weight."""
    digits = f"{weight & ((1 << 3 * width) - 1):0{width}o}".rstrip("0") if width else ""
    return weight >> 3 * width, "".join(LETTERS[int(d)] for d in digits)


def _weight(cost: int, letters: str, width: int) -> int:
    weight = cost
    for letter in letters.ljust(width):
        weight = weight << 3 | LETTERS.index(letter)
    return weight


def cheapest(messages: Sequence[tuple[str, int]]) -> tuple[int, str]:
    """Cost and letters of the edits of a whole conversation."""
    width = 3 * len(messages) + 2
    return spelled(backwards(messages, [_weight(*CLOSING[s], width) for s in range(4)], width)[START], width)


def crossings(messages: Sequence[tuple[str, int]]) -> dict[tuple[int, int], tuple[int, str]]:
    """Cost and letters of the best edits from every state to every state."""
    width, found = 3 * len(messages), {}
    for end in range(4):
        for state, weight in enumerate(backwards(messages, [0 if s == end else None for s in range(4)], width)):
            if weight is not None:
                found[state, end] = spelled(weight, width)
    return found


def _meet(a: dict, b: dict) -> dict:
    """Crossings of two successive parts."""
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for (start, middle), (cost, letters) in a.items():
        for (other, end), (more, rest) in b.items():
            if other == middle:
                way = (cost + more, letters + rest)
                if (start, end) not in found or way < found[start, end]:
                    found[start, end] = way
    return found


def together(parts: Sequence[dict]) -> tuple[int, str]:
    """Cost and letters of the edits of a conversation from the crossings of its parts."""
    level = [*parts, {(state, START): way for state, way in CLOSING.items()}]
    while len(level) > 1:
        level = [_meet(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0][START, START]


def carried_out(letters: str, rows: Sequence[tuple[str, str]], state: int = START) -> tuple[list[tuple[str, str]], int]:
    """The (role, text) that the edits leave, and the state behind them."""
    out, at = [], 0
    for letter in letters:
        if letter in "IR":
            state = NEXT[state]
            out.append((ROLE[state], "" if letter == "I" else rows[at][1]))
        elif letter == "K":
            state = STEP[state, rows[at][0][:1]]
            out.append(rows[at])
        at += letter != "I"
    return out, state


@dataclass
class _Part:
    """Successive messages of one conversation; ``whole`` if its first message is known to be the conversation's."""

    conv: object
    whole: bool
    seq: int
    marks: list[tuple[str, int]] = field(default_factory=list)
    rows: list[tuple[str, str]] = field(default_factory=list)
    size: int = 0
    faults: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if self.marks:
            self.illegal += self.marks[-1][0] + initial not in LEGAL
        if turn is not None and (self.last_turn is None or turn != self.last_turn):
            self.turns += 1
            self.last_turn = turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        self.faults[fault] += 1
        self.marks.append((initial, fault))
        self.rows.append((role, text if fault not in (BLANK, DUPLICATE) else ""))
        self.size += len(text)

    def record(self, pid: int, closed: bool) -> dict:
        whole = self.whole and closed
        found = {
            "conv_id": self.conv, "pid": pid, "seq": self.seq, "whole": whole, "n_rows": len(self.marks), "illegal": self.illegal,
            "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED],
            "turns": self.turns, "first_turn": self.first_turn, "last_turn": self.last_turn, "cost": None, "audit": None, "ways": None,
            "first_initial": self.marks[0][0] if self.marks else None, "last_initial": self.marks[-1][0] if self.marks else None,
        }
        rows = self.rows
        if whole:
            found["cost"], found["audit"] = cheapest(self.marks)
            rows, _ = carried_out(found["audit"], rows)
        else:
            found["ways"] = [{"start": s, "end": e, "cost": c, "audit": a} for (s, e), (c, a) in crossings(self.marks).items()]
        return found | {"messages": [{"role": r, "text": t} for r, t in rows]}


_MESSAGES = "messages array<struct<role string, text string>>"
_PARTS = (
    "pid int, seq long, whole boolean, n_rows long, illegal long, blank long, duplicate long, truncated long, turns long, "
    "first_turn long, last_turn long, cost long, audit string, ways array<struct<start int, end int, cost long, audit string>>, "
    f"first_initial string, last_initial string, {_MESSAGES}"
)
_SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batches(records: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Records as batches of some hundred rows or a few megabytes."""
    held, size = [], 0
    for record in records:
        held.append(record)
        size += sum(len(m["text"] or "") for m in record.get("messages") or ())
        if len(held) >= 500 or size >= 4 << 20:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            yield from batch.slice(at, 500).to_pylist()


def _cut(rows: Iterator[dict], pid: int, most: int) -> Iterator[dict]:
    """Parts of ordered messages: whole conversations are solved, others get their crossings."""
    part, seq, marker, before = None, 0, None, None
    for row in rows:
        if part is None or row["conv_id"] != part.conv:
            if part is not None:
                yield part.record(pid, True)
                seq += 1
            part, marker, before = _Part(row["conv_id"], part is not None, seq), None, None
        key = (row["turn"], row["role"], row["key"])
        if row["kind"] == 0:
            marker = key
        elif row["kind"] == 1:
            for copy in range(row["copies"]):
                if row["blank"]:
                    fault = BLANK
                elif copy or key == marker or key == before:
                    fault = DUPLICATE
                else:
                    fault = TRUNCATED if row["truncated"] else FINE
                if len(part.marks) >= most or part.size >= PART_BYTES:
                    yield part.record(pid, False)
                    seq += 1
                    part = _Part(part.conv, False, seq)
                part.add(row["turn"], row["role"], row["text"], fault)
            before = key
    if part is not None:
        yield part.record(pid, False)


def _counted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Identical messages of a batch as one with their number."""
    keys = ["conv_id", "turn", "role", "key", "kind", "blank", "truncated"]
    grouped = pa.Table.from_batches([batch]).group_by(keys, use_threads=False).aggregate([("text", "first"), ("copies", "sum")])
    grouped = grouped.rename_columns({"text_first": "text", "copies_sum": "copies"}).select(batch.schema.names)
    yield from grouped.combine_chunks().to_batches()


def _solved(conv: list[dict]) -> Iterator[dict]:
    """Start state and edits of each part of a conversation; its summary stands with the first."""
    cost, audit = together([{(w["start"], w["end"]): (w["cost"], w["audit"]) for w in p["ways"]} for p in conv])
    turns, last_turn, first_turn, illegal, initial = 0, None, None, 0, None
    for p in conv:
        turns += p["turns"] - (p["first_turn"] is not None and p["first_turn"] == last_turn)
        first_turn = p["first_turn"] if first_turn is None else first_turn
        last_turn = last_turn if p["last_turn"] is None else p["last_turn"]
        illegal += p["illegal"] + (None not in (initial, p["first_initial"]) and initial + p["first_initial"] not in LEGAL)
        initial = p["last_initial"] if p["n_rows"] else initial
    summary = {
        "gaps": 0 if first_turn is None else last_turn - first_turn + 1 - turns, "illegal": illegal, "cost": cost, "audit": audit,
        **{f: sum(p[f] for p in conv) for f in ("blank", "duplicate", "truncated")},
    }
    state, at = START, 0
    for number, p in enumerate(conv):
        lo, left = at, p["n_rows"]
        while left:
            left -= audit[at] != "I"
            at += 1
        letters = audit[lo:] if number == len(conv) - 1 else audit[lo:at]
        yield {"pid": p["pid"], "seq": p["seq"], "start": state, "letters": letters, "summary": None if number else summary}
        for letter, initial in _initials(letters, p["initials"]):
            state = NEXT[state] if letter in "IR" else STEP[state, initial] if letter == "K" else state


def _initials(letters: str, initials: list[str]) -> Iterator[tuple[str, str]]:
    at = 0
    for letter in letters:
        yield letter, initials[at] if letter != "I" else ""
        at += letter != "I"


def repair(rows: DataFrame, part: int = PART) -> DataFrame:
    """Repaired conversations of messages (conv_id, turn, role, text), one row per part of one.

    conv_id, pid and seq (order of the parts), whole (the only part), summary (gaps, blank, duplicate, truncated, illegal,
    cost, audit; null but for the first part), messages (role and text of what stays or comes in). A message with
    ``dropped`` counts as absent, but its conversation is in the result.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    dropped = F.col("dropped") if "dropped" in rows.columns else F.lit(False)
    solid = F.expr("rtrim(' \t\n\x0b\f\r', text)")
    plain = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), dropped.alias("dropped"))
    there = plain.where("not dropped").select(
        "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("key"), F.lit(1).alias("kind"), (solid == "").alias("blank"),
        (~F.right(solid, F.lit(1)).isin(".", "!", "?")).alias("truncated"), "text", F.lit(1).cast("long").alias("copies"))
    counted = arrow_map(there, _counted, there.schema)

    # turns at which an equal message has been seen before
    thin = there.where("not blank").select("conv_id", "role", "key", F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0).cast("long")).alias("turn")).alias("at"))
    first = thin.groupBy("conv_id", "role", "key").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first <> last")
    seen = thin.join(first.withColumnsRenamed({"conv_id": "c", "role": "r", "key": "k"}),
                     F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k"))).where("at <> first")
    nothing = [F.lit(None).cast("boolean").alias("blank"), F.lit(None).cast("boolean").alias("truncated"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies")]
    markers = seen.select("conv_id", F.when(F.col("at.known"), F.col("at.turn")).alias("turn"), "role", "key", F.lit(0).alias("kind"), *nothing)
    ghosts = plain.where("dropped").select(
        "conv_id", "turn", F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("key"), F.lit(2).alias("kind"), *nothing)
    order = ["conv_id", "turn", "role", "key"]
    ranged = counted.union(markers).union(ghosts).repartitionByRange(*order).sortWithinPartitions(*order, "kind")

    parts = T.StructType.fromDDL(f"conv_id {kind}, {_PARTS}")
    cut_schema = _arrow(parts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_cut(_rows(batches), TaskContext.get().partitionId(), part), cut_schema)

    found = stored(ranged.mapInArrow(cut, parts), "conversations")
    summary = "struct<gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string>"
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0).cast("long")).alias("gaps")
    whole = found.where("whole").select("conv_id", "pid", "seq", "whole", F.struct(gaps, *_SUMMARY[1:]).alias("summary"), "messages")

    paths = T.StructType.fromDDL(f"pid int, seq long, start int, letters string, summary {summary}")
    path_schema = _arrow(paths)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs = groupby(_rows(batches), key=lambda r: r["conv_id"])
        return _batches((r for _, conv in convs for r in _solved(list(conv))), path_schema)

    open_parts = found.where("not whole")
    # no text goes here: a part is its crossings and the initials of its messages
    light = open_parts.select(*[c for c in open_parts.columns if c != "messages"], F.transform("messages", lambda m: F.left(m["role"], F.lit(1))).alias("initials"))
    solved = light.repartition("conv_id").sortWithinPartitions("conv_id", "pid", "seq").mapInArrow(solve, paths)

    edited = T.StructType.fromDDL(f"conv_id {kind}, pid int, seq long, whole boolean, summary {summary}, {_MESSAGES}")
    edited_schema = _arrow(edited)

    def carry_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[dict]:
            for r in _rows(batches):
                left, _ = carried_out(r["letters"], [(m["role"], m["text"]) for m in r["messages"]], r["start"])
                yield {"conv_id": r["conv_id"], "pid": r["pid"], "seq": r["seq"], "whole": False, "summary": r["summary"],
                       "messages": [{"role": a, "text": b} for a, b in left]}

        return _batches(records(), edited_schema)

    parted = open_parts.select("conv_id", "pid", "seq", "messages").join(solved, ["pid", "seq"]).mapInArrow(carry_out, edited)
    return whole.union(parted)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, the fields of the summary and repaired_sha256 (messages as ``role:text``, joined by line breaks) per conversation."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    joined = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    whole = repaired.where("whole").select("conv_id", "summary.*", F.sha2(joined, 256).alias("repaired_sha256"))
    schema = _arrow(whole.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[dict]:
            for conv, parts in groupby(_rows(batches), key=lambda r: r["conv_id"]):
                digest, begun, summary = hashlib.sha256(), False, {}
                for part in parts:
                    summary = part["summary"] or summary
                    for m in part["messages"]:
                        digest.update(f"{chr(10) if begun else ''}{m['role']}:{m['text']}".encode())
                        begun = True
                yield {"conv_id": conv, **summary, "repaired_sha256": digest.hexdigest()}

        return _batches(records(), schema)

    parts = repaired.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "pid", "seq")
    return whole.union(parts.mapInArrow(run, T.StructType.fromDDL(f"conv_id {kind}, " + ", ".join(f"{f} {'string' if f == 'audit' else 'long'}" for f in _SUMMARY) + ", repaired_sha256 string")))


def damaged(rows: DataFrame) -> DataFrame:
    """The messages with the faults that the checksum of conversation and turn chooses; ``dropped`` marks lost ones."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    fault = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("f"))
    return fault.select(
        "conv_id", "turn",
        F.when(F.col("f") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("f") == 1, "").when(F.col("f") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("f") == 0).alias("dropped"),
        F.explode(F.when(F.col("f") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of every damaged and repaired conversation."""
    return digests(repair(damaged(table(spark, sf_dir, "conversations"))))


def _steps(target: int) -> str:
    """SQL for the best list that ends in a state after one more message, from those before it; lists as fixed-width cost and letters."""
    ways = [f"d.w{target}"]
    ways += [f"case when initial = '{i}' then k.w{state} end" for (state, i), to in STEP.items() if to == target]
    ways += [f"r.w{state}" for state in range(4) if NEXT[state] == target]
    return f"least({', '.join(ways)})"


def _more(way: str, cost: str, letter: str) -> str:
    return f"lpad(cast(cast(substr({way}, 1, 9) as bigint) + {cost} as varchar), 9, '0') || substr({way}, 10) || '{letter}'"


def _inserted(source: str, step: int) -> str:
    """SQL columns: the best list per state after up to one more insertion than in ``source``."""
    ways = {to: [f"g{step}.w{to}", *[_more(f"{source}.w{s}", "2", "I") for s in range(4) if NEXT[s] == to]] for to in range(4)}
    return "{" + ", ".join(f"'w{to}': least({', '.join(w)})" for to, w in ways.items()) + "}"


def _sql() -> str:
    """Forward over each conversation's messages with the best list of edits per state, as text."""
    kept = "{" + ", ".join(f"'w{s}': " + _more(f"ins.w{s}", "late", "K") for s in range(4)) + "}"
    renamed = "{" + ", ".join(f"'w{s}': " + _more(f"ins.w{s}", "2 + late", "R") for s in range(4)) + "}"
    deleted = "{" + ", ".join(f"'w{s}': " + _more(f"ins.w{s}", "3", "D") for s in range(4)) + "}"
    read = "{" + ", ".join(f"'w{to}': {_steps(to)}" for to in range(4)) + "}"
    # a text behind every list stands for "no way"; null is passed over by least()
    start = "{'w0': '000000000', 'w1': cast(null as varchar), 'w2': cast(null as varchar), 'w3': cast(null as varchar)}"
    return rf"""
with recursive byte_table as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc
), keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key from conversations
), summed as (
  select keyed.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda x: cast(ascii(x) as bigint))),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 20 as f from keyed, byte_table
), damaged as (
  select conv_id, turn, case when f = 4 then 'user' else role end as role,
    case f when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, unnest(case when f = 3 then [1, 2] else [1] end) as copy
  from summed where f <> 0
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as place,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as final from damaged
), compared as (
  select *, row_number() over (partition by conv_id, role, text order by place) > 1 as again from placed
), judged as (
  select *, substr(role, 1, 1) as initial, case when final = '' then 'blank' when again then 'duplicate'
    when final not in ('.', '!', '?') then 'truncated' end as fault from compared
), linked as (
  select *, cast(coalesce(fault = 'truncated', false) as int) as late, coalesce(fault in ('blank', 'duplicate'), false) as must,
    lag(initial) over (partition by conv_id order by place) || initial as pair from judged
), walk(conv_id, place, best) as (
  select distinct conv_id, cast(0 as bigint), {start} from conversations
  union all
  select conv_id, place, {read} as best from (
    select conv_id, place, initial, {deleted} as d, case when not must then {kept} end as k, case when not must then {renamed} end as r from (
      select *, {_inserted("g1", 0)} as ins from (
        select *, {_inserted("g0", 0)} as g1 from (
          select l.conv_id, l.place, initial, late, must, best as g0 from walk w join linked l
            on w.conv_id is not distinct from l.conv_id and l.place = w.place + 1)))
  )
), ends as (
  select conv_id, unnest([best.w0, best.w3, {_more("best.w2", "2", "I")}, {_more("best.w1", "4", "II")}]) as way
  from (select conv_id, max_by(best, place) as best from walk group by 1)
), decided as (
  select conv_id, min(way) as way from ends group by 1
), letters as (
  select conv_id, unnest(string_split(substr(way, 10), '')) as letter, unnest(range(1, length(way) - 8)) as nr from decided where length(way) > 9
), numbered as (
  select *, sum(cast(letter <> 'I' as int)) over w as at, sum(cast(letter <> 'D' as int)) over w as emitted
  from letters window w as (partition by conv_id order by nr rows unbounded preceding)
), told as (
  select n.conv_id, n.nr, n.letter, n.emitted, j.role, j.text, max(case when letter = 'K' and j.role[1] = 's' then 1 else 0 end) over (partition by n.conv_id) as system
  from numbered n left join judged j on n.conv_id is not distinct from j.conv_id and n.at = j.place and n.letter <> 'I'
), repaired as (
  select conv_id, sha256(string_agg(case when letter = 'K' then role when (emitted - system) % 2 = 1 then 'user' else 'assistant' end || ':' || coalesce(text, ''),
    chr(10) order by nr)) as repaired_sha256 from told where letter <> 'D' group by 1
), counts as (
  select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (pair not in ('su', 'ua', 'au')) as illegal from linked group by 1
)
select d.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, cast(coalesce(blank, 0) as bigint) as blank, cast(coalesce(duplicate, 0) as bigint) as duplicate,
  cast(coalesce(truncated, 0) as bigint) as truncated, cast(coalesce(illegal, 0) as bigint) as illegal, cast(substr(way, 1, 9) as bigint) as cost,
  substr(way, 10) as audit, coalesce(repaired_sha256, sha256('')) as repaired_sha256
from decided d left join counts c on d.conv_id is not distinct from c.conv_id left join repaired r on d.conv_id is not distinct from r.conv_id
"""


SQL = _sql()
