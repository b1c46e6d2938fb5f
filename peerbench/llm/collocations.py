"""Phrases whose words belong together: frequent phrases by Toivonen's method, then a score of their cuts.

Phrases of one to four words are counted per language within pieces of text between punctuation marks and line breaks. A
sample of the documents proposes phrases (seen there at least ``SEEN`` times; the sample is a fixed share of the rows, so it
grows with them). A full pass counts the proposed phrases and the negative border, the phrases that were not proposed
though both of their shorter parts were. It counts under hashes, which can only count too much: what stays below the
threshold is not frequent. Border phrases that reach it are failures of the sample. While there are some, the next pass
counts the phrases that they bring within reach (four passes at most, as these are longer each time). At the end
the phrases that reached the threshold are counted exactly, by their words.

What is proposed or known goes to the tasks as bitmaps of fixed size, which pass some phrases more than they hold: those are
counted, too, and change nothing. Equal phrases are added up within a slice of text (told apart by 128 bits there), then
per task and then by their words, so a phrase that is everywhere costs a row per task.

Null texts have no words, a null language is ``und``, repeated rows count each time; texts of any length are cut between
pieces; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peerbench.llm.frames import Bits, stored, table
from peerbench.llm.tokens import cut, grams, mix, slices

LONGEST, SUPPORT, TOP = 4, 30, 2000
#: One document row in so many is in the sample; a phrase seen twice there is proposed.
SAMPLE, SEEN = 8, 2
BITS = 26
SLICE = 1 << 20
#: Border hashes that a task holds before it packs them.
HELD = 3_000_000
COVERED = 80

SEPARATOR = np.zeros(256, bool)
SEPARATOR[list(b".,;:!?\n\x0b\x0c\r")] = True
WORD = ~SEPARATOR
WORD[list(b" \t")] = False


@dataclass
class Phrases:
    """Words of some texts with, per length, the hash of the phrase that begins at each word and whether there is one."""

    text: np.ndarray
    start: np.ndarray
    size: np.ndarray
    lang: np.ndarray
    hashes: list[np.ndarray]
    there: list[np.ndarray]

    def phrases(self, at: np.ndarray, length: int) -> pa.Array:
        """The words of the phrases that begin at the given words, with single spaces between."""
        last = at + length - 1
        sizes = self.start[last] + self.size[last] - self.start[at]
        offsets = np.zeros(len(at) + 1, np.int32)
        np.cumsum(sizes, out=offsets[1:])
        places = np.repeat((self.start[at] - offsets[:-1]).astype(np.int32), sizes)
        places += np.arange(offsets[-1], dtype=np.int32)
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(self.text[places]))


def phrases_of(text: pa.Array, lang: np.ndarray, lang_hash: np.ndarray) -> Phrases:
    """Phrases of texts whose languages have the numbers ``lang`` and per number a hash."""
    words = cut(text, WORD, lower=True)
    row = np.repeat(np.arange(len(lang)), words.counts)
    own = mix(words.hashes() ^ lang_hash[lang[row]])
    marks = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(SEPARATOR[words.data], out=marks[1:])
    whole = np.ones(len(row), bool)  # whether word i and word i + 1 stand in one piece
    whole[-1:] = False
    whole[:-1] = (row[1:] == row[:-1]) & (marks[words.start[1:]] == marks[words.end[:-1]])
    hashes, there = [own], [np.ones(len(row), bool)]
    for length in range(2, LONGEST + 1):
        hashes.append(grams(own, length))
        there.append(there[-1][: len(hashes[-1])] & whole[length - 2 : length - 2 + len(hashes[-1])])
    size = words.end - words.start
    start = np.concatenate([[0], np.cumsum(size + 1)]).astype(np.int64)
    places = np.repeat(words.start - start[:-1], size + 1) + np.arange(start[-1])
    spaced = np.full(start[-1], 0x20, np.uint8)
    solid = np.ones(start[-1], bool)
    solid[start[1:] - 1] = False
    spaced[solid] = words.data[places[solid]]
    return Phrases(spaced, start[:-1], size, lang[row], hashes, there)


def _portions(text: pa.Array) -> Iterator[tuple[int, int, pa.Array]]:
    """Ranges of rows with their texts; a text beyond the size of a slice comes in portions cut between pieces."""
    for lo, hi in slices(text, SLICE):
        part = text.slice(lo, hi - lo)
        if hi - lo > 1 or part.nbytes <= 2 * SLICE:
            yield lo, hi, part
            continue
        data = part[0].as_py().encode()
        ends = np.flatnonzero(SEPARATOR[np.frombuffer(data, np.uint8)]) + 1
        begin = 0
        while begin < len(data):
            later = np.searchsorted(ends, begin + SLICE)
            end = int(ends[later]) if later < len(ends) else len(data)
            yield lo, hi, pa.array([data[begin:end].decode()])
            begin = end


def _languages(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The languages of a batch, the number of each row's and a hash of each."""
    coded = column.fill_null("und").dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = [int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little") for n in names]
    return names, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.array(hashes, np.uint64)


#: In decimals, as the product may pass 64 bits.
SCORE = "(cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0))) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))"

def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], Phrases]]:
    """The names of the languages and the phrases of every portion of text."""
    for batch in batches:
        names, lang, lang_hash = _languages(batch.column("lang"))
        for lo, hi, text in _portions(batch.column("text")):
            yield names, phrases_of(text, lang[lo:hi], lang_hash)


def heavy(rows: DataFrame, hashes_of: Callable[[Phrases], list[np.ndarray]], support: int) -> DataFrame:
    """The column h: leading bits of the hashes that ``hashes_of`` gives ``support`` times or more over all rows.

    A task sorts its hashes and packs them by bucket with their numbers (cut at ``support``, which is enough); a bucket's
    packs are added up together. Beyond the bucket 32 bits of a hash are kept, so that some more may be found heavy.
    """
    # a few buckets per shuffle partition, 1,024 at least
    bits = max(10, (8 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    below = np.uint64(64 - bits - 32)
    number = np.dtype(np.uint8 if support < 256 else np.uint32)

    def pack(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h, n = np.unique(np.concatenate(held) >> below, return_counts=True)
        if not len(h):
            return
        n = np.minimum(n, support).astype(number)
        bucket = (h >> np.uint64(32)).astype(np.int32)
        begins = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = [*begins[1:], len(h)]
        low = h.astype(np.uint32)
        yield pa.RecordBatch.from_arrays([
            pa.array(bucket[begins]), pa.array([low[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
            pa.array([n[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary())], ["bucket", "hashes", "numbers"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, found in _parts(batches):
            new = hashes_of(found)
            held += new
            size += sum(map(len, new))
            if size >= HELD:
                yield from pack(held)
                held, size = [], 0
        if size:
            yield from pack(held)

    def found(bucket: int, hashes: list[bytes], numbers: list[bytes]) -> pa.RecordBatch:
        low, n = np.frombuffer(b"".join(hashes), np.uint32), np.frombuffer(b"".join(numbers), number)
        order = np.argsort(low, kind="stable")
        low, n = low[order], n[order]
        begins = np.flatnonzero(np.diff(low.astype(np.int64), prepend=-1))
        often = np.add.reduceat(n.astype(np.int64), begins) >= support
        h = (np.uint64(bucket) << np.uint64(32) | low[begins[often]].astype(np.uint64)) << below
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, hashes, numbers = None, [], []
        for batch in batches:
            for b, h, n in zip(*[column.to_pylist() for column in batch.columns]):
                if b != bucket and hashes:
                    yield found(bucket, hashes, numbers)
                    hashes, numbers = [], []
                bucket = b
                hashes.append(h)
                numbers.append(n)
        if hashes:
            yield found(bucket, hashes, numbers)

    packs = rows.select("text", "lang").mapInArrow(run, "bucket int, hashes binary, numbers binary")
    return packs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "h long")


def within_reach(known: Bits, before: Sequence[Bits], shortest: int) -> Callable[[Phrases], list[np.ndarray]]:
    """Hashes of the phrases with both shorter parts in ``known`` but not in one of the sets before it; words have no parts."""

    def hashes(found: Phrases) -> list[np.ndarray]:
        out = []
        for length in range(shortest, LONGEST + 1):
            open_ = found.there[length - 1]
            for at, bits in enumerate((known, *before)):
                if length > 1 and open_.any():
                    part = bits.have(found.hashes[length - 2])
                    both = part[: len(open_)] & part[1 : len(open_) + 1]
                    open_ = open_ & (~both if at else both)
            out.append(found.hashes[length - 1][open_])
        return out

    return hashes


def by_words(rows: DataFrame, named: Bits) -> DataFrame:
    """lang, phrase, n of the phrases in ``named``; an empty phrase stands for all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, found in _parts(batches):
            name_column = pa.array(names, pa.string())
            total = np.bincount(found.lang, minlength=len(names))
            yield pa.RecordBatch.from_arrays([name_column, pa.array([""] * len(names)), pa.array(total)], ["lang", "phrase", "n"])
            for length in range(1, LONGEST + 1):
                h = found.hashes[length - 1]
                at = np.flatnonzero(found.there[length - 1] & named.have(h))
                if len(at):
                    first, n = _equal(h[at], grams(found.hashes[0], length, 1)[at])
                    at = at[first]
                    yield pa.RecordBatch.from_arrays(
                        [name_column.take(pa.array(found.lang[at])), found.phrases(at, length), pa.array(n)], ["lang", "phrase", "n"])

    return rows.select("text", "lang").mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _equal(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and number of every different pair."""
    order = np.lexsort((b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    begins = np.flatnonzero(new)
    return order[begins], np.diff(np.append(begins, len(a)))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, sample: int = SAMPLE, seen: int = SEEN) -> DataFrame:
    """lang, phrase, length, n for every phrase of up to four words that occurs ``support`` times; length 0: all words of a language."""
    drawn = F.pmod(F.xxhash64(*[F.col(c) for c in ("doc_id", "text") if c in docs.columns]), F.lit(sample)) == 0
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), drawn.alias("drawn"))
    everything = lambda found: [h[t] for h, t in zip(found.hashes, found.there)]
    proposed = stored(heavy(rows.where("drawn"), everything, seen), "proposed")
    known, frequent = [Bits(proposed, "h", BITS)], None
    for number in range(1, LONGEST + 1):
        new = stored(heavy(rows, within_reach(known[-1], known[:-1], number), support), "heavy")
        frequent = new if frequent is None else frequent.union(new)
        failures = new.join(proposed, "h", "left_anti") if number == 1 else new
        if failures.isEmpty():
            break
        known.append(Bits(frequent, "h", BITS))
    length = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ", -1)))
    counts = by_words(rows, Bits(frequent, "h", BITS)).where((F.col("n") >= support) | (F.col("phrase") == ""))
    return stored(counts.select("lang", "phrase", length.alias("length"), "n"), "frequent")


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, covered: int = COVERED, sample: int = SAMPLE, seen: int = SEEN) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases of two to four words."""
    known = frequent_phrases(docs, support, sample, seen)
    words = F.split("phrase", " ", -1)
    size = F.size("w")

    def part(first, length):
        return F.array_join(F.slice("w", first, length), " ")

    phrases = known.where("length >= 2").select("lang", "phrase", F.col("n").alias("a"), words.alias("w"))
    # every part of a frequent phrase is frequent, so it is in the table
    sides = phrases.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    sides = sides.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, size - F.col("k")).alias("rest"))
    for side, name in (("first", "l"), ("rest", "r")):
        sides = sides.join(known.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    best = (
        sides.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b")).select("lang", "phrase", "b.score", "b.a", "b.l", "b.r"))

    longer = phrases.where(size > 2).select("lang", "w", "a", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    longer = longer.select("lang", "w", "a", "m", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("at"))
    longer = longer.select("lang", part(F.col("at"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(
        F.expr(f"longest is null or cast(longest as decimal(19, 0)) * 100 < cast(a as decimal(19, 0)) * {covered}"))
    total = known.where("length = 0").select("lang", "n")
    order = (F.desc("score"), F.desc("a"), "phrase")
    # the first of each of 64 shares, then the first of those
    share = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order))
    few = kept.withColumn("rank", share).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = rf"""
with piece as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece from documents where text is not null
), word as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from piece
), gram as (
  select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(list_slice(w, i, i + m - 1), ' '))) as phrase
  from word, (select unnest(range(1, {LONGEST + 1})) as m) where len(w) >= m
), total as (
  select lang, count(*) as n from gram where m = 1 group by 1
), known as (
  select lang, m, phrase, count(*) as f from gram group by 1, 2, 3 having count(*) >= {SUPPORT}
), candidate as (
  select lang, m, phrase, f as a, string_split(phrase, ' ') as w from known where m >= 2
), side as (
  select *, array_to_string(list_slice(w, 1, k), ' ') as one, array_to_string(list_slice(w, k + 1, m), ' ') as two
  from (select *, unnest(range(1, m)) as k from candidate)
), scored as (
  select s.lang, s.phrase, s.a, s.k, x.f as l, y.f as r, cast((cast(2000000 as hugeint) * s.a) // (x.f + y.f) as bigint) as score
  from side s join known x on x.lang = s.lang and x.phrase = s.one join known y on y.lang = s.lang and y.phrase = s.two
), best as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inner_part as (
  select lang, a, array_to_string(list_slice(w, i, i + q - 1), ' ') as phrase
  from (select *, unnest(range(1, m - q + 2)) as i from (select *, unnest(range(2, m)) as q from candidate where m > 2))
), covering as (
  select lang, phrase, max(a) as longest from inner_part group by 1, 2
), kept as (
  select b.* from best b left join covering c using (lang, phrase) where longest is null or 100 * longest < {COVERED} * b.a
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept
)
select lang, rank, phrase, a, l, r, n, score from ranked join total using (lang) where rank <= {TOP}
"""
