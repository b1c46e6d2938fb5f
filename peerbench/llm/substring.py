"""Removal of word spans that already stand in a document with a smaller id.

``remove_repeats`` compares the corpus with itself: each word covered by a window of 13 words goes if the same word
sequence starts in a document with a smaller id. Streaming every document past automata of every shard of the same
corpus takes work that grows with its square (figures in the README), so the windows are matched by hash here:

1. A window holds nine five-word grams; equal windows have the same smallest gram hash. The smallest hashes of each
   document are counted over the corpus, about a fifth as many rows as words. A window whose smallest gram stands
   in one document only is unique. The others are told from a bitmap of fixed size, which lets no repeated one slip.
2. The remaining windows, as 96-bit hashes, are reduced to their smallest doc_id, combined before the shuffle, so
   that a passage in a third of all documents is a few rows a task.
3. Each document gets the windows of which it is the smallest owner and removes its other remaining windows.

``remove_reference`` is the form with a given reference: suffix automata of reference shards are broadcast one at a
time and the documents stream past them for matching statistics, which gives the same spans as matching windows.

Defined results: null and blank texts have no words; rows that share a doc_id are one document (nothing in it counts
against itself); a null doc_id neither loses words nor counts as smaller; kept words are joined by one space.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.llm.frames import Bits, arrow_map, stored, table, with_doc
from peerbench.llm.tokens import SOLID, Words, cut, grams, slices, sliding_min

WINDOW = 13
_GRAM = 5
_FILTER_BITS = 26
#: Reference words of a shard; its automaton has at most twice as many states.
SHARD_WORDS = 100_000


def _windows(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and row of every window within a row, and its smallest gram hash."""
    row = np.repeat(np.arange(len(words.counts)), words.counts)
    gram = min(_GRAM, size)
    least = sliding_min(grams(hashes, gram), size - gram + 1)
    at = np.flatnonzero(np.arange(len(least)) + size <= words.first[row[: len(least)] + 1])
    return at, row[at], least[at]


def _covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``length`` words a window from one of ``starts`` covers."""
    edge = np.zeros(length + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, length), -1)
    return np.cumsum(edge[:-1]) > 0


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _anchors(docs: DataFrame, size: int) -> DataFrame:
    """(gram, doc_id): the smallest gram hash of every window; neighbours with the same one give one row."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column("doc_id").to_numpy()
        for lo, hi in slices(batch.column("text")):
            words = cut(batch.column("text").slice(lo, hi - lo), SOLID)
            _, row, least = _windows(words, words.hashes(), size)
            new = np.ones(len(least), bool)
            new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(least[new].view(np.int64)), pa.array(ids[lo:hi][row[new]])], ["gram", "doc_id"])

    return arrow_map(_texts(docs), run, "gram long, doc_id long")


def _candidates(docs: DataFrame, size: int, seen: Bits) -> DataFrame:
    """(w1, w2, doc_id) of every window whose smallest gram may stand in several documents."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column("doc_id").to_numpy()
        for lo, hi in slices(batch.column("text")):
            words = cut(batch.column("text").slice(lo, hi - lo), SOLID)
            hashes = words.hashes()
            at, row, least = _windows(words, hashes, size)
            good = seen.have(least)
            at, row = at[good], row[good]
            one, two = grams(hashes, size)[at], grams(hashes, size, lane=1)[at]
            yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array((two >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(ids[lo:hi][row])], ["w1", "w2", "doc_id"])

    return arrow_map(_texts(docs), run, "w1 long, w2 int, doc_id long")


def remove_repeats(docs: DataFrame, keep: Sequence[str] = ("doc_id",), size: int = WINDOW) -> DataFrame:
    """Per document row: ``doc`` (the columns named in ``keep``), n_words, n_removed, text (kept words)."""
    counted = _anchors(docs, size).groupBy("gram").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    seen = Bits(stored(counted.where("low < high").select("gram"), "grams"), "gram", _FILTER_BITS)
    owned = _candidates(docs, size, seen).groupBy("w1", "w2").agg(F.min("doc_id").alias("owner"))
    owned = owned.groupBy("owner").agg(F.collect_list("w1").alias("own"))  # at most the windows of one document
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(owned, F.col("id") == F.col("owner"), "left").select("doc", "id", "text", "own")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text, own, ids = batch.column("text"), batch.column("own"), batch.column("id")
        total, removed, kept = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), []
        for lo, hi in slices(text):
            words = cut(text.slice(lo, hi - lo), SOLID)
            hashes = words.hashes()
            at, row, least = _windows(words, hashes, size)
            good = seen.have(least)
            at, row = at[good], row[good]
            whole = grams(hashes, size)[at]
            bound = np.searchsorted(row, np.arange(hi - lo + 1))
            total[lo:hi] = words.counts
            for i in range(hi - lo):
                here = slice(bound[i], bound[i + 1])
                left = words.row_words(i)
                if here.stop > here.start and ids[lo + i].is_valid:
                    mine = own[lo + i].values.to_numpy() if own[lo + i].is_valid else np.zeros(0, np.int64)
                    other = ~np.isin(whole[here], mine.view(np.uint64))
                    gone = _covered(at[here][other] - words.first[i], len(left), size)
                    removed[lo + i] = gone.sum()
                    if removed[lo + i]:
                        left = [w for w, g in zip(left, gone) if not g]
                kept.append(b" ".join(left))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(total), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string())], ["doc", "n_words", "n_removed", "text"]
        )

    return arrow_map(rows, run, with_doc(rows, "n_words long, n_removed long, text string"))


class SuffixAutomaton:
    """All word sequences of the texts added; built word by word, at most two states per word."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, text: Sequence[int]) -> None:
        last = 0
        for word in text:
            old = self.next[last].get(word)
            if old is not None and self.length[old] == self.length[last] + 1:
                last = old
                continue
            if old is not None:
                last = self._split(last, old, word)
                continue
            state = self._state({}, self.length[last] + 1)
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = state
                p = self.link[p]
            if p < 0:
                self.link[state] = 0
            else:
                q = self.next[p][word]
                self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
            last = state

    def _state(self, edges: dict[int, int], length: int) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        clone = self._state(dict(self.next[q]), self.length[p] + 1)
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def matches(self, text: Sequence[int]) -> Iterator[int]:
        """Matching statistics: the length of the longest known sequence that ends at each word."""
        state = size = 0
        for word in text:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            yield size


def remove_reference(docs: DataFrame, reference: DataFrame, keep: Sequence[str] = ("doc_id",), size: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Removes from ``docs`` every word in a span of at least ``size`` words that a text of ``reference`` holds.

    Per document row: ``doc`` (the columns named in ``keep``), n_words, n_removed, text (kept words). The reference is
    dealt into shards of about ``shard_words`` words; one pass over the documents per shard, without a shuffle.
    """
    texts = stored(reference.where("text is not null").select(F.col("text").cast("string").alias("text")).distinct(), "reference")
    total = texts.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.col("text").cast("string").alias("text"), F.expr("cast(array() as array<bigint>)").alias("hit"))
    for k in range(shards):
        rows = _stream(rows, texts.where(F.pmod(F.xxhash64("text"), F.lit(shards)) == k), size)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        total, removed, kept = [], [], []
        for text, hit in zip(batch.column("text"), batch.column("hit").to_pylist()):
            left = cut(pa.array([text.as_py()], pa.large_string()), SOLID).row_words(0)
            gone = _covered(np.array(hit, np.int64), len(left), size)
            total.append(len(left))
            removed.append(int(gone.sum()))
            kept.append(b" ".join(w for w, g in zip(left, gone) if not g))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc", "n_words", "n_removed", "text"]
        )

    return arrow_map(rows, run, with_doc(rows, "n_words long, n_removed long, text string"))


def _stream(rows: DataFrame, shard: DataFrame, size: int) -> DataFrame:
    """Adds the window starts that one reference shard holds to ``hit``."""
    automaton, number = SuffixAutomaton(), {}
    for (text,) in shard.toLocalIterator():  # about shard_words words
        automaton.add([number.setdefault(w, len(number)) for w in text.encode().split()])
    shared = rows.sparkSession.sparkContext.broadcast((automaton, number))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        automaton, number = shared.value
        hits = []
        for text, old in zip(batch.column("text"), batch.column("hit").to_pylist()):
            words = [number.get(w, -1) for w in (text.as_py() or "").encode().split()]
            hits.append(sorted(set(old).union(at - size + 1 for at, length in enumerate(automaton.matches(words)) if length >= size)))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("text"), pa.array(hits, pa.list_(pa.int64()))], ["doc", "text", "hit"])

    return arrow_map(rows, run, with_doc(rows, "text string, hit array<long>"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without 13-word windows of documents with smaller ids."""
    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc.doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select doc_id, i, list_slice(w, i, i + 12) as win from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from words where len(w) >= 13)
), gone as (
  select distinct doc_id, unnest(range(i, i + 13)) as i from (select doc_id, i, min(doc_id) over (partition by win) < doc_id as old from windows) where old
), kept as (
  select doc_id, count(*) as n_words, count(g.i) as n_removed, coalesce(string_agg(word, ' ' order by p.i) filter (g.i is null), '') as kept_text
  from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from words) p left join gone g using (doc_id, i) group by 1
)
select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept_text, '')) as kept_sha256
from documents d left join kept using (doc_id)
"""
