"""Benchmark decontamination by a prefix-filtered set join of document shingles with item windows.

An item is cut into windows of 13 consecutive words (a shorter item is one window). A document holds a window
only if it holds every three-word shingle of it, so one shingle per window, its rarest over all documents, is
the necessary prefix. Documents are joined with the windows by that token; a hit at position p of a token that
stands at offset j puts the window at p - j, which must lie within the document (positional and length bounds);
there the words are compared one by one.

The windows are dealt into shards of at most ``shard_rows`` rows. One shard at a time is indexed and broadcast,
so the broadcast size is bounded whatever the size of the benchmark, and a larger benchmark costs more passes
over the documents. Documents are never shuffled.

Defined results: null or wordless texts have no words and no hits; items without words are left out; those
without an id hit words but are neither counted nor listed; repeated item rows count once; repeated documents are
judged row by row; item ids are listed once each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerbench.llm.frames import arrow_map, stored, table, with_doc
from peerbench.llm.tokens import ALNUM, Words, cut, grams, slices

WINDOW = 13
SHINGLE = 3
#: Window rows of a shard; at 13 words each an index stays below some 100 MB.
SHARD_ROWS = 100_000
_FILTER_BITS = 22


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, window): the distinct windows of every item, words joined by a space."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, windows = [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = cut(pa.array([text.as_py()], pa.large_string()), ALNUM, lower=True).row_words(0)
            for at in range(max(1, len(words) - WINDOW + 1) if words else 0):
                ids.append(item)
                windows.append(b" ".join(words[at : at + WINDOW]))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(windows, pa.binary())], ["item_id", "window"])

    named = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    return arrow_map(named, run, "item_id long, window binary").distinct()


@dataclass
class Shard:
    """Windows of a shard with the prefix token of each; tokens of one shingle size are sorted."""

    windows: list[list[bytes]]
    owners: list[list[int]]
    tokens: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # size -> token, run start, window, offset


def _key(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


class Finder:
    """Positions of known grams in a slice of documents."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[_key(known)] = True

    def __call__(self, words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position, row and number of the known gram of every occurrence within a row."""
        seen = grams(hashes, size)
        at = np.flatnonzero(self.maybe[_key(seen)])
        which = np.minimum(np.searchsorted(self.known, seen[at]), len(self.known) - 1)
        row = np.searchsorted(words.first, at, "right") - 1
        good = (self.known[which] == seen[at]) & (at + size <= words.first[row + 1])
        return at[good], row[good], which[good]


def _shingles(windows: list[list[bytes]]) -> dict[int, list[tuple[np.ndarray, int]]]:
    """Per shingle size: the shingle hashes of each window that is cut at this size."""
    out: dict[int, list[tuple[np.ndarray, int]]] = {}
    flat = pa.array([b" ".join(w).decode() for w in windows], pa.large_string())
    for lo, hi in slices(flat):
        words = cut(flat.slice(lo, hi - lo), ALNUM, lower=True)
        hashes = words.hashes()
        for i in range(hi - lo):
            own = hashes[words.first[i] : words.first[i + 1]]
            size = min(SHINGLE, len(own))
            out.setdefault(size, []).append((grams(own, size), lo + i))
    return out


def build_shard(rows: DataFrame, docs: DataFrame) -> Shard:
    """Index the (item_id, window) rows of a shard; shingle rarity is counted over all documents."""
    by_window: dict[bytes, list[int]] = {}
    got = rows.select("item_id", "window").toArrow()
    for item, window in zip(got["item_id"].to_pylist(), got["window"].to_pylist()):
        owners = by_window.setdefault(window, [])
        if item is not None:
            owners.append(item)
    windows = [w.split(b" ") for w in by_window]
    cuts = _shingles(windows)
    known = {size: np.unique(np.concatenate([s for s, _ in own])) for size, own in cuts.items()}
    finders = docs.sparkSession.sparkContext.broadcast({size: Finder(k) for size, k in known.items()})

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        totals = {size: np.zeros(len(f.known), np.int64) for size, f in finders.value.items()}
        for lo, hi in slices(batch.column(0)):
            words = cut(batch.column(0).slice(lo, hi - lo), ALNUM, lower=True)
            hashes = words.hashes()
            for size, find in finders.value.items():
                totals[size] += np.bincount(find(words, hashes, size)[2], minlength=len(find.known))
        for size, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), size)), pa.array(some), pa.array(total[some])], ["size", "gram", "n"]
            )

    counted = arrow_map(docs.select("text"), count, "size long, gram long, n long").groupBy("size", "gram").agg(F.sum("n").alias("n"))
    frequency = {size: np.zeros(len(k), np.int64) for size, k in known.items()}
    for size, gram, n in counted.toPandas().itertuples(index=False):  # at most the shingles of the shard
        frequency[size][gram] = n
    tokens = {}
    for size, own in cuts.items():
        rarest = []
        for shingles, window in own:
            order = frequency[size][np.searchsorted(known[size], shingles)]
            offset = min(range(len(shingles)), key=lambda j: (order[j], shingles[j]))
            rarest.append((shingles[offset], window, offset))
        rarest.sort()
        token, start = np.unique(np.array([r[0] for r in rarest], np.uint64), return_index=True)
        tokens[size] = (token, np.append(start, len(rarest)), np.array([r[1] for r in rarest]), np.array([r[2] for r in rarest]))
    return Shard(windows, list(by_window.values()), tokens)


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1]:
            out[-1] = max(out[-1], hi)
        else:
            out += [lo, hi]
    return out


def _search(docs: DataFrame, shard: Shard) -> DataFrame:
    """Adds the hits of one shard to the spans and items that earlier shards found."""
    shared = docs.sparkSession.sparkContext.broadcast((shard, {size: Finder(t[0]) for size, t in shard.tokens.items()}))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        shard, finders = shared.value
        text = batch.column("text")
        count = np.zeros(batch.num_rows, np.int64)
        spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
        for lo, hi in slices(text):
            words = cut(text.slice(lo, hi - lo), ALNUM, lower=True)
            count[lo:hi] = words.counts
            hashes, found = words.hashes(), {}
            for size, find in finders.items():
                _, start, window, offset = shard.tokens[size]
                for at, row, token in zip(*find(words, hashes, size)):
                    for k in range(start[token], start[token + 1]):
                        found.setdefault(row, []).append((at - words.first[row] - offset[k], window[k]))
            for row, candidates in found.items():
                own, hits, owners = words.row_words(row), [], set()
                for at, w in candidates:
                    window = shard.windows[w]
                    if at >= 0 and at + len(window) <= len(own) and own[at : at + len(window)] == window:
                        hits.append((int(at), int(at) + len(window)))
                        owners.update(shard.owners[w])
                if hits:
                    old = spans[lo + row]
                    spans[lo + row] = _merged(hits + list(zip(old[::2], old[1::2])))
                    items[lo + row] = sorted(owners.union(items[lo + row]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), text, pa.array(count), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.int64()))],
            ["doc", "text", "n_words", "spans", "items"],
        )

    return arrow_map(docs, run, _schema(docs))


def _schema(docs: DataFrame) -> T.StructType:
    return with_doc(docs, "text string, n_words long, spans array<long>, items array<long>")


def decontaminate(docs: DataFrame, items: DataFrame, keep: Sequence[str] = ("doc_id",), shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Per document row: ``doc`` (the columns named in ``keep``), text, n_words, n_hit, n_items, item_ids, spans, contaminated.

    ``spans`` lists the merged hit word ranges as start, end, start, end ...; ``contaminated`` holds where at least
    one word and a twentieth of all words are hit. The columns of ``docs`` stay inside ``doc``, so they can't clash.
    """
    windows = stored(item_windows(items), "windows")
    rows = windows.count()
    shards = -(-rows // shard_rows)
    out = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.col("text").cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<bigint>)").alias("spans"), F.expr("cast(array() as array<bigint>)").alias("items"),
    )
    for k in range(max(shards, 1)):
        part = windows.where(F.pmod(F.xxhash64("window", "item_id"), F.lit(max(shards, 1))) == k)
        out = _search(out, build_shard(part, docs) if rows else Shard([], [], {}))
    hit = F.expr("aggregate(transform(spans, (x, i) -> if(i % 2 = 0, -x, x)), 0L, (total, x) -> total + x)")
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    out = out.select("doc", "text", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), ids.alias("item_ids"), "spans")
    return out.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by the benchmark items."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc.doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated"
    )


SQL = r"""
with words as (
  select doc_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_az from documents)
), item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), windows as (
  select distinct item_id, least(len(w), 13) as size, list_slice(w, i, i + least(len(w), 13) - 1) as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from item_words where len(w) > 0)
), places as (
  select doc_id, size, i, list_slice(w, i, i + size - 1) as win
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from words, (select distinct size from windows) where len(w) >= size)
), hits as (
  select p.doc_id, p.i, p.size, x.item_id from places p join windows x on p.win = x.win
), covered as (
  select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + size)) as j from hits) group by 1
), owners as (
  select doc_id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hits group by 1
)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from words d left join covered using (doc_id) left join owners using (doc_id)
"""
