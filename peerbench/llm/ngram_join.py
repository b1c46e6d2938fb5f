"""Jaccard self-join of word-shingle sets by parity sketches, and the components of its links.

Tokens (hashed shingles) are dealt into parts by their leading bits, and each part is the XOR of its tokens, so a
token in only one of two sets changes one part. Sizes fall into bands; in band b two sets that reach the
similarity differ in at most d(b) tokens, so of d(b) + 1 + e parts at least 1 + e agree (pigeonhole). Sets meet
where a part agrees. Empty parts are left out, and parts of one token too, which say little, unless a set has more than e of
both. A set of more than e empty parts is also met by its smallest tokens: so many that two sets that reach the
similarity share one. So texts without a common shingle meet nowhere. Parity sketches, whose Hamming distance is at most the symmetric difference, reject most false candidates (one
of 1,024 bits within the join, then one of eight bits or more per token); the rest are verified on the whole texts.

No group is paired with itself. Documents of equal sets, told by size and two fingerprints, link with the smallest id
of them, which alone goes on for all of them. In the first round each document meets only the smallest id of each part value
(a minimum and a join), and one of those that pass the sketch is verified. Documents that are then in one component
need no more comparison; only rows of part values that still hold several components are joined with each
other, and only pairs from different components that pass size and sketches come out of that join. Of these, the
closest pair of each two components is verified first, then four times as many, and so on: once a pair links, the
others of its two components need no verification, and those that stay apart have all their pairs verified. So a
large group of copies costs few verifications per document, and no link between different components is missed.

Defined results: a null or blank text has an empty set and links with nothing, and so does a null doc_id; rows that
share a doc_id are one node, for which the text with the smallest hash is compared, while ``n_shingles`` counts
each row's own set; equal texts link.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peerbench.llm.frames import Bits, arrow_map, components, stored, table, text_key
from peerbench.llm.tokens import SOLID, cut, grams, mix, slices
from peerbench.session import setting

SHINGLE = 4
PERCENT = 85
_SKETCH_BITS = 1_024
#: Bits of the fixed-size filter of part values that occur twice.
_FILTER_BITS = 26
#: Texts that a task and its Python worker hold at once.
_BATCH_ROWS = 1_000


@dataclass(frozen=True)
class Likeness:
    """Shingle length in words and the least similarity in percent."""

    words: int = SHINGLE
    percent: int = PERCENT


@lru_cache(maxsize=4)
def _bands(percent: int, limit: int = 1 << 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First size of every band, its number of parts and how many parts of fewer than two tokens it makes up for.

    A set of band b can only reach the similarity with a larger one in band b or b + 1.
    """
    first = [1, 2]
    while first[-1] < limit:
        first.append(max(first[-1] + 1, (first[-1] - 1) * 100 // percent + 1))
    most = np.array(first[1:], dtype=object) - 1
    differ = [(100 - percent) * (n + n * 100 // percent) // (100 + percent) for n in most]
    spare = [3 + (d + 1) * 15 // 100 for d in differ]
    return np.array(first[:-1], np.int64), np.array([d + 1 + s for d, s in zip(differ, spare)], np.int64), np.array(spare, np.int64)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a text of fewer words has its whole sequence as one."""
    found = cut(texts, SOLID, lower=True)
    hashes = found.hashes()
    shingles = grams(hashes, words)
    for lo, hi in zip(found.first[:-1], found.first[1:]):
        if hi - lo >= words:
            yield np.unique(shingles[lo : hi - words + 1])
        else:
            yield grams(hashes[lo:hi], hi - lo, lane=1) if hi > lo else hashes[:0]


def part_values(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of (band, part, XOR of the part's tokens) in the band of the set and in the one below."""
    if not len(tokens):
        return tokens
    first, parts, spare = _bands(percent)
    own, out = int(np.searchsorted(first, len(tokens), "right")) - 1, []
    for band in {own, max(own - 1, 0)}:
        part = ((tokens >> np.uint64(32)) * np.uint64(parts[band])) >> np.uint64(32)
        start = np.flatnonzero(np.diff(part, prepend=~part[:1]))
        label, value = part[start], np.bitwise_xor.reduceat(tokens, start)
        full = np.diff(start, append=len(tokens)) > 1
        if parts[band] - full.sum() <= spare[band]:
            label, value = label[full], value[full]
        elif parts[band] - len(label) > spare[band]:
            # two such sets may agree in empty parts only, but then share one of so many smallest tokens
            prefix = tokens[: len(tokens) - -(-len(tokens) * percent // 100) + 1]
            label, value = np.append(label, np.full(len(prefix), parts[band], np.uint64)), np.append(value, prefix)
        out.append(mix(value ^ mix(label + np.uint64(band << 40) + np.uint64(1))))
    return np.concatenate(out)


def sets_of(docs: DataFrame, like: Likeness) -> DataFrame:
    """(doc_id, tk, n_shingles, f1, f2, sketch, wide) per row: size, two fingerprints of the set and its parity sketches."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text, size, prints, sketches, wide = batch.column("text"), [], [], [], []
        for lo, hi in slices(text):
            for tokens in shingle_sets(text.slice(lo, hi - lo), like.words):
                size.append(len(tokens))
                prints.append((tokens.sum(dtype=np.uint64), mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)))
                sketches.append(parity(tokens, _SKETCH_BITS))
                wide.append(parity(tokens, max(64, 8 << len(tokens).bit_length())))
        two = mix(np.array(prints, np.uint64).reshape(-1, 2)).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tk"), pa.array(size, pa.int64()), pa.array(two[:, 0]), pa.array(two[:, 1]), _lists(sketches), _lists(wide)],
            ["doc_id", "tk", "n_shingles", "f1", "f2", "sketch", "wide"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_key().alias("tk"))
    return arrow_map(rows, run, "doc_id long, tk long, n_shingles long, f1 long, f2 long, sketch array<long>, wide array<long>")


def parity(tokens: np.ndarray, bits: int) -> np.ndarray:
    """The parity of the number of tokens per slot, ``bits`` slots, a power of two, packed into 64-bit words."""
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _parts(docs: DataFrame, like: Likeness, seen: Bits | None = None) -> DataFrame:
    """(part, doc_id) of every document with an id, or of those part values only that pass ``seen``."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text, ids = batch.column("text"), batch.column("doc_id").to_numpy()
        for lo, hi in slices(text, 1 << 19):
            parts = [part_values(tokens, like.percent) for tokens in shingle_sets(text.slice(lo, hi - lo), like.words)]
            owner = np.repeat(ids[lo:hi], [len(p) for p in parts])
            value = np.concatenate(parts)
            if seen is not None:
                good = seen.have(value)
                owner, value = owner[good], value[good]
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(owner)], ["part", "doc_id"])

    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, run, "part long, doc_id long")


def _near(percent: int) -> Column:
    """Whether sizes and sketches of the sides x and y allow the similarity."""
    sizes = (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
    # one column per word of the sketch: unlike array functions these are compiled
    apart = reduce(add, [F.bit_count(F.col(f"x.s{i}").bitwiseXOR(F.col(f"y.s{i}"))) for i in range(_SKETCH_BITS // 64)])
    return sizes & (apart * (100 + percent) <= (F.col("x.n") + F.col("y.n")) * (100 - percent))


def _apart(x: Column, y: Column) -> Column:
    """Hamming distance of two sketches of one width."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, one: total + one)


def _near_wide(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose wide sketches allow the similarity; of two widths the larger one is folded to the smaller."""
    x, y = (nodes.select(F.col("doc_id").alias(k), F.col("n").alias(f"{k}_n"), F.col("wide").alias(f"{k}_wide")) for k in ("a", "b"))
    met = pairs.join(x, "a").join(y, "b")
    half = lambda own: (F.size(own) / 2).cast("int")
    fold = lambda own: F.zip_with(F.slice(own, F.lit(1), half(own)), F.slice(own, half(own) + 1, half(own)), lambda p, q: p.bitwiseXOR(q))
    a, b = F.col("a_wide"), F.col("b_wide")  # sizes that reach 0.5 or more are at most one width apart
    apart = F.when(F.size(a) == F.size(b), _apart(a, b)).when(F.size(a) == 2 * F.size(b), _apart(fold(a), b)).when(F.size(b) == 2 * F.size(a), _apart(a, fold(b))).otherwise(0)
    met = met.withColumn("apart", apart)
    return met.where(F.col("apart") * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent)).select(*pairs.columns, "apart")


def verified(pairs: DataFrame, docs: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, a_tk, b, b_tk) whose texts reach the similarity, as (a, b)."""
    ids = pairs.select(F.col("a").alias("doc_id"), F.col("a_tk").alias("tk")).union(pairs.select("b", "b_tk")).distinct()
    # the texts wanted are read once; both joins below share the exchange of this small part of the documents
    wanted = Bits(ids.select(F.xxhash64("doc_id", "tk").alias("key")), "key", 24)

    def pick(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(wanted.have(batch.column("key").to_numpy().view(np.uint64)))).select(["doc_id", "tk", "text"])

    keyed = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("tk"), F.col("text").cast("string").alias("text"))
    texts = arrow_map(keyed.withColumn("key", F.xxhash64("doc_id", "tk")), pick, "doc_id long, tk long, text string").dropDuplicates(["doc_id", "tk"])
    texts = stored(texts, "texts")
    left = texts.select(F.col("doc_id").alias("a"), F.col("tk").alias("a_tk"), F.col("text").alias("a_text"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("tk").alias("b_tk"), F.col("text").alias("b_text"))

    def compare(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        good = []
        a, b = batch.column("a_text"), batch.column("b_text")
        for lo, hi in slices(a):
            for x, y in zip(shingle_sets(a.slice(lo, hi - lo), like.words), _one_by_one(b.slice(lo, hi - lo), like.words)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= like.percent * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(right, ["b", "b_tk"]).join(left, ["a", "a_tk"]).select("a", "b", "a_text", "b_text")
    return arrow_map(joined, compare, "a long, b long")


def _one_by_one(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    for lo, hi in slices(texts):
        yield from shingle_sets(texts.slice(lo, hi - lo), words)


def _confirm(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, like: Likeness) -> DataFrame:
    """Links among candidate pairs, by their wide sketches and texts."""
    doubtful = stored(_near_wide(stored(pairs, "pairs"), nodes, like.percent).drop("apart"), "doubtful")
    return verified(doubtful, docs, like)


def distinct_sets(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The node of the smallest doc_id of each set, told by size and fingerprints, and (a, b) that links it with each other one."""
    own = [c for c in nodes.columns if c not in ("n", "f1", "f2")]
    least = nodes.groupBy("n", "f1", "f2").agg(F.min(F.struct(*own)).alias("s"))
    heads = stored(least.select("n", "f1", "f2", *[F.col(f"s.{c}").alias(c) for c in own]), "heads")
    copies = nodes.select("n", "f1", "f2", F.col("doc_id").alias("b")).join(heads.select("n", "f1", "f2", F.col("doc_id").alias("a")), ["n", "f1", "f2"])
    return heads, stored(copies.where("a < b").select("a", "b"), "copies")


def similar_groups(docs: DataFrame, like: Likeness = Likeness()) -> tuple[DataFrame, DataFrame]:
    """The stored rows of :func:`sets_of`, and (node, component) of the documents that have links."""
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", _BATCH_ROWS):
        return _groups(docs, like)


def _groups(docs: DataFrame, like: Likeness) -> tuple[DataFrame, DataFrame]:
    rows = stored(sets_of(docs, like), "sets")
    one = rows.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(F.min(F.struct("tk", "n_shingles", "f1", "f2", "sketch", "wide")).alias("s"))
    sketch = [f"s{i}" for i in range(_SKETCH_BITS // 64)]
    parts_of_sketch = [F.get("s.sketch", F.lit(i)).alias(c) for i, c in enumerate(sketch)]
    nodes = stored(one.select("doc_id", "s.tk", F.col("s.n_shingles").alias("n"), "s.f1", "s.f2", *parts_of_sketch, "s.wide"), "nodes")
    nodes, copies = distinct_sets(nodes)

    # part values alone are counted first; only those that occur twice are met again with their documents
    counted = _parts(docs, like).select("part").groupBy("part").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    seen = Bits(counted, "part", _FILTER_BITS)
    members = stored(_parts(docs, like, seen), "rows")
    leaders = members.groupBy("part").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last"))
    members = stored(members.join(stored(leaders.where("leader < last").select("part", "leader"), "parts"), "part"), "members")

    side = lambda name, key: nodes.select(F.col("doc_id").alias(key), F.col("tk").alias(f"{name}_tk"), F.struct("n", *sketch).alias(name))
    pair = [F.col("a"), F.col("x_tk").alias("a_tk"), F.col("b"), F.col("y_tk").alias("b_tk")]

    met = members.where("doc_id <> leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b")).distinct()
    met = met.join(side("x", "a"), "a").join(side("y", "b"), "b").where(_near(like.percent)).select(*pair)
    nearest = met.groupBy("b").agg(F.min(F.struct("a", "a_tk", "b_tk")).alias("p"))
    links = stored(copies.union(_confirm(nearest.select("p.a", "p.a_tk", "b", "p.b_tk"), nodes, docs, like)), "links")

    first = stored(components(links), "first")
    placed = members.select("part", "doc_id").join(nodes.select("doc_id"), "doc_id").join(first, F.col("doc_id") == F.col("node"), "left").select("part", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    placed = stored(placed, "placed")
    mixed = placed.groupBy("part").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("part")
    open_rows = stored(placed.join(mixed, "part").join(nodes, "doc_id").select("part", "doc_id", "component", "tk", "n", *sketch), "open")
    x, y = (open_rows.select("part", F.col("doc_id").alias(key), F.col("component").alias(f"{s}_component"), F.col("tk").alias(f"{s}_tk"), F.struct("n", *sketch).alias(s)) for s, key in (("x", "a"), ("y", "b")))
    rest = x.join(y, (x["part"] == y["part"]) & (F.col("x_component") < F.col("y_component")) & _near(like.percent)).select(*pair).distinct()
    rest = stored(_near_wide(rest, nodes, like.percent), "rest")
    place = {k: first.select(F.col("node").alias(k), F.col("component").alias(f"{k}_component")) for k in ("a", "b")}
    each = 1
    while True:
        met = rest.join(place["a"], "a", "left").join(place["b"], "b", "left")
        sides = [F.coalesce(f"{k}_component", k) for k in ("a", "b")]
        met = met.withColumn("low", F.least(*sides)).withColumn("high", F.greatest(*sides)).where("low < high")
        closest = W.partitionBy("low", "high").orderBy("apart", "a", "b")
        turn = stored(met.withColumn("turn", F.row_number().over(closest)).where(F.col("turn") <= each).select(*rest.columns), "turn")
        if turn.isEmpty():
            return rows, first
        links = stored(links.union(verified(turn.select("a", "a_tk", "b", "b_tk"), docs, like)), "links")
        rest = stored(rest.join(turn.select("a", "b"), ["a", "b"], "left_anti").select(*rest.columns), "rest")
        first = stored(components(links), "first")
        place = {k: first.select(F.col("node").alias(k), F.col("component").alias(f"{k}_component")) for k in ("a", "b")}
        each *= 4


def jaccard_components(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id (null for a null doc_id)."""
    rows, found = similar_groups(docs, like)
    joined = rows.join(found, F.col("doc_id") == F.col("node"), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of Jaccard similarity 0.85 on four-word shingles."""
    return jaccard_components(table(spark, sf_dir, "documents"))


SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), tokens as (
  select distinct doc_id, list_slice(w, i, i + 3) as s from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from words where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from tokens group by 1
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from tokens a join tokens b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)
), ends as (
  select a, b from links union all select b, a from links
), reach as (
  select doc_id as node, doc_id as low from documents union select b, low from reach join ends on node = a
)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id from documents d left join sizes using (doc_id)
  join (select node, min(low) as component_id from reach group by 1) on node = d.doc_id
"""
