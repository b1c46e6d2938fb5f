"""Near-duplicate embeddings by Euclidean p-stable hashing with exact cosine checks.

Vectors are normalised. In each of 32 tables a vector falls into the bucket of eight random projections, shifted and
cut to a width of 1.2, so vectors at cosine 0.93 (distance 0.37) share a bucket of some table with probability 0.97,
closer ones more often. Within a bucket and label all cosines are computed in double precision.

Equal vectors are one row with a weight throughout. Buckets are streamed in sorted order; one with more than
``block`` vectors is dealt into blocks, and each pair of blocks is a task of its own size. Pairs are never emitted: a
block gives, per vector, how many vectors it links with (in the first table that holds the pair) and one edge towards
the root of its links.

Defined results: vectors that are null, empty or zero or hold null or non-finite components, and rows without a
label, link with nothing; vectors of different length never link; every row is a vector of its own, also where
vec_ids repeat; the smallest vec_id of a component is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.llm.frames import arrow_map, components, stored, table
from peerbench.llm.tokens import mix

COSINE = 0.93
TABLES = 32
PROJECTIONS = 8
WIDTH = 1.2
BLOCK = 1_024


@lru_cache(maxsize=8)
def _projections(size: int, tables: int, projections: int, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([size, tables, projections])
    return rng.normal(size=(size, tables * projections)), rng.uniform(0, width, tables * projections), rng.integers(1, 1 << 62, projections).astype(np.uint64) | np.uint64(1)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def buckets(vectors: np.ndarray, tables: int, projections: int, width: float) -> np.ndarray:
    """A 64-bit bucket hash per vector and table."""
    lines, shift, spread = _projections(vectors.shape[1], tables, projections, width)
    cells = np.floor((unit(vectors) @ lines + shift) / width).astype(np.int64).view(np.uint64)
    cells = (cells.reshape(len(vectors), tables, projections) * spread).sum(2, dtype=np.uint64)
    return mix(cells + np.arange(tables, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _hash_rows(classes: DataFrame, tables: int, projections: int, width: float) -> DataFrame:
    """(bucket, number of the table, cid, weight, vector, all): one row per vector and table."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        label, sizes = batch.column("label").cast(pa.int64()).to_numpy().view(np.uint64), np.array([len(v) for v in batch.column("vector")])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            vectors = np.array(batch.column("vector").take(pa.array(at)).flatten()).reshape(len(at), size)
            hashes = mix(buckets(vectors, tables, projections, width) ^ mix(label[at] + np.uint64(size))[:, None])
            short = (hashes >> np.uint64(32)).astype(np.uint32)
            whole = pa.array([v.tobytes() for v in vectors.astype(np.float64)], pa.binary())
            every = pa.array([s.tobytes() for s in short], pa.binary())
            for lo in range(0, len(at), 256):
                own = hashes[lo : lo + 256]
                within = pa.array(np.repeat(np.arange(lo, lo + len(own)), tables))
                order = pa.array(at).take(within)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.ravel().view(np.int64)), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(own))),
                     batch.column("cid").take(order), batch.column("weight").take(order), whole.take(within), every.take(within)],
                    ["bucket", "table", "cid", "weight", "vector", "all"],
                )

    return arrow_map(classes, run, "bucket long, table int, cid long, weight long, vector binary, all binary")


def _roots(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id reachable over the symmetric matrix ``near``."""
    root = ids.copy()
    while True:
        lower = np.minimum(root, np.where(near, root[None, :], np.iinfo(np.int64).max).min(1))
        if (lower == root).all():
            return root
        root = lower


def _compare(cid: np.ndarray, weight: np.ndarray, table_no: int, block: np.ndarray, vectors: np.ndarray, seen: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each vector that this table counts, and the root of its links within the group."""
    near = unit(vectors) @ unit(vectors).T
    near = np.maximum(near, near.T) >= cosine
    np.fill_diagonal(near, False)
    if block[0] != block[-1]:
        near &= block[:, None] != block[None, :]
    first = near.copy()
    i, j = np.nonzero(near)
    for lo in range(0, len(i), 1 << 18):
        a, b = i[lo : lo + (1 << 18)], j[lo : lo + (1 << 18)]
        first[a, b] = ~(seen[a, :table_no] == seen[b, :table_no]).any(1)
    return first @ weight, _roots(near, cid)


def linked_vectors(classes: DataFrame, cosine: float = COSINE, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH, block: int = BLOCK) -> DataFrame:
    """(cid, links, root) of the distinct vectors (cid, label, vector, weight) that link within a bucket, per bucket."""
    rows = _hash_rows(classes, tables, projections, width)
    counted = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    # stored: its size on disk decides whether the join below may broadcast it
    shared = stored(counted.select("bucket", F.ceil(F.col("rows") / block).cast("int").alias("blocks")), "buckets")
    rows = rows.join(shared, "bucket").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("*", other).withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other")).drop("other", "blocks")
    dealt = rows.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two", "block", "cid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            whole = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            keys = np.stack([whole.column(c).to_numpy().astype(np.int64) for c in ("bucket", "one", "two")], 1)
            start = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
            yield from _groups(whole, start[:-1], start[1:], cosine)
            rest = whole.slice(start[-1])
        if rest is not None:
            yield from _groups(rest, np.array([0]), np.array([len(rest)]), cosine)

    return dealt.mapInArrow(run, "cid long, links long, root long")


def _groups(rows: pa.Table, start: np.ndarray, end: np.ndarray, cosine: float) -> Iterator[pa.RecordBatch]:
    rows, out = rows.combine_chunks(), []
    cid, weight, block, number = (rows.column(c).to_numpy() for c in ("cid", "weight", "block", "table"))
    several = np.flatnonzero(end - start > 1)
    for lo, hi in zip(start[several], end[several]):
        vectors = np.stack([np.frombuffer(v.as_buffer(), np.float64) for v in rows.column("vector")[lo:hi]])
        seen = np.stack([np.frombuffer(v.as_buffer(), np.uint32) for v in rows.column("all")[lo:hi]])
        links, root = _compare(cid[lo:hi], weight[lo:hi], int(number[lo]), block[lo:hi], vectors, seen, cosine)
        some = np.flatnonzero((links > 0) | (root != cid[lo:hi]))
        if len(some):
            out.append((cid[lo:hi][some], links[some], root[some]))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["cid", "links", "root"])


def near_vectors(vectors: DataFrame, cosine: float = COSINE, **hashing: float) -> DataFrame:
    """Per row of (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    value = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    norm = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), value.alias("vector"))
    whole = F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.withColumn("cid", F.when(whole & (norm > 0) & (norm < float("inf")), F.xxhash64("label", F.transform("vector", lambda x: x + 0.0))))
    classes = rows.where("cid is not null").groupBy("cid").agg(F.count(F.lit(1)).alias("weight"), F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("vec_id").alias("low"))
    classes = stored(classes, "classes")
    found = stored(linked_vectors(classes, cosine, **hashing), "near")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    placed = classes.select("cid", "weight", "low").join(groups, F.col("cid") == F.col("node"), "left").join(links, "cid", "left")
    placed = placed.select("cid", "weight", "low", F.coalesce("component", "cid").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    placed = stored(placed.join(lowest, "component").select("cid", "component_id", (F.col("links") + F.col("weight") - 1).alias("n_links")), "placed")
    out = rows.select("vec_id", "cid").join(placed, "cid", "left")
    component = F.coalesce("component_id", "vec_id").cast("long")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.93."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
