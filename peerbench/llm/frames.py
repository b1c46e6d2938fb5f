"""Helpers that the operators share: keys, stored steps, membership bits, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerbench.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    return materialize(df, f"llm-{label}")


def with_doc(rows: DataFrame, others: str) -> T.StructType:
    """The column ``doc`` of ``rows``, whose field names may be anything, and ``others`` as DDL."""
    return T.StructType([rows.schema["doc"], *T.StructType.fromDDL(others).fields])


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.mapInArrow(run, schema)


class Bits:
    """A set of 64-bit keys as a bitmap of fixed size: no key of the set is missed, others may pass.

    Its size does not grow with the data, so it may be broadcast; when it fills up, more keys pass and
    the exact step behind it gets more to do.
    """

    def __init__(self, keys: DataFrame, key: str, bits: int):
        words = (
            keys.select(F.shiftrightunsigned(F.col(key), 64 - bits).alias("slot"))
            .groupBy(F.shiftright("slot", 6).alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("set"))
        )
        bitmap = np.zeros(1 << (bits - 6), np.uint64)
        got = words.toArrow()  # 2 ** (bits - 6) rows at most
        bitmap[got["at"].to_numpy()] = got["set"].to_numpy().view(np.uint64)
        self.bits = bits
        self.bitmap: Broadcast = keys.sparkSession.sparkContext.broadcast(bitmap.view(np.uint8))

    def have(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> np.uint64(64 - self.bits)
        return (self.bitmap.value[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def text_key(text: str = "text") -> Column:
    """Tells rows of one id apart by their text."""
    return F.xxhash64(F.col(text))


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component): the smallest node reachable over the undirected ``links`` (a, b), for every linked node.

    Alternates the large-star and small-star steps until the edges form stars. Each step is a minimum per node
    and a join with it, so a node with many links is pre-aggregated and may be split; each result is written,
    which cuts the lineage.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _digest(edges)
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(small_low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(hooked.union(small_low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _digest(edges)
        if now == state:
            roots = edges.groupBy("v").agg(F.lit(0)).select(F.col("v").alias("node"), F.col("v").alias("component"))
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first())
