"""Sampling of a fixed size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD = 4  # leading hex digits that are counted: at most 65,536 groups


def sample_order(keys: Sequence[str], seed: int) -> Column:
    """A reproducible shuffle key of a row: the digest of seed and key columns."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def fixed_sample(df: DataFrame, keys: Sequence[str], size: int, seed: int) -> DataFrame:
    """``size`` rows (all if there are fewer), the same ones however the rows are partitioned.

    The rows with the smallest digests are taken. Counting the leading digits first tells up to
    where they can lie, so that every task hands on only its rows in that range instead of ``size``.
    """
    head = F.substring(sample_order(keys, seed), 1, HEAD)
    counts = df.groupBy(head.alias("_head")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_head"))
    last = counts.select("_head", upto.alias("_upto")).agg(F.min(F.when(F.col("_upto") >= size, F.col("_head")))).scalar()
    return df.filter(head <= F.coalesce(last, F.lit("g"))).orderBy(sample_order(keys, seed), *keys).limit(size)
