"""Cleaning steps; each takes and returns a frame with role columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerbench.functions.numbers import known, to_number
from peerbench.functions.strings import null_if_token, title_case
from peerbench.roles import CRITICAL, NUMERIC


def null_tokens(df: DataFrame) -> DataFrame:
    """Missing-value tokens in text columns become null; padded tokens stay text."""
    return df.select(*[
        null_if_token(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema
    ])


def drop_critical(df: DataFrame) -> DataFrame:
    """Drop rows without id, peer group or net amount."""
    return df.na.drop(subset=list(CRITICAL))


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Turn the numeric columns that are present into doubles, null where that fails."""
    present = [f for f in df.schema if f.name in NUMERIC]
    return df.withColumns({
        f.name: to_number(f.name) if isinstance(f.dataType, T.StringType) else known(f.name) for f in present
    })


def keep_positive(df: DataFrame) -> DataFrame:
    """Keep rows whose net amount and volume are known and above zero."""
    return df.filter((F.col("net") > 0) & (F.col("volume") > 0))


def title_peer(df: DataFrame) -> DataFrame:
    """Trim and title-case the peer group."""
    return df.withColumn("peer_group", title_case(F.trim("peer_group")))


def clean(df: DataFrame) -> DataFrame:
    return (
        df.transform(null_tokens).transform(drop_critical).transform(coerce_numeric)
        .transform(keep_positive).transform(title_peer)
    )
