"""Incremental loads: a store that new files are added to without reading what is in it.

Below its path the store has, for every batch, a folder of lines (cleaned, with what depends on the line alone) and of
states that add up: per entity its smallest line and its volume, per peer group count, mean and sum of squared deviations
(M2) of the net amount, and histograms of the net amount per peer group and of the volume. A load writes
these from the new lines only and names the batch in ``batches`` last, so a load that fails leaves nothing behind that
is read. A batch name counts once, however often it is loaded. The order of batches does not matter.

What depends on all lines - z-scores, outlier flags, volume tiers - is not stored, since one new line changes it for the
whole peer group. ``Store.star`` joins the lines with the merged statistics, one small row per peer group, when they are
read; it equals a star built from all files at once. ``compact`` merges the states of many batches into one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.functions.labels import volume_tier
from peerbench.operators.features import QUARTILES, add_entity_name, add_outlier_flag, add_ratios, add_region, add_zscore
from peerbench.operators.ranks import exact_quantiles, histogram, merge_histograms
from peerbench.operators.star import Star, conform, star_tables
from peerbench.session import materialize, together

STATES = ("entities", "peers", "peer_bins", "volume_bins")
ATTRIBUTES = ("entity_name", "peer_group", "place", "locality", "region")
#: The smallest line of an entity gives its attributes.
SMALLEST = ("item_code", "net", "volume")
_BATCHES = "batch string, name string, covers array<string>"


def load_batch(spark: SparkSession, path: str, cleaned: DataFrame, places: DataFrame, name: str) -> bool:
    """Add cleaned lines to the store as the batch ``name``; False if it has been loaded before."""
    if not _batches(spark, path).where(F.col("name") == name).isEmpty():
        return False
    batch = uuid.uuid4().hex
    lines = cleaned.transform(add_ratios).transform(add_region, places).transform(add_entity_name)
    lines.write.parquet(f"{path}/lines/{batch}")
    _write_states(_states(spark.read.schema(lines.schema).parquet(f"{path}/lines/{batch}")), path, batch)
    _announce(spark, path, batch, name, [])
    return True


def compact(spark: SparkSession, path: str) -> None:
    """Merge the states of all batches into one; the lines stay where they are."""
    store = Store(spark, path)
    batch = uuid.uuid4().hex
    _write_states(store.merged, path, batch)
    _announce(spark, path, batch, None, store.loaded)


def _states(lines: DataFrame) -> dict[str, DataFrame]:
    """The states of some lines."""
    smallest = F.struct(*SMALLEST)
    return {
        "entities": lines.groupBy("entity_id").agg(
            F.min_by(F.struct(*ATTRIBUTES), smallest).alias("attributes"), F.min(smallest).alias("smallest"), F.sum("volume").alias("volume")),
        "peers": lines.where("peer_group is not null").groupBy("peer_group").agg(
            F.count("net").alias("n"), F.avg("net").alias("mean"), (F.var_pop("net") * F.count("net")).alias("m2")),
        "peer_bins": histogram(lines.where("peer_group is not null"), ["peer_group"], "net"),
        "volume_bins": histogram(lines, [], "volume"),
    }


def _merged(parts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The states of several batches as those of all their lines."""
    smallest, size = F.struct(*[F.col(f"smallest.{c}") for c in SMALLEST]), F.coalesce(F.sum("n"), F.lit(0))
    packed = F.filter(F.collect_list(F.struct("n", "mean", "m2")), lambda s: s["n"] > 0)  # one entry per batch
    mean = F.aggregate("s", F.lit(0.0), lambda a, s: a + s["n"] * s["mean"]) / F.nullif(F.col("n"), F.lit(0))
    m2 = F.aggregate("s", F.lit(0.0), lambda a, s: a + s["m2"] + s["n"] * (s["mean"] - F.col("mean")) * (s["mean"] - F.col("mean")))
    return {
        "entities": parts["entities"].groupBy("entity_id").agg(
            F.min_by("attributes", smallest).alias("attributes"), F.min(smallest).alias("smallest"), F.sum("volume").alias("volume")),
        "peers": parts["peers"].groupBy("peer_group").agg(size.alias("n"), packed.alias("s"))
        .withColumn("mean", mean).withColumn("m2", F.when(F.col("n") > 0, m2)).drop("s"),
        "peer_bins": merge_histograms(parts["peer_bins"], ["peer_group"]),
        "volume_bins": merge_histograms(parts["volume_bins"], []),
    }


def _write_states(states: dict[str, DataFrame], path: str, batch: str) -> None:
    def job(name: str):
        return lambda: states[name].write.parquet(f"{path}/{name}/{batch}")

    together(states["entities"].sparkSession, *[job(name) for name in STATES])


def _announce(spark: SparkSession, path: str, batch: str, name: str | None, covers: list[str]) -> None:
    """One row in one file, after everything else has been written."""
    spark.createDataFrame([(batch, name, covers)], _BATCHES).coalesce(1).write.mode("append").parquet(f"{path}/batches")


def _batches(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_BATCHES).parquet(f"{path}/batches")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _BATCHES)


@dataclass(frozen=True)
class Store:
    """The batches that are in a store when it is first read."""

    spark: SparkSession
    path: str

    @cached_property
    def _announced(self) -> list:
        """One row per load or merge; of two loads that ran at once under one name the lower batch counts."""
        rows = sorted(_batches(self.spark, self.path).collect(), key=lambda r: r["batch"])
        seen, kept = set(), []
        for row in rows:
            if row["name"] is None or row["name"] not in seen:
                kept.append(row)
                seen.add(row["name"])
        return kept

    @property
    def loaded(self) -> list[str]:
        """The batches of lines."""
        return [r["batch"] for r in self._announced if r["name"] is not None]

    @property
    def _state_batches(self) -> list[str]:
        """The widest merge of loads that all count, and the loads that it does not cover."""
        loads = set(self.loaded)
        merges = [r for r in self._announced if r["name"] is None and set(r["covers"]) <= loads]
        widest = max(merges, key=lambda r: len(r["covers"]), default=None)
        if widest is None:
            return sorted(loads)
        return [widest["batch"], *sorted(loads - set(widest["covers"]))]

    def _read(self, table: str, batches: list[str]) -> DataFrame:
        if not batches:
            raise ValueError(f"nothing has been loaded into {self.path}")
        return self.spark.read.parquet(*[f"{self.path}/{table}/{b}" for b in batches])

    @cached_property
    def lines(self) -> DataFrame:
        return self._read("lines", self.loaded)

    @cached_property
    def merged(self) -> dict[str, DataFrame]:
        """The states of all lines, from the stored ones alone."""
        return _merged({name: self._read(name, self._state_batches) for name in STATES})

    @cached_property
    def moments(self) -> DataFrame:
        """Mean and sample standard deviation of the net amount per peer group."""
        spread = F.when(F.col("n") > 1, F.sqrt(F.greatest("m2", F.lit(0.0)) / (F.col("n") - 1)))
        return materialize(self.merged["peers"].select("peer_group", F.col("mean").alias("peer_mean"), spread.alias("peer_sd")), "moments")

    def peer_stats(self) -> DataFrame:
        """Mean, sample standard deviation and 75th percentile per peer group; reads only lines of the bins around it."""
        upper = exact_quantiles(self.lines, ["peer_group"], "net", {"peer_p75": 0.75}, counts=self.merged["peer_bins"])
        return self.moments.join(materialize(upper, "upper"), "peer_group")

    @cached_property
    def edges(self) -> DataFrame:
        """Quartile edges of the volume over all lines; reads no lines where the bins around them have one value each."""
        bins = self.merged["volume_bins"]
        inner = materialize(exact_quantiles(self.lines, [], "volume", QUARTILES, counts=bins), "edges")
        ends = materialize(bins.agg(F.min("low").alias("q0"), F.max("high").alias("q4")), "edges")
        one = ends.select(F.struct("q0", "q4")).scalar()
        return materialize(inner.select(one["q0"].alias("q0"), *QUARTILES, one["q4"].alias("q4")), "edges")

    def scored(self) -> DataFrame:
        """All lines with z-score, outlier flag and volume tier under the current statistics."""
        return self.lines.transform(self._tiered).transform(add_zscore, self.moments).transform(add_outlier_flag)

    def _tiered(self, rows: DataFrame) -> DataFrame:
        one = self.edges.select(F.struct("q0", *QUARTILES, "q4")).scalar()
        return rows.withColumn("volume_tier", volume_tier("volume", one))

    def star(self) -> Star:
        """The star of everything loaded; entities come from the states, scores are computed when they are read."""
        entities = self.merged["entities"].select(
            "entity_id", "attributes.*", F.col("volume").alias("total_volume"), F.col("smallest.volume").alias("volume"))
        whole = star_tables(self.scored())
        return Star(conform(entities.transform(self._tiered), "entities"), whole.items, whole.measures, whole.segments)
