"""The four tables that scored lines are stored in."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.roles import star_schemas
from peerbench.session import materialize, together


@dataclass(frozen=True)
class Star:
    """entities (one row per id), items and measures (one per line), segments (one per id)."""

    entities: DataFrame
    items: DataFrame
    measures: DataFrame
    segments: DataFrame
    shared: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def joined(self) -> DataFrame:
        """Measures with the attributes of their entity."""
        return self.entities.join(self.measures, "entity_id")

    @property
    def merged(self) -> DataFrame:
        """The joined rows, stored once: reports over them are scans instead of joins."""
        return self._once("merged", self.joined)

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.shared:
            self.shared[name] = materialize(build(), name)
        return self.shared[name]

    @property
    def rollup(self) -> DataFrame:
        """One stored row per entity with its attributes and the sums of its measures.

        Measures are aggregated before they meet the attributes, so that the join is one to one
        and every report by an attribute adds up entities instead of counting distinct ids.
        """
        sums = [F.count(F.lit(1)).alias("n_rows"), F.sum("is_outlier").alias("n_outliers"),
                F.max("net").alias("max_net"), F.min("net").alias("min_net")]
        for name in ("net", "net_z", "net_per_unit", "gross_net_ratio"):
            sums += [F.sum(name).alias(f"sum_{name}"), F.count(name).alias(f"n_{name}")]
        return self._once(
            "rollup", lambda: self.entities.join(self.measures.groupBy("entity_id").agg(*sums), "entity_id"))

    def with_segments(self, segments: DataFrame) -> Star:
        """The same star with another segments table; stored tables are shared, whichever is used first."""
        return replace(self, segments=segments)


def conform(df: DataFrame, name: str) -> DataFrame:
    """The columns of a star table in its pinned types."""
    schema = star_schemas(df.schema["entity_id"].dataType)[name]
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def star_tables(scored: DataFrame) -> Star:
    """Split scored lines into the star. Attributes of an entity come from its smallest item code."""
    attributes = F.struct("entity_name", "peer_group", "place", "locality", "region", "volume_tier")
    entities = (
        scored.groupBy("entity_id")
        .agg(F.min_by(attributes, F.struct("item_code", "net", "volume")).alias("a"),
             F.sum("volume").alias("total_volume"))
        .select("entity_id", "a.*", "total_volume")
    )
    segments = (
        scored.groupBy("entity_id")
        .agg(F.count_distinct("item_code").alias("item_diversity"), F.avg("net_z").alias("avg_z"))
        .withColumns({c: F.lit(None) for c in ("cluster_id", "cluster_name", "performance_tier")})
    )
    return Star(conform(entities, "entities"), conform(scored, "items"),
                conform(scored, "measures"), conform(segments, "segments"))


TABLES = ("entities", "items", "measures", "segments")


def write_star(star: Star, path: str) -> str:
    """Replace the four tables below ``path``."""
    def job(name: str):
        return lambda: getattr(star, name).write.mode("overwrite").parquet(f"{path}/{name}")

    together(star.entities.sparkSession, *[job(name) for name in TABLES])
    return path


def read_star(spark: SparkSession, path: str, id_type=None) -> Star:
    """Read the four tables under their pinned schemas."""
    schemas = star_schemas(id_type) if id_type else star_schemas()
    return Star(*[spark.read.schema(schemas[name]).parquet(f"{path}/{name}") for name in TABLES])


def publish_star(star: Star, path: str) -> str:
    """Write the star to a new version folder below ``path`` and then make it the current one."""
    spark = star.entities.sparkSession
    version = f"version-{uuid.uuid4().hex}"
    write_star(star, f"{path}/{version}")
    # one row in one file; the rows of earlier versions stay, the latest time counts
    spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("since")).coalesce(1).write.mode(
        "append").parquet(f"{path}/current")
    return version


def current_star(spark: SparkSession, path: str, id_type=None) -> Star:
    """The star that was published last below ``path``."""
    version = spark.read.parquet(f"{path}/current").agg(F.max_by("version", "since")).first()[0]
    return read_star(spark, f"{path}/{version}", id_type)
