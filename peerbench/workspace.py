"""The tables derived from one data folder, each written once per session and then shared."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerbench.operators.clean import clean
from peerbench.operators.features import enrich
from peerbench.operators.star import Star, read_star, star_tables, write_star
from peerbench.plans import keyed, refresh, segments
from peerbench.session import fresh_path, materialize, sized
from peerbench.sources.tables import event_lines, place_regions, read_table, service_lines
from peerbench.streaming.jobs import publish_stats

# Centroids in scaled feature space for labels that do not depend on a training run.
FIXED_CENTROIDS = (
    (1.5, -1.0, -1.0, 1.0, 0.0),
    (-0.5, 1.0, 0.5, 0.0, 0.0),
    (0.0, -0.5, 0.0, -1.0, 0.5),
    (0.0, 0.0, 0.0, 1.0, -0.5),
)

_open: dict[tuple[str, str], "Workspace"] = {}


class Workspace:
    """Lazy access to lines, scored lines and the star of ``sf_dir``; a snapshot of its files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def lines(self) -> DataFrame:
        # the footers tell the number of rows
        with sized(self.spark, read_table(self.spark, self.sf_dir, "lineitem").count()):
            return materialize(service_lines(self.spark, self.sf_dir), "lines")

    @property
    def places(self) -> DataFrame:
        return place_regions(self.spark, self.sf_dir)

    @cached_property
    def regions(self) -> list[str]:
        """The names in the region dimension."""
        return [r["region"] for r in self.places.select("region").distinct().orderBy("region").collect()]

    @property
    def events(self) -> DataFrame:
        return event_lines(self.spark, self.sf_dir)

    @property
    def cleaned(self) -> DataFrame:
        """A filter over the stored lines, which every reader applies to the columns it needs."""
        return clean(self.lines)

    @cached_property
    def scored(self) -> DataFrame:
        return materialize(enrich(self.cleaned, self.places), "scored")

    @cached_property
    def star(self) -> Star:
        star = star_tables(self.scored)
        return read_star(self.spark, write_star(star, fresh_path(self.spark, "star")), T.LongType())

    @cached_property
    def store(self) -> refresh.Store:
        """The cleaned lines loaded in three batches, by item."""
        path = fresh_path(self.spark, "store")
        for k in range(3):
            part = self.cleaned.where(F.pmod(F.crc32("item_code"), F.lit(3)) == k)
            refresh.load_batch(self.spark, path, part, self.places, f"batch {k}")
        return refresh.Store(self.spark, path)

    @cached_property
    def features(self) -> DataFrame:
        """Clustering features per entity."""
        return materialize(segments.features(self.star), "features")

    @cached_property
    def scaled(self) -> DataFrame:
        """Imputed and scaled clustering features."""
        return segments.scaled_features(self.features)

    @cached_property
    def k_search(self) -> DataFrame:
        return segments.k_search(self.scaled)

    @cached_property
    def clustered(self) -> DataFrame:
        """Scaled features with the K-Means cluster for the chosen k."""
        chosen = self.k_search.filter("chosen = 1").first()["k"]
        return segments.assign_kmeans(self.scaled, chosen)

    @cached_property
    def nearest(self) -> DataFrame:
        """Scaled features with the nearest of four fixed centroids."""
        return materialize(segments.assign_nearest(self.scaled, FIXED_CENTROIDS), "nearest")

    @cached_property
    def labelled_star(self) -> Star:
        """The star whose segments carry the fixed-centroid clusters."""
        return segments.with_segments(self.star, segments.label_entities(self.features, self.nearest))

    @cached_property
    def segmented_star(self) -> Star:
        """The star whose segments carry the K-Means clusters."""
        return segments.with_segments(self.star, segments.label_entities(self.features, self.clustered))

    @cached_property
    def keyed(self) -> keyed.KeyedStar:
        """The star by entity, published without clusters and then updated with the fixed-centroid ones."""
        store = keyed.publish(self.star, fresh_path(self.spark, "keyed"))
        store.update_segments(self.labelled_star.segments.select("entity_id", "cluster_id", "cluster_name", "performance_tier"))
        return store

    @cached_property
    def event_stats(self) -> DataFrame:
        return publish_stats(self.events)


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """The workspace of a folder in this application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        _open[key] = Workspace(spark, sf_dir)
    return _open[key]


def forget(spark: SparkSession, sf_dir: str) -> None:
    """Drop the snapshot, so that the next query reads the folder anew."""
    _open.pop((spark.sparkContext.applicationId, sf_dir), None)
