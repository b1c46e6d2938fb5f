"""From a raw file to the stored star, and from the star to stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from peerbench.operators.clean import clean
from peerbench.operators.features import enrich
from peerbench.operators.quality import passed, quality_report
from peerbench.operators.star import Star, current_star, publish_star, star_tables
from peerbench.plans import facts, queries, refresh, segments
from peerbench.roles import Roles
from peerbench.session import materialize, together
from peerbench.sources.csvs import read_raw_csv, require_columns, write_csv, write_text
from peerbench.sources.dims import state_regions


# The coverage a full raw file has at least.
PLACES_EXPECTED = 45
PEERS_EXPECTED = 25


class QualityError(RuntimeError):
    """A strict load met failed checks."""


def load_raw(
    spark: SparkSession, raw_path: str, star_path: str, roles: Roles = Roles(),
    places: DataFrame | None = None, strict: bool = False, places_expected: int = PLACES_EXPECTED,
    peers_expected: int = PEERS_EXPECTED, multi_line: bool = False,
) -> tuple[Star, DataFrame]:
    """Read, clean, enrich, check and store; returns the star and the quality report.

    A raw file without one of the columns that play a role is an error. Failed checks are reported and do not stop
    the load unless it is ``strict``. The tables go to a new folder below ``star_path``, named last in the file
    ``current``, so that a failed load leaves the former star in place.
    """
    raw = read_raw_csv(spark, raw_path, multi_line)
    raw = require_columns(raw, [c for role, c in vars(roles).items() if role != "age"])
    cleaned = materialize(clean(roles.rename(raw)), "cleaned")
    scored = materialize(enrich(cleaned, state_regions(spark) if places is None else places), "scored")
    report = materialize(quality_report(scored, places_expected, peers_expected), "quality")
    if strict and not passed(report).first()["all_passed"]:
        raise QualityError("the quality report has failed checks")
    publish_star(star_tables(scored), star_path)
    return current_star(spark, star_path), report


def add_raw(
    spark: SparkSession, raw_path: str, store_path: str, name: str | None = None, roles: Roles = Roles(),
    places: DataFrame | None = None, multi_line: bool = False,
) -> bool:
    """Add a raw file to a store (``plans.refresh``) without reading what is in it; False if ``name`` is in it already.

    The name is the path unless it is given. ``refresh.Store(spark, store_path).star()`` is the star of all files.
    """
    raw = read_raw_csv(spark, raw_path, multi_line)
    raw = require_columns(raw, [c for role, c in vars(roles).items() if role != "age"])
    return refresh.load_batch(
        spark, store_path, clean(roles.rename(raw)), state_regions(spark) if places is None else places, raw_path if name is None else name)


def save_results(star: Star, path: str) -> list[str]:
    """One CSV folder per query."""
    def job(name: str, frame: DataFrame):
        return lambda: write_csv(frame, f"{path}/{name}")

    results = queries.run_all(star)
    return together(star.entities.sparkSession, *[job(name, frame) for name, frame in results.items()])


def save_cluster_summary(named: DataFrame, path: str) -> str:
    """The feature means per cluster as CSV."""
    return write_csv(segments.cluster_summary(named), path)


def save_narrative(star: Star, path: str, stamp: str) -> list[str]:
    """The four narrative texts under a title and the given time."""
    texts = {
        "peer_insights": ("Peer Cost Variation", facts.peer_sentence(facts.peer_facts(star))),
        "geographic_insights": ("Geographic Cost Disparity", facts.geo_sentence(facts.geo_facts(star))),
        "outlier_insights": ("Outliers", facts.outlier_sentence(facts.outlier_facts(star))),
        "overall_summary": ("Overall Summary", facts.overall_sentence(facts.overall_facts(star))),
    }
    return [write_text(text, "text", f"{path}/{name}", title, stamp) for name, (title, text) in texts.items()]


def segment(star: Star, segments_path: str) -> tuple[DataFrame, Star]:
    """Search k, cluster, name, and store the segments table at a new place."""
    spark = star.entities.sparkSession
    feats = materialize(segments.features(star), "features")
    scaled = segments.scaled_features(feats)
    chosen = segments.k_search(scaled).filter("chosen = 1").first()["k"]
    named = materialize(segments.label_entities(feats, segments.assign_kmeans(scaled, chosen)), "named")
    updated = segments.updated_segments(star, named)
    updated.write.mode("errorifexists").parquet(segments_path)
    stored = spark.read.schema(updated.schema).parquet(segments_path)
    return named, star.with_segments(stored)
