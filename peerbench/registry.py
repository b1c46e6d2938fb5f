"""Every operator as a query over a data folder: ``key -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.functions.labels import outlier_type, performance_tier
from peerbench.functions.numbers import round_stable, to_number
from peerbench.operators import clean, features, quality
from peerbench.operators.sampling import fixed_sample
from peerbench.operators.star import Star
from peerbench.plans import alerts, dashboards, eda, facts, profiles, segments
from peerbench.plans import queries as q
from peerbench.session import fresh_path
from peerbench.sources.csvs import read_raw_csv, write_csv
from peerbench.sources.tables import damaged_text, read_table
from peerbench.streaming import alerts as stream_alerts
from peerbench.streaming import jobs
from peerbench.workspace import Workspace, workspace

Query = Callable[[Workspace], DataFrame]
KEY = ("entity_id", "item_code")


def _rounded(df: DataFrame, columns, digits: int) -> DataFrame:
    return df.withColumns({c: round_stable(c, digits) for c in columns})


def _dirty(w: Workspace) -> DataFrame:
    return damaged_text(w.lines)


def _csv_raw(w: Workspace) -> DataFrame:
    """Lines exported with damage, read back as text and parsed."""
    text = _dirty(w)
    path = write_csv(text, fresh_path(w.spark, "raw-csv"))
    read = clean.null_tokens(read_raw_csv(w.spark, path))
    return read.select(*KEY, "peer_group", "place", *[round_stable(to_number(c), 4).alias(c) for c in ("net", "volume")])


def _zscored(w: Workspace) -> DataFrame:
    return features.add_zscore(w.cleaned, features.peer_stats(w.cleaned))


def _star_counts(w: Workspace) -> DataFrame:
    merged = w.star.merged.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("merged").alias("table_name"), "row_count")
    return profiles.health(w.star).unionByName(merged)


def _region_sizes(w: Workspace) -> DataFrame:
    people = read_table(w.spark, w.sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("entities"))
    nation = read_table(w.spark, w.sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("place"))
    return (
        people.join(nation, people.c_nationkey == nation.n_nationkey).join(w.places, "place")
        .groupBy("place", "region").agg(F.sum("entities").alias("entities"))
    )


def _arg_extreme(w: Workspace) -> DataFrame:
    return w.star.merged.groupBy("peer_group").agg(
        F.max_by("entity_id", "net").alias("costliest_entity"), round_stable(F.max("net"), 2).alias("max_net"),
        F.max_by("entity_id", F.struct(F.abs("net_z"), "net")).alias("most_extreme_entity"))


def _with_items_text(found: DataFrame) -> DataFrame:
    """Profiles with the item list as one text, so that the tables can be compared by value."""
    listed = F.array_join(F.transform("items", lambda i: F.concat(
        i["item_code"], F.lit("="), i["services"].cast("bigint").cast("string"), F.lit("x"), i["times"].cast("string"))), ";")
    return found.withColumn("items_text", listed).drop("items")


def _alerted_profiles(w: Workspace) -> DataFrame:
    """Profiles of the entities of the ten most extreme outlier rows, looked up in the star by entity."""
    ids = [r["entity_id"] for r in q.most_extreme(q.outlier_rows(w.star), 10).select("entity_id").distinct().collect()]
    return _with_items_text(profiles.entity_profile(w.keyed.of(*ids)))


def _event_stream(w: Workspace, spark: SparkSession) -> DataFrame:
    """The events of the folder, whether they are one file or a folder of files."""
    return jobs.event_stream(spark, f"{w.sf_dir.rstrip('/')}/{{events.parquet}}")


def _published(w: Workspace, spark: SparkSession) -> DataFrame:
    """The stored peer statistics, read in another session."""
    return spark.read.schema(w.event_stats.schema).parquet(*w.event_stats.inputFiles())


def _folders(w: Workspace, label: str) -> tuple[str, str]:
    """Output and checkpoint of a run of its own."""
    return fresh_path(w.spark, label), fresh_path(w.spark, f"{label}-checkpoint")


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("starts", F.date_format("starts", "yyyy-MM-dd HH:mm:ss"))


def _stream_score(w: Workspace) -> DataFrame:
    scored = jobs.score(_event_stream(w, w.spark), w.event_stats)
    return jobs.run_append(scored, *_folders(w, "scores")).select("event_id", "entity_id", "peer_group", "net_z", "is_outlier")


def _stream_daily(w: Workspace) -> DataFrame:
    own = jobs.own_session(w.spark)
    scored = jobs.score(_event_stream(w, own), _published(w, own))
    return _stamp(jobs.with_daily_alert(jobs.run_updates(jobs.daily_outliers(scored, "2 days"), "starts", *_folders(w, "daily"))))


def _stream_weekly(w: Workspace) -> DataFrame:
    weekly = jobs.weekly_rows(_event_stream(w, jobs.own_session(w.spark)), "2 days")
    return _stamp(jobs.with_weekly_gate(jobs.run_updates(weekly, "starts", *_folders(w, "weekly"))))


def _stream_versions(w: Workspace) -> DataFrame:
    output, checkpoint = _folders(w, "versioned-scores")
    stream_alerts.publish(w.events, f"{output}/statistics")
    scores = stream_alerts.run_scores(_event_stream(w, w.spark), f"{output}/statistics", output, checkpoint)
    return scores.select("event_id", "entity_id", "peer_group", "net_z", "is_outlier")


def _stream_once(w: Workspace) -> DataFrame:
    own = jobs.own_session(w.spark)
    output, checkpoint = _folders(w, "daily-once")
    stream_alerts.publish(w.events, f"{output}/statistics")
    return _stamp(stream_alerts.run_daily(_event_stream(w, own), f"{output}/statistics", output, checkpoint)["windows"])


def _union(w: Workspace) -> DataFrame:
    """Two batches put together again."""
    merged = w.star.merged.select("peer_group", "is_outlier")
    batches = merged.filter("is_outlier = 1").unionByName(merged.filter("is_outlier = 0"))
    return batches.groupBy("peer_group").agg(F.count(F.lit(1)).alias("n"))


def _report(w: Workspace) -> DataFrame:
    """The report with the places and peer groups that the dimensions hold."""
    peers = read_table(w.spark, w.sf_dir, "customer").select("c_mktsegment").distinct().count()
    return quality.quality_report(w.scored, w.places.count(), peers)


def _broken_star(w: Workspace) -> Star:
    """The star with every tenth entity lost, every seventh twice, and the flags of every fifth turned round."""
    entities = w.star.entities.filter("entity_id % 10 <> 0")
    turned = F.when(F.col("entity_id") % 5 == 0, 1 - F.col("is_outlier")).otherwise(F.col("is_outlier"))
    return Star(
        entities.unionByName(entities.filter("entity_id % 7 = 0")), w.star.items,
        w.star.measures.withColumn("is_outlier", turned), w.star.segments)


QUERIES: dict[str, Query] = {
    # sources and sinks
    "src_csv_raw": _csv_raw,
    "src_star_counts": _star_counts,
    "dim_region": _region_sizes,
    "star_entities": lambda w: w.star.entities,
    "star_items": lambda w: _rounded(w.star.items, ["services"], 2),
    "star_measures": lambda w: _rounded(
        w.star.measures, ["gross", "net", "net_per_unit", "gross_net_ratio", "net_z"], 4),
    "star_segments": lambda w: _rounded(w.star.segments, ["avg_z"], 4).select("entity_id", "item_diversity", "avg_z"),
    "seg_update": lambda w: w.segmented_star.segments,
    "seg_update_fixed": lambda w: _rounded(w.labelled_star.segments, ["avg_z"], 4),
    # the same tables from a store that has been loaded in batches
    "refresh_entities": lambda w: w.store.star().entities,
    "refresh_measures": lambda w: _rounded(
        w.store.star().measures, ["gross", "net", "net_per_unit", "gross_net_ratio", "net_z"], 4),
    "refresh_segments": lambda w: _rounded(w.store.star().segments, ["avg_z"], 4).select("entity_id", "item_diversity", "avg_z"),
    "refresh_peer_stats": lambda w: _rounded(w.store.peer_stats(), ["peer_mean", "peer_sd", "peer_p75"], 4),
    # cleaning and features
    "clean_drop_critical": lambda w: _dirty(w).transform(clean.null_tokens).transform(clean.drop_critical)
    .select(*KEY, "peer_group"),
    "clean_coerce": lambda w: _rounded(
        _dirty(w).transform(clean.null_tokens).transform(clean.drop_critical).transform(clean.coerce_numeric)
        .select(*KEY, "volume", "services", "gross", "net"), ["volume", "services", "gross", "net"], 4),
    "clean_positive": lambda w: _rounded(
        _dirty(w).transform(clean.null_tokens).transform(clean.drop_critical).transform(clean.coerce_numeric)
        .transform(clean.keep_positive).select(*KEY, "volume", "net"), ["volume", "net"], 4),
    "clean_titlecase": lambda w: clean.clean(_dirty(w)).select(*KEY, "peer_group"),
    "feat_ratios": lambda w: features.add_ratios(w.cleaned).select(*KEY, "net_per_unit", "gross_net_ratio"),
    "feat_volume_tier": lambda w: features.add_volume_tier(w.cleaned, features.volume_edges(w.cleaned))
    .select(*KEY, "volume_tier"),
    "feat_peer_stats": lambda w: _rounded(
        features.peer_stats(w.cleaned), ["peer_mean", "peer_sd", "peer_p75"], 4),
    "feat_zscore": lambda w: _zscored(w).select(*KEY, "net_z"),
    "feat_high_cost": lambda w: features.add_high_cost(_zscored(w)).select(*KEY, "is_high_cost"),
    "feat_outlier_flag": lambda w: features.add_outlier_flag(_zscored(w)).select(*KEY, "is_outlier"),
    "feat_region": lambda w: features.add_region(w.lines, w.places).select(*KEY, "place", "region"),
    "feat_entity_name": lambda w: features.add_entity_name(w.cleaned).select(*KEY, "entity_name"),
    "etl_transform": lambda w: _rounded(w.scored, ["net", "gross"], 4).select(
        *KEY, "entity_name", "peer_group", "place", "region", "volume_tier", "net_per_unit", "gross_net_ratio",
        "net_z", "is_high_cost", "is_outlier", "net", "gross"),
    "outlier_type": lambda w: w.star.measures.select(*KEY, outlier_type("net_z").alias("outlier_type")),
    "performance_tier": lambda w: w.star.segments.select("entity_id", performance_tier("avg_z").alias("performance_tier")),
    # joins
    "join_entity_measure": lambda w: w.star.joined().select(
        *KEY, "peer_group", "place", "total_volume", round_stable("net", 4).alias("net")),
    "join_outlier_segment": lambda w: profiles.outliers_with_segment(w.labelled_star),
    # aggregates
    "agg_basic": lambda w: q.named_agg(
        w.star.merged.groupBy("peer_group"), row_count=F.count(F.lit(1)), avg_net=round_stable(F.avg("net"), 2),
        min_net=round_stable(F.min("net"), 2), max_net=round_stable(F.max("net"), 2),
        sum_net=round_stable(F.sum("net"), 0)),
    "variation_ratio": lambda w: w.star.rollup.groupBy("peer_group").agg(
        round_stable(q.rollup_ratio(), 2).alias("variation_ratio")),
    "global_agg": lambda w: w.star.measures.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("entity_id").alias("entities"),
        round_stable(F.avg("net"), 2).alias("avg_net"), round_stable(F.avg("net_z"), 3).alias("avg_z"),
        round_stable(F.avg("gross_net_ratio"), 3).alias("avg_ratio")),
    "conditional_counts": lambda w: w.star.measures.agg(
        F.count_if(F.col("net_z") > 2).alias("expensive"), F.count_if(F.col("net_z") < -2).alias("cheap"),
        round_stable(F.avg("is_outlier"), 4).alias("outlier_fraction")),
    "two_level_region_mean": lambda w: dashboards.region_means(w.star),
    "pivot_region": lambda w: eda.region_pivot(w.star, w.regions, None),
    "value_counts": lambda w: w.star.merged.groupBy("peer_group").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "peer_group"),
    # windows, top-k
    "peer_zscore_window": lambda w: features.add_zscore_window(w.cleaned).select(*KEY, "net_z"),
    "topk_per_peer": lambda w: profiles.top_outliers_per_peer(w.star),
    "arg_extreme": _arg_extreme,
    "head_preview": lambda w: q.geographic(w.star).limit(10),
    # the six queries
    "q1_peer_variation": lambda w: q.peer_variation(w.star),
    "q2_geographic": lambda w: q.geographic(w.star),
    "q3_volume_cost": lambda w: q.volume_cost(w.star),
    "q4_outliers": lambda w: q.outliers(w.star),
    "q5_items": lambda w: q.item_spread(w.star),
    "q6_item_quartiles": lambda w: q.item_quartiles(w.star),
    "q6_strict": lambda w: q.item_quartiles_strict(w.star),
    "query_summary": lambda w: q.summary(w.star),
    # sets and samples
    "union_batches": _union,
    "list_peers": lambda w: profiles.peers(w.star),
    "expected_minus_actual": lambda w: quality.missing_values(
        w.star.entities.select("entity_id"), w.star.measures.filter("is_outlier = 1").select("entity_id")),
    "sample_points": lambda w: fixed_sample(w.star.measures.select(*KEY), KEY, 500, 42),
    # quality
    "dq_report": _report,
    "dq_duplicates": lambda w: quality.duplicates(w.scored.unionByName(w.scored.filter("is_outlier = 1"))),
    "dq_outlier_flag": lambda w: quality.outlier_flag_errors(_broken_star(w)),
    "dq_unique_entity": lambda w: quality.repeated_ids(_broken_star(w).entities),
    "dq_orphans": lambda w: quality.orphans(_broken_star(w)),
    "dq_ratio": lambda w: quality.ratio_checks(w.star),
    "dq_cluster_coverage": lambda w: quality.cluster_coverage(w.segmented_star.segments),
    # exploration
    "eda_summary": lambda w: eda.summary(w.star),
    "eda_box_stats": lambda w: eda.box_stats(w.star),
    "eda_place_mean": lambda w: eda.place_mean(w.star),
    "eda_volume_scatter": lambda w: eda.volume_scatter(w.star),
    "eda_z_histogram": lambda w: eda.z_histogram(w.star),
    "eda_variation_top15": lambda w: eda.variation_top(w.star),
    "eda_region_pivot": lambda w: eda.region_pivot(w.star, w.regions),
    # segmentation
    "ml_features": lambda w: _rounded(w.features, [*segments.FEATURES, "avg_net"], 4),
    "ml_impute": lambda w: _rounded(
        segments.impute_median(w.features).drop("avg_net"), segments.FEATURES, 4),
    "ml_scaled": lambda w: _rounded(w.scaled.drop("avg_net"), segments.FEATURES, 4),
    "ml_k_search": lambda w: w.k_search,
    "ml_silhouette_euclid": lambda w: segments.silhouette(w.nearest).select(
        "row_count", "clusters", round_stable("silhouette", 4).alias("silhouette")),
    "ml_assign": lambda w: w.clustered.select("entity_id", "cluster_id"),
    "ml_cluster_names": lambda w: segments.name_clusters(
        segments.centroids(segments.with_clusters(w.features, w.nearest))),
    "ml_cluster_summary": lambda w: segments.cluster_summary(segments.label_entities(w.features, w.nearest)),
    "ml_tiers": lambda w: segments.tiers(w.features),
    "ml_pca": lambda w: segments.projection(w.clustered),
    "ml_pca_centroids": lambda w: segments.projected_centroids(segments.projection(w.clustered)),
    "ml_importance": lambda w: segments.importance(w.clustered),
    # lookups and dashboards
    "api_health": lambda w: profiles.health(w.star),
    "api_entity_profile": lambda w: _with_items_text(profiles.entity_profile(w.labelled_star)),
    "api_peer_profile": lambda w: profiles.peer_profile(w.star),
    "api_outliers": lambda w: profiles.outlier_list(w.labelled_star),
    "dash_kpis": lambda w: dashboards.kpis(w.star),
    "dash_peer_variation": lambda w: dashboards.peer_variation(w.star),
    "dash_geo": lambda w: dashboards.geo(w.star),
    "dash_clusters": lambda w: dashboards.clusters(w.labelled_star),
    "dash_outliers": lambda w: dashboards.top_outliers(w.star),
    "bi_overview": lambda w: dashboards.overview(w.star),
    "bi_top_peers": lambda w: dashboards.top_peers_by_cost(w.star),
    "bi_peer_vs_national": lambda w: dashboards.peer_vs_all(w.star),
    "bi_region_compare": lambda w: dashboards.region_compare(w.star),
    "bi_cluster_region": lambda w: dashboards.cluster_by_region(w.labelled_star),
    "bi_outlier_mix": lambda w: dashboards.outlier_mix(w.star),
    # alerts and lookups by id
    "alert_outlier_count": lambda w: alerts.outlier_alert(w.star),
    "alert_top10": lambda w: alerts.alert_rows(w.star),
    "refresh_gate": lambda w: alerts.refresh_gate(w.star),
    "entity_lookup": lambda w: profiles.entity_lookup(w.labelled_star),
    # the star by entity: lookups that read single buckets, updates that write single buckets
    "keyed_alert_profiles": _alerted_profiles,
    "keyed_entity_lookup": lambda w: profiles.entity_lookup(w.keyed.star()),
    "keyed_segments": lambda w: _rounded(w.keyed.star().segments, ["avg_z"], 4),
    # streams
    "stream_score": _stream_score,
    "stream_daily_alert": _stream_daily,
    "stream_weekly_counts": _stream_weekly,
    "stream_score_versions": _stream_versions,
    "stream_daily_once": _stream_once,
    # narrative facts
    "insight_peer": lambda w: facts.peer_facts(w.star),
    "insight_geo": lambda w: facts.geo_facts(w.star),
    "insight_outlier": lambda w: facts.outlier_facts(w.star),
    "insight_overall": lambda w: facts.overall_facts(w.star),
    "prompt_context": lambda w: facts.context_rows(w.star),
    "prompt_context_10": lambda w: facts.context_rows(w.star, 10, 10, 10),
}


def by_folder(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    """The query as a function of session and data folder."""
    return lambda spark, sf_dir: query(workspace(spark, sf_dir))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: by_folder(query) for key, query in QUERIES.items()}
