"""The checking statement of every query key."""

from __future__ import annotations

from peerbench.oracle.base import OUTLIER_TYPE, perf, r
from peerbench.plans.segments import FEATURES

TIE = "md5(concat_ws('|', CAST(m.entity_id AS VARCHAR), m.item_code))"
EXTREME_ORDER = "ORDER BY abs(net_z) DESC, entity_id, item_code"


def _quartiles(condition: str) -> str:
    return f"""
  SELECT i.item_desc, e.entity_name, e.peer_group, e.place, {r('m.net', 2)} AS net, e.total_volume,
         CAST(ntile(4) OVER (PARTITION BY i.item_code ORDER BY m.net, {TIE}) AS INT) AS net_quartile
  FROM items i JOIN measures m ON {condition} JOIN entities e ON e.entity_id = i.entity_id"""


def _boxes() -> str:
    inside = "m.net BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return f"""
  SELECT peer_group, is_outlier, count(*) AS rows, count(*) FILTER (WHERE NOT ({inside})) AS fliers,
         {r('any_value(q1)', 2)} AS q1, {r('any_value(b.median)', 2)} AS median, {r('any_value(q3)', 2)} AS q3,
         {r(f'min(m.net) FILTER (WHERE {inside})', 2)} AS low_whisker,
         {r(f'max(m.net) FILTER (WHERE {inside})', 2)} AS high_whisker,
         {r('any_value(peer_median)', 2)} AS peer_median
  FROM merged m JOIN (
    SELECT peer_group, is_outlier, quantile_cont(net, 0.25) AS q1, quantile_cont(net, 0.5) AS median,
           quantile_cont(net, 0.75) AS q3 FROM merged GROUP BY ALL) b USING (peer_group, is_outlier)
  JOIN (SELECT peer_group, quantile_cont(net, 0.5) AS peer_median FROM merged GROUP BY peer_group
        HAVING stddev_samp(net) IS NOT NULL ORDER BY stddev_samp(net) DESC, peer_group LIMIT 10) w USING (peer_group)
  GROUP BY peer_group, is_outlier"""


def _histogram() -> str:
    return f"""
  SELECT CAST(b.bin AS INT) AS bin, {r('low + b.bin * width', 4)} AS low_edge,
         {r('low + (b.bin + 1) * width', 4)} AS high_edge, coalesce(c.n, 0) AS n,
         (SELECT count(*) FROM measures WHERE is_outlier = 1) AS outlier_rows
  FROM range(80) AS b(bin)
  JOIN (SELECT min(net_z) AS low, (max(net_z) - min(net_z)) / 80 AS width
        FROM measures WHERE net_z BETWEEN -6 AND 6) s ON true
  LEFT JOIN (SELECT coalesce(least(floor((net_z - t.low) / nullif(t.width, 0)), 79), 0) AS bin, count(*) AS n
             FROM measures, (SELECT min(net_z) AS low, (max(net_z) - min(net_z)) / 80 AS width
                             FROM measures WHERE net_z BETWEEN -6 AND 6) t
             WHERE net_z BETWEEN -6 AND 6 GROUP BY 1) c ON c.bin = b.bin"""


def _pivot(top: str = "") -> str:
    regions = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
    columns = ", ".join(
        f"coalesce({r(f'''avg(net) FILTER (WHERE region = '{x}')''', 2)}, 0) AS \"{x}\"" for x in regions)
    return f"""
  SELECT peer_group, {columns} FROM merged WHERE peer_group IN (
    SELECT peer_group FROM merged GROUP BY peer_group ORDER BY avg(net) DESC, peer_group {top})
  GROUP BY peer_group"""


def _silhouette() -> str:
    square = " + ".join(f"{f} * {f}" for f in FEATURES)
    dot = " + ".join(f"p.{f} * c.s_{f}" for f in FEATURES)
    return f"""
  , sums AS (SELECT cluster_id, count(*) AS n, sum({square}) AS q, {', '.join(f'sum({f}) AS s_{f}' for f in FEATURES)} FROM nearest GROUP BY cluster_id),
  ab AS (SELECT entity_id, max(c.n) FILTER (WHERE p.cluster_id = c.cluster_id) AS n,
                max((c.n * ({square}) + c.q - 2 * ({dot})) / nullif(c.n - 1, 0)) FILTER (WHERE p.cluster_id = c.cluster_id) AS a,
                min((c.n * ({square}) + c.q - 2 * ({dot})) / c.n) FILTER (WHERE p.cluster_id <> c.cluster_id) AS b
         FROM nearest p JOIN sums c ON true GROUP BY entity_id)
  SELECT count(*) AS row_count, CAST((SELECT count(*) FROM sums) AS INT) AS clusters,
         {r('avg(CASE WHEN n = 1 OR b IS NULL THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END)', 4)} AS silhouette
  FROM ab"""


def _counts(*names: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}" for n, t in (
        (x.split(":") if ":" in x else (x, x)) for x in names))


def _report() -> str:
    def row(name, observed, threshold, severity, passed):
        return f"""SELECT '{name}' AS check_name, {r(observed, 4)} AS observed, CAST({threshold} AS DOUBLE) AS threshold,
           '{severity}' AS severity, CAST(coalesce({passed}, false) AS INT) AS passed FROM scored"""

    dup = "count(*) - count(DISTINCT (entity_id, item_code))"
    bad = "count(*) FILTER (WHERE isnan(net_z) OR isinf(net_z))"
    return " UNION ALL ".join([
        row("duplicate_pairs", dup, "0", "WARNING", f"{dup} = 0"),
        row("negative_net", "count(*) FILTER (WHERE net < 0)", "0", "ERROR", "count(*) FILTER (WHERE net < 0) = 0"),
        row("mean_z", "abs(avg(net_z))", "0.5", "WARNING", "abs(avg(net_z)) <= 0.5"),
        row("z_not_finite", bad, "0", "ERROR", f"{bad} = 0"),
        row("max_net", "max(net)", "1000000", "WARNING", "max(net) <= 1000000"),
        row("places_covered", "count(DISTINCT place)", "(SELECT count(*) FROM nation)", "INFO", "count(DISTINCT place) >= (SELECT count(*) FROM nation)"),
        row("peers_covered", "count(DISTINCT peer_group)", "(SELECT count(DISTINCT c_mktsegment) FROM customer)", "INFO", "count(DISTINCT peer_group) >= (SELECT count(DISTINCT c_mktsegment) FROM customer)"),
        row("total_rows", "count(*)", "NULL", "INFO", "true"),
        row("distinct_entities", "count(DISTINCT entity_id)", "NULL", "INFO", "true"),
        row("outlier_rows", "sum(is_outlier)", "NULL", "INFO", "true"),
        row("missing_z", "count(*) - count(net_z)", "NULL", "INFO", "true"),
    ])


def _rounded(columns, digits: int) -> str:
    return ", ".join(f"{r(c, digits)} AS {c}" for c in columns)


def _windows(origin: str, length: str, extra: str = "") -> str:
    return f"""
  SELECT strftime(TIMESTAMP '{origin}' + to_microseconds(
                    (epoch_us(ts) - epoch_us(TIMESTAMP '{origin}')) // {length} * {length}), '%Y-%m-%d %H:%M:%S') AS starts, count(*) AS row_count{extra}"""


DAY, WEEK = str(86_400_000_000), str(7 * 86_400_000_000)
DIRTY_OK = "peer_group IS NOT NULL AND net IS NOT NULL"
LINE_KEY = "entity_id, item_code"

QUERIES: dict[str, str] = {
    # sources and sinks
    "src_csv_raw": f"SELECT CAST(entity_id AS VARCHAR) AS entity_id, item_code, peer_group, place, {_rounded(['net', 'volume'], 4)} FROM dirty JOIN (SELECT entity_id, item_code, place FROM lines) p USING (entity_id, item_code)",
    "src_star_counts": _counts("entities", "items", "measures", "segments", "merged"),
    "dim_region": "SELECT n_name AS place, r_name AS region, count(*) AS entities FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL",
    "star_entities": "SELECT * FROM entities",
    "star_items": f"SELECT entity_id, item_code, item_desc, {r('services', 2)} AS services FROM items",
    "star_measures": f"SELECT entity_id, item_code, {_rounded(['gross', 'net', 'net_per_unit', 'gross_net_ratio', 'net_z'], 4)}, is_outlier FROM measures",
    "star_segments": f"SELECT entity_id, item_diversity, {r('avg_z', 4)} AS avg_z FROM plain_segments",
    # cleaning and features
    "clean_drop_critical": f"SELECT CAST(entity_id AS VARCHAR) AS entity_id, item_code, peer_group FROM dirty WHERE {DIRTY_OK}",
    "clean_coerce": f"SELECT CAST(entity_id AS VARCHAR) AS entity_id, item_code, {_rounded(['volume', 'services', 'gross', 'net'], 4)} FROM dirty WHERE {DIRTY_OK}",
    "clean_positive": f"SELECT CAST(entity_id AS VARCHAR) AS entity_id, item_code, {_rounded(['volume', 'net'], 4)} FROM dirty WHERE {DIRTY_OK} AND net > 0 AND volume > 0",
    "clean_titlecase": f"SELECT CAST(entity_id AS VARCHAR) AS entity_id, item_code, upper(left(trim(peer_group), 1)) || lower(substr(trim(peer_group), 2)) AS peer_group FROM dirty WHERE {DIRTY_OK} AND net > 0 AND volume > 0",
    "feat_ratios": f"SELECT {LINE_KEY}, net_per_unit, gross_net_ratio FROM scored",
    "feat_volume_tier": f"SELECT {LINE_KEY}, volume_tier FROM tiered",
    "feat_peer_stats": f"SELECT peer_group, {_rounded(['peer_mean', 'peer_sd', 'peer_p75'], 4)} FROM stats",
    "feat_zscore": f"SELECT {LINE_KEY}, net_z FROM zscored",
    "feat_high_cost": f"SELECT {LINE_KEY}, is_high_cost FROM scored",
    "feat_outlier_flag": f"SELECT {LINE_KEY}, is_outlier FROM scored",
    "feat_region": f"SELECT {LINE_KEY}, place, coalesce(region, 'Unknown') AS region FROM lines",
    "feat_entity_name": f"SELECT {LINE_KEY}, entity_name FROM scored",
    "etl_transform": f"SELECT {LINE_KEY}, entity_name, peer_group, place, region, volume_tier, net_per_unit, gross_net_ratio, net_z, is_high_cost, is_outlier, {_rounded(['net', 'gross'], 4)} FROM scored",
    "outlier_type": f"SELECT {LINE_KEY}, {OUTLIER_TYPE} AS outlier_type FROM measures",
    "performance_tier": f"SELECT entity_id, {perf('avg_z')} AS performance_tier FROM plain_segments",
    # joins
    "join_entity_measure": f"SELECT {LINE_KEY}, peer_group, place, total_volume, {r('net', 4)} AS net FROM merged",
    "join_outlier_segment": f"SELECT m.entity_id, m.item_code, m.entity_name, m.peer_group, m.place, m.locality, m.volume_tier, {r('net', 2)} AS net, {r('net_z', 3)} AS z_score, {r('gross_net_ratio', 3)} AS gross_net_ratio, {OUTLIER_TYPE} AS outlier_type, s.cluster_name, s.performance_tier FROM merged m LEFT JOIN segments s USING (entity_id) WHERE is_outlier = 1",
    # aggregates
    "agg_basic": f"SELECT peer_group, count(*) AS row_count, {r('avg(net)', 2)} AS avg_net, {r('min(net)', 2)} AS min_net, {r('max(net)', 2)} AS max_net, {r('sum(net)', 0)} AS sum_net FROM merged GROUP BY peer_group",
    "variation_ratio": f"SELECT peer_group, {r('max(net) / nullif(min(net), 0)', 2)} AS variation_ratio FROM merged GROUP BY peer_group",
    "global_agg": f"SELECT count(*) AS row_count, count(DISTINCT entity_id) AS entities, {r('avg(net)', 2)} AS avg_net, {r('avg(net_z)', 3)} AS avg_z, {r('avg(gross_net_ratio)', 3)} AS avg_ratio FROM measures",
    "conditional_counts": f"SELECT count(*) FILTER (WHERE net_z > 2) AS expensive, count(*) FILTER (WHERE net_z < -2) AS cheap, {r('avg(is_outlier)', 4)} AS outlier_fraction FROM measures",
    "two_level_region_mean": f"SELECT region, {r('mean', 2)} AS region_avg FROM region_means",
    "pivot_region": _pivot(),
    "value_counts": "SELECT peer_group, count(*) AS n FROM merged GROUP BY peer_group",
    # windows, top-k
    "peer_zscore_window": f"SELECT {LINE_KEY}, {r('(net - avg(net) OVER w) / nullif(stddev_samp(net) OVER w, 0)', 4)} AS net_z FROM cleaned WINDOW w AS (PARTITION BY peer_group)",
    "topk_per_peer": f"SELECT peer_group, CAST(rank AS INT) AS rank, entity_id, item_code, {r('net', 2)} AS net, {r('net_z', 3)} AS z_score FROM (SELECT *, row_number() OVER (PARTITION BY peer_group {EXTREME_ORDER}) AS rank FROM merged WHERE is_outlier = 1) WHERE rank <= 10",
    "arg_extreme": f"SELECT peer_group, arg_max(entity_id, net) AS costliest_entity, {r('max(net)', 2)} AS max_net, arg_max(entity_id, abs(net_z) * 1000000000 + net / 1000000) AS most_extreme_entity FROM merged GROUP BY peer_group",
    "head_preview": "SELECT place, region, peer_group, place_avg, entity_count FROM geographic ORDER BY place_avg DESC, place, region, peer_group LIMIT 10",
    # the six queries
    "q1_peer_variation": "SELECT * FROM variation",
    "q2_geographic": "SELECT * FROM geographic",
    "q3_volume_cost": f"SELECT volume_tier, peer_group, {r('avg(net)', 2)} AS avg_net, {r('avg(net_per_unit)', 2)} AS avg_net_per_unit, count(DISTINCT entity_id) AS entity_count, CAST(sum(total_volume) AS BIGINT) AS total_volume_served FROM merged GROUP BY volume_tier, peer_group",
    "q4_outliers": "SELECT entity_name, peer_group, place, locality, net, z_score, gross_net_ratio, volume_tier, outlier_type FROM listed",
    "q5_items": "SELECT * FROM spreads",
    "q6_item_quartiles": _quartiles("m.entity_id = i.entity_id"),
    "q6_strict": _quartiles("m.entity_id = i.entity_id AND m.item_code = i.item_code"),
    "query_summary": f"SELECT (SELECT peer_group FROM variation ORDER BY variation_ratio DESC, peer_group LIMIT 1) AS top_peer, (SELECT max(variation_ratio) FROM variation) AS top_ratio, (SELECT {r('avg(variation_ratio)', 1)} FROM variation) AS mean_ratio, (SELECT count(*) FROM flagged WHERE outlier_type = 'Expensive Outlier') AS expensive, (SELECT count(*) FROM flagged WHERE outlier_type = 'Cheap Outlier') AS cheap, (SELECT item_desc FROM spreads ORDER BY net_spread DESC, item_desc LIMIT 1) AS widest_item, (SELECT max(net_spread) FROM spreads) AS widest_spread",
    # sets and samples
    "union_batches": "SELECT peer_group, count(*) AS n FROM (SELECT peer_group FROM measures JOIN entities USING (entity_id) WHERE is_outlier = 1 UNION ALL SELECT peer_group FROM measures JOIN entities USING (entity_id) WHERE is_outlier = 0) GROUP BY peer_group",
    "list_peers": "SELECT DISTINCT peer_group FROM entities",
    "expected_minus_actual": "SELECT entity_id FROM entities WHERE entity_id NOT IN (SELECT entity_id FROM measures WHERE is_outlier = 1)",
    "sample_points": f"SELECT {LINE_KEY} FROM measures ORDER BY md5('42|' || CAST(entity_id AS VARCHAR) || '|' || item_code), entity_id, item_code LIMIT 500",
    # quality
    "dq_report": _report(),
    "dq_duplicates": "SELECT count(*) FILTER (WHERE is_outlier = 1) AS duplicate_rows FROM scored",
    "dq_outlier_flag": "SELECT count(*) FILTER (WHERE is_outlier = 1 AND NOT coalesce(abs(net_z) > 2, false)) AS wrongly_flagged, count(*) FILTER (WHERE is_outlier = 0 AND coalesce(abs(net_z) > 2, false)) AS wrongly_unflagged FROM (SELECT * REPLACE (CASE WHEN entity_id % 5 = 0 THEN 1 - is_outlier ELSE is_outlier END AS is_outlier) FROM measures)",
    "dq_unique_entity": "SELECT count(*) FILTER (WHERE n > 1) AS repeated_ids FROM (SELECT count(*) AS n FROM broken_entities GROUP BY entity_id)",
    "dq_orphans": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS orphan_rows FROM {t} WHERE entity_id NOT IN (SELECT entity_id FROM broken_entities)" for t in ("items", "measures", "segments")),
    "dq_ratio": f"SELECT count(*) FILTER (WHERE gross < net) AS gross_below_net, count(*) FILTER (WHERE net_per_unit <= 0) AS unit_not_positive, {r('avg(CAST(gross_net_ratio < 0.99 AS INT))', 6)} AS low_ratio_share FROM measures",
    # exploration
    "eda_summary": f"SELECT count(*) AS rows, count(DISTINCT entity_id) AS entities, count(DISTINCT peer_group) AS peers, count(DISTINCT place) AS places, {r('avg(net)', 2)} AS mean_net, {r('median(net)', 2)} AS median_net, {r('stddev_samp(net)', 2)} AS sd_net, {r('avg(is_outlier)', 4)} AS outlier_fraction FROM merged",
    "eda_box_stats": _boxes(),
    "eda_place_mean": f"SELECT place, region, {r('avg(net)', 2)} AS avg_net FROM merged GROUP BY place, region",
    "eda_volume_scatter": f"SELECT {LINE_KEY}, peer_group, total_volume, {r('net', 2)} AS net, {r('least(greatest(gross_net_ratio, 0), 10) * 5', 3)} AS dot_size FROM merged WHERE peer_group IN (SELECT peer_group FROM merged GROUP BY peer_group ORDER BY count(*) DESC, peer_group LIMIT 8) ORDER BY md5('42|' || CAST(entity_id AS VARCHAR) || '|' || item_code), entity_id, item_code LIMIT 5000",
    "eda_z_histogram": _histogram(),
    "eda_variation_top15": f"SELECT peer_group, {r('max(net) / min(net)', 2)} AS variation_ratio FROM merged GROUP BY peer_group HAVING min(net) > 0 ORDER BY max(net) / min(net) DESC, peer_group LIMIT 15",
    "eda_region_pivot": _pivot("LIMIT 5"),
    # segmentation with fixed labels
    "ml_features": f"SELECT entity_id, {_rounded([*FEATURES, 'avg_net'], 4)} FROM features",
    "ml_impute": f"SELECT entity_id, {_rounded(FEATURES, 4)} FROM imputed",
    "ml_scaled": f"SELECT entity_id, {_rounded(FEATURES, 4)} FROM scaled",
    "ml_silhouette_euclid": _silhouette(),
    "ml_cluster_names": "SELECT cluster_id, cluster_name FROM names",
    "ml_cluster_summary": f"SELECT cluster_id, cluster_name, {', '.join(f'{r(f'avg({f})', 3)} AS {f}' for f in FEATURES)} FROM named GROUP BY cluster_id, cluster_name",
    "ml_tiers": f"SELECT entity_id, {perf('avg_z')} AS performance_tier FROM features",
    "seg_update_fixed": f"SELECT entity_id, item_diversity, {r('avg_z', 4)} AS avg_z, cluster_id, cluster_name, performance_tier FROM segments",
    # lookups and dashboards
    "api_health": _counts("entities", "items", "measures", "segments"),
    "api_entity_profile": f"SELECT *, coalesce(entity_name, 'Unnamed') || ' / ' || concat_ws(', ', peer_group, locality) || printf(': mean net %.2f, ', avg_net) || CASE WHEN avg_z > 0 THEN 'dearer than' WHEN avg_z < 0 THEN 'cheaper than' ELSE 'level with' END || printf(' the peer mean (z %.3f); ', avg_z) || cluster_name || ', tier ' || performance_tier AS summary FROM (SELECT entity_id, e.entity_name, e.peer_group, e.place, e.locality, e.region, coalesce(s.cluster_name, 'Unassigned') AS cluster_name, {r('coalesce(m.net, 0)', 2)} AS avg_net, {r('coalesce(m.z, 0)', 3)} AS avg_z, {r('coalesce(m.gnr, 0)', 3)} AS gross_net_ratio, coalesce(s.performance_tier, 'Unknown') AS performance_tier, e.total_volume, e.volume_tier, coalesce(s.item_diversity, 0) AS item_diversity, i.items_text FROM entities e JOIN (SELECT entity_id, avg(net) AS net, avg(net_z) AS z, avg(gross_net_ratio) AS gnr FROM measures GROUP BY entity_id) m USING (entity_id) LEFT JOIN segments s USING (entity_id) LEFT JOIN (SELECT entity_id, string_agg(item_code || '=' || CAST(CAST(services AS BIGINT) AS VARCHAR) || 'x' || CAST(times AS VARCHAR), ';' ORDER BY item_code, item_desc) AS items_text FROM (SELECT entity_id, item_code, item_desc, sum(services) AS services, count(*) AS times FROM items GROUP BY ALL) GROUP BY entity_id) i USING (entity_id))",
    "api_peer_profile": f"SELECT peer_group, count(DISTINCT entity_id) AS entity_count, {r('avg(net)', 2)} AS avg_net, {r('min(net)', 2)} AS min_net, {r('max(net)', 2)} AS max_net, {r('max(net) / nullif(min(net), 0)', 1)} AS variation_ratio, CAST(sum(total_volume) AS BIGINT) AS total_volume, CAST(sum(is_outlier) AS BIGINT) AS outlier_rows, any_value(top_places) AS top_places FROM merged JOIN (SELECT peer_group, string_agg(place, ', ' ORDER BY rank) AS top_places FROM (SELECT peer_group, place, row_number() OVER (PARTITION BY peer_group ORDER BY count(*) DESC, place) AS rank FROM entities GROUP BY peer_group, place) WHERE rank <= 3 GROUP BY peer_group) t USING (peer_group) GROUP BY peer_group",
    "api_outliers": f"SELECT entity_id, m.entity_name, m.peer_group, m.place, m.locality, m.volume_tier, {r('net', 2)} AS net, {r('net_z', 3)} AS z_score, {r('gross_net_ratio', 3)} AS gross_net_ratio, {OUTLIER_TYPE} AS outlier_type, s.cluster_name, s.performance_tier FROM (SELECT * FROM merged WHERE is_outlier = 1 {EXTREME_ORDER} LIMIT 20) m LEFT JOIN segments s USING (entity_id)",
    "dash_kpis": f"SELECT (SELECT count(DISTINCT entity_id) FROM entities) AS total_entities, (SELECT count(*) FROM items) AS total_items, (SELECT count(*) FROM measures WHERE is_outlier = 1) AS total_outliers, (SELECT {r('avg(variation_ratio)', 1)} FROM all_variation) AS avg_variation_ratio",
    "dash_peer_variation": "SELECT * FROM dash_variation",
    "dash_geo": f"SELECT place, region, {r('avg(net)', 2)} AS avg_net, count(DISTINCT entity_id) AS entity_count FROM merged GROUP BY place, region",
    "dash_clusters": f"SELECT cluster_name, count(*) AS entity_count, {r('avg(avg_z)', 3)} AS avg_z FROM segments WHERE cluster_name IS NOT NULL GROUP BY cluster_name",
    "dash_outliers": f"SELECT entity_name, peer_group, place, net, z_score, CASE WHEN net_z > 2 THEN 'Expensive' ELSE 'Cheap' END AS side FROM (SELECT * FROM listed {EXTREME_ORDER} LIMIT 50)",
    "bi_overview": f"SELECT CAST(sum(entity_count) AS BIGINT) AS total_entities, {r('avg(variation_ratio)', 2)} AS avg_variation_ratio, (SELECT count(*) FROM flagged) AS total_outliers FROM all_variation",
    "bi_top_peers": "SELECT peer_group, avg_net FROM variation ORDER BY avg_net DESC, peer_group LIMIT 10",
    "bi_peer_vs_national": f"SELECT peer_group, variation_ratio, {r('(SELECT avg(variation_ratio) FROM all_variation)', 2)} AS mean_ratio, CASE WHEN variation_ratio > (SELECT avg(variation_ratio) FROM all_variation) THEN 'above' ELSE 'below' END AS position FROM all_variation",
    "bi_region_compare": f"SELECT region, {r('avg(place_avg)', 2)} AS region_avg, CAST(sum(entity_count) AS BIGINT) AS entity_count, max(place_avg) AS top_avg FROM geographic GROUP BY region",
    "bi_cluster_region": f"SELECT cluster_name, region, count(*) AS entity_count, {r('any_value(n) * 1.0 / (SELECT count(*) FROM segments WHERE cluster_name IS NOT NULL)', 4)} AS cluster_share FROM entities JOIN segments USING (entity_id) JOIN (SELECT cluster_name, count(*) AS n FROM segments GROUP BY cluster_name) c USING (cluster_name) GROUP BY cluster_name, region",
    "bi_outlier_mix": f"SELECT peer_group, outlier_type, count(*) AS outlier_count, {r('count(*) * 100.0 / (SELECT count(*) FROM entities)', 4)} AS pct_of_entities, {r('avg(z_score)', 3)} AS avg_z FROM flagged GROUP BY peer_group, outlier_type",
    # alerts and lookups by id
    "alert_outlier_count": f"SELECT count(*) AS outlier_count, {r('avg(abs(net_z))', 2)} AS avg_severity, CAST(200 AS INT) AS threshold, CAST(count(*) > 200 AS INT) AS fires FROM measures WHERE is_outlier = 1",
    "alert_top10": f"SELECT entity_name, peer_group, place, net, z_score FROM (SELECT * FROM listed {EXTREME_ORDER} LIMIT 10)",
    "refresh_gate": "SELECT count(*) AS entity_count, (SELECT count(*) FROM measures) AS measure_count, CASE WHEN count(*) > 1000 THEN 'OK' ELSE 'FAIL' END AS status FROM entities",
    "entity_lookup": "SELECT e.*, s.cluster_name, s.performance_tier FROM entities e LEFT JOIN segments s USING (entity_id)",
    # streams
    "stream_score": "SELECT event_id, entity_id, peer_group, net_z, CAST(coalesce(abs(net_z) > 2, false) AS INT) AS is_outlier FROM event_scores",
    "stream_daily_alert": _windows("2000-01-03 09:00:00", DAY, ", CAST(sum(CAST(coalesce(abs(net_z) > 2, false) AS INT)) AS BIGINT) AS outlier_count, CAST(sum(CAST(coalesce(abs(net_z) > 2, false) AS INT)) > 200 AS INT) AS fires FROM event_scores GROUP BY 1"),
    "stream_weekly_counts": _windows("2000-01-03 08:00:00", WEEK, ", CASE WHEN count(*) > 1000 THEN 'OK' ELSE 'FAIL' END AS status FROM events GROUP BY 1"),
    # narrative facts
    "insight_peer": f"SELECT (SELECT peer_group FROM all_variation ORDER BY variation_ratio DESC, peer_group LIMIT 1) AS top_peer, max(variation_ratio) AS top_ratio, (SELECT peer_group FROM all_variation ORDER BY variation_ratio, peer_group DESC LIMIT 1) AS bottom_peer, min(variation_ratio) AS bottom_ratio, {r('avg(variation_ratio)', 2)} AS mean_ratio, CAST(coalesce(sum(entity_count) FILTER (WHERE variation_ratio > 1.5 * (SELECT avg(variation_ratio) FROM all_variation)), 0) AS BIGINT) AS entities_in_wide_peers FROM all_variation",
    "insight_geo": f"SELECT (SELECT region FROM region_means ORDER BY mean DESC, region LIMIT 1) AS top_region, {r('max(mean)', 2)} AS top_region_avg, (SELECT region FROM region_means ORDER BY mean, region LIMIT 1) AS low_region, {r('min(mean)', 2)} AS low_region_avg, {r('(max(mean) - min(mean)) / min(mean)', 4)} AS gap, (SELECT place FROM geographic ORDER BY place_avg DESC, place, region, peer_group LIMIT 1) AS top_place, (SELECT max(place_avg) FROM geographic) AS top_place_avg FROM region_means",
    "insight_outlier": f"SELECT (SELECT count(*) FROM flagged WHERE outlier_type = 'Expensive Outlier') AS expensive, (SELECT count(*) FROM flagged WHERE outlier_type = 'Cheap Outlier') AS cheap, entity_name AS top_entity, peer_group AS top_peer, place AS top_place, z_score AS top_z, (SELECT {r('avg(abs(z_score))', 2)} FROM flagged) AS mean_abs_z, {r('abs(z_score) * 500 + 200', 2)} AS illustrative_extra FROM (SELECT * FROM flagged {EXTREME_ORDER} LIMIT 1)",
    "insight_overall": f"SELECT (SELECT count(*) FROM all_variation) AS peers, (SELECT {r('avg(variation_ratio)', 2)} FROM all_variation) AS mean_ratio, (SELECT count(*) FROM flagged) AS total_outliers, (SELECT CASE WHEN count(*) >= 2 THEN {r('(max(mean) - min(mean)) / min(mean)', 4)} END FROM region_means) AS region_spread",
    "prompt_context": "SELECT 'PEER VARIATION' AS section, concat_ws(' | ', peer_group, CAST(entity_count AS VARCHAR), printf('%.2f', avg_net), printf('%.2f', variation_ratio)) AS line FROM (SELECT * FROM variation ORDER BY variation_ratio DESC, peer_group LIMIT 5) UNION ALL SELECT 'GEOGRAPHIC', concat_ws(' | ', place, region, peer_group, printf('%.2f', place_avg)) FROM (SELECT * FROM geographic ORDER BY place_avg DESC, place, region, peer_group LIMIT 5) UNION ALL SELECT 'OUTLIERS', concat_ws(' | ', entity_name, peer_group, place, printf('%.2f', net), printf('%.2f', z_score)) FROM (SELECT * FROM listed " + EXTREME_ORDER + " LIMIT 5)",
    "prompt_context_10": "SELECT 'PEER VARIATION' AS section, concat_ws(' | ', peer_group, CAST(entity_count AS VARCHAR), printf('%.2f', avg_net), printf('%.2f', variation_ratio)) AS line FROM (SELECT * FROM variation ORDER BY variation_ratio DESC, peer_group LIMIT 10) UNION ALL SELECT 'GEOGRAPHIC', concat_ws(' | ', place, region, peer_group, printf('%.2f', place_avg)) FROM (SELECT * FROM geographic ORDER BY place_avg DESC, place, region, peer_group LIMIT 10) UNION ALL SELECT 'OUTLIERS', concat_ws(' | ', entity_name, peer_group, place, printf('%.2f', net), printf('%.2f', z_score)) FROM (SELECT * FROM listed " + EXTREME_ORDER + " LIMIT 10)",
}

# a store loaded in batches equals one load
QUERIES |= {f"refresh_{name}": QUERIES[f"{kind}_{name}"] for kind, name in (
    ("star", "entities"), ("star", "measures"), ("star", "segments"), ("feat", "peer_stats"))}

# the stream with versions and the one that fires once give the rows of the plain ones when all is there at once
QUERIES |= {"stream_score_versions": QUERIES["stream_score"], "stream_daily_once": QUERIES["stream_daily_alert"]}

# the star by entity holds the same rows; an update of its buckets gives the same segments
QUERIES |= {
    "keyed_alert_profiles": f"SELECT * FROM ({QUERIES['api_entity_profile']}) WHERE entity_id IN (SELECT entity_id FROM (SELECT * FROM merged WHERE is_outlier = 1 {EXTREME_ORDER} LIMIT 10))",
    "keyed_entity_lookup": QUERIES["entity_lookup"], "keyed_segments": QUERIES["seg_update_fixed"]}
