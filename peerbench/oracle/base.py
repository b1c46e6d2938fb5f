"""Common table expressions that the checking statements share."""

from __future__ import annotations

import re

from peerbench.plans.segments import FEATURES
from peerbench.workspace import FIXED_CENTROIDS


def r(expression: str, digits: int) -> str:
    """The rounding formula of ``functions.numbers.round_stable``."""
    return f"(floor(CAST({expression} AS DOUBLE) * 1e{digits} + 0.500001) / 1e{digits})"


def title(column: str) -> str:
    """Title case of a single word."""
    return f"(upper(left(trim({column}), 1)) || lower(substr(trim({column}), 2)))"


def perf(z: str) -> str:
    return f"""CASE WHEN {z} IS NULL THEN 'Unknown' WHEN {z} > 1.5 THEN 'High Cost'
      WHEN {z} > 0.5 THEN 'Above Average' WHEN {z} > -0.5 THEN 'Average'
      WHEN {z} > -1.5 THEN 'Below Average' ELSE 'Low Cost' END"""


OUTLIER_TYPE = "CASE WHEN net_z > 2 THEN 'Expensive Outlier' WHEN net_z < -2 THEN 'Cheap Outlier' END"


def _distances() -> str:
    return ",\n".join(
        "    (" + " + ".join(f"({f} - ({x})) * ({f} - ({x}))" for f, x in zip(FEATURES, point)) + f") AS d{i}"
        for i, point in enumerate(FIXED_CENTROIDS))


def _nearest() -> str:
    n = len(FIXED_CENTROIDS)
    least = "least(" + ", ".join(f"d{i}" for i in range(n)) + ")"
    return "CASE " + " ".join(f"WHEN d{i} = {least} THEN {i}" for i in range(n)) + " END"


TABLES: dict[str, str] = {
    "lines": """
  SELECT g.entity_id, g.item_code, g.volume, g.services, g.gross, g.net,
         split_part(c_name, '#', 1) AS last_name, split_part(c_name, '#', 2) AS first_name,
         c_mktsegment AS peer_group, n_name AS place, r_name AS region,
         n_name || '/' || CAST(c_custkey % 5 AS VARCHAR) AS locality, lower(g.item_code) || ' item' AS item_desc
  FROM (SELECT o_custkey AS entity_id, p_type AS item_code, count(DISTINCT l_orderkey) AS volume,
               sum(l_quantity) AS services, avg(l_extendedprice * (1 + l_tax)) AS gross,
               avg(l_extendedprice * (1 - l_discount)) AS net
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
        GROUP BY o_custkey, p_type) g
  JOIN customer ON c_custkey = g.entity_id JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey""",
    "dirty": """
  SELECT entity_id, item_code, services, gross,
         CASE WHEN volume = 1 AND services > 45 THEN NULL ELSE '  ' || lower(peer_group) || ' ' END AS peer_group,
         CASE WHEN volume >= 10 THEN NULL WHEN gross < 20000 THEN -1.0 ELSE net END AS net,
         CASE WHEN services BETWEEN 48 AND 50 THEN NULL ELSE volume END AS volume
  FROM lines""",
    "cleaned": f"""
  SELECT * REPLACE ({title('peer_group')} AS peer_group) FROM lines
  WHERE entity_id IS NOT NULL AND peer_group IS NOT NULL AND net > 0 AND volume > 0""",
    "edges": """
  SELECT min(volume) AS q0, quantile_cont(volume, 0.25) AS q1, quantile_cont(volume, 0.5) AS q2,
         quantile_cont(volume, 0.75) AS q3, max(volume) AS q4 FROM cleaned""",
    "stats": """
  SELECT peer_group, avg(net) AS peer_mean, stddev_samp(net) AS peer_sd,
         quantile_cont(net, 0.75) AS peer_p75 FROM cleaned GROUP BY peer_group""",
    "tiered": """
  SELECT c.*, CASE WHEN len(list_distinct([q0, q1, q2, q3, q4])) < 5 THEN 'Medium' WHEN volume <= q1 THEN 'Low'
                   WHEN volume <= q2 THEN 'Medium' WHEN volume <= q3 THEN 'High' ELSE 'Very High' END AS volume_tier
  FROM cleaned c CROSS JOIN edges""",
    "zscored": f"""
  SELECT t.*, s.peer_mean, s.peer_sd, s.peer_p75, {r('(net - peer_mean) / nullif(peer_sd, 0)', 4)} AS net_z
  FROM tiered t LEFT JOIN stats s USING (peer_group)""",
    "scored": f"""
  SELECT *, {r('net / nullif(volume, 0)', 4)} AS net_per_unit, {r('gross / nullif(net, 0)', 4)} AS gross_net_ratio,
         CAST(coalesce(net > peer_p75, false) AS INT) AS is_high_cost,
         CAST(coalesce(abs(net_z) > 2, false) AS INT) AS is_outlier,
         'Dr. ' || {title('last_name')} || ' ' || {title('first_name')} AS entity_name
  FROM zscored""",
    "entities": """
  SELECT entity_id, arg_min(entity_name, item_code) AS entity_name, arg_min(peer_group, item_code) AS peer_group,
         arg_min(place, item_code) AS place, arg_min(locality, item_code) AS locality,
         arg_min(region, item_code) AS region, CAST(sum(volume) AS BIGINT) AS total_volume,
         arg_min(volume_tier, item_code) AS volume_tier
  FROM scored GROUP BY entity_id""",
    "items": "SELECT entity_id, item_code, item_desc, services FROM scored",
    "measures": """
  SELECT entity_id, item_code, gross, net, net_per_unit, gross_net_ratio, net_z, is_outlier FROM scored""",
    "plain_segments": """
  SELECT entity_id, count(DISTINCT item_code) AS item_diversity, avg(net_z) AS avg_z FROM scored GROUP BY entity_id""",
    "merged": "SELECT * FROM entities JOIN measures USING (entity_id)",
    "features": """
  SELECT e.entity_id, m.net_per_unit, CAST(e.total_volume AS DOUBLE) AS total_volume,
         CAST(s.item_diversity AS DOUBLE) AS item_diversity, m.avg_z, m.avg_gross_net_ratio, m.avg_net
  FROM entities e LEFT JOIN (
    SELECT entity_id, avg(net_per_unit) AS net_per_unit, avg(net_z) AS avg_z,
           avg(gross_net_ratio) AS avg_gross_net_ratio, avg(net) AS avg_net
    FROM measures GROUP BY entity_id) m USING (entity_id)
  LEFT JOIN plain_segments s USING (entity_id)""",
    "imputed": "SELECT entity_id, " + ", ".join(
        f"coalesce({f}, (SELECT median({f}) FROM features)) AS {f}" for f in FEATURES) + " FROM features",
    "scaled": "SELECT entity_id, " + ", ".join(
        f"coalesce(({f} - (SELECT avg({f}) FROM imputed)) / nullif((SELECT stddev_pop({f}) FROM imputed), 0), 0) AS {f}"
        for f in FEATURES) + " FROM imputed",
    "nearest": f"""
  SELECT *, CAST({_nearest()} AS INT) AS cluster_id FROM (SELECT *,
{_distances()} FROM scaled)""",
    "raw_labels": "SELECT f.*, n.cluster_id FROM features f JOIN nearest n USING (entity_id)",
    "means": "SELECT cluster_id, " + ", ".join(f"avg({f}) AS {f}" for f in FEATURES)
             + " FROM raw_labels GROUP BY cluster_id",
    "billers": "SELECT cluster_id FROM means ORDER BY abs(avg_z) DESC, cluster_id LIMIT 1",
    "premium": """
  SELECT cluster_id FROM means WHERE cluster_id NOT IN (SELECT cluster_id FROM billers)
  ORDER BY net_per_unit DESC, cluster_id LIMIT 1""",
    "community": """
  SELECT cluster_id FROM means WHERE cluster_id NOT IN (SELECT cluster_id FROM billers)
    AND cluster_id NOT IN (SELECT cluster_id FROM premium) ORDER BY total_volume DESC, cluster_id LIMIT 1""",
    "names": """
  SELECT cluster_id, CASE WHEN cluster_id IN (SELECT cluster_id FROM billers) THEN 'Outlier Billers'
    WHEN cluster_id IN (SELECT cluster_id FROM premium) THEN 'Premium Specialists'
    WHEN cluster_id IN (SELECT cluster_id FROM community) THEN 'Community Providers'
    ELSE 'Standard Practice' END AS cluster_name FROM means""",
    "named": "SELECT * FROM raw_labels JOIN names USING (cluster_id)",
    "segments": f"""
  SELECT s.entity_id, s.item_diversity, s.avg_z, n.cluster_id, n.cluster_name, n.performance_tier
  FROM plain_segments s LEFT JOIN (
    SELECT entity_id, cluster_id, cluster_name, {perf('avg_z')} AS performance_tier FROM named) n USING (entity_id)""",
    "variation": f"""
  SELECT peer_group, count(DISTINCT entity_id) AS entity_count, {r('avg(net)', 2)} AS avg_net,
         {r('max(net)', 2)} AS max_net, {r('min(net)', 2)} AS min_net,
         {r('max(net) / nullif(min(net), 0)', 1)} AS variation_ratio, {r('avg(net_z)', 3)} AS avg_z
  FROM merged GROUP BY peer_group HAVING count(DISTINCT entity_id) > 20""",
    "geographic": f"""
  SELECT place, region, peer_group, {r('avg(net)', 2)} AS place_avg, count(DISTINCT entity_id) AS entity_count
  FROM merged GROUP BY place, region, peer_group""",
    "extreme": """
  SELECT * FROM merged WHERE is_outlier = 1 ORDER BY abs(net_z) DESC, entity_id, item_code LIMIT 100""",
    "listed": f"""
  SELECT entity_id, item_code, entity_name, peer_group, place, locality, {r('net', 2)} AS net,
         {r('net_z', 2)} AS z_score, {r('gross_net_ratio', 2)} AS gross_net_ratio, volume_tier,
         {OUTLIER_TYPE} AS outlier_type, net_z FROM extreme""",
    "all_variation": f"""
  SELECT peer_group, count(DISTINCT entity_id) AS entity_count, {r('max(net) / nullif(min(net), 0)', 1)} AS variation_ratio
  FROM merged GROUP BY peer_group""",
    "flagged": f"""
  SELECT *, {r('net_z', 2)} AS z_score, {OUTLIER_TYPE} AS outlier_type FROM merged WHERE is_outlier = 1""",
    "broken_entities": """
  SELECT * FROM entities WHERE entity_id % 10 <> 0 UNION ALL SELECT * FROM entities WHERE entity_id % 10 <> 0 AND entity_id % 7 = 0""",
    "spreads": f"""
  SELECT i.item_desc, count(DISTINCT i.entity_id) AS entities, {r('avg(m.net)', 2)} AS avg_net,
         {r('max(m.net)', 2)} AS max_net, {r('min(m.net)', 2)} AS min_net,
         {r('max(m.net) - min(m.net)', 2)} AS net_spread
  FROM items i JOIN measures m ON i.entity_id = m.entity_id AND i.item_code = m.item_code
  JOIN entities e ON e.entity_id = i.entity_id
  GROUP BY i.item_desc HAVING count(DISTINCT i.entity_id) > 10 ORDER BY net_spread DESC, item_desc LIMIT 20""",
    "dash_variation": f"""
  SELECT peer_group, count(DISTINCT entity_id) AS entity_count, {r('avg(net)', 2)} AS avg_net,
         {r('max(net) / nullif(min(net), 0)', 1)} AS variation_ratio
  FROM merged GROUP BY peer_group HAVING count(DISTINCT entity_id) > 10
  ORDER BY avg_net DESC, peer_group LIMIT 30""",
    "region_means": "SELECT region, avg(place_avg) AS mean FROM geographic GROUP BY region",
    "event_stats": """
  SELECT event_type AS peer_group, avg(value) AS peer_mean, stddev_samp(value) AS peer_sd
  FROM events GROUP BY event_type""",
    "event_scores": f"""
  SELECT event_id, user_id AS entity_id, event_type AS peer_group, ts, value AS net,
         {r('(value - peer_mean) / nullif(peer_sd, 0)', 4)} AS net_z
  FROM events JOIN event_stats ON event_type = peer_group""",
}


def statement(body: str) -> str:
    """``body`` preceded by the common tables it needs, directly or through others."""
    needed: list[str] = []
    text = body
    for name in reversed(TABLES):
        if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
            needed.insert(0, name)
            text += " " + TABLES[name]
    if not needed:
        return body.strip()
    tables = ",\n".join(f"{name} AS MATERIALIZED ({TABLES[name]})" for name in needed)
    body = body.strip()  # a body may go on with tables of its own
    return f"WITH {tables}{body}" if body.startswith(",") else f"WITH {tables}\n{body}"
