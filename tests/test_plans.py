"""Plans that should stay as they are."""

from __future__ import annotations

import re

from __spark_entry__ import SMOKE_DIR
from peerbench.session import setting
from peerbench.sources.tables import service_lines


def test_lines_are_exchanged_once_by_order(spark):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", -1), setting(spark, "spark.sql.adaptive.enabled", "false"):
        plan = service_lines(spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    exchanges = [re.sub(r"#\d+L?", "", e) for e in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)]
    # entity_id counts twice: lines and people
    fact = [e for e in exchanges if e in ("l_partkey", "l_orderkey", "o_custkey, p_type", "entity_id") or "l_orderkey" in e]
    assert sorted(fact) == ["entity_id", "entity_id", "l_orderkey", "l_partkey", "o_custkey, p_type"]


def test_lines_are_read_with_their_columns_only(spark):
    plan = service_lines(spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_comment" not in plan
