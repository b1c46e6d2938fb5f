"""Every query with SQL equals it on the smallest tables; the others run."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from check import TABLES, compare
from peerbench.oracle import sql_by_key
from peerbench.registry import all_queries

STATEMENTS = sql_by_key()
TRAINED = ("ml_k_search", "ml_assign", "seg_update", "dq_cluster_coverage", "ml_pca", "ml_pca_centroids", "ml_importance")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMOKE_DIR}/{table}.parquet'")
    return connection


def test_every_statement_belongs_to_a_query():
    assert set(STATEMENTS) <= set(oracle_sql()) <= set(queries())
    assert set(all_queries()) - set(STATEMENTS) == set(TRAINED)


@pytest.mark.parametrize("key", sorted(STATEMENTS))
def test_query_equals_sql(spark, db, key):
    assert compare(queries()[key](spark, SMOKE_DIR).toPandas(), db.execute(STATEMENTS[key]).df()) == "ok"


def test_entry(spark):
    assert entry(spark).count() == 5
