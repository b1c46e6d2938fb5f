"""The star by entity: lookups open single files, updates write single buckets."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from peerbench.operators.clean import clean
from peerbench.operators.features import enrich
from peerbench.operators.star import TABLES, Star, read_star, star_tables, write_star
from peerbench.plans import keyed, profiles
from peerbench.roles import Roles
from peerbench.session import setting
from peerbench.sources.dims import state_regions
from tests.synthetic import synthesize


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    raw = Roles().rename(synthesize(spark, 3000)).withColumn("entity_id", (F.col("entity_id").cast("long") % 400).cast("string"))
    made = star_tables(enrich(clean(raw), state_regions(spark)))
    return read_star(spark, write_star(made, str(tmp_path_factory.mktemp("keyed") / "star")))


@pytest.fixture()
def store(star, tmp_path):
    return keyed.publish(star, str(tmp_path / "store"), rows_per_bucket=50)


def written(store):
    """Inode and time of every segments file."""
    out = {}
    for folder, _, files in os.walk(f"{store.path}/segments"):
        for f in files:
            if f.endswith(".parquet"):
                out.setdefault(os.path.basename(folder), set()).add((f, os.stat(f"{folder}/{f}").st_ino))
    return out


def test_holds_the_star_in_files_of_one_bucket(store, star):
    for name in TABLES:
        assert same(getattr(store.star(), name), getattr(star, name)), name
    assert store.buckets["entities"] == -(-star.entities.count() // 50) and store.buckets["measures"] > store.buckets["entities"]
    for name in TABLES:
        files = store._read(name).inputFiles()
        assert len(files) == len(set(map(os.path.dirname, files))) <= store.buckets[name]


def test_a_lookup_opens_one_file_per_table(store, star):
    ids = [r["entity_id"] for r in star.entities.orderBy("entity_id").limit(5).collect()]
    for one in ids:
        found = store.of(one)
        assert all(len(getattr(found, name).inputFiles()) == 1 for name in (*TABLES, "rollup"))
        assert same(profiles.entity_profile(found, one), profiles.entity_profile(star, one))
        assert same(profiles.entity_lookup(found, one), profiles.entity_lookup(star, one))
    assert same(store.of(*ids).measures, star.measures.where(F.col("entity_id").isin(ids)))
    scan = store.of(ids[0]).entities
    scan.collect()
    assert f"EqualTo(entity_id,{ids[0]})" in scan._jdf.queryExecution().executedPlan().toString()
    assert profiles.entity_profile(store.of("nobody"), "nobody").isEmpty() and store.of("").items.isEmpty()


def test_an_update_of_one_entity_writes_one_bucket(spark, store, star):
    one = star.segments.orderBy("entity_id").first()["entity_id"]
    before = written(store)
    row = spark.createDataFrame([(one, 3, "Group"), ("stranger", 1, "None")], "entity_id string, cluster_id int, cluster_name string")
    touched = store.update_segments(row)
    after = written(store)
    assert [k for k in before if before[k] != after[k]] == [f"bucket={b}" for b in touched] and len(touched) == 1
    want = star.segments.withColumns({
        "cluster_id": F.when(F.col("entity_id") == one, 3).otherwise(F.col("cluster_id")),
        "cluster_name": F.when(F.col("entity_id") == one, "Group").otherwise(F.col("cluster_name"))})
    assert same(store.star().segments, want)
    assert store.update_segments(row) == [] and written(store) == after
    # a value may become null again
    store.update_segments(row.select("entity_id", F.lit(None).cast("int").alias("cluster_id"), F.lit(None).cast("string").alias("cluster_name")))
    assert same(store.star().segments, star.segments)


def test_an_interrupted_update_is_ended(spark, store, star):
    one = star.segments.orderBy("entity_id").first()["entity_id"]
    bucket = store._read("segments").where(F.col("entity_id") == one).first()["bucket"]
    new = store._read("segments", [bucket]).drop("bucket").withColumn("cluster_id", F.lit(7))
    keyed._write(new, store._pending, store.buckets["segments"], "overwrite")
    with pytest.raises(RuntimeError):
        store.of(one)
    again = keyed.KeyedStar(spark, store.path)
    again.finish_update()
    assert again.of(one).segments.first()["cluster_id"] == 7 and again.star().segments.count() == star.segments.count()
    again.finish_update()


def test_a_hot_entity_is_split(spark, star, tmp_path):
    wide = star.items.limit(1).select("entity_id").crossJoin(spark.range(40_000)).select(
        "entity_id", F.sha2(F.col("id").cast("string"), 256).alias("item_code"), F.sha2(F.col("id").cast("string"), 224).alias("item_desc"), F.lit(1.0).alias("services"))
    hot = Star(star.entities, star.items.unionByName(wide.repartition(8)), star.measures, star.segments)
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k"):
        store = keyed.publish(hot, str(tmp_path / "hot"), rows_per_bucket=100_000)
    assert len(store._read("items").inputFiles()) > 1 and same(store.star().items, hot.items)


def test_empty_star(spark, star, tmp_path):
    empty = Star(*[getattr(star, name).limit(0) for name in TABLES])
    store = keyed.publish(empty, str(tmp_path / "empty"))
    assert store.star().items.isEmpty() and store.of("1").entities.isEmpty()
    assert store.update_segments(spark.createDataFrame([("1", 1)], "entity_id string, cluster_id int")) == []
