"""Loads into a store, one after another, against one load of everything."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerbench.operators.clean import clean
from peerbench.operators.features import enrich, peer_stats, volume_edges
from peerbench.operators.star import star_tables
from peerbench.plans import etl, refresh
from peerbench.session import materialize
from peerbench.roles import Roles
from peerbench.sources.csvs import write_csv
from peerbench.sources.dims import state_regions
from tests.synthetic import synthesize


@pytest.fixture(scope="module")
def lines(spark):
    """1,500 cleaned lines; entities have several, some in different batches."""
    raw = Roles().rename(synthesize(spark, 1500)).withColumns({
        "entity_id": (F.col("entity_id").cast("long") % 200).cast("string"),
        "volume": F.when(F.rand(3) < 0.02, F.lit(5000.5)).otherwise(F.col("volume"))})
    return materialize(clean(raw), "refresh-lines")


def rounded(frame):
    return frame.select(*[F.round(f.name, 9).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in frame.schema])


def rows(frame):
    return sorted(map(tuple, rounded(frame).collect()), key=repr)


def parts(lines, number):
    return [lines.where(F.pmod(F.xxhash64("entity_id", "item_code", "net"), F.lit(number)) == k) for k in range(number)]


@pytest.fixture(scope="module")
def whole(spark, lines):
    return star_tables(enrich(lines, state_regions(spark)))


def same_star(got, want):
    for name in ("entities", "items", "measures", "segments"):
        assert rows(getattr(got, name)) == rows(getattr(want, name)), name


@pytest.mark.parametrize("number", [1, 4])
def test_batches_equal_one_load(spark, tmp_path, lines, whole, number):
    path = str(tmp_path / "store")
    for k, part in enumerate(parts(lines, number)):
        assert refresh.load_batch(spark, path, part, state_regions(spark), f"file {k}")
    store = refresh.Store(spark, path)
    same_star(store.star(), whole)
    assert rows(store.peer_stats().select("peer_group", "peer_mean", "peer_sd", "peer_p75")) == rows(
        peer_stats(lines).select("peer_group", "peer_mean", "peer_sd", "peer_p75"))
    assert rows(store.edges) == rows(volume_edges(lines).select(*store.edges.columns))


def test_a_second_load_reads_nothing_of_the_first(spark, tmp_path, lines, whole):
    path = str(tmp_path / "store")
    first, second = parts(lines, 2)
    refresh.load_batch(spark, path, first, state_regions(spark), "first")
    hidden = {}
    for table in ("lines", *refresh.STATES):  # whoever opened one of these would fail
        (batch,) = os.listdir(f"{path}/{table}")
        hidden[f"{path}/{table}/{batch}"] = f"{tmp_path}/{table}-{batch}"
    for place, away in hidden.items():
        os.rename(place, away)
    refresh.load_batch(spark, path, second, state_regions(spark), "second")
    for place, away in hidden.items():
        os.rename(away, place)
    same_star(refresh.Store(spark, path).star(), whole)


def test_only_touched_entities_are_written(spark, tmp_path, lines):
    path = str(tmp_path / "store")
    refresh.load_batch(spark, path, lines, state_regions(spark), "all")
    (old,) = os.listdir(f"{path}/entities")
    refresh.load_batch(spark, path, lines.where("entity_id in ('3', '5')"), state_regions(spark), "two")
    (new,) = set(os.listdir(f"{path}/entities")) - {old}
    assert {r["entity_id"] for r in spark.read.parquet(f"{path}/entities/{new}").collect()} == {"3", "5"}


def test_a_name_counts_once_and_a_broken_load_not_at_all(spark, tmp_path, lines, whole, monkeypatch):
    path = str(tmp_path / "store")
    first, second = parts(lines, 2)
    assert refresh.load_batch(spark, path, first, state_regions(spark), "first")
    assert not refresh.load_batch(spark, path, first, state_regions(spark), "first")
    with monkeypatch.context() as broken:
        broken.setattr(refresh, "_announce", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            refresh.load_batch(spark, path, second, state_regions(spark), "second")
    assert refresh.Store(spark, path).lines.count() == first.count()
    assert refresh.load_batch(spark, path, second, state_regions(spark), "second")
    # two loads of one name that ran at once
    refresh._announce(spark, path, "zzzz", "second", [])
    same_star(refresh.Store(spark, path).star(), whole)


def test_merged_states(spark, tmp_path, lines, whole):
    path = str(tmp_path / "store")
    first, second, third = parts(lines, 3)
    for name, part in (("a", first), ("b", second)):
        refresh.load_batch(spark, path, part, state_regions(spark), name)
    refresh.compact(spark, path)
    assert len(refresh.Store(spark, path)._state_batches) == 1
    refresh.load_batch(spark, path, third, state_regions(spark), "c")
    store = refresh.Store(spark, path)
    assert len(store._state_batches) == 2 and len(store.loaded) == 3
    same_star(store.star(), whole)
    refresh.compact(spark, path)
    assert len(refresh.Store(spark, path)._state_batches) == 1
    same_star(refresh.Store(spark, path).star(), whole)


def test_raw_files_one_by_one(spark, tmp_path):
    raw = synthesize(spark, 400)
    write_csv(raw, f"{tmp_path}/whole")
    star, _ = etl.load_raw(spark, f"{tmp_path}/whole", f"{tmp_path}/star")
    half = F.col("npi").cast("long") % 2
    for k in range(2):
        write_csv(raw.where(half == k), f"{tmp_path}/part{k}")
        assert etl.add_raw(spark, f"{tmp_path}/part{k}", f"{tmp_path}/store")
    assert not etl.add_raw(spark, f"{tmp_path}/part0", f"{tmp_path}/store")
    same_star(refresh.Store(spark, f"{tmp_path}/store").star(), star)


def test_an_empty_store_and_empty_batches(spark, tmp_path, lines, whole):
    path = str(tmp_path / "store")
    with pytest.raises(ValueError, match="nothing has been loaded"):
        refresh.Store(spark, path).lines
    refresh.load_batch(spark, path, lines.limit(0), state_regions(spark), "empty")
    empty = refresh.Store(spark, path).star()
    assert [getattr(empty, t).count() for t in ("entities", "items", "measures", "segments")] == [0] * 4
    refresh.load_batch(spark, path, lines, state_regions(spark), "full")
    same_star(refresh.Store(spark, path).star(), whole)
