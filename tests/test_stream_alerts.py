"""Streams that span versions of the statistics, late rows and files that come again."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from peerbench.streaming import alerts, jobs

STATS = "peer_group string, peer_mean double, peer_sd double, peer_p75 double"


def write(spark, folder, name, rows):
    """Rows (event_id, time, value) as one file."""
    full = [(i, at, 1, "x", float(v), "") for i, at, v in rows]
    spark.createDataFrame(full, jobs.EVENT_SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def stats(spark, path, mean):
    return alerts.publish_version(spark.createDataFrame([("x", float(mean), 1.0, 0.0)], STATS), path)


@pytest.fixture
def places(tmp_path):
    return {n: str(tmp_path / n) for n in ("in", "stats", "out", "cp")}


def test_each_batch_is_scored_with_the_version_it_records(spark, places, monkeypatch):
    def run():
        found = alerts.run_scores(jobs.event_stream(spark, f"{places['in']}/*", 1), places["stats"], places["out"], places["cp"])
        return {r["event_id"]: (r["net_z"], r["version"]) for r in found.collect()}

    write(spark, places["in"], "a", [(1, datetime(2024, 1, 1), 5)])
    with pytest.raises(Exception, match="no statistics"):
        run()
    assert stats(spark, places["stats"], 5) == 1
    assert run() == {1: (0.0, 1)}
    write(spark, places["in"], "b", [(2, datetime(2024, 1, 2), 5)])
    assert stats(spark, places["stats"], 2) == 2
    assert run() == {1: (0.0, 1), 2: (3.0, 2)}

    # a new version is published while one call reads two files: the second file gets it
    write(spark, places["in"], "c", [(3, datetime(2024, 1, 3), 5)])
    write(spark, places["in"], "d", [(4, datetime(2024, 1, 4), 5)])
    chosen, calls = alerts._chosen, []

    def publishing(*args):
        version = chosen(*args)
        if not calls:
            stats(spark, places["stats"], 1)
        calls.append(version)
        return version

    monkeypatch.setattr(alerts, "_chosen", publishing)
    got = run()
    assert calls == [2, 3] and sorted(got[i][1] for i in (3, 4)) == [2, 3]
    assert all(z == {2: 3.0, 3: 4.0}[v] for i, (z, v) in got.items() if i > 2)


def test_a_batch_that_runs_again_keeps_its_version(spark, places, monkeypatch):
    stats(spark, places["stats"], 5)
    write(spark, places["in"], "a", [(1, datetime(2024, 1, 1), 5)])
    real = alerts.score
    monkeypatch.setattr(alerts, "score", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    run = lambda: alerts.run_scores(jobs.event_stream(spark, f"{places['in']}/*"), places["stats"], places["out"], places["cp"])
    with pytest.raises(Exception, match="lost"):
        run()
    stats(spark, places["stats"], 0)
    monkeypatch.setattr(alerts, "score", real)
    assert [(r["net_z"], r["version"]) for r in run().collect()] == [(0.0, 1)]


def test_one_alert_with_late_and_repeated_files(spark, places):
    stats(spark, places["stats"], 0)
    outliers = lambda first, n, day: [(first + i, datetime(2024, 1, day, 10, 0, i), 9) for i in range(n)]

    def run():
        own = jobs.own_session(spark)
        found = alerts.run_daily(jobs.event_stream(own, f"{places['in']}/*"), places["stats"], places["out"], places["cp"], "2 days", 5)
        windows = {r["starts"].day: (r["row_count"], r["outlier_count"], r["fires"]) for r in found["windows"].collect()}
        alerted = sorted((r["starts"].day, r["outlier_count"]) for r in found["alerts"].collect())
        return windows, alerted, sorted(r["event_id"] for r in found["late"].collect())

    write(spark, places["in"], "a", [*outliers(0, 4, 1), (50, datetime(2024, 1, 1, 12), 1)])
    assert run() == ({1: (5, 4, 0)}, [], [])
    write(spark, places["in"], "b", outliers(10, 3, 1))
    assert run() == ({1: (8, 7, 1)}, [(1, 7)], [])
    write(spark, places["in"], "b-again", outliers(10, 3, 1))  # the same file once more
    write(spark, places["in"], "c", [*outliers(20, 1, 1), *outliers(20, 1, 1)])  # a row twice
    assert run() == ({1: (9, 8, 1)}, [(1, 7)], [])  # still one alert
    write(spark, places["in"], "d", outliers(30, 6, 20))
    assert run() == ({1: (9, 8, 1), 20: (6, 6, 1)}, [(1, 7), (20, 6)], [])
    write(spark, places["in"], "e", [*outliers(40, 2, 1), *outliers(42, 1, 19)])  # two rows beyond the two days
    want = ({1: (9, 8, 1), 19: (1, 1, 0), 20: (6, 6, 1)}, [(1, 7), (20, 6)], [40, 41])
    assert run() == want
    assert run() == want  # nothing new


def test_null_times_and_no_files(spark, places):
    stats(spark, places["stats"], 0)
    write(spark, places["in"], "a", [(1, None, 9), (2, datetime(2024, 1, 1, 10), 9)])
    found = alerts.run_daily(jobs.event_stream(jobs.own_session(spark), f"{places['in']}/*"), places["stats"], places["out"], places["cp"])
    assert [r["row_count"] for r in found["windows"].where(F.col("starts").isNotNull()).collect()] == [1]
    assert found["late"].count() == 0 and found["alerts"].count() == 0
