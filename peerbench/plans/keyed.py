"""The star laid out by entity: a lookup reads one bucket per table, an update rewrites the buckets it changes.

Every table is partitioned by a hash of the entity; its number of buckets follows from its rows, so that a bucket stays
one file of moderate size however large the table is. Rows are in order of entity and item with a Bloom filter of
the entities. An entity with more rows than a task should hold is split by adaptive rebalancing, and its bucket then has
several files.

The rollup is stored beside the four tables, since profiles are read from it.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerbench.operators.star import TABLES, Star
from peerbench.session import delete_path, path_exists, together

ROWS_PER_BUCKET = 500_000
_STORED = (*TABLES, "rollup")


def bucket_of(entity: Column, buckets: int) -> Column:
    """The bucket of an entity; a null one counts as an empty text."""
    return (F.crc32(F.coalesce(entity.cast("string"), F.lit(""))) % buckets).cast("int").alias("bucket")


def _write(rows: DataFrame, path: str, buckets: int, mode: str, replace: str = "static") -> None:
    order = ["bucket", "entity_id", *(["item_code"] if "item_code" in rows.columns else [])]
    placed = rows.withColumn("bucket", bucket_of(F.col("entity_id"), buckets))
    (
        placed.hint("rebalance", F.col("bucket")).sortWithinPartitions(*order)
        .write.mode(mode).partitionBy("bucket").option("partitionOverwriteMode", replace)
        .option("parquet.bloom.filter.enabled#entity_id", "true").parquet(path)
    )


def publish(star: Star, path: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> KeyedStar:
    """Write the star below ``path``, which must not hold one already."""
    spark = star.entities.sparkSession
    tables = {name: getattr(star, name) for name in _STORED}
    sizes = together(spark, *[t.count for t in tables.values()])
    buckets = {name: max(1, -(-n // rows_per_bucket)) for name, n in zip(tables, sizes)}

    def job(name: str):
        return lambda: _write(tables[name], f"{path}/{name}", buckets[name], "errorifexists")

    together(spark, *[job(name) for name in tables])
    layout = [(name, buckets[name], tables[name].schema.json()) for name in tables]
    spark.createDataFrame(layout, "name string, buckets int, columns string").coalesce(1).write.parquet(f"{path}/layout")
    return KeyedStar(spark, path)


class KeyedStar:
    """A star stored by ``publish``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        layout = spark.read.parquet(f"{path}/layout").collect()  # one row per table
        self.buckets = {r["name"]: r["buckets"] for r in layout}
        self.schemas = {r["name"]: T.StructType.fromJson(json.loads(r["columns"])) for r in layout}

    @property
    def _pending(self) -> str:
        return f"{self.path}/pending"

    def _read(self, name: str, buckets: Sequence[int] | None = None, folder: str | None = None) -> DataFrame:
        """A table with its column ``bucket``, or the given buckets of it; other folders are not even listed."""
        folder = folder or f"{self.path}/{name}"
        schema = T.StructType([*self.schemas[name].fields, T.StructField("bucket", T.IntegerType())])
        if buckets is None:
            return self.spark.read.schema(schema).parquet(folder)
        paths = [p for p in (f"{folder}/bucket={b}" for b in sorted(set(buckets))) if path_exists(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", folder).parquet(*paths)

    def _whole(self) -> None:
        if path_exists(self.spark, f"{self._pending}/_SUCCESS"):
            raise RuntimeError(f"an update of {self.path} was interrupted; call finish_update() before reading it")

    def star(self) -> Star:
        """All rows."""
        self._whole()
        tables = {name: self._read(name).drop("bucket") for name in _STORED}
        return Star(*[tables[name] for name in TABLES], shared={"rollup": tables["rollup"]})

    def of(self, *entity_ids) -> Star:
        """The rows of the given entities, from their buckets alone. For a table of ids, join it with ``star()``."""
        self._whole()
        tables = {}
        for name in _STORED:
            n = self.buckets[name]
            at = [zlib.crc32(("" if e is None else str(e)).encode()) % n for e in entity_ids]
            tables[name] = self._read(name, at).drop("bucket").where(F.col("entity_id").isin(*entity_ids))
        return Star(*[tables[name] for name in TABLES], shared={"rollup": tables["rollup"]})

    def update_segments(self, rows: DataFrame) -> list[int]:
        """Give segments the values of ``rows`` (entity_id once each, and any of the table's other columns).

        Entities that are not stored are passed by, equal rows change nothing. Buckets with a change are written anew and
        returned; the others are left alone. The new buckets are complete below ``pending`` before the first old
        one goes, so that an update that was cut off is ended by ``finish_update``.
        """
        self.finish_update()
        columns = [c for c in self.schemas["segments"].names if c != "entity_id" and c in rows.columns]
        n = self.buckets["segments"]
        new = rows.select(F.col("entity_id"), F.struct(*[
            F.col(c).cast(self.schemas["segments"][c].dataType).alias(c) for c in columns]).alias("new"))
        old = F.struct(*columns)
        changed = (
            self._read("segments").join(new, "entity_id").where(~old.eqNullSafe(F.col("new")))
            .select("bucket").distinct().collect()  # a number per bucket at most
        )
        touched = sorted(r["bucket"] for r in changed)
        if touched:
            here = self._read("segments", touched).drop("bucket")
            value = {c: F.when(F.col("new").isNull(), F.col(c)).otherwise(F.col(f"new.{c}")) for c in columns}
            mine = new.where(bucket_of(F.col("entity_id"), n).isin(touched))
            _write(here.join(mine, "entity_id", "left").withColumns(value).drop("new"), self._pending, n, "overwrite")
            self.finish_update()
        return touched

    def finish_update(self) -> None:
        """Put a complete pending update in place; without one, nothing happens."""
        if path_exists(self.spark, f"{self._pending}/_SUCCESS"):
            done = self._read("segments", folder=self._pending).drop("bucket")
            _write(done, f"{self.path}/segments", self.buckets["segments"], "overwrite", "dynamic")
        delete_path(self.spark, self._pending)
