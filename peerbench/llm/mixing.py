"""Mixing of sources to target weights by Sainte-Lague apportionment of equal-token blocks.

The mix has 1.5 times the words of the corpus. Sources in code point order (null last) weigh 5, 2, 1, repeating;
a target stops at twice the source's size and the excess is shared again by weight. Since every stop is
reached at the fill level of its source, the final level is the largest of the levels in order of the stops.

Blocks of ``block`` words go to the highest quotients target / (2 k + 1). Only the few seats that the rounding
can touch are ranked; those below are certain. The blocks of a source go to its shards by the same rule, so
each shard has an integer quota. A shard's documents stand in a seeded order; its quota is the first so many
blocks of that word stream, which starts again when it ends. No document is used more than twice.

A source with a third of all rows is spread over shards of some 65,000 words (100,000 shards a source at most),
and all that is ranked or summed over a source was aggregated to one row per source or shard first.

Defined results: a null text has size 0; a null source is a source of its own; without words all targets are 0;
repeated rows are documents of their own, ordered by size and text where their ids tie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peerbench.llm.frames import stored, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
BLOCK = 64
SHARD_WORDS = 65_536
MAX_SHARDS = 100_000
SEED = "mix-1"
#: Tables of so many sources or fewer are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 100_000


def word_count(text: Column) -> Column:
    """Runs of characters that are not ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _key(seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def source_targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target) of a table (source, size)."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("long"))
    everything, before = W.partitionBy(), W.orderBy("fill", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumn("fill", F.col("source_size").cast("double") * LIMIT / F.col("weight"))
    stopped, passed = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * LIMIT, F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (F.sum("source_size").over(everything) * F.lit(SHARE) - stopped) / (F.sum("weight").over(everything) - passed)
    per = per.withColumn("level", level)
    reached = F.max("level").over(everything)
    target = F.least(F.col("source_size").cast("double") * LIMIT, F.col("weight") * reached)
    return per.select("source", "source_size", target.alias("target"))


def apportion(parties: DataFrame, within: Sequence[str], name: Sequence[str], votes: str, seats: Column) -> DataFrame:
    """Adds ``seats`` by Sainte-Lague to ``parties``, in each group ``within``; ties go to the smaller ``name``, null last.

    With n parties and s seats, each party's seats differ from its share of s by at most its share of n / 2, plus 1.
    """
    group = W.partitionBy(*within)
    total, count = F.sum(votes).over(group), F.count(F.lit(1)).over(group)
    parts = parties.withColumn("all_seats", seats.cast("long")).withColumn("part", F.when(total > 0, F.col(votes) / total).otherwise(0.0)).withColumn("slack", F.col("part") * count / 2)
    low = F.greatest(F.lit(0), F.floor(F.col("part") * F.col("all_seats") - F.col("slack")) - 1).cast("long")
    high = (F.ceil(F.col("part") * F.col("all_seats") + F.col("slack")) + 1).cast("long")
    parts = parts.withColumn("sure", F.when(F.col("part") > 0, low).otherwise(F.lit(0).cast("long"))).withColumn("top", high)
    parts = parts.withColumn("open", F.col("all_seats") - F.sum("sure").over(group))
    asked = parts.where("part > 0").select("*", F.explode(F.sequence("sure", "top")).alias("k"))
    order = W.partitionBy(*within).orderBy((F.col(votes) / (2 * F.col("k") + 1)).desc(), *[F.col(c).asc_nulls_last() for c in name], "k")
    won = asked.withColumn("place", F.row_number().over(order)).where("place <= open").groupBy(*within, *name).agg(F.count(F.lit(1)).alias("more"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"w.{c}")) for c in (*within, *name)]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    return parts.alias("p").join(won.alias("w"), condition, "left").select(
        *[F.col(f"p.{c}").alias(c) for c in parties.columns], (F.col("p.sure") + F.coalesce("w.more", F.lit(0))).alias("seats")
    )


def _by_source(rows: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    named = sources.withColumnRenamed("source", "its_source")
    return rows.join(F.broadcast(named) if few else named, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")


def mix_sources(docs: DataFrame, keep: Sequence[str] = ("doc_id",), seed: str = SEED, block: int = BLOCK, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per document row: ``doc`` (the columns named in ``keep``), size, source_size, target (of its source), taken."""
    own = [F.col("source"), word_count(F.col("text")).alias("size"), _key(seed).alias("key")]
    sized = stored(docs.select(*own), "sizes")
    sources = source_targets(sized)
    blocks = F.round(F.sum("target").over(W.partitionBy()) / block)
    sources = apportion(sources, (), ("source",), "target", blocks).withColumnRenamed("seats", "blocks")
    sources = sources.withColumn("shards", F.least(F.lit(MAX_SHARDS), F.ceil((F.col("source_size") + 1) / shard_words)).cast("long"))
    sources = stored(sources, "sources")
    few = sources.count() <= BROADCAST_ROWS
    shard = F.conv(F.substring("key", 1, 12), 16, 10).cast("long") % F.col("shards")
    per_shard = _by_source(sized, sources, few).withColumn("shard", shard).groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.max("blocks").alias("blocks"))
    quotas = apportion(per_shard, ("source",), ("shard",), "shard_size", F.col("blocks"))
    quotas = stored(quotas.select(F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "shard_size", "seats"), "quotas")

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), *own, F.xxhash64("text").alias("tie"))
    rows = _by_source(rows, sources, few).withColumn("shard", shard)
    before = F.sum("size").over(W.partitionBy("source", "shard").orderBy("key", "size", "tie").rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    rows = rows.withColumn("before", before)
    rows = rows.join(quotas, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard")))
    quota = F.least(F.col("seats") * block, F.col("shard_size") * LIMIT)
    rounds = F.when(F.col("shard_size") > 0, F.floor(quota / F.col("shard_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.greatest(F.lit(0), F.least(F.col("size"), quota - rounds * F.col("shard_size") - F.col("before")))
    return rows.select("doc", "size", "source_size", "target", (rounds * F.col("size") + rest).cast("long").alias("taken"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mix_sources(table(spark, sf_dir, "documents")).select("doc.doc_id", "size", "source_size", "target", "taken")


def _seats_sql(parties: str, within: str, name: str, votes: str) -> str:
    part_by = f"partition by {within}" if within else ""
    keys = ", ".join(x for x in (within, name) if x)
    same = " and ".join(f"p.{c} is not distinct from w.{c}" for c in (within, name) if c)
    return f"""
  select p.*, sure + coalesce(more, 0) as seats from ({parties}) p left join (
    select {keys}, count(*) as more from (
      select {keys}, open, row_number() over ({part_by} order by {votes} / (2 * k + 1) desc, {name} asc nulls last, k) as place
      from (select *, unnest(range(sure, top + 1)) as k from ({parties}) where part > 0)
    ) where place <= open group by {keys}
  ) w on {same}"""


def _parts_sql(rows: str, within: str, votes: str, seats: str) -> str:
    over = f"over (partition by {within})" if within else "over ()"
    return f"""
  select *, all_seats - sum(sure) {over} as open from (
    select *, case when part > 0 then cast(greatest(0, floor(part * all_seats - slack) - 1) as bigint) else 0 end as sure, cast(ceil(part * all_seats + slack) + 1 as bigint) as top from (
      select *, part * n / 2 as slack from (
        select *, cast({seats} as bigint) as all_seats, case when sum({votes}) {over} > 0 then {votes} / sum({votes}) {over} else 0.0 end as part, count(*) {over} as n from {rows})))"""


SQL = rf"""
with sized as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size, md5('{SEED}/' || coalesce(cast(doc_id as varchar), '')) as key from documents
), per as (
  select source, sum(size)::bigint as source_size, case (row_number() over (order by source asc nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight from sized group by source
), filled as (
  select *, source_size::double * 2 / weight as fill from per
), levels as (
  select *, (sum(source_size) over () * 1.5::double - 2 * coalesce(sum(source_size) over b, 0)) / (sum(weight) over () - coalesce(sum(weight) over b, 0)) as level
  from filled window b as (order by fill, source asc nulls last rows between unbounded preceding and 1 preceding)
), targets as (
  select source, source_size, least(source_size::double * 2, weight * max(level) over ()) as target from levels
), with_seats as ({_seats_sql(_parts_sql("targets", "", "target", f"round(sum(target) over () / {BLOCK})"), "", "source", "target")}
), sources as (
  select source, source_size, target, seats as blocks, least({MAX_SHARDS}, ceil((source_size + 1) / {SHARD_WORDS}))::bigint as shards from with_seats
), placed as (
  select d.*, source_size, target, blocks, cast('0x' || substr(key, 1, 12) as bigint) % shards as shard from sized d join sources s on d.source is not distinct from s.source
), per_shard as (
  select source, shard, sum(size)::bigint as shard_size, max(blocks) as blocks from placed group by all
), quotas as ({_seats_sql(_parts_sql("per_shard", "source", "shard_size::double", "blocks"), "source", "shard", "shard_size::double")}
), streamed as (
  select *, sum(size) over (partition by source, shard order by key, size rows between unbounded preceding and current row) - size as before from placed
), ready as (
  select s.*, shard_size, least(seats * {BLOCK}, shard_size * 2) as quota, case when shard_size > 0 then least(seats * {BLOCK}, shard_size * 2) // shard_size else 0 end as rounds
  from streamed s join quotas q on s.source is not distinct from q.source and s.shard = q.shard
)
select doc_id, size, source_size, target, cast(rounds * size + greatest(0, least(size, quota - rounds * shard_size - before)) as bigint) as taken from ready
"""
