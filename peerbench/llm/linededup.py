"""Removal of multi-line passages that repeat anywhere in the corpus: whole passages, or content-defined chunks.

:func:`dedup_passages` finds every one. Two successive lines that are not blank, with the blank ones between them, are
a pair; a passage of two lines or more is a run of pairs, so it repeats exactly where each of its pairs does. A pair
whose bytes stand at an earlier place by (doc_id, text key, place) is removed with both its lines, unless it overlaps
that place. Of every line the first occurrence stays: a pair it stands in cannot occur earlier. Where two repeated
passages overlap in a document, what stays of the second may be its end only; the rest stands where the first came from.

:func:`dedup_lines` is the form that its SQL defines and **keeps most short passages**: it cuts a text into chunks
and compares those. A line ends a chunk where a rolling hash over its own hash and that of the line
before it is divisible by ``divisor``: the boundary depends on nearby content only, so a passage that moves
within its document, or to another one, is cut at the same places again. Chunks of two or more lines that are
not blank are compared over the whole corpus; of equal ones the first by (doc_id, text key, place) stays.

:func:`dedup_grown`, which the pipeline uses, removes the repeated chunks and then, line by line, what of a repeated
passage their boundaries leave: the pairs of successive lines that repeat. Both are found in the whole texts, and of every
line the first occurrence stays.

Everything is DataFrame functions. Hashes only select candidates: chunk text travels for hashes that occur
more than once, and a chunk is removed only after its bytes are found equal. A chunk that a third of all
documents share is pre-aggregated before each shuffle and its occurrences meet it in a join that adaptive
execution may split.

Defined results: a null text stays null, an empty one empty; rows that share doc_id and text are one document
and keep the same lines; a null doc_id comes first in the order; further columns are untouched; documents that
lose all their lines keep an empty text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.llm.frames import stored, table, text_key

#: Of the places after a line, one in so many is a boundary.
DIVISOR = 3
_PRIME = 1_000_003
#: Bits of the fixed-size filter that keeps chunk text with a unique hash from being shuffled.
_FILTER_BITS = 23
#: The same for pairs of lines, of which there are more.
_PAIR_FILTER_BITS = 26
#: White space as in the word classes of ``tokens``.
_NOT_BLANK = r"[^\x20\x09-\x0D]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("long") % _PRIME


def chunks(text: Column, divisor: int = DIVISOR) -> Column:
    """Array of (chunk, lo, n_lines, n_solid) in order; ``lo`` is the index of its first line, ``n_solid`` counts the lines that are not blank."""

    def pieces(lines: Column, starts: Column) -> Column:
        def piece(start: Column, k: Column) -> Column:
            own = F.slice(lines, start, F.coalesce(F.get(starts, k + 1), F.size(lines) + 1) - start)
            return let(own, lambda x: F.struct(
                F.array_join(x, "\n").alias("chunk"), (start - 1).alias("lo"), F.size(x).alias("n_lines"),
                F.size(F.filter(x, lambda line: F.trim(line) != "")).alias("n_solid"),
            ))

        return F.transform(starts, piece)

    def starts(lines: Column, hashes: Column) -> Column:
        after = lambda i: (i == 1) | ((i > 2) & ((F.get(hashes, i - 3) * 31 + F.get(hashes, i - 2)) % _PRIME % divisor == 0))
        return F.filter(F.sequence(F.lit(1), F.size(lines)), after)

    return let(
        F.split(text, "\n", -1),
        lambda lines: let(F.transform(lines, _line_hash), lambda hashes: let(starts(lines, hashes), lambda s: pieces(lines, s))),
    )


def _occurrences(docs: DataFrame, divisor: int) -> DataFrame:
    """(doc_id, tk, place, lo, hi, chunk, h) of every chunk with at least two lines that are not blank."""
    cut = docs.where("text is not null").select("doc_id", text_key().alias("tk"), F.posexplode(chunks(F.col("text"), divisor)).alias("place", "c"))
    return cut.where("c.n_solid >= 2").select(
        "doc_id", "tk", "place", "c.lo", F.expr("c.lo + c.n_lines - 1 as hi"), F.col("c.chunk").alias("chunk"), F.xxhash64("c.chunk").alias("h"))


def _slot(hashed: str, bits: int) -> tuple[Column, Column]:
    slot = F.shiftrightunsigned(F.col(hashed), 64 - bits)
    return F.shiftright(slot, 6), F.expr(f"shiftleft(1L, cast(shiftrightunsigned({hashed}, {64 - bits}) & 63 as int))")


def _repeated(seen: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``seen`` whose hash may repeat, and (h, same, first) of each chunk that does."""
    at, bit = _slot("h", bits)
    twice = seen.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # one row per 64 slots, 2 ** (bits - 6) rows at most whatever the corpus
    bitmap = stored(twice.select(at.alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("set")), "bitmap")
    maybe = seen.withColumn("at", at).withColumn("bit", bit).join(F.broadcast(bitmap), "at").where("set & bit <> 0").select(*seen.columns)
    first = maybe.groupBy("h", "chunk").agg(F.min(F.struct("doc_id", "tk", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
    # stored, so that the join reads plain exchanges, which adaptive execution may split
    return maybe, stored(first.where("n > 1").select("h", F.col("chunk").alias("same"), "first"), "chunks")


def _gone_chunks(docs: DataFrame, divisor: int) -> DataFrame:
    """(doc_id, tk, place, lo, hi) of every chunk whose bytes stand at an earlier place."""
    maybe, first = _repeated(_occurrences(docs, divisor), _FILTER_BITS)
    gone = maybe.join(first, "h").where((F.col("chunk") == F.col("same")) & ~F.struct("doc_id", "tk", "place").eqNullSafe(F.col("first")))
    return gone.select("doc_id", "tk", "place", "lo", "hi")


def repeated_chunks(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """(doc_id, tk, removed): the places of the chunks to remove, per document that has any."""
    return _gone_chunks(docs, divisor).groupBy("doc_id", "tk").agg(F.collect_set("place").alias("removed"))


def dedup_lines(docs: DataFrame, keep: Sequence[str] = ("doc_id",), divisor: int = DIVISOR) -> DataFrame:
    """Per document row: ``doc`` (the columns named in ``keep``), text (what is left), n_lines, n_removed, n_chunks, n_chunks_removed."""
    gone = repeated_chunks(docs, divisor)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.col("doc_id").alias("id"), F.col("text").alias("whole"), text_key().alias("key"))
    joined = whole.join(gone, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("tk")), "left")
    cut = joined.select("doc", "whole", "removed", F.when(F.col("removed").isNotNull(), chunks(F.col("whole"), divisor)).alias("cut"))
    left = let(
        F.array_except(F.transform(F.col("cut"), lambda _, i: i), F.col("removed")),
        lambda places: F.array_join(F.transform(places, lambda i: F.get(F.col("cut"), i)["chunk"]), "\n"),
    )
    dropped = F.aggregate("removed", F.lit(0), lambda n, i: n + F.get(F.col("cut"), i)["n_lines"])
    return cut.select(
        "doc",
        F.when(F.col("removed").isNull(), F.col("whole")).otherwise(left).alias("text"),
        F.coalesce(F.size(F.split("whole", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(dropped, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_chunks_removed"),
    )


def pairs(text: Column) -> Column:
    """Array of (lo, hi, chunk) in order: successive lines that are not blank, by index, and the text from one to the other."""

    def between(lines: Column, solid: Column) -> Column:
        def pair(lo: Column, k: Column) -> Column:
            hi = F.get(solid, k + 1)
            return F.struct(lo.alias("lo"), hi.alias("hi"), F.array_join(F.slice(lines, lo + 1, hi - lo + 1), "\n").alias("chunk"))

        return F.transform(F.slice(solid, F.lit(1), F.greatest(F.size(solid) - 1, F.lit(0))), pair)

    def solid(lines: Column) -> Column:
        return F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(_NOT_BLANK), i)), lambda i: i.isNotNull())

    return let(F.split(text, "\n", -1), lambda lines: let(solid(lines), lambda s: between(lines, s)))


def _gone_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, tk, lo, hi) of every pair of lines whose bytes stand at an earlier place that it does not overlap."""
    cut = docs.where("text is not null").select("doc_id", text_key().alias("tk"), F.posexplode(pairs(F.col("text"))).alias("place", "c"))
    seen = cut.select("doc_id", "tk", "place", "c.lo", "c.hi", "c.chunk", F.xxhash64("c.chunk").alias("h"))
    maybe, first = _repeated(seen, _PAIR_FILTER_BITS)
    here = F.struct("doc_id", "tk").eqNullSafe(F.struct("first.doc_id", "first.tk"))
    # a pair that overlaps its first occurrence, as in three equal lines, is no second passage
    gone = maybe.join(first, "h").where((F.col("chunk") == F.col("same")) & ~(here & (F.col("place") < F.col("first.place") + 2)))
    return gone.select("doc_id", "tk", "lo", "hi")


def _lines(ranges: DataFrame) -> DataFrame:
    """(doc_id, tk, removed): the indexes of the lines in the ranges, per document that has any."""
    return ranges.groupBy("doc_id", "tk").agg(F.array_distinct(F.flatten(F.collect_set(F.sequence("lo", "hi")))).alias("removed"))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, tk, removed): the indexes of the lines to remove, per document that has any."""
    return _lines(_gone_pairs(docs))


def grown_lines(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """(doc_id, tk, removed): the lines of repeated chunks and of the repeated pairs around and between them."""
    return _lines(_gone_chunks(docs, divisor).select("doc_id", "tk", "lo", "hi").union(_gone_pairs(docs)))


def dedup_passages(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per document row: ``doc`` (the columns named in ``keep``), text (what is left), n_lines, n_removed."""
    return _without(docs, repeated_lines(docs), keep)


def dedup_grown(docs: DataFrame, keep: Sequence[str] = ("doc_id",), divisor: int = DIVISOR) -> DataFrame:
    """The columns of :func:`dedup_passages`, without the lines of :func:`grown_lines`."""
    return _without(docs, grown_lines(docs, divisor), keep)


def _without(docs: DataFrame, gone: DataFrame, keep: Sequence[str]) -> DataFrame:
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.col("doc_id").alias("id"), F.col("text").alias("whole"), text_key().alias("key"))
    joined = whole.join(gone, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("tk")), "left")
    left = let(F.split("whole", "\n", -1), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed")), lambda i: F.get(lines, i)), "\n"))
    return joined.select(
        "doc",
        F.when(F.col("removed").isNull(), F.col("whole")).otherwise(left).alias("text"),
        F.coalesce(F.size(F.split("whole", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
    )


def op2_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated passages of two lines or more."""
    left = dedup_passages(table(spark, sf_dir, "documents"))
    return left.select("doc.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated multi-line chunks."""
    left = dedup_lines(table(spark, sf_dir, "documents"))
    return left.select("doc.doc_id", "n_lines", "n_removed", "n_chunks_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = f"""
with split as (
  select doc_id, text, string_split(text, chr(10)) as lines from documents where text is not null
), hashed as (
  select doc_id, text, lines, list_transform(lines, lambda x: cast('0x' || substr(md5(x), 1, 15) as bigint) % {_PRIME}) as h from split
), starts as (
  select *, list_filter(range(1, len(lines) + 1), lambda i: i = 1 or (i > 2 and (h[i - 2] * 31 + h[i - 1]) % {_PRIME} % {DIVISOR} = 0)) as s from hashed
), cut as (
  select doc_id, text, unnest(range(1, len(s) + 1)) as place, unnest(list_transform(range(1, len(s) + 1),
    lambda k: list_slice(lines, s[k], coalesce(s[k + 1], len(lines) + 1) - 1))) as own from starts
), chunk as (
  select doc_id, text, place, array_to_string(own, chr(10)) as chunk, len(own) as n_lines, len(list_filter(own, lambda x: trim(x) <> '')) >= 2 as multi from cut
), judged as (
  select *, multi and row_number() over (partition by multi, chunk order by doc_id, place) > 1 as gone from chunk
), done as (
  select doc_id, sum(n_lines) as n_lines, coalesce(sum(n_lines) filter (gone), 0) as n_removed, count(*) filter (gone) as n_chunks_removed,
    coalesce(string_agg(chunk, chr(10) order by place) filter (not gone), '') as kept from judged group by 1
)
select d.doc_id, cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  cast(coalesce(n_chunks_removed, 0) as bigint) as n_chunks_removed, sha256(coalesce(kept, '')) as kept_sha256
from documents d left join done using (doc_id)
"""

PASSAGE_SQL = r"""
with split as (
  select doc_id, text, string_split(text, chr(10)) as lines from documents where text is not null
), solid as (
  select *, list_filter(range(1, len(lines) + 1), lambda i: regexp_matches(lines[i], '[^\x20\x09-\x0D]')) as s from split
), pair as (
  select doc_id, text, unnest(range(1, len(s))) as place, unnest(list_transform(range(1, len(s)), lambda k: s[k])) as lo,
    unnest(list_transform(range(1, len(s)), lambda k: s[k + 1])) as hi,
    unnest(list_transform(range(1, len(s)), lambda k: array_to_string(list_slice(lines, s[k], s[k + 1]), chr(10)))) as chunk from solid
), judged as (
  select *, first_value(doc_id) over w as first_id, first_value(place) over w as first_place from pair
  window w as (partition by chunk order by doc_id nulls first, place)
), gone as (
  select distinct doc_id, unnest(range(lo, hi + 1)) as i from judged where doc_id is distinct from first_id or place >= first_place + 2
), line as (
  select doc_id, unnest(range(1, len(lines) + 1)) as i, unnest(lines) as line from split
), done as (
  select l.doc_id, count(*) as n_lines, count(g.i) as n_removed, string_agg(line, chr(10) order by l.i) filter (g.i is null) as kept
  from line l left join gone g on l.doc_id = g.doc_id and l.i = g.i group by 1
)
select d.doc_id, cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from documents d left join done using (doc_id)
"""
