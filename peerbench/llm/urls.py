"""URL filter: given host and path rules first, mined association rules for the rest.

Every labelled URL is a transaction of its tokens (host labels, path words with digits masked, query keys, scheme) and
its label; Spark's FP-growth mines the frequent sets. Rules that conclude "bad" are kept with enough confidence and
support, unless a part of their tokens already gives a rule as sure. Matching uses an inverted index: a
rule stands under its rarest token, so a URL meets it only with that token, and the other tokens are compared then.

Labels come from ``labels``: a page is bad where the label row of its id has quality 0 or toxic 1.

Defined results: a null url, or one without "://", has an empty host and path, no tokens and verdict allow;
A-Z only is lower-cased, in the host only; repeated pages are judged row by row; without labels nothing is mined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.llm.frames import stored, table

#: (host, path start, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.6
_BAD = "=bad"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL; runs of digits count as one mark, so that page numbers don't make tokens unique."""
    masked = lambda part: F.regexp_replace(part, "[0-9]+", "0")
    named = lambda kind, parts: F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(kind), p))
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    scheme = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    found = F.concat(
        named("s:", F.array(scheme)), named("h:", F.split(host_of(url), r"\.")),
        named("p:", F.transform(F.split(path_of(url), "[/.]"), masked)),
        named("q:", F.transform(F.split(query, "&"), lambda p: F.regexp_extract(p, "^([^=]*)", 1))),
    )
    return F.array_distinct(F.coalesce(found, F.array().cast("array<string>")))


def given_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null: rules are looked up under every suffix of the host."""
    listed: dict[str, list[tuple[str, str]]] = {}
    for rule_host, start, verdict in rules:
        listed.setdefault(rule_host, []).append((start, verdict))
    if not listed:
        return F.lit(None).cast("struct<size:int,rule:string,start:string,verdict:string>")
    entries = []
    for rule_host, own in listed.items():
        entry = [F.struct(F.lit(len(rule_host + start)).alias("size"), F.lit(rule_host + start).alias("rule"), F.lit(start).alias("start"), F.lit(verdict).alias("verdict")) for start, verdict in own]
        entries += [F.lit(rule_host), F.array(*entry)]
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    under = F.transform(suffixes, lambda s: F.coalesce(F.try_element_at(F.create_map(*entries), s), F.array().cast("array<struct<size:int,rule:string,start:string,verdict:string>>")))
    return F.array_max(F.filter(F.flatten(under), lambda r: F.startswith(path, r["start"])))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(tokens, rarest, confidence, support) of the rules to "bad" from rows (url, bad)."""
    items = tokens_of(F.col("url"))
    baskets = labelled.where("url is not null and bad is not null").select(F.when(F.col("bad"), F.array_append(items, _BAD)).otherwise(items).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    sets = stored(model.freqItemsets, "itemsets")
    # frequent sets with the label, each set against itself without the label
    bad = sets.where(F.array_contains("items", _BAD) & (F.size("items") > 1)).select(F.array_sort(F.array_remove("items", _BAD)).alias("tokens"), F.col("freq").alias("both"))
    alone = sets.where(~F.array_contains("items", _BAD)).select(F.array_sort("items").alias("tokens"), "freq")
    total = stored(baskets.agg(F.count(F.lit(1)).alias("n")), "baskets").first()["n"]
    rules = bad.join(alone, "tokens").select("tokens", (F.col("both") / F.col("freq")).alias("confidence"), (F.col("both") / F.lit(max(total, 1))).alias("support"))
    rules = stored(rules.where(F.col("confidence") >= min_confidence), "rules")
    # a longer rule that is not surer than the rule of one token less says nothing new
    parts = rules.where(F.size("tokens") > 1).select("tokens", "confidence", F.explode("tokens").alias("less")).select("tokens", "confidence", F.array_remove("tokens", F.col("less")).alias("part"))
    sure = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("part_confidence"))
    rules = rules.join(parts.join(sure, "part").where("part_confidence >= confidence").select("tokens").distinct(), "tokens", "left_anti")
    single = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    placed = rules.select("*", F.explode("tokens").alias("token")).join(single, "token")
    return placed.groupBy("tokens", "confidence", "support").agg(F.min(F.struct("freq", "token"))["token"].alias("rarest"))


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, confidence) of the surest rule that each distinct url matches."""
    own = urls.where("url is not null").select("url").distinct().select("url", tokens_of(F.col("url")).alias("own"))
    met = own.select("url", "own", F.explode("own").alias("rarest")).join(stored(rules, "index"), "rarest")
    return met.where(F.size(F.array_except("tokens", "own")) == 0).groupBy("url").agg(F.max("confidence").alias("confidence"))


def filter_urls(pages: DataFrame, labelled: DataFrame, keep: Sequence[str] = ("page_id",), rules: Sequence[tuple[str, str, str]] = RULES, **mining: float) -> DataFrame:
    """Per page row: ``page`` (the columns named in ``keep``), host, path, rule, confidence (of the mined rule), verdict."""
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("page"), "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("given", given_rule(F.col("host"), F.col("path"), rules))
    rows = rows.join(matched(rows.where("given is null"), mine_rules(labelled, **mining)), "url", "left")
    mined = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return rows.select("page", "host", "path", F.col("given.rule").alias("rule"), "confidence", F.coalesce("given.verdict", mined).alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    bad = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    found = filter_urls(pages, pages.join(bad, "page_id").select("url", "bad"))
    return found.select("page.page_id", "host", "path", "rule", "verdict", "confidence")
