"""Documents through quality, line dedup, near-duplicate removal, decontamination and mixing, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of ``docs``, of any names; the last one
adds ``taken``, the words that the mix takes of a document (repeats counted), and replaces a column of that name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.llm import decontam, linededup, mixing, ngram_join, quality
from peerbench.llm.frames import stored, table

#: Near duplicates here share four fifths of their five-word shingles.
NEAR = ngram_join.Likeness(words=5, percent=80)


def _columns(docs: DataFrame, source: str = "doc") -> list:
    return [F.col(f"{source}.`{c}`").alias(c) for c in docs.columns]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, trained on ``labels``, rejects; one that had nothing to learn rejects none."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    if not model.weights:
        return docs
    return quality.score(docs, model, docs.columns).where("predicted = 1").select(*_columns(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes content-defined chunks of lines that repeat, and what they leave of repeated passages of two lines or more.

    ``n_chars`` follows the text. Every document stays.
    """
    others = [c for c in docs.columns if c != "text"]
    left = linededup.dedup_grown(docs, others)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return left.select(*[new[c].alias(c) if c in new else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of every group of near duplicates."""
    _, found = ngram_join.similar_groups(docs, NEAR)
    losers = found.where("component < node").select(F.col("node").alias("doc_id"))
    return docs.join(losers, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with benchmark passages."""
    others = [c for c in docs.columns if c != "text"]
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), others).where("not contaminated")
    return found.select(*[F.col("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which the mix takes words, with ``taken``."""
    taken = mixing.mix_sources(docs, docs.columns).where("taken > 0")
    return taken.select(*[c for c, name in zip(_columns(docs), docs.columns) if name != "taken"], "taken")


STAGES = [
    ("quality", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

#: The classifier of the first stage is trained, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
