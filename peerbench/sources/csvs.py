"""Raw files in, result files out."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerbench.session import materialize


def _files(spark: SparkSession, path: str) -> list[tuple[str, str, list[str]]]:
    """(header, encoding, files): the files of ``path`` by header line and encoding, from one pass over their lines.

    A file with bytes that are not UTF-8 counts as Latin-1. One row per file comes back.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    found = lines.groupBy("file").agg(
        F.min_by("value", F.struct("start", "at")).alias("header"), F.max(~F.is_valid_utf8("value")).alias("damaged")).collect()
    kinds: dict[tuple[str, str], list[str]] = {}
    for row in sorted(found, key=lambda r: r["file"]):
        header = row["header"].removeprefix("\ufeff").rstrip("\r")
        kinds.setdefault((header, "ISO-8859-1" if row["damaged"] else "UTF-8"), []).append(row["file"])
    return [(header, encoding, files) for (header, encoding), files in kinds.items()]


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Headed CSV files with every column as text, so that codes keep their leading zeros.

    Columns are found by the names in each file's header, in whatever order they come; files with other
    columns are an error, and so are a missing path and a row with too few or too many fields.
    Each file is read as UTF-8 or, if it is not, as Latin-1. Line breaks in quoted fields need ``multi_line`` (see
    ``quoted_records``); without it they are an error.
    """
    out = None
    for header, encoding, files in _files(spark, path):
        if multi_line:
            part = _parsed(quoted_records(spark, files), header, encoding)
        else:
            part = spark.read.options(header=True, escape='"', encoding=encoding, mode="FAILFAST", columnPruning=False).csv(files)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError(f"no CSV file with a header in {path}")
    return out


def quoted_records(spark: SparkSession, files: list[str]) -> DataFrame:
    """file, number (from 1), value: the records of CSV files that may have line breaks in quoted fields.

    A file is read in splits by many tasks. Whether a line begins inside a quoted field follows from the number of quotes
    before it (a doubled quote counts twice): added up within its split, and over the splits before it in a table
    of one row per split. Lines that are a record go straight on; only those of a longer record are put together.
    A quote that is never closed is an error.
    """
    lines = spark.read.option("lineSep", "\n").text(files).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    # bytes, since the text may not be UTF-8
    quotes = (F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    split = Window.partitionBy("file", "start").orderBy("at")

    def placed(columns: list[str]) -> DataFrame:
        marked = lines.select(*columns, "file", "start", "at", quotes.alias("odd"))
        return marked.withColumn("inner", (F.sum("odd").over(split) - F.col("odd")) % 2)

    per_split = placed([]).groupBy("file", "start").agg(
        F.sum("odd").alias("odd"), F.count_if(F.col("inner") == 0).alias("n0"), F.count_if(F.col("inner") == 1).alias("n1"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    entered = per_split.withColumn("entry", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("entry") == 0, F.col("n0")).otherwise(F.col("n1"))  # lines that begin outside of quotes
    splits = materialize(
        entered.withColumn("begun", begun).select("file", "start", "entry", "odd", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("before")), "splits")
    left_open = splits.groupBy("file").agg(F.sum("odd").alias("odd")).where("odd % 2 = 1").first()
    if left_open is not None:
        raise ValueError(f"a quote is left open in {left_open['file']}")

    numbered = placed(["value"]).join(splits.select("file", "start", "entry", "before"), ["file", "start"])
    numbered = numbered.withColumn("outside", F.col("inner") == F.col("entry")).withColumn(
        "number", F.col("before") + F.sum(F.col("outside").cast("long")).over(split))
    whole = numbered.where("outside and odd = 0").select("file", "number", "value")
    parts = numbered.where("not outside or odd = 1").groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("start", "at", "value"))).alias("lines"))
    return whole.unionByName(parts.select("file", "number", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("value")))


def _parsed(records: DataFrame, header: str, encoding: str) -> DataFrame:
    """The fields of records as text columns; the first record of a file is its header, empty ones are passed over."""
    names = next(csv.reader([header]))
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    text = F.col("value") if encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    bare = F.regexp_replace(text, "\r$", "")
    rows = records.where("number > 1").select(bare.alias("value")).where(F.trim("value") != "")
    return rows.select(F.from_csv("value", schema, {"escape": '"', "mode": "FAILFAST"}).alias("row")).select("row.*")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df``, or an error that names the columns it lacks."""
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"the raw file lacks {', '.join(lacking)}")
    return df


def write_csv(df: DataFrame, path: str) -> str:
    """Write a result as headed CSV part files; padding of texts is kept."""
    (
        df.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A saved result under its pinned schema; an absent one is an empty frame."""
    try:
        return (
            spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"')
            .csv(path)
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_text(df: DataFrame, column: str, path: str, title: str, stamp: str) -> str:
    """Write narrative text under a title and a time that the caller gives."""
    head = f"# {title} ({stamp})\n\n"
    df.select(F.concat(F.lit(head), F.col(column)).alias("value")).write.mode("overwrite").text(path)
    return path
