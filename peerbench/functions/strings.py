"""String column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens a CSV reader of the reference format takes for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def null_if_token(c: Column | str) -> Column:
    """Null where the text is exactly one of the missing-value tokens."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~c.isin(*NULL_TOKENS), c)


def title_case(c: Column | str) -> Column:
    """Capitalise the first letter after every non-letter, lower-case the rest."""
    c = F.col(c) if isinstance(c, str) else c
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def money(c: Column) -> Column:
    """``$1,234`` from a thousand upwards, one decimal below."""
    return F.when(F.abs(c) >= 1000, F.format_string("$%,.0f", c)).otherwise(F.format_string("%.1f", c))


def percent(c: Column) -> Column:
    """A fraction as a percentage with one decimal."""
    return F.format_string("%.1f%%", c * F.lit(100.0))
