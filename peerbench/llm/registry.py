"""Queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from peerbench.llm import collocations, conversations, decontam, embeddings, language, linededup, mixing, ngram_join, pieces, quality, substring, surrogates, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontam.op1_decontamination,
    "op2_line_dedup": linededup.op2_line_dedup,
    "op2_passage_dedup": linededup.op2_passage_dedup,
    "op3_substring_dedup": substring.op3_substring_dedup,
    "op4_language": language.op4_language,
    "op5_mixing": mixing.op5_mixing,
    "op6_ngram_join": ngram_join.op6_ngram_join,
    "op7_quality": quality.op7_quality,
    "op8_url_filter": urls.op8_url_filter,
    "op9_surrogates": surrogates.op9_surrogates,
    "op10_embedding_dedup": embeddings.op10_embedding_dedup,
    "op11_collocations": collocations.op11_collocations,
    "op12_pieces": pieces.op12_pieces,
    "op13_conversations": conversations.op13_conversations,
}

SQL: dict[str, str] = {
    "op1_decontamination": decontam.SQL,
    "op2_line_dedup": linededup.SQL,
    "op2_passage_dedup": linededup.PASSAGE_SQL,
    "op3_substring_dedup": substring.SQL,
    "op5_mixing": mixing.SQL,
    "op6_ngram_join": ngram_join.SQL,
    "op11_collocations": collocations.SQL,
    "op13_conversations": conversations.SQL,
}
