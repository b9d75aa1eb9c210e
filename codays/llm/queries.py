"""The operators as registered queries over the given tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from codays.llm.byte_bpe import round_trip
from codays.llm.chat import format_conversations, read_back, with_forged_markers
from codays.llm.common import table
from codays.llm.decontaminate import decontaminate, decontaminate_sql
from codays.llm.forest import jaccard_join
from codays.llm.hard_negatives import hard_negatives, hard_negatives_sql
from codays.llm.lm import score_texts
from codays.llm.mixing import mixture, mixture_sql
from codays.llm.pivots import near_duplicates
from codays.llm.spelling import spelling_variants
from codays.llm.suffix_dedup import remove_repeats
from codays.llm.token_counts import count_tokens
from codays.llm.toxicity import toxicity
from codays.llm.top_k import nearest_rows, nearest_rows_sql


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_forged_markers(table(spark, folder, "conversations"))
    return read_back(format_conversations(rows))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return count_tokens(table(spark, folder, "documents"), vocabulary)


def op3_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_rows(table(spark, folder, "embeddings"))


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))


def op7_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return score_texts(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(table(spark, folder, "documents"))


def op9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixture(table(spark, folder, "documents"))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN, cut_at_blanks=True)


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives(table(spark, folder, "embeddings"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_token_counts": op2_token_counts,
    "op3_near_vectors": op3_near_vectors,
    "op4_toxicity": op4_toxicity,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_lm_scores": op7_lm_scores,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_mixture": op9_mixture,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_decontamination": op12_decontamination,
    "op13_hard_negatives": op13_hard_negatives,
}

LLM_SQL: dict[str, str] = {
    "op5_exact_top_k": nearest_rows_sql(),
    "op9_mixture": mixture_sql(),
    "op12_decontamination": decontaminate_sql(),
    "op13_hard_negatives": hard_negatives_sql(),
}
