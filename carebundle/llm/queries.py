"""The queries of the operators over the given tables, with production parameters, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebundle.llm import byte_bpe, decontaminate, exact_dedup, html_extract, language_id, license_scan, lm_score, ngram_join, periodic_runs, quality, target_sampling, token_counts, tool_calls
from carebundle.llm.common import table
from carebundle.llm.oracles import license_scan_sql, similar_components_sql, target_sampling_sql

RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def op1_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents")).drop("n_points")


def op3_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    training = language_id.fold(F.col("doc_id"), 5) != 1
    return lm_score.lm_scores(table(spark, folder, "documents"), training)


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, folder, "documents"), ngram_join.Settings(width=3, percent=90)).drop("text_hash", "component")


def op5_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    return tool_calls.format_conversations(spark, folder)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    pieces = token_counts.read_pieces(public_tokenizers.path(PIECES))
    return token_counts.token_counts(table(spark, folder, "documents"), pieces, token_counts.zipf_scores(pieces))


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = byte_bpe.encode(
        table(spark, folder, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, decode=True
    )
    return byte_bpe.digests(coded)


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(language_id.fold(F.col("doc_id"), 4) == 2, F.lit(True))  # nothing is learned from a null id
    labelled = documents.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = language_id.train(labelled.select(F.col("doc_id").alias("id"), "text", "lang"))
    predicted = language_id.predict(documents, model)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_quality_resampling(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = quality.fit(documents, table(spark, folder, "labels"))
    return quality.resample(documents, model).drop("text_hash")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_hash")


def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents")).drop("places")


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    documents = periodic_runs.with_planted_periods(table(spark, folder, "documents"))
    return periodic_runs.summary(periodic_runs.periodic_runs(documents))


def op13_target_sampling(spark: SparkSession, folder: str) -> DataFrame:
    return target_sampling.resample_to_target(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (op1_html_extract, op2_exact_dedup, op3_lm_score, op4_ngram_join, op5_tool_calls, op6_token_counts, op7_byte_bpe, op8_language_id, op9_quality_resampling, op10_decontamination, op11_license_scan, op12_periodic_runs, op13_target_sampling)
}

SQL: dict[str, str] = {
    "op2_exact_dedup": r"""
        with rows as (
            select doc_id, coalesce(length(text), 0) as n,
                   translate(coalesce(text, ''), E' \t\n\x0b\f\r', '') as bare
            from documents),
        best as (
            select bare, count(*) as group_size, arg_min(doc_id, (-n, doc_id)) as keep_id from rows group by bare)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(bare) as text_sha256
        from rows join best using (bare)""",
    "op4_ngram_join": similar_components_sql(3, 90),
    "op11_license_scan": license_scan_sql(),
    "op13_target_sampling": target_sampling_sql(),
}
