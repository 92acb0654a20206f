"""The corpus pipeline: documents in, encoded clean documents out.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.  All but the last return documents
with all their columns: good texts, one text of each group of equal texts, one of each group of similar texts, and
those without benchmark questions.  The last one encodes what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebundle.llm import byte_bpe, decontaminate, exact_dedup, ngram_join, quality
from carebundle.llm.common import each_once, stored, table, without

RANKS = "byte_bpe_multi_50k.tiktoken"
# Near duplicates: shingles of five words, a similarity of 0.8.
NEAR = ngram_join.Settings(width=5, percent=80)


def _text_keys(docs: DataFrame) -> list:
    return [(docs["doc_id"], "doc_id"), (F.xxhash64(docs["text"]), "text_hash")]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects as bad or toxic go.  Texts without words (null, empty, blank) are among them
    unless nothing is rejected; very long texts are judged whole; repeated rows share their fate; ties at the last
    place stay.  Extra columns of any name are kept; an empty table gives an empty one."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    rejected = quality.resample(docs, model).where("not selected").select("doc_id", "text_hash").distinct()
    return without(docs, rejected, _text_keys(docs))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space the one with most code points stays, then the smallest id (null last);
    null counts as empty, and repeated rows fold into the first by all columns.  Texts of any length are compared whole.
    Extra columns of any name are kept; an empty table gives an empty one."""
    return exact_dedup.deduplicated(docs, exact_dedup.exact_duplicates(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts stays: the one with the smallest id (null last), of equal ids the one
    with the smaller hash of its text, of repeated rows the first by all columns.  Null, empty and blank texts are like
    nothing and stay.  Extra columns of any name are kept; an empty table gives an empty one."""
    found = ngram_join.similar_components(docs, NEAR).where("component is not null")
    members = found.groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    members = stored(members, "near-members")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("least")
    heads = members.groupBy("component").agg(least)
    own = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    judged = stored(members.join(heads, "component").select("doc_id", "text_hash", "n", own.alias("stays")), "near-judged")
    return each_once(docs, judged.where("not stays"), judged.where("stays and n > 1"), _text_keys(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go, with other values or without.  Null and empty texts are clean; very long texts
    are searched whole; rows with one id and text share their fate, rows with one id and different texts do not.  Extra
    columns of any name are kept; an empty table gives an empty one, an empty benchmark drops nothing."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.where("contaminated").select("doc_id", "text_hash").distinct(), _text_keys(docs))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row of token counts and digests for each row; null counts as empty and has no tokens, texts of any length are encoded
    whole, repeated rows give repeated rows and null ids stay null.  Other columns are not looked at; an empty table gives
    an empty one."""
    # The heap of the stages before is still taken, so fewer texts are encoded together.
    coded = byte_bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, decode=True, batch_bytes=1 << 20)
    return byte_bpe.digests(coded)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_level_bpe", byte_level_bpe),
]
# Models, components and token ids are not for SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
