"""Corpus pipeline over ``documents``: language ID, near duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes every stage's result as
Parquet to the shared folder and reads it back as the next one's input. All stages but the last return the
columns of ``documents``; n_chars follows a text that was cut.

Rejected: documents without a word of a known language or with less than half of their words in one language;
all but the smallest doc_id of near duplicates (5-word shingles, Jaccard 0.75); documents that have nothing left once
repeated 200-byte strings, or benchmark passages, are cut out. Others stay, with what is left of their texts. Further columns
of ``documents`` come through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand.llm import decontaminate, lang_crf, ngram_join, packing, suffix_dedup
from demand.llm.catalog import held_out_language
from demand.llm.common import table, written
from demand.llm.tokenizing import tokenizer_path

LEAST_SHARE = 0.5


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Documents that have a word left, with n_chars of their text."""
    return (docs.where(F.col("text").rlike(r"\S"))
            .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*columns))


def _aside(docs: DataFrame, names) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its own columns of the given names under other ones, and how to name them back."""
    back = {f"__own_{c}": c for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed({c: own for own, c in back.items()}), back


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, back = _aside(docs, ("lang_pred", "score"))
    found = lang_crf.identify(rows, ~held_out_language(F.col("doc_id")))
    kept = found.where((F.col("lang_pred") != lang_crf.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).drop("lang_pred", "score").withColumnsRenamed(back).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(suffix_dedup.dedup_texts(docs), docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, back = _aside(docs, decontaminate.NEW)
    marked = decontaminate.mark(rows, table(spark, sf_dir, "benchmark"), cut=True)
    return _with_text(marked.drop(*decontaminate.NEW).withColumnsRenamed(back), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("best-fit packing", packed),
]
#: Language ID and packing cannot be said in SQL; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
