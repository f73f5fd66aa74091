"""From raw documents to token files, in stages; each works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracefold.llm import decontamination, language_id, mixing, queries, simhash
from tracefold.llm.common import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear: texts without a letter and those with a narrow margin go."""
    model = language_id.train(language_id.learning_rows(docs))
    return docs.filter(language_id.language_of(F.col("text"), model)["accepted"])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints (four-word shingles) linked at 4 or fewer differing bits: that with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs, shingle=4, budget=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"), with_row=True)
    return found.filter(F.size("spans") == 0).select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, shared by weights, in one epoch; a document that the prefix ends in stays whole."""
    return mixing.mix(docs, queries.mix_groups(), queries.MIX_WEIGHTS, budget_percent=90, max_epochs=1).select("doc.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back and digested."""
    return queries.token_digests(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: Dictionary compression, 64-bit XXH64 votes and the tokenizer have no SQL; the tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
