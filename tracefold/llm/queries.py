"""One query per operator over the test tables; ``oracles`` holds the same questions as SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracefold.cluster import shared_path
from tracefold.llm import (
    alignment, decontamination, language_id, lexical_search, line_dedup, mixing, pair_index_bpe, quality, simhash, substring_dedup, token_counts, token_files,
    warc,
)
from tracefold.llm.common import table, written


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(language_id.learning_rows(docs))
    held_out = F.coalesce(language_id.fold_of() == 2, F.lit(False)).alias("held_out")
    return language_id.identify_languages(docs, model).select("doc_id", held_out, "lang_pred", "score", "accepted")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


#: Whole weights by level and value; 1 for values not named.
MIX_WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 4, "de": 2, "fr": 2}, "source": {}}


def mix_groups() -> dict[str, Column]:
    """Domain (by the number of the source), language, source."""
    number = F.regexp_extract(F.col("source"), "[0-9]+$", 0).try_cast("int") % 3
    domain = F.when(number == 0, "web").when(number == 1, "books").when(number == 2, "code").otherwise("other")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source is switched off: what it would have taken goes to its siblings."""
    groups, weights = mix_groups(), {**MIX_WEIGHTS, "source": {"src19": 0}}
    found = mixing.mix(table(spark, sf_dir, "documents").withColumn("domain", groups["domain"]), groups, weights)
    return found.select("doc.doc_id", "doc.domain", "doc.lang", "doc.source", "epoch", "n_tokens", "take_tokens")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.rate_documents(table(spark, sf_dir, "documents"))
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc_path, warc_path = shared_path(spark, "arc"), shared_path(spark, "warc")
    warc.write_arc(table(spark, sf_dir, "pages"), arc_path)
    warc.convert(spark, arc_path, warc_path)
    records = written(warc.read_warc(spark, warc_path, with_payload=False), "warc-records")
    first = records.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("number").alias("refers_to"))
    revisits = records.filter("record_type = 'revisit'").join(first, "refers_to_id")
    found = records.filter("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long")).unionByName(revisits)
    return found.select(F.col("number").alias("page_id"), "payload_bytes", F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
                        "record_type", "refers_to")


def token_digests(docs: DataFrame) -> DataFrame:
    """Write documents as token files, read these back, and digest each document."""
    spark, path = docs.sparkSession, shared_path(docs.sparkSession, "token-files")
    token_files.write_files(token_files.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json")), path)
    found = token_files.read_files(spark, path)
    return found.select("doc_id", "start", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda groups: F.when(groups != "", F.sha2(groups, 256)).otherwise("")
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    found = alignment.align(table(spark, sf_dir, "documents"), *files, as_text=True, carry=digest)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = public_tokenizers.path("word_bpe_49k.json")
    encoded = pair_index_bpe.encode_texts(table(spark, sf_dir, "documents"), file)
    ids, decoded = F.col("ids"), pair_index_bpe.decode_ids(F.col("ids"), file)
    return encoded.select("doc_id", F.size(ids).cast("long").alias("n_tokens"), F.sha2(F.array_join(ids.cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2(decoded, 256).alias("decoded_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        op1_language_id, op2_token_counts, op3_mixing, op4_quality_rules, op5_decontamination, op6_simhash_dedup, op7_line_dedup, op8_warc,
        op9_token_files, op10_substring_dedup, op11_alignment, op12_pair_index_bpe, op13_lexical_search,
    ]
    return {query.__name__: query for query in listed}
