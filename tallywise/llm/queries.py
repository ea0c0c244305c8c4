"""Registered queries of the corpus operators; each reads its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import (
    byte_bpe, collocation, decontamination, language, line_windows, multi_index, packing, resharding, simhash,
    text_density, toxicity, unit_dedup, whitening)
from .common import in_fold, table

OLD_SHARDS = 32
NEW_SHARDS = 40
TOKENIZER = "word_bpe_49k.json"
RANKS = "byte_bpe_50k.tiktoken"


def op1_benchmark_decontamination(spark, folder) -> DataFrame:
    found = decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_overlaps", "longest", "matched")


def op2_simhash_near_dedup(spark, folder) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op3_flow_resharding(spark, folder) -> DataFrame:
    """The old layout is by source, as a crawl writes it; the new one has shards of equal bytes."""
    by_source = F.pmod(F.crc32(F.coalesce("source", F.lit(""))), F.lit(OLD_SHARDS))
    docs = resharding.sized(table(spark, folder, "documents"), by_source)
    return resharding.plan(docs, NEW_SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op4_ftrl_toxicity(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    taught = table(spark, folder, "labels").where(~in_fold("doc_id", 4, 2))
    scored = toxicity.with_toxicity(docs.select("doc_id", "text"), toxicity.fit(docs, taught))
    return scored.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_first_fit_packing(spark, folder) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_line_window_dedup(spark, folder) -> DataFrame:
    return line_windows.without_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_removed", "text")


def op7_unit_dedup(spark, folder) -> DataFrame:
    return unit_dedup.repeated_units(table(spark, folder, "documents")).select(
        "doc_id", "start", "end", "n_units", "n_words", "first_doc_id", "first_start")


def op8_multi_index_near_dedup(spark, folder) -> DataFrame:
    return multi_index.near_duplicates(table(spark, folder, "embeddings"))


def op9_text_density_extraction(spark, folder) -> DataFrame:
    pages = text_density.with_main_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("main_text").alias("text"),
                        F.length("main_text").cast("long").alias("n_chars"))


def op10_mixture_language_id(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.where(~in_fold("doc_id", 3, 1)))
    return language.with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "language.lang_pred", "language.score",
        F.concat_ws(",", "language.langs").alias("languages"))


def op11_refined_whitening(spark, folder) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return whitening.by_component(whitening.with_whitened(vectors, whitening.fit(vectors)))


def op12_backtracking_bpe(spark, folder) -> DataFrame:
    ranks = byte_bpe.ranks_of(public_tokenizers.path(RANKS))
    return byte_bpe.round_trips(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


def op13_suffix_collocations(spark, folder) -> DataFrame:
    return collocation.collocations(table(spark, folder, "documents"))


def queries() -> dict:
    import corpus_pipeline
    found = [op1_benchmark_decontamination, op2_simhash_near_dedup, op3_flow_resharding, op4_ftrl_toxicity,
             op5_first_fit_packing, op6_line_window_dedup, op7_unit_dedup, op8_multi_index_near_dedup,
             op9_text_density_extraction, op10_mixture_language_id,
             op11_refined_whitening, op12_backtracking_bpe, op13_suffix_collocations]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracles() -> dict:
    from .oracles import ORACLES
    return dict(ORACLES)
