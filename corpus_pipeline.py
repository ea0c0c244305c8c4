"""From raw documents to packed training sequences: five stages, each stored before the next reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.llm import decontamination, language, line_windows, packing, queries, simhash
from tallywise.llm.common import in_fold, table
from tallywise.session import cut_lineage, release


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep documents in a language; `lang` becomes the predicted one. Texts without letters go."""
    model = language.fit(docs.where(~in_fold("doc_id", 3, 1)))
    known = language.with_language(docs, model, "__language").withColumn("lang", F.col("__language.lang_pred"))
    return known.where(F.col("lang") != language.UNKNOWN).drop("__language")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Cut repeated three-line windows; documents of which only white space is left go."""
    cut = line_windows.without_repeats(docs).where("n_removed = 0 OR trim(text) <> ''")
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group stays that fingerprints within two bits link."""
    return simhash.one_of_each(docs).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontamination.without_contaminated(docs, table(spark, folder, "benchmark")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents in sequences of 4,096 tokens."""
    return packing.pack(docs, public_tokenizers.path(queries.TOKENIZER))


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: No SQL: the mixture model, XXH64 and the tokenizer are beyond it; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the last stage."""
    docs, stored = table(spark, folder, "documents"), []
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, folder))
        stored.append(docs)
    release(*stored[:-1])
    return docs
