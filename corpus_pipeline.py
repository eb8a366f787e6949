"""A corpus from documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next one's docs.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import decontamination, language_id, packing, simhash, suffix_dedup
from larder.llm.common import drop_written, load, new_path

#: A document whose best language has less than this share is rejected, as is one without letters.
LEAST_SCORE = 0.5
#: So is one that its best model codes worse than plain bytes: it is in no learned language.
MOST_BITS = 8.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language the PPM models settle; ``und``, undecided and strange ones go."""
    model = language_id.fit(docs.where(~language_id.held_out()))
    if not model.languages:
        return docs.where(F.lit(False))
    v = F.col("verdict")
    settled = (v["lang"] != "und") & (v["score"] >= LEAST_SCORE) & (v["bits_per_byte"] <= MOST_BITS)
    return language_id.identify(docs, model).where(settled).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each SimHash component: the one of the least doc_id (of repeated ids, one)."""
    return simhash.representatives(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated byte strings out of the texts; what a cut leaves of a split character goes too.

    Null and empty texts stay as they are, whole texts of any length are cut; a text may become empty.
    """
    return suffix_dedup.without_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that leak no benchmark item; null and empty texts leak nothing and stay, long ones are read whole."""
    return decontamination.clean(docs, load(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens; a null or empty text is its end id, a long text is cut into several pieces."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", decontaminate),
    ("packing", pack_sequences),
]

#: Fingerprints, language models and tokenizers are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            drop_written(before)
        suffix_dedup.drop_tables(spark)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
