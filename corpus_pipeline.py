"""The corpus pipeline: toxicity, exact dedup, near-dedup, suffix-array dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last
return the columns of documents, and further ones that docs has. Null texts count
as empty, and stay null where a stage leaves them; empty tables give empty tables;
very long texts are worked on whole; a null doc_id is an id like others, but no
near copy of anything.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docprep.llm import exact_dedup, packing, similar, suffix_dedup, toxicity
from docprep.llm.common import counted, drop_written, keep_rows, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half stay."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.with_scores(docs, "text", *model, score_col="_toxicity").where("_toxicity < 0.5").drop("_toxicity")


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, with the largest doc_id."""
    return keep_rows(docs, exact_dedup.exact_duplicates(docs).where("kept"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share four fifths of their five-word shingles the one with the smallest doc_id stays.

    SimHash links documents whose fingerprints differ in four bits at most, if they share as much; the pairs
    that 64 bits can't show are found by their shingles. Rows that share a doc_id stay or go together.
    """
    gone = similar.similar_documents(docs, words=5, least=(4, 5), radius=4)
    return docs.join(counted(gone.select("node")), F.col("doc_id") == F.col("node"), "left_anti")


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the passages that an earlier document has; a document that is left empty stays as such."""
    made = suffix_dedup.remove_repeats(docs, with_text=True, carry=tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars")))
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return made.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens, with their ids."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("suffix_array_dedup", suffix_dedup_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the scores nor the fingerprints; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        made = written(stage(spark, docs, sf_dir), name)
        if docs is not given:
            drop_written(docs)
        docs = made
    return STAGES[-1][1](spark, docs, sf_dir)
