"""A training corpus out of ``documents``: five stages, each a DataFrame to a DataFrame.

Each stage is written as Parquet to the shared folder and read again as the next one's
input. All but the last return the columns they were given, whatever their names.

Defined results, by stage, of odd rows: a null or empty text has no words, so the
classifier gives it the score of such a text and the quality rules drop it; a text of any
length is read whole; repeated rows stay or go together until near-dedup, which drops the
copies of a smaller doc_id's text but not rows of one doc_id; of equal texts the least doc_id
stays; rows with a null doc_id are never dropped as copies, and lose no passages; the packing
stage packs each row that is left; an empty table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from decklight.llm import packing, quality, simhash, substring, toxicity
from decklight.llm.shared import read_table, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier, fitted on ``labels``, finds toxic."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that fail the base check or a rule."""
    return quality.quality_filter(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each group of copies: five-word shingles, similarity 0.8 or more."""
    return simhash.keep_one_of_each(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 13 words or more that a document of a smaller doc_id has as well."""
    return substring.remove_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 1024 tokens; one row a piece."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

#: SQL can express neither a fitted classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
