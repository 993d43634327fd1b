"""From raw documents to packed training sequences.

Each stage takes (spark, docs, folder) and returns a table, which is written and read again as the next one's ``docs``. All
but the last return rows of ``documents`` with its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm import decontamination, exact_dedup, language, near_duplicates, packing
from ledgermill.llm.common import read
from ledgermill.llm.queries import vocabulary
from ledgermill.session import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence; the model is trained on those that are labelled."""
    return language.accepted(docs, language.train(docs, docs["doc_id"].isNotNull()))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the longest, then first."""
    return exact_dedup.without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five-word shingles, similarity 0.8) the first."""
    return near_duplicates.without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their sequence and offset."""
    return packing.packed(docs, vocabulary())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Models, fingerprints and token ids are beyond SQL; the tests compare the stages with plain searches.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
