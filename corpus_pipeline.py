"""A corpus pipeline: good documents, in a known language, one of each near copy, packed.

Each stage takes the documents that its predecessor kept, read from the Parquet it was written
to, and works on all of them. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from blotterline.llm.common import materialize, read_table
from blotterline.llm.language_id import fit_bounds, fit_filters, held_out, in_known_language
from blotterline.llm.packing import pack_documents
from blotterline.llm.quality import fit_quality, good
from blotterline.llm.simhash import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return good(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or in no known language go.

    The filters learn from rows that are not held out; held-out rows set what a known language is.
    """
    filters = fit_filters(docs.where(~held_out()))
    return in_known_language(docs, filters, fit_bounds(docs.where(held_out()), filters))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id.

    Near copies have fingerprints over shingles of four words that differ in at most four bits, and
    are near copies of each other's near copies.
    """
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: SQL cannot express the models, the fingerprints and the tokens; ``tests/llm`` checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
