"""From raw documents to packed training sequences: five stages, each a table for the next.

Toxic documents go, one document of each near-duplicate group stays, passages that a smaller document
already has are cut out, contaminated documents go, and what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filingweave.llm.common import ready, stored, unused
from filingweave.llm.decontamination import without_contaminated
from filingweave.llm.packing import pack
from filingweave.llm.passages import cut_passages, shared_passages, with_row_ids
from filingweave.llm.queries import table, tokenizer_file
from filingweave.llm.simhash import one_of_each
from filingweave.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; null texts count as empty ones, repeated rows go or stay together."""
    return without_toxic(docs, table(ready(spark), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of fingerprints; of null and blank texts one in all."""
    ready(spark)
    return one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that one with a smaller id shares.

    Rows without an id and texts that share one count as documents of their own, after all others.
    """
    ready(spark)
    length = "n_chars" if "n_chars" in docs.columns else None
    row = unused(docs, "_row")
    numbered = with_row_ids(docs, name=row)
    return cut_passages(numbered, shared_passages(numbered, row), row, length_col=length).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; null texts are not, repeated rows go or stay together."""
    return without_contaminated(docs, table(ready(spark), sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens, with their ids."""
    ready(spark)
    return pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Fingerprints, language models and tokenizers are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
