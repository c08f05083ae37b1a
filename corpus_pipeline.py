"""The corpus pipeline: documents to packed sequences, a stage at a time.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from boxstats.llm import lines, packing, pii, quality, simhash, store
from boxstats.llm.queries import trusted_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.accepted(docs, trusted_documents(spark, sf_dir))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than a tenth of a source's documents go from them."""
    return lines.cleaned(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: texts whose SimHash fingerprints link,
    and others that MinHashes bring together, if they share 0.8 of their five-word shingles."""
    return simhash.similar_representatives(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind."""
    return pii.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their token ids and their place in a sequence."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("private_data", private_data),
    ("best_fit_packing", best_fit_packing),
]

#: SQL expresses neither the scores nor the fingerprints, spans and token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store.keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
