"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from boxstats.llm import bpe, embeddings, lines, packing, passages, pii, quality, simhash, store, token_files, url_reputation


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, dealt out to all cores if they come in fewer partitions (a small file)."""
    docs, cores = _table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism
    return docs if docs.rdd.getNumPartitions() >= cores else docs.repartition(cores)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return bpe.round_trip(_documents(spark, sf_dir), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return packing.pack(_documents(spark, sf_dir), public.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared(_documents(spark, sf_dir))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    path = store.place(spark, "token-files")
    token_files.write(_documents(spark, sf_dir), path, public.path("word_bpe_49k.json"), end_id=1)
    return token_files.digest(token_files.read(spark, path))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.cleaned(_documents(spark, sf_dir), count_columns=("n_lines", "n_dropped"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_documents(spark, sf_dir), trusted_documents(spark, sf_dir))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_documents(spark, sf_dir))


def op10_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() & F.col("toxic").isNotNull(), 0)
    return url_reputation.judge(_table(spark, sf_dir, "pages"), labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")))


QUERIES = {"op1_bpe": op1_bpe, "op2_embeddings": op2_embeddings, "op3_packing": op3_packing, "op4_passages": op4_passages, "op5_token_files": op5_token_files, "op6_lines": op6_lines, "op7_simhash": op7_simhash, "op8_quality": op8_quality, "op9_pii": op9_pii, "op10_url_reputation": op10_url_reputation}

ORACLES = {"op6_lines": lines.oracle(), "op10_url_reputation": url_reputation.oracle()}
