"""Token-ID output: texts to integer ids in ORC files, and reading them back.

ORC keeps integers run-length encoded in stripes, with a row index and, on request, a Bloom
filter for each row group. The files here hold documents in ascending id order, so a stripe's
statistics and Bloom filters on the document id let a reader skip every stripe but the one it
needs, and stripes are read in parallel.

Columns of the files: the document id, ``part`` (number of the file in id order), ``before``
(ids in this file before the document), ``n_tokens`` and ``ids``.

Defined cases: a null text is an empty one (its ids are the end id alone); null document ids
come first; rows of one document id are all kept, in an order fixed by a hash of their text;
an empty table gives no rows; columns other than the two named are not looked at, so none can
clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxstats.llm import tokens

FILE_SCHEMA = "doc_id long, part int, before long, n_tokens long, ids array<int>"


def _encode(path: str, end_id: int, leading_space: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, before = tokens.library_encoder(path, leading_space), 0
        part = TaskContext.get().partitionId()
        for block in tokens.blocks(batches, "text"):
            ids, at = encode(block.column("text"))
            rows = len(at) - 1
            ids = np.insert(ids, at[1:], end_id).astype(np.int32)
            at = at + np.arange(rows + 1)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(np.full(rows, part, np.int32)), pa.array(before + at[:-1]), pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))],
                ["doc_id", "part", "before", "n_tokens", "ids"],
            )
            before += int(at[-1])

    return run


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int, leading_space: bool = False, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encode whole texts and write them to ORC files at ``path`` in ascending id order.

    One shuffle, by ranges of the id (and of the text's hash, so that a document id that many
    rows share is split too). Texts are encoded after it, so they are encoded once.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.asc_nulls_first("doc_id"), tie).sortWithinPartitions(F.asc_nulls_first("doc_id"), tie)
    (
        ordered.mapInArrow(_encode(vocabulary, end_id, leading_space), FILE_SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.create.index", "true")
        .option("compression", "zstd")
        .orc(path)
    )


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids of the files at ``path``.

    doc_ids: only these documents; the predicate reaches the stripes' statistics and Bloom
    filters. The files' totals come to the driver: one number a file.
    """
    files = spark.read.schema(FILE_SCHEMA).orc(path)
    totals = dict(files.groupBy("part").agg(F.max(F.col("before") + F.col("n_tokens"))).collect())
    parts = sorted(totals)
    starts = np.cumsum([0, *(totals[p] for p in parts)]).tolist()
    base = spark.createDataFrame(list(zip(parts, starts, strict=False)), "part int, base long")
    if doc_ids is not None:
        files = files.where(F.col("doc_id").isin(doc_ids))
    joined = files.join(F.broadcast(base), "part")
    return joined.select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        at, ids = lists.offsets.to_numpy(), memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
        sums = [crc32(ids[4 * a : 4 * b]) for a, b in zip(at, at[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def digest(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers) of what :func:`read` returns."""
    return files.select("doc_id", "start", "ids").mapInArrow(_digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
