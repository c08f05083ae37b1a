"""Snapshots that arrive one after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def summary(rows: DataFrame, by: str, value: str) -> DataFrame:
    """Mergeable statistics of each snapshot; works on a stream as on a table."""
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("spread"), F.min(value).alias("least"), F.max(value).alias("largest"))


def arrivals(spark: SparkSession, path: str, schema: StructType, files: int | None = None) -> DataFrame:
    """A stream of the Parquet files that appear in a folder."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def windowed(stream: DataFrame, time: str, value: str, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Statistics by window of event time; a window is final once it is later than ``late``."""
    return summary(stream.withWatermark(time, late).withColumn("snap", F.window(time, width)), "snap", value)


def for_each_snapshot(stream: DataFrame, by: str, statistic: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """A statistic of each batch's snapshots, written to ``out`` by snapshot. A batch that is run
    again overwrites its own folder, so results come once."""

    def write(batch: DataFrame, number: int) -> None:
        statistic(batch).write.mode("overwrite").partitionBy(by).parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
