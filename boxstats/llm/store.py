"""Working tables in the folder that the cluster shares (``spark.checkpoint.dir``)."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may leave it unset (tests); then a temporary folder is used, since
    driver and executors are one process there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "boxstats-scratch")


def place(spark: SparkSession, label: str) -> str:
    """A path of its own for one working table."""
    return f"{root(spark)}/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost
    executor costs a re-read instead of a re-run."""
    spark = df.sparkSession
    path = place(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete working tables that no later plan reads."""
    for df in tables:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        own = root(spark).removeprefix("file://")
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if own in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Have Spark delete the shuffles that no plan refers to any more. It does so when the driver's
    garbage is collected, which in a small driver may be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that ``df`` doesn't have (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
