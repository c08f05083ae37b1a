"""Writers of result tables and catalogues."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def text_lines(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Tab-separated values; doubles as %.6e, others as they are."""
    kinds = dict(rows.dtypes)
    cells = [F.format_string("%.6e", F.col(c)) if kinds[c] in ("double", "float") else F.col(c).cast("string") for c in columns or rows.columns]
    return rows.select(F.concat_ws("\t", *cells).alias("value"))


def spaced_lines(rows: DataFrame) -> DataFrame:
    """All columns as text, with one space between them."""
    return rows.select(F.concat_ws(" ", *(F.col(f"`{c}`").cast("string") for c in rows.columns)).alias("value"))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path, in whatever store Spark reads it from."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def reused(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A result that is made and written only if it isn't there. Unfinished output (without the
    mark that Spark's writers leave last) is made anew."""
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def write_halos(rows: DataFrame, path: str, header: Sequence[str] = ()) -> None:
    """A catalogue as text, a file for each partition, each with the # line of column names and
    further header lines, so that files can be read alone."""
    names = [f"#{' '.join(rows.columns)}", *(f"#{line}" for line in header)]
    body = spaced_lines(rows)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = True
        for batch in batches:
            if head:
                yield pa.RecordBatch.from_arrays([pa.array(names, batch.schema[0].type)], schema=batch.schema)
            head = False
            yield batch

    body.mapInArrow(told, "value string").write.text(path)


def write_compressed(rows: DataFrame, path: str, box: float, grid: int, vmax: float, pmax: float, percents: Sequence[int], keys: Sequence[str] = ("id",)) -> None:
    """A snapshot by the codec, in one job: a folder for each subsample, ordered by cell within,
    and the attributes as JSON beside it. What is whole already is left as it is."""
    from boxstats.operators import codec

    spark = rows.sparkSession
    if not exists(spark, f"{path}/data/_SUCCESS"):
        dealt = codec.subsamples(rows, keys, percents)
        coded = codec.encode_snapshot(dealt, box, grid, vmax, pmax)
        ordered = coded.repartitionByRange("subsample", "cell", "packed").sortWithinPartitions("subsample", "cell")
        ordered.write.mode("overwrite").partitionBy("subsample").option("compression", "zstd").parquet(f"{path}/data")
    if not exists(spark, f"{path}/info/_SUCCESS"):
        write_info(spark, f"{path}/info", {"L": box, "Ngrid": grid, "vmax": vmax, "pmax": pmax, "subsamp_percent": list(percents), "Ndata": rows.count()})


def read_compressed(spark: SparkSession, path: str, subsamples: Sequence[int] | None = None) -> DataFrame:
    """The decoded particles of some or all subsamples (by their percents); only their folders are read."""
    from boxstats.operators import codec

    info = spark.read.json(f"{path}/info", multiLine=True).first()
    coded = spark.read.parquet(f"{path}/data")
    if subsamples is not None:
        coded = coded.where(F.col("subsample").isin(*subsamples))
    return codec.decode_snapshot(coded, info["L"], info["Ngrid"], info["vmax"], info["pmax"])


def attributes(info: Mapping[str, object]) -> Column:
    """A codec's attributes as a map of text."""
    return F.create_map(*(F.lit(x) for k, v in info.items() for x in (k, str(v))))


def write_table(rows: DataFrame, path: str, header: Sequence[str] = (), order: Sequence[str] = ()) -> None:
    """A small result table as one text file, # header lines first."""
    head = rows.sparkSession.createDataFrame([(n, f"# {line}") for n, line in enumerate(header)], "n int, value string")
    body = text_lines(rows.orderBy(*order) if order else rows).select((F.monotonically_increasing_id() + len(header)).alias("n"), "value")
    head.select(F.col("n").cast("long"), "value").unionByName(body).repartition(1).sortWithinPartitions("n").select("value").write.text(path)


def write_catalogue(rows: DataFrame, path: str, basic: Sequence[str], key: str = "id", mode: str = "errorifexists") -> None:
    """Column families side by side, whole numbers as long and others as float, so that a reader
    takes only the family it needs. Existing output isn't overwritten."""
    typed = rows.select(*(F.col(f"`{c}`").cast("long" if k in ("int", "bigint", "smallint") else "float" if k == "double" else k).alias(c) for c, k in rows.dtypes))
    rest = [c for c in rows.columns if c not in basic and c != key]
    typed.select(key, *basic).write.mode(mode).option("compression", "zstd").parquet(f"{path}/basic")
    typed.select(key, *(f"`{c}`" for c in rest)).write.mode(mode).option("compression", "zstd").parquet(f"{path}/extended")


def write_by(rows: DataFrame, path: str, *by: str, mode: str = "errorifexists") -> None:
    """A folder for each value of the columns (simulation, snapshot, k, subsample, ...)."""
    rows.repartition(*by).write.mode(mode).partitionBy(*by).option("compression", "zstd").parquet(path)


def write_info(spark, path: str, info: Mapping[str, object]) -> None:
    """A header as JSON, in one file."""
    spark.createDataFrame([(json.dumps(info, indent=4, default=lambda x: x.item()),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def output_root(stem: str, real: int, snap: int, statistic: str) -> str:
    return f"{statistic}/{stem}/r{real}/{statistic}_{snap:03d}"
