"""Readers of catalogues and tables in text, and of run configurations.

Files are read by Spark's text and csv readers, so folders, globs and any store work, and lines
are parsed by column expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a halo catalogue with merger-tree values, in file order. Ids that the
# files keep as floats are long here.
HALO_COLUMNS = [
    ("Scale", "double"),
    ("ID", "long"),
    ("descScale", "double"),
    ("descID", "long"),
    ("numProg", "int"),
    ("pid", "int"),
    ("upid", "int"),
    ("descpid", "int"),
    ("phantom", "int"),
    ("sam_mvir", "double"),
    ("mbnd_vir", "double"),
    ("rvir", "double"),
    ("rs", "double"),
    ("vrms", "double"),
    ("mmp", "int"),
    ("ScaleLastMM", "double"),
    ("vmax", "double"),
    ("x", "double"),
    ("y", "double"),
    ("z", "double"),
    ("vx", "double"),
    ("vy", "double"),
    ("vz", "double"),
    ("Jx", "double"),
    ("Jy", "double"),
    ("Jz", "double"),
    ("spin", "double"),
    ("BreadthFirstID", "long"),
    ("DepthFirstID", "long"),
    ("TreeRootID", "long"),
    ("OrigHaloID", "long"),
    ("snapnum", "int"),
    ("NextCoprogDepthFirstID", "long"),
    ("LastProgDepthFirstID", "long"),
    ("LastMainLeafDepthFirstID", "long"),
    ("TidalForce", "double"),
    ("TidalID", "long"),
    ("rs_klypin", "double"),
    ("mvir", "double"),
    ("m200b", "double"),
    ("m200c", "double"),
    ("mCustom2", "double"),
    ("mCustom", "double"),
    ("Xoff", "double"),
    ("Voff", "double"),
    ("spin_bullock", "double"),
    ("b_to_a", "double"),
    ("c_to_a", "double"),
    ("Ax", "double"),
    ("Ay", "double"),
    ("Az", "double"),
    ("b_to_a_500c", "double"),
    ("c_to_a_500c", "double"),
    ("Ax_500c", "double"),
    ("Ay_500c", "double"),
    ("Az_500c", "double"),
    ("TbyU", "double"),
    ("Mpe_Behroozi", "double"),
    ("Mpe_Diemer", "double"),
    ("halfmassradius", "double"),
    ("macc", "double"),
    ("mpeak", "double"),
    ("vacc", "double"),
    ("vpeak", "double"),
    ("halfmassscale", "double"),
    ("accrate_inst", "double"),
    ("accrate_100Myr", "double"),
    ("accrate_1tdyn", "double"),
    ("accrate_2tdyn", "double"),
    ("accrate_mpeak", "double"),
    ("acc_logvmax_inst", "double"),
    ("acc_logvmax_1tdyn", "double"),
    ("mpeakscale", "double"),
    ("accscale", "double"),
    ("firstaccscale", "double"),
    ("firstaccmvir", "double"),
    ("firstaccvmax", "double"),
    ("vmaxAtmpeak", "double"),
    ("TidalForce_tdyn", "double"),
    ("log(vmax/vmax_max(tdyn,tmpeak))", "double"),
    ("time_futmerg", "double"),
    ("futmerg_mmpid", "long"),
    ("spin_mpeakscale", "double"),
]
# The scales of the value-added columns.
TIDAL_SCALES = ("R2R200b", "R4R200b", "R6R200b", "R8R200b", "R2Mpch", "R3Mpch", "R5Mpch")
HESSIAN_SCALES = ("R3Mpch", "R5Mpch")
_TYPES = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType()}


def halo_schema() -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in HALO_COLUMNS])


def value_added_schema() -> T.StructType:
    names = [f"lam{i}_{s}" for s in TIDAL_SCALES for i in (1, 2, 3)] + [f"lamH{i}_{s}" for s in HESSIAN_SCALES for i in (1, 2, 3)]
    return T.StructType([T.StructField("ID", T.LongType()), *(T.StructField(n, T.DoubleType()) for n in names), T.StructField("b1", T.DoubleType())])


def tensor_schema() -> T.StructType:
    names = [f"tens{p}_{s}" for s in TIDAL_SCALES for p in ("11", "22", "33", "12", "13", "23")]
    return T.StructType([T.StructField("ID", T.LongType()), *(T.StructField(n, T.DoubleType()) for n in names)])


def fields(lines: DataFrame, schema: T.StructType, separator: str = "\\s+") -> DataFrame:
    """Typed columns of lines that don't begin with #; whole numbers may be written as floats."""
    parts = F.split(F.trim("value"), separator)

    def typed(n: int, field: T.StructField) -> Column:
        raw = F.get(F.col("__parts"), F.lit(n))
        whole = isinstance(field.dataType, (T.IntegerType, T.LongType))
        exact = raw.try_cast(field.dataType)
        return (F.coalesce(exact, raw.try_cast("double").cast(field.dataType)) if whole else exact).alias(field.name)

    kept = lines.where(~F.ltrim("value").startswith("#") & (F.trim("value") != "")).select(parts.alias("__parts"))
    return kept.select(*(typed(n, f) for n, f in enumerate(schema)))


def table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of columns between blanks, with # comments."""
    return fields(spark.read.text(path), schema)


def halos(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, halo_schema())


def value_added(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, value_added_schema())


def _doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def timeline(spark: SparkSession, path: str) -> DataFrame:
    """snapnum, scale and redshift z."""
    schema = T.StructType([T.StructField("snapnum", T.IntegerType()), T.StructField("scale", T.DoubleType())])
    return table(spark, path, schema).withColumn("z", 1 / F.col("scale") - 1)


def power_table(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, _doubles("k", "p_mm", "p_hh", "p_hm"))


def mass_function_table(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, _doubles("mass", "dndlnm_mvir", "dndlnm_m200b", "dndlnm_m200c"))


def transfer_table(spark: SparkSession, path: str) -> DataFrame:
    """k and p; a line of another number of columns is an error."""
    parts = F.size(F.split(F.trim("value"), "\\s+"))
    lines = spark.read.text(path).where(~F.ltrim("value").startswith("#") & (F.trim("value") != ""))
    checked = lines.select(F.when(parts == 2, F.col("value")).otherwise(F.raise_error(F.lit("a transfer table has two columns"))).cast("string").alias("value"))
    return fields(checked, _doubles("k", "p"))


def forests(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField("tree_root_id", T.LongType()), T.StructField("forest_id", T.LongType())])
    return table(spark, path, schema)


def configuration(spark: SparkSession, path: str) -> DataFrame:
    """key and value of ``KEY = VALUE`` lines."""
    parts = F.split(F.regexp_replace("value", "\\s*#.*$", ""), "\\s*=\\s*", 2)
    return spark.read.text(path).where(F.col("value").rlike("^\\s*\\w+\\s*=")).select(F.trim(parts[0]).alias("key"), F.trim(parts[1]).alias("value"))


def column_names(header: str) -> list[str]:
    """Names of a header line, without # and the (index) after each."""
    return [re.sub(r"\(\d+\)$", "", n) for n in header.lstrip("#").split()]


def snapshot_info(spark: SparkSession, path: str) -> DataFrame:
    """The header of a compressed snapshot, kept as JSON."""
    return spark.read.json(path, multiLine=True)
