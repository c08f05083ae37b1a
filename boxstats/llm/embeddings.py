"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors of one label are compared by cosine in double precision. They are turned into principal
axes, so that the leading dimensions carry most of a product. A tile holds two blocks of vectors;
it multiplies the leading dimensions of all pairs at once, adds for the rest at most the product
of the two suffix norms, and goes on only with the pairs that can still reach the threshold,
some dimensions at a time, until they fail or the whole product is known. Vectors whose first
coordinates are further apart than linked vectors can be don't meet in any tile.

Equal vectors of a label are one class and are compared once. Large labels are dealt into blocks
by counts made before the shuffle, so no label is gathered in one task. A tile hands on the sum
of links of each vector and a forest of its links, never the pairs. The axes are fitted on a
bounded sample; they decide in which order products are added up, not what links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxstats.llm import store
from boxstats.llm.components import components
from boxstats.llm.forest import forest

#: Vectors in a block; a tile compares two of them.
BLOCK = 1024
#: Vectors of each dimension that the axes are fitted on, and dimensions that have axes.
SAMPLE, FITTED = 4096, 8
#: Products are added up in steps that end at these dimensions (then doubling).
FIRST_STEP = 8
#: Room for rounding; pairs this close to the threshold are multiplied anew as they are given.
SLACK = 1e-9


def axes(vectors: np.ndarray) -> np.ndarray:
    """Columns: orthonormal axes of the unit vectors, the largest variance first."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    _, axes_ = np.linalg.eigh(unit.T @ unit)
    return axes_[:, ::-1]


def valid(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def linked(left: np.ndarray, right: np.ndarray, basis: np.ndarray | None, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of the pairs whose cosine reaches the threshold; i < j if both blocks
    are the same."""
    scaled = [x / np.abs(x).max(axis=1, keepdims=True) for x in (left, right)]  # no overflow of squares
    unit = [x / np.linalg.norm(x, axis=1, keepdims=True) for x in scaled]
    a, b = unit if basis is None else [x @ basis for x in unit]
    dims = a.shape[1]
    rest = [np.sqrt(np.maximum(np.cumsum(x[:, ::-1] ** 2, axis=1)[:, ::-1], 0)) for x in (a, b)]
    suffix = [np.concatenate((r, np.zeros((len(r), 1))), axis=1) for r in rest]
    at = min(FIRST_STEP, dims)
    sums = a[:, :at] @ b[:, :at].T
    alive = sums + np.outer(suffix[0][:, at], suffix[1][:, at]) >= threshold - SLACK
    if same:
        alive = np.triu(alive, 1)
    i, j = np.nonzero(alive)
    sums = sums[i, j]
    while at < dims and len(i):
        to = min(2 * at, dims)
        sums = sums + np.einsum("ij,ij->i", a[i, at:to], b[j, at:to])
        good = sums + suffix[0][i, to] * suffix[1][j, to] >= threshold - SLACK
        i, j, sums, at = i[good], j[good], sums[good], to
    close = np.flatnonzero(np.abs(sums - threshold) <= SLACK)
    if len(close):
        u, v = scaled[0][i[close]], scaled[1][j[close]]
        sums[close] = np.einsum("ij,ij->i", u, v) / np.sqrt(np.einsum("ij,ij->i", u, u) * np.einsum("ij,ij->i", v, v))
    good = sums >= threshold
    return i[good], j[good]


def _cells(bases: dict[int, np.ndarray], width: float):
    """Adds the cell of the first coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for vector in batch.column("vector"):
                x = vector.values.to_numpy(zero_copy_only=False)
                x = x / np.abs(x).max()
                first = x @ bases[len(x)][:, 0] if len(x) in bases else x[0]
                cells.append(int(np.floor(first / np.linalg.norm(x) / width)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], [*batch.schema.names, "cell"])

    return run


_KEY = ("label", "dims", "cell", "strip", "step", "other")


def _compare(bases: dict[int, np.ndarray], threshold: float):
    def tile(rows: pa.Table, out: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        dims = rows.column("dims")[0].as_py()
        side = rows.column("side").to_numpy()
        same = bool((side == 2).any())
        lefts = np.flatnonzero(side != 1)
        rights = lefts if same else np.flatnonzero(side == 1)
        if not len(rights) or not len(lefts):
            return
        flat = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(side), dims)
        cid, n = rows.column("cid").to_numpy(), rows.column("copies").to_numpy()
        i, j = linked(flat[lefts], flat[rights], bases.get(dims), threshold, same)
        if len(i):
            i, j = lefts[i], rights[j]
            ones = np.concatenate((i, j))
            counts = np.bincount(ones, weights=n[np.concatenate((j, i))].astype(float), minlength=len(side)).astype(np.int64)
            some = np.flatnonzero(counts)
            out.append((cid[some], cid[some], counts[some]))
            x, y = forest(cid[i], cid[j])
            out.append((x, y, np.zeros(len(x), np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            starts = _starts(held)
            if len(starts) > 1:
                yield from tiles(held, starts)
                held = held.slice(starts[-1])
        if held is not None and held.num_rows:
            yield from tiles(held, [*_starts(held), held.num_rows])

    def tiles(table: pa.Table, starts: list[int]) -> Iterator[pa.RecordBatch]:
        out: list = []
        for a, b in zip(starts, starts[1:], strict=False):
            tile(table.slice(a, b - a), out)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["a", "b", "n"])

    return run


def _starts(table: pa.Table) -> list[int]:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in _KEY:
        column = table.column(key).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new).tolist()


def _tiles(own: str, above: str, below: str) -> Column:
    """The tiles of a row of strip ``strip`` among ``own`` strips of its cell, with the strips
    of the next cells above and below: (left cell, left strip, cells to the right, right strip,
    side: 0 left, 1 right, 2 both)."""
    cell, strip = F.col("cell"), F.col("strip")

    def made(upto: Column, from_: Column, make) -> Column:
        return F.when(upto >= from_, F.transform(F.sequence(from_, upto), make)).otherwise(F.array())

    def row(c, s, step, other, side) -> Column:
        return F.struct(c.alias("tile_cell"), s.alias("tile_strip"), F.lit(step).alias("step"), other.alias("other"), F.lit(side).alias("side"))

    zero = F.lit(0)
    return F.concat(
        F.array(row(cell, strip, 0, strip, 2)),
        made(F.col(own) - 1, strip + 1, lambda t: row(cell, strip, 0, t, 0)),
        made(strip - 1, zero, lambda u: row(cell, u, 0, strip, 1)),
        made(F.col(above) - 1, zero, lambda t: row(cell, strip, 1, t, 0)),
        made(F.col(below) - 1, zero, lambda u: row(cell - 1, u, 1, strip, 1)),
    )


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (the smallest vec_id
    connected by links, its own included) and kept (vec_id = component_id) of every row.

    Two vectors link if their labels are equal and not null, they are of one length, and their
    cosine is at least ``threshold`` (above 0). Defined cases: null, empty or zero vectors and
    those with null or non-finite components link with nothing, not even their copies; repeated
    rows link as copies do; a null id doesn't name a component (a component of null ids alone
    has null, and kept is false); an empty table gives none; other columns are not looked at.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    spark = vectors.sparkSession
    vector = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector"), F.col(label_column).cast("long").alias("label"))
    able = rows.where(F.col("label").isNotNull() & valid(F.col("vector")))
    classes = able.groupBy("label", "vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = store.keep(classes.select(F.monotonically_increasing_id().alias("cid"), "label", F.size("vector").alias("dims"), "vector", "copies", "least"), "embedding-classes")

    bases = {}
    for dims, _ in classes.groupBy("dims").count().orderBy(F.desc("count"), "dims").limit(FITTED).collect():
        some = classes.where(F.col("dims") == dims).orderBy(F.xxhash64("cid")).limit(SAMPLE).select("vector").collect()
        bases[dims] = axes(np.array([r[0] for r in some]))
    width = float(np.sqrt(2 - 2 * threshold)) + 1e-6
    fields = "cid long, label long, dims int, vector array<double>, copies long, cell int"
    celled = classes.select("cid", "label", "dims", "vector", "copies").mapInArrow(_cells(bases, width), fields)
    near = Window.partitionBy("label", "dims").orderBy("cell")
    sizes = celled.groupBy("label", "dims", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("own"))
    above = F.when(F.lead("cell").over(near) == F.col("cell") + 1, F.lead("own").over(near))
    below = F.when(F.lag("cell").over(near) == F.col("cell") - 1, F.lag("own").over(near))
    sizes = store.keep(sizes.select("label", "dims", "cell", "own", F.coalesce(above, F.lit(0)).alias("above"), F.coalesce(below, F.lit(0)).alias("below")), "embedding-cells")
    dealt = celled.join(sizes, ["label", "dims", "cell"]).withColumn("strip", F.pmod(F.xxhash64("cid"), "own").cast("int"))
    tiled = dealt.select("label", "dims", "cid", "copies", "vector", F.inline(_tiles("own", "above", "below")))
    tiled = tiled.withColumnsRenamed({"tile_cell": "cell", "tile_strip": "strip"})
    tiled = tiled.repartition(*_KEY).sortWithinPartitions(*_KEY)
    found = store.keep(tiled.mapInArrow(_compare(bases, threshold), "a long, b long, n long"), "embedding-links")

    counts = found.groupBy("a").agg(F.sum("n").alias("others"))
    stars = store.keep(components(found.where("a <> b")), "embedding-stars")
    named = classes.join(stars.withColumnRenamed("id", "cid"), "cid", "left").select("cid", "label", "vector", "copies", "least", F.coalesce("component_id", "cid").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(least, "root").join(counts, F.col("cid") == F.col("a"), "left")
    named = named.select("label", "vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component")
    out = rows.withColumn("able", F.col("label").isNotNull() & valid(F.col("vector"))).withColumn("key", F.when(F.col("able"), F.col("vector")))
    named = named.withColumnRenamed("vector", "key")
    joined = out.join(named, ["label", "key"], "left")
    component = F.when(F.col("able"), F.col("component")).otherwise(F.col("vec_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
