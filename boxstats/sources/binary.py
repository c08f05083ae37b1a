"""Snapshots in binary: HDF5 (if h5py is there) and the older record format.

Both are Python data sources: a partition for each file, the column block chosen by an option,
and rows handed over as Arrow batches.
"""

from __future__ import annotations

import glob
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

try:
    import h5py
except ImportError:  # only the HDF5 source needs it
    h5py = None

BLOCKS = {
    "pos": ("Coordinates", "x float, y float, z float"),
    "vel": ("Velocities", "vx float, vy float, vz float"),
    "ids": ("ParticleIDs", "id long"),
    "potential": ("Potential", "potential float"),
}
HEADER = "time double, redshift double, npart array<long>, mass_table array<double>, box_size double, num_files int, omega0 double, omega_lambda double, hubble double"
ROWS = 1 << 16


def snapshot_files(path: str, suffix: str = ".hdf5") -> list[str]:
    """The files of a snapshot: one, numbered ones, or those in its folder."""
    name = os.path.basename(path)
    folder = os.path.join(os.path.dirname(path), name.replace("snapshot", "snapdir"), name)
    for pattern in (path + suffix, f"{path}.[0-9]*{suffix}", folder + suffix, f"{folder}.[0-9]*{suffix}"):
        if found := sorted(glob.glob(pattern), key=lambda f: (len(f), f)):
            return found
    raise FileNotFoundError(f"no snapshot at {path}")


class _Files(DataSourceReader):
    def __init__(self, options: dict[str, str], suffix: str):
        self.options = options
        files = snapshot_files(options["path"], suffix)
        chosen = options.get("files")
        self.files = [files[int(n)] for n in chosen.split(",")] if chosen else files

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for f in self.files]


def _batches(columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c[at : at + ROWS])) for c in columns], names)


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


class Hdf5Reader(_Files):
    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if h5py is None:
            raise ImportError("the HDF5 source needs h5py")
        block, ddl = BLOCKS[self.options.get("block", "pos")]
        with h5py.File(partition.value, "r") as f:
            data = f[f"PartType{self.options.get('type', '1')}/{block}"]
            scale = float(np.sqrt(f["Header"].attrs["Time"])) if block == "Velocities" and self.options.get("physicalvelocities") == "true" else 1
            for at in range(0, len(data), ROWS):
                part = data[at : at + ROWS]
                columns = [part[:, i] * np.float32(scale) for i in range(3)] if part.ndim == 2 else [part.astype(np.int64) if block == "ParticleIDs" else part]
                yield from _batches(columns, _names(ddl))


class Hdf5HeaderReader(_Files):
    """One row a file, of the attributes that ``HEADER`` names and of all of Config, Header and
    Parameters as text."""

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if h5py is None:
            raise ImportError("the HDF5 source needs h5py")
        with h5py.File(partition.value, "r") as f:
            groups = {g: dict(f[g].attrs) for g in ("Config", "Header", "Parameters") if g in f}
            head, more = groups["Header"], groups.get("Parameters", {})
            told = {f"{g}/{k}": str(v) for g, attrs in groups.items() for k, v in attrs.items()}
            whole = lambda v, kind: [kind(x) for x in np.atleast_1d(v)]
            yield (
                float(head["Time"]), float(head["Redshift"]), whole(head["NumPart_Total"], int), whole(head["MassTable"], float), float(head["BoxSize"]), int(head["NumFilesPerSnapshot"]),
                *(float(more[k] if k in more else head[k]) for k in ("Omega0", "OmegaLambda", "HubbleParam")), told,
            )


class Hdf5Header(DataSource):
    """``format("hdf5_header")``: options path and files (numbers between commas)."""

    @classmethod
    def name(cls) -> str:
        return "hdf5_header"

    def schema(self) -> str:
        return f"{HEADER}, attributes map<string,string>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return Hdf5HeaderReader({k.lower(): v for k, v in self.options.items()}, ".hdf5")


class Hdf5Snapshot(DataSource):
    """``format("hdf5_snapshot")``: options path, block (pos, vel, ids, potential), type, files (numbers
    between commas), physicalVelocities."""

    @classmethod
    def name(cls) -> str:
        return "hdf5_snapshot"

    def schema(self) -> str:
        return BLOCKS[self.options.get("block", "pos")][1]

    def reader(self, schema: StructType) -> DataSourceReader:
        return Hdf5Reader({k.lower(): v for k, v in self.options.items()}, ".hdf5")


def read_record(f) -> bytes:
    """One record between its two lengths."""
    (size,) = struct.unpack("<i", f.read(4))
    body = f.read(size)
    if struct.unpack("<i", f.read(4))[0] != size:
        raise ValueError("a record's lengths differ")
    return body


def record_header(body: bytes) -> dict:
    """The 256 bytes at the head of a record file."""
    npart = struct.unpack_from("<6i", body, 0)
    masses = struct.unpack_from("<6d", body, 24)
    time, redshift = struct.unpack_from("<2d", body, 72)
    total = struct.unpack_from("<6i", body, 96)
    (files,) = struct.unpack_from("<i", body, 124)
    box, om, ol, h = struct.unpack_from("<4d", body, 128)
    return {"npart": npart, "mass_table": masses, "time": time, "redshift": redshift, "total": total, "num_files": files, "box_size": box, "omega0": om, "omega_lambda": ol, "hubble": h}


class RecordReader(_Files):
    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        block = self.options.get("block", "pos")
        with open(partition.value, "rb") as f:
            read_record(f)
            bodies = {b: read_record(f) for b in ("pos", "vel", "ids")[: ("pos", "vel", "ids").index(block) + 1]}
        if block == "ids":
            columns = [np.frombuffer(bodies["ids"], "<u4").astype(np.int64)]
        else:
            columns = list(np.frombuffer(bodies[block], "<f4").reshape(-1, 3).T)
        yield from _batches(columns, _names(BLOCKS[block][1]))


class RecordSnapshot(DataSource):
    """``format("record_snapshot")``: options path, block (pos, vel, ids), files."""

    @classmethod
    def name(cls) -> str:
        return "record_snapshot"

    def schema(self) -> str:
        return BLOCKS[self.options.get("block", "pos")][1]

    def reader(self, schema: StructType) -> DataSourceReader:
        return RecordReader({k.lower(): v for k, v in self.options.items()}, "")


def register(spark) -> None:
    spark.dataSource.register(Hdf5Header)
    spark.dataSource.register(Hdf5Snapshot)
    spark.dataSource.register(RecordSnapshot)
