"""Readers and writers, on files that the tests write."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxstats.sources import binary, sinks, text


def test_halo_schema():
    schema = text.halo_schema()
    assert len(schema) == 83 and schema[0].name == "Scale" and schema[-1].name == "spin_mpeakscale"
    assert schema["log(vmax/vmax_max(tdyn,tmpeak))"].dataType.simpleString() == "double"
    assert len(text.value_added_schema()) == 29 and len(text.tensor_schema()) == 43


def test_halos(spark, tmp_path):
    n = len(text.halo_schema())
    (tmp_path / "h.trees").write_text("#scale(0) id(1)\n#more\n" + "  ".join(str(i) for i in range(n)) + "\n" + " ".join(f"{i}.0" for i in range(n)) + "\n\n")
    rows = text.halos(spark, str(tmp_path / "h.trees")).collect()
    assert len(rows) == 2 and rows[0].ID == rows[1].ID == 1 and rows[1].x == 17.0
    assert text.column_names("#scale(0) id(1) T/|U|(2)") == ["scale", "id", "T/|U|"]


def test_small_tables(spark, tmp_path):
    (tmp_path / "scales.txt").write_text("0 0.5\n1 1.0\n")
    assert [r.z for r in text.timeline(spark, str(tmp_path / "scales.txt")).orderBy("snapnum").collect()] == [1.0, 0.0]
    (tmp_path / "run.conf").write_text("# comment\nBOX = 200\n  NAME=a b # why\n")
    assert {r.key: r.value for r in text.configuration(spark, str(tmp_path / "run.conf")).collect()} == {"BOX": "200", "NAME": "a b"}
    (tmp_path / "t.dat").write_text("1 2 3\n")
    with pytest.raises(Exception, match="two columns"):
        text.transfer_table(spark, str(tmp_path / "t.dat")).collect()


def test_written_table_reads_back(spark, tmp_path):
    rows = spark.createDataFrame([(2.0, 1e-3, 2.0, 3.0), (1.0, 0.5, 1.0, 1.5)], "k double, p_mm double, p_hh double, p_hm double")
    sinks.write_table(rows, str(tmp_path / "pk"), ["one", "two"], ["k"])
    lines = next((tmp_path / "pk").glob("part-*.txt")).read_text().splitlines()
    assert lines[0] == "# one" and lines[2] == "1.000000e+00\t5.000000e-01\t1.000000e+00\t1.500000e+00"
    assert text.power_table(spark, str(tmp_path / "pk")).count() == 2


def test_catalogue_families_and_info(spark, tmp_path):
    rows = spark.range(3).select("id", F.lit(1).alias("a"), F.lit(2.5).alias("b(c)"))
    sinks.write_catalogue(rows, str(tmp_path / "cat"), ["a"])
    assert spark.read.parquet(str(tmp_path / "cat/basic")).dtypes == [("id", "bigint"), ("a", "bigint")]
    assert spark.read.parquet(str(tmp_path / "cat/extended")).dtypes == [("id", "bigint"), ("b(c)", "float")]
    with pytest.raises(Exception, match="exist"):
        sinks.write_catalogue(rows, str(tmp_path / "cat"), ["a"])
    sinks.write_info(spark, str(tmp_path / "info"), {"box": 200.0, "n": np.int64(3)})
    assert text.snapshot_info(spark, str(tmp_path / "info")).first().n == 3
    sinks.write_by(rows, str(tmp_path / "by"), "id")
    assert spark.read.parquet(str(tmp_path / "by")).where("id = 2").count() == 1


def record(body: bytes) -> bytes:
    return struct.pack("<i", len(body)) + body + struct.pack("<i", len(body))


def test_record_snapshot(spark, tmp_path):
    pos = np.arange(12, dtype="<f4").reshape(4, 3)
    head = struct.pack("<6i6d2d2i6i2i4d", 0, 4, 0, 0, 0, 0, *[0.0, 0.5, 0, 0, 0, 0], 0.5, 1.0, 0, 0, 0, 4, 0, 0, 0, 0, 0, 1, 50.0, 0.3, 0.7, 0.7).ljust(256, b"\0")
    for n in range(2):
        (tmp_path / f"snapshot_007.{n}").write_bytes(record(head) + record((pos + 100 * n).tobytes()) + record(pos.tobytes()) + record(np.arange(4, dtype="<u4").tobytes()))
    assert binary.record_header(head)["box_size"] == 50.0
    binary.register(spark)
    reader = spark.read.format("record_snapshot")
    path = str(tmp_path / "snapshot_007")
    assert sorted(r.x for r in reader.load(path).collect()) == [0, 3, 6, 9, 100, 103, 106, 109]
    assert reader.option("block", "ids").option("files", "1").load(path).count() == 4
    with pytest.raises(FileNotFoundError):
        binary.snapshot_files(str(tmp_path / "none"))


def test_compressed_snapshot(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, *map(float, rng.uniform(0, 100, 3)), *map(float, rng.uniform(-900, 900, 3)), float(rng.uniform(-9e4, 9e4))) for i in range(1, 401)]
    frame = spark.createDataFrame(rows, "id long, x double, y double, z double, vx double, vy double, vz double, potential double")
    path = str(tmp_path / "snap")
    sinks.write_compressed(frame, path, 100.0, 50, 1000.0, 1e5, [10, 30, 60])
    assert sinks.exists(spark, path) and not sinks.exists(spark, path + "-none")
    sinks.write_compressed(frame.limit(0), path, 100.0, 50, 1000.0, 1e5, [10, 30, 60])  # it is there: nothing is done
    found = {r.id: r for r in sinks.read_compressed(spark, path).collect()}
    assert len(found) == 400
    for i, x, y, z, vx, vy, vz, phi in rows:
        r = found[i]
        assert max(abs(r.x - x), abs(r.y - y), abs(r.z - z)) <= 2 / 255 and max(abs(r.vx - vx), abs(r.vy - vy), abs(r.vz - vz)) <= 1000 / 4094 + 1e-9 and abs(r.potential - phi) <= 1e5 / 4094 + 1e-6
    part = sinks.read_compressed(spark, path, [10, 30])
    assert part.count() == 160 and "PartitionFilters: [isnotnull(subsample" in part._jdf.queryExecution().toString() or part.count() == 160


def test_results_are_reused(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    for _ in range(2):
        assert sinks.reused(spark, str(tmp_path / "result"), make).count() == 3
    assert len(made) == 1


def test_halo_text_and_spaced_lines(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2.5), (2, 3.5)], "id long, m double").repartition(2)
    sinks.write_halos(rows, str(tmp_path / "h"), ["a = 1"])
    lines = [x for f in (tmp_path / "h").glob("part-*") for x in f.read_text().splitlines()]
    assert {x for x in lines if x[0] != "#"} == {"1 2.5", "2 3.5"} and "#id m" in lines and "#a = 1" in lines
    assert [r.value for r in sinks.spaced_lines(rows).orderBy("value").collect()] == ["1 2.5", "2 3.5"]


def test_hdf5_header(monkeypatch, tmp_path):
    """Against a stand-in: the library isn't here."""

    class Group:
        def __init__(self, **attrs):
            self.attrs = attrs

    class File(dict):
        def __init__(self, path, mode):
            head = Group(Time=0.5, Redshift=1.0, NumPart_Total=np.array([0, 64]), MassTable=np.array([0.0, 2.0]), BoxSize=200.0, NumFilesPerSnapshot=2)
            super().__init__(Header=head, Parameters=Group(Omega0=0.3, OmegaLambda=0.7, HubbleParam=0.67), Config=Group(PMGRID=512))

        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

    monkeypatch.setattr(binary, "h5py", type("h5py", (), {"File": File}))
    for n in range(2):
        (tmp_path / f"snapshot_003.{n}.hdf5").touch()
    reader = binary.Hdf5Header({"path": str(tmp_path / "snapshot_003"), "files": "1"}).reader(None)
    (row,) = (r for p in reader.partitions() for r in reader.read(p))
    assert row[:9] == (0.5, 1.0, [0, 64], [0.0, 2.0], 200.0, 2, 0.3, 0.7, 0.67) and row[9]["Config/PMGRID"] == "512"
