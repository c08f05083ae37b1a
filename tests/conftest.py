import os
import sys
from pathlib import Path

import pandas as pd
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for path in Path(DATA).glob("*.parquet"):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    return con


def same(found, expected) -> None:
    """Equal rows in any order, by column name."""
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)

    def rows(frame):
        frame = frame[columns].astype(object)
        return sorted(repr([None if pd.isna(x) else float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x for x in row]) for row in frame.itertuples(index=False))

    assert rows(found) == rows(expected)


@pytest.fixture(scope="session")
def compare():
    return same
