import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from pulseboard.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.default.parallelism": "4",
        # Small inputs would be merged into one block, and the carry between blocks not tested.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SF


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con
