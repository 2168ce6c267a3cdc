import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from shapelens.llm.oracle import ORACLE
from shapelens.llm.queries import QUERIES
from tools.check_oracle import compare


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in pathlib.Path("/root/testdata/sf0.001").glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_rows(spark, duck, sf_dir, name):
    _, n, problem = compare(spark, duck, name, sf_dir)
    assert problem is None and n > 0


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
