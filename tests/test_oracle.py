"""Registered queries against DuckDB on the smallest tables; set ORACLE_ALL=1 for every query."""

import os
import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare

QUICK = [
    "s1_select_topics", "s2a_sample_topics", "s2b_sample_topics_per_partition", "s6_schema_registry_lookup", "f1_is_avro_message",
    "f5_split_broken", "f6_split_invalid", "f8_rowkey_range_week", "p1_extract_envelope", "p4_json_paths", "p7_flatten_typed",
    "a1_distinct_events", "a6_distinct_structures", "a9_topic_report", "a10_event_type_report", "a11_day_count", "a12_pivot_parameters",
    "d1_view_drift",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in pathlib.Path("/root/testdata/sf0.001").glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", list(entry.oracle_sql()) if os.environ.get("ORACLE_ALL") else QUICK)
def test_same_rows(spark, duck, sf_dir, name):
    _, n, problem = compare(spark, duck, name, sf_dir)
    assert problem is None and n > 0


def test_every_query_has_a_statement():
    from shapelens.plans.queries import QUERIES

    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
