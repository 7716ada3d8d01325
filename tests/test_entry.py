"""The registered queries: complete, and equal to their SQL on the small dataset."""

import glob
import os

import pytest

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
QUICK = [
    "merge_snapshot", "merge_snapshot_late", "merge_all_live", "merge_bulk", "merge_repeated_prior", "latest_changes",
    "table_status", "dropped_tables", "all_documents", "merge_counts", "dedup_snapshot", "extract_intrinsics",
    "iso_to_millis", "invalid_documents", "poll_dates", "update_id", "to_change_rows", "parse_envelopes",
    "scan_snapshot_lines", "generate_snapshot",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_its_sql():
    assert set(entry_points.QUERIES) == set(entry_points.ORACLES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_flagship(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["tbl", "k", "value", "origin"] and df.count() > 0


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, sql, name):
    df = entry_points.queries()[name](spark, SF)
    result = sql.execute(entry_points.oracle_sql()[name])
    want = comparable([c[0] for c in result.description], result.fetchall())
    assert comparable(df.columns, [tuple(r) for r in df.collect()]) == want
