"""Every registered query against its SQL in DuckDB."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    frame = registry.queries()[name](spark, SF_DIR)
    wanted = db.sql(registry.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(wanted.columns)
    got = rows_by_name(frame.columns, [tuple(r) for r in frame.collect()])
    assert got == rows_by_name(wanted.columns, wanted.fetchall())


def test_every_query_has_sql():
    own = {name for name in registry.queries() if name.startswith("q_")}
    assert own and own <= set(registry.oracle_sql()) <= set(registry.queries())


# Row counts at sf0.01, worked out beforehand by two engines.
COUNTS = {
    "q_start_events": 1982,
    "q_end_events": 1981,
    "q_correlated": 3963,
    "q_finished_events": 242,
    "q_starts_without_end": 1734,
    "q_ends_without_start": 1739,
    "q_kpi_violations": 91,
    "q_documents_latest": 228,
    "q_finished_per_trace": 228,
    "q_open_per_trace": 1546,
    "q_orphans_per_trace": 1562,
    "q_alarms": 20,
    "q_phases": 254,
    "q_resolve_pending": 68,
    "q_still_pending": 866,
    "q_unresolved_ends": 857,
}


@pytest.mark.parametrize("name", sorted(COUNTS))
def test_known_counts(spark, name):
    assert registry.queries()[name](spark, "/root/testdata/sf0.01").count() == COUNTS[name]


def test_entry(spark):
    assert sum(r.matches for r in registry.entry(spark).collect()) == 18
