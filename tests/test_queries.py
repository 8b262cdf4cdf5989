"""Catalogue queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from quernel.plans import catalogue

TABLES = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    return "NULL" if value is None else str(value)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{TABLES}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    ours = catalogue.queries()[name](spark, TABLES)
    columns = sorted(ours.columns)
    theirs = db.sql(catalogue.oracle_sql()[name])
    assert columns == sorted(theirs.columns)
    places = [theirs.columns.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in ours.collect()) == sorted(tuple(plain(r[i]) for i in places) for r in theirs.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_round_trip_queries(spark):
    rows = catalogue.queries()["bpe_roundtrip"](spark, TABLES).collect()
    assert rows and all(r.framed and r.same for r in rows)


def test_second_run_of_a_build_finds_nothing_new(spark):
    batch = {r.reason: r.documents for r in catalogue.queries()["corpus_funnel"](spark, TABLES).collect()}
    stream = {r.reason: r.documents for r in catalogue.queries()["resumable_build"](spark, TABLES).collect()}
    assert batch == stream
