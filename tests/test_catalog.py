"""Every catalog query against its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as contract
from alarmloom.operators import merge
from alarmloom.plans import catalog, oracles
from compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, tables, name):
    assert differences(spark, tables, QUERIES[name], ORACLES[name], SF_DIR) == []


def test_contract_registers_the_catalog():
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLES.items() <= contract.oracle_sql().items()


def test_comparison_notices_a_changed_row(spark, tables):
    wrong = ORACLES["route_messages"].replace("'transformation'", "'transformed'")
    assert differences(spark, tables, QUERIES["route_messages"], wrong, SF_DIR)


def test_entry_has_rows(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["uuid", "pid", "route", "type_label", "win", "date"]
    assert frame.limit(1).count() == 1


def test_batch_and_stream_merges_agree(spark):
    batch = QUERIES["merge_summary_gen2"](spark, SF_DIR)
    stream = QUERIES["merge_summary_stream"](spark, SF_DIR).select(batch.columns)
    assert batch.exceptAll(stream).isEmpty() and stream.exceptAll(batch).isEmpty()


def test_merge_invariants(spark):
    details = QUERIES["merge_detail_gen2"](spark, SF_DIR).cache()
    summaries = QUERIES["merge_summary_gen2"](spark, SF_DIR)
    assert summaries.selectExpr("sum(size)").first()[0] == details.count()
    assert details.select(*merge.KEYS).distinct().count() == summaries.count()
    linked = details.join(summaries.select("uuid"), details.pid == summaries.uuid, "left_anti")
    assert linked.isEmpty()
    details.unpersist()
