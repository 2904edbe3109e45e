"""Every registered query against its check SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as contract
from modelyard.plans import catalog
from modelyard.sources.tables import table
from modelyard.sources.views import view
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_check_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, duck, name):
    ok, note = compare(spark, duck, SF_DIR, name)
    assert ok, note


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_document_is_a_context(spark):
    contexts = view(spark, SF_DIR, "samples").select("context").distinct()
    documents = table(spark, SF_DIR, "documents").select("text").distinct()
    assert documents.join(contexts, documents.text == contexts.context, "left_anti").count() == 0
