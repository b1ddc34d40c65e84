"""Every registered query agrees with its SQL; those of the training-data operators have tests of their own."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from tracklayer.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    assert compare(spark, db, contract.queries()[name], contract.oracle_sql()[name], SF_DIR) > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["PK", "CT_COL"]
    assert df.count() > 0
