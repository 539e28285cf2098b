"""Every registered query against its SQL on another engine."""

from __future__ import annotations

import os

import oracle_check
import pytest

from tagpulse.plans.catalog import QUERIES
from tagpulse.plans.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")


@pytest.fixture(scope="module")
def engine():
    connection = oracle_check.connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, engine):
    assert oracle_check.differences(QUERIES[name](spark, SF_DIR), engine, ORACLE[name]) is None
