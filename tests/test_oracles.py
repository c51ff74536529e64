"""Every registered query against its SQL counterpart on the small test tables."""

import os

import pytest

import __spark_entry__ as entry_point
from tests.compare import differences

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_matches_sql(spark, name):
    assert differences(spark, SF_DIR, entry_point.queries()[name], entry_point.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) - set(entry_point.oracle_sql())))
def test_runs(spark, name):
    assert entry_point.queries()[name](spark, SF_DIR).limit(1).count() == 1


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
