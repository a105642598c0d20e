"""Every registered query beside its SQL, at the smallest scale factor."""

import pytest

import __spark_entry__ as repo
from playledger.testbed.oracle import ORACLE
from playledger.testbed.queries import QUERIES
from tools.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_names_agree():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(repo.queries())
    assert set(repo.oracle_sql()) <= set(repo.queries())


def test_entry(spark):
    df = repo.entry(spark)
    assert df.columns[:4] == ["as_of", "section_no", "section", "rank"]
    assert df.count() == 30


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, db, name):
    assert differences(repo.queries()[name](spark, SF_DIR), db.sql(repo.oracle_sql()[name])) == []
