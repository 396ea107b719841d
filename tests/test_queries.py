import pytest
from oracle import SF_DIR, check

from docprep.plans.registry import ORACLE, QUERIES

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="needs the test tables")


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    check(spark, QUERIES[name], ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, str(SF_DIR)).count() > 0
