import pytest

from aislewise.llm.queries import QUERIES, SQL
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture
def against_sql(spark):
    """Differences between a registered query and its SQL on the smallest tables."""
    return lambda name: compare(spark, connect(SF), SF, QUERIES[name], SQL[name])
