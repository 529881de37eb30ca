"""Every query against its SQL on DuckDB."""

import pytest

from workload.check import differences
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    assert differences(spark, name, SF_DIR) == []
