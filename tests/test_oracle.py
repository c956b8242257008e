"""Every registered query against its SQL, on the smallest driver tables."""
import os

import pytest

import __spark_entry__ as entry
from compare import difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert difference(entry.queries()[name](spark, SF), SF, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
