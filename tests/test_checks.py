"""Every registered query against its SQL, on the smallest tables."""

import pytest

from checks import CHECKS
from checks.run import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_equals_sql(spark, name):
    result, _, count = compare(spark, FOLDER, name)
    assert result in ("equal", "rows only")
    assert count > 0
