"""Every registered query of the library against DuckDB on the same tables."""

import pytest
from conftest import same

from helixframe.plans import registry


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, sf, name):
    same(registry.QUERIES[name](spark, sf), sf, registry.SQL[name])
