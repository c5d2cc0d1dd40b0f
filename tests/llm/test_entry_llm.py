"""The subpackage's queries against their SQL, on the smallest tables."""

import pytest

from rawscan.llm import registry
from tests.test_entry import SF, duck, needs_data, table_of  # noqa: F401


@needs_data
@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):  # noqa: F811
    df = registry.queries()[name](spark, SF)
    found = duck.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert table_of(df.columns, df.collect()) == table_of(columns, found.fetchall())
