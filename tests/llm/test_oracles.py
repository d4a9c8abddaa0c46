"""Every query of this subpackage that has a DuckDB oracle, against it."""

import pytest

from compare import compare, duck
from skyfold.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, name):
    result = compare(queries.queries()[name](spark, SF), duck(SF), queries.oracle_sql()[name])
    assert result["hash_match"], result
