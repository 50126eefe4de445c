"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""

import os

import pytest

from docmart.plans import ORACLE_SQL, QUERIES
from docmart.plans.compare import compare

SF = os.environ.get("DOCMART_TEST_SF", "/root/testdata/sf0.001")


def test_registry_complete():
    import __spark_entry__ as E
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SF)
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["cols_match"] and r["types_match"] and r["hash_match"], r


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns[:5] == ["id", "part", "title", "description", "imdb_rating"]
    assert df.count() > 0
