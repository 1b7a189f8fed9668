"""Every registered query against its DuckDB SQL (the driver's gate, locally)."""

from __future__ import annotations

import pytest

from oracle_compare import compare
from touchline.plans.catalog import QUERIES
from touchline.plans.oracle import ORACLE


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, name):
    result = compare(spark, sf_dir, name, QUERIES[name], ORACLE[name])
    assert result["columns_match"], result
    assert result["spark_rows"] == result["oracle_rows"], result
    assert result["values_match"], result


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    # Optional subpackages may add queries that SQL cannot express; the library's own all have SQL.
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
