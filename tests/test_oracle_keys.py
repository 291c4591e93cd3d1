"""Every key with an oracle must match DuckDB on the sf0.001 tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck_connect

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_key_matches_oracle(spark, duck, key):
    res = compare(entry.queries()[key](spark, SF_SMALL), duck.sql(ORACLE[key]))
    assert res["columns_match"], res
    assert res["rows_match"], res
    assert res["values_match"], res


def test_every_key_has_a_builder():
    assert set(ORACLE) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["rank", "item_id", "title", "rating_count", "rating_mean", "popularity_score"]
