"""Every query against its SQL form on the smallest tables."""

import __spark_entry__ as contract
import pytest
from arrears.plans import catalog
from compare import difference, reference

from tests.conftest import SMALL

SQL = contract.oracle_sql()
MODELS = sorted(set(catalog.queries()) - set(SQL))


@pytest.fixture(scope="module")
def duck():
    return reference(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    found = contract.queries()[name](spark, SMALL).toPandas()
    assert len(found) > 0
    assert difference(found, duck.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", MODELS)
def test_model_query_gives_rows(spark, name):
    assert len(contract.queries()[name](spark, SMALL).toPandas()) > 0


def test_entry(spark):
    ranked = contract.entry(spark)
    assert ranked.count() > 0
    assert "priority_rank" in ranked.columns
