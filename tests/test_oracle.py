"""Every catalog key that has a SQL twin: Spark result == DuckDB result
(row count, column names, order-insensitive values) on sf0.001."""

from decimal import Decimal

import pytest

from helpers import SMALL
from helpers import rows
from raremine.plans import catalog

KEYS = sorted(catalog.SQL)


def family(column):
    """Kind of the values of a result column: flag, number or other."""
    kinds = {type(v.item() if getattr(v, "ndim", 1) == 0 and hasattr(v, "item") else v) for v in column.dropna()}
    return {"bool"} if kinds <= {bool} and kinds else {"number"} if kinds <= {int, float, Decimal} and kinds else {"other"} if kinds else {"none"}


@pytest.mark.parametrize("key", KEYS)
def test_spark_equals_duckdb(spark, duck, key):
    sdf = catalog.QUERIES[key](spark, SMALL).toPandas()
    odf = duck.execute(catalog.SQL[key]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    cols = sorted(sdf.columns)
    assert len(sdf) == len(odf)
    assert rows(sdf, cols) == rows(odf, cols)
    assert {c: family(sdf[c]) for c in cols if len(sdf)} == {c: family(odf[c]) for c in cols if len(sdf)}


def test_every_oracle_key_is_a_query():
    assert set(catalog.SQL) <= set(catalog.QUERIES)
