import duckdb
import pandas as pd
import pytest
from llm_helpers import SMALL

import __spark_entry__
from raremine.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.execute(queries.SQL[name]).df()
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    assert list(got.columns) == list(want.columns)
    norm = lambda df: sorted(tuple("null" if pd.isna(v) else str(v).removesuffix(".0") for v in r) for r in df.itertuples(index=False))
    assert norm(got) == norm(want)


def test_every_operator_is_registered():
    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)} and "pipeline" in names
