"""Keys without a SQL twin (ML fits, searches, UDF stemming): they run on the
driver tables, return rows, and their figures lie where such figures can."""

import math

import pytest

from helpers import SMALL
from raremine.plans import catalog

KEYS = sorted(set(catalog.QUERIES) - set(catalog.SQL))
SHARES = ("f1", "precision", "recall", "auc", "accuracy", "explained")


@pytest.mark.parametrize("key", KEYS)
def test_runs(spark, key):
    out = catalog.QUERIES[key](spark, SMALL).toPandas()
    assert len(out) > 0 and len(out.columns) > 0 and out.notna().any().all()
    for c in out.columns:
        values = [v for v in out[c] if isinstance(v, float) and not math.isnan(v)]
        if c in ("prediction", "label"):
            assert set(values) <= {0.0, 1.0}
        if any(c == s or c.endswith("_" + s) for s in SHARES):
            assert all(-1e-9 <= v <= 1 + 1e-9 for v in values)


def test_stems_follow_the_words(spark):
    out = catalog.QUERIES["text_stem_join"](spark, SMALL).toPandas().set_index("doc_id")["stemmed"]
    words = catalog.QUERIES["str_split_ws"](spark, SMALL).toPandas().set_index("doc_id")["n_words"]
    assert {k: len(v.split()) for k, v in out.items()} == words.to_dict()
