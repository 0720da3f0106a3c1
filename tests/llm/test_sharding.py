import zlib
from collections import Counter

import numpy as np
import pytest

from raremine.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 65, 1000, 4097])
def test_permutation_is_a_bijection_with_inverse(n):
    p = sharding.permute(np.arange(n), n)
    assert sorted(p) == list(range(n))
    assert (sharding.permute(p, n, inverse=True) == np.arange(n)).all()
    assert n < 64 or (p != sharding.permute(np.arange(n), n, seed=7)).any()


def test_rows_are_even_gapless_and_reproducible(docs, rows):
    out = sharding.shard_documents(docs, 40).collect()
    assert len(out) == len(rows)
    per = Counter(r.shard for r in out)
    assert max(per.values()) - min(per.values()) <= 1 and set(per) <= set(range(40))
    for s in per:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(per[s]))
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
    again = sharding.shard_documents(docs.repartition(2), 40).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    at = sharding.row_of([r.shard for r in out], [r.slot for r in out], 40, len(out))
    assert [r.row_number for r in out] == at.tolist()


def test_order_is_mixed():
    p = sharding.permute(np.arange(10_000), 10_000)
    assert abs(np.corrcoef(np.arange(10_000), p)[0, 1]) < 0.05
    assert np.bincount(p[:5000] % 40).min() > 80


def test_many_copies_and_empty(spark, empty):
    same = spark.createDataFrame([(None, None)] * 500 + [(1, "a")] * 3, "doc_id long, text string")
    out = sharding.shard_documents(same, 7).collect()
    assert sorted(r.row_number for r in out) == list(range(503))
    assert sharding.shard_documents(empty, 7).count() == 0
