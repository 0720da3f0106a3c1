import re

import pyarrow.parquet as pq
import pytest
from llm_helpers import SMALL
from test_decontaminate import brute as contaminated
from test_packing import check as check_packing
from test_pii import brute as personal
from test_quality import brute as measures
from test_simhash import fingerprint, groups

import corpus_pipeline
from raremine.llm import quality


@pytest.fixture(scope="module")
def stages(spark):
    """The documents that every stage left."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), "test")
        assert docs.columns == columns
        out.append(docs.collect())
    out.append(corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect())
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_names():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_quality_rules(stages):
    def kept(text):
        n, _, _, _, repeated, covered, longest = measures(text)
        return (n >= quality.MIN_WORDS and 100 * repeated <= 20 * n and covered <= quality.MAX_COVERED * n
                and longest <= quality.MAX_REPEAT_WORDS)
    assert ids(stages[1]) == sorted(r.doc_id for r in stages[0] if kept(r.text))
    assert set(stages[1]) <= set(stages[0])


def test_near_duplicates(stages):
    rows = stages[1]
    least = {}
    for r, g in zip(rows, groups([fingerprint(r.text) for r in rows], 3)):
        least[g] = min(r.doc_id, least.get(g, r.doc_id))
    assert ids(stages[2]) == sorted(least.values()) and set(stages[2]) <= set(rows)


def test_decontamination(stages):
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SMALL}/benchmark.parquet").to_pylist()]
    short = [r for r in stages[2] if len(r.text) < 3000]
    kept = {r.doc_id for r in stages[3]}
    for r in short:
        assert (r.doc_id in kept) == (not contaminated(r.text, items)[-1])
    assert set(stages[3]) <= set(stages[2]) and len(kept) < len(stages[2])


def test_personal_data(stages):
    before = {r.doc_id: r for r in stages[3]}
    assert ids(stages[4]) == sorted(before)
    changed = 0
    for r in stages[4]:
        old = before[r.doc_id]
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (old.lang, old.source)
        spans = [s for s in personal(old.text).split(",") if s]
        changed += bool(spans)
        if not spans:
            assert r.text == old.text
        assert personal(r.text) == "" and len(re.findall(r"\[(?:EMAIL|IP|CARD|PHONE)\]", r.text)) >= bool(spans)
    assert changed


def test_packing(stages, spark):
    rows = [(r.doc_id, r.text) for r in stages[4]]
    used, least = check_packing(stages[5], rows, 1024)
    assert used <= least * 1.02 + 2
    final = corpus_pipeline.run(spark, SMALL)
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in final.collect()} == {(r.doc_id, r.piece, r.ids_crc32) for r in stages[5]}
