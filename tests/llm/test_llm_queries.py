"""The operators' queries against SQL, and the pipeline, on the smallest tables."""

import os
import re

import duckdb
import pandas as pd
import pytest

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")

from larkspan.llm import registry  # noqa: E402


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_oracle(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want, got = db.sql(registry.ORACLES[name]).df(), registry.QUERIES[name](spark, DIR).toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    rows = lambda df: sorted((tuple(None if pd.isna(x) else x for x in r) for r in df[columns].itertuples(index=False)), key=repr)
    assert rows(want) == rows(got)


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in registry.QUERIES) == list(range(1, 11))


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    from larkspan.llm import decontamination, exact_dedup, jaccard_join
    from larkspan.llm.common import written

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in p.STAGES[:-1]:
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        kept = written(stage(spark, kept, DIR), name)
        assert kept.columns == columns and {r.doc_id for r in kept.select("doc_id").collect()} <= before
    ids = {r.doc_id for r in kept.collect()}
    assert 0.6 * docs.count() < len(ids) < docs.count()
    assert exact_dedup.exact_dedup(kept).where("not kept").isEmpty()
    assert jaccard_join.jaccard_components(kept).where("doc_id <> component_id").isEmpty()
    assert decontamination.leaks(kept, spark.read.parquet(f"{DIR}/benchmark.parquet")).isEmpty()
    packed = p.STAGES[-1][1](spark, kept, DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids
    assert {r.doc_id for r in p.run(spark, DIR).select("doc_id").distinct().collect()} == ids


def test_stages_on_odd_and_empty_tables(spark, docs):
    import corpus_pipeline as p

    kind = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(None, "a b c d e f", None, None, None), (1, None, "en", "s", 0), (2, "", None, "s", 0), (3, "", "en", None, 0), (4, "a b c d e f", "en", "s", 11), (4, "a b c d e f", "en", "s", 11)]
    for rows in ([], odd):
        kept = docs(rows, kind)
        columns = kept.columns
        for _, stage in p.STAGES[:-1]:
            kept = stage(spark, kept, DIR)
            assert kept.columns == columns
        found = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
        assert found == ([(False, 1), (False, 4), (False, 4), (True, 0)] if rows else [])
        packed = p.STAGES[-1][1](spark, kept, DIR).collect()
        assert len(packed) == len(found)
