"""Every registered query of the library against its SQL in a second engine, at the smallest scale."""

import os

import duckdb
import pytest

from larkspan.plans.registry import FLAGSHIP, ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normalised(rows):
    def one(x):
        if hasattr(x, "tolist"):
            x = x.tolist()
        if isinstance(x, float):
            return None if x != x else round(x, 5) + 0.0
        return None if x is None or str(x) in ("NaT", "<NA>") else x

    return sorted((tuple(map(one, r)) for r in rows), key=repr)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")
@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_oracle(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want, got = db.sql(ORACLES[name]).df(), QUERIES[name](spark, DIR).toPandas()
    assert sorted(want.columns) == sorted(got.columns)
    columns = sorted(want.columns)
    assert normalised(want[columns].itertuples(index=False)) == normalised(got[columns].itertuples(index=False))


def test_wave_lengths_round_as_the_sql(spark, tmp_path):
    """Odd numbers of samples end in half a microsecond."""
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(n, n) for n in range(1, 5000, 2)] + [(5000, 0), (5001, None)], "doc_id long, n_chars long").coalesce(1).write.parquet(path)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    want = {r[0]: r[1] for r in db.sql(ORACLES["wave_lengths"]).fetchall()}
    assert {r.doc_id: r.seconds for r in QUERIES["wave_lengths"](spark, str(tmp_path)).collect()} == want


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES and f"{n}_quality" not in ORACLES])
def test_runs(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0


def test_entry_imports_without_subpackage(monkeypatch):
    import importlib
    import sys

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    sys.modules.pop("__spark_entry__", None)
    entry = importlib.import_module("__spark_entry__")
    assert FLAGSHIP in entry.queries() and "pipeline" not in entry.queries()
    sys.modules.pop("__spark_entry__", None)
