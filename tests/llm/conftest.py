import pytest

duck = pytest.importorskip("duckdb")


@pytest.fixture(scope="session")
def docs(spark):
    """A frame of (doc_id, text, source, extra columns whose names clash with those that operators use)."""

    def make(rows, kind="doc_id long, text string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, kind)
        clash = {c: F.lit("clash") for c in ("id", "digest", "h", "h1", "n", "line", "rank", "block", "own", "th", "word", "key", "kept", "ranges", "payload", "host") if c not in df.columns}
        return df.withColumns(clash)

    return make
