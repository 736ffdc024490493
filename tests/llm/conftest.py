import pytest

from tessera.llm.common import ship_package

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def table(spark):
    """Rows of (doc_id, text[, source]) as a documents table with a clashing extra column."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] else 0, 7, True) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS + ", n int, kept boolean")
        return df.repartition(parts) if rows else df
    return make
