import os

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Rows (doc_id, text[, lang, source]) as a documents table with a clashing extra column."""
    def build(rows, extra="key string, ld_drop int, n_words int"):
        full = [((*r, None, None)[:4]) for r in rows]
        data = [(*r, len(r[1]) if r[1] else 0, "x", 1, -1) for r in full]
        return spark.createDataFrame(data, DOCS + ", " + extra)
    return build


@pytest.fixture(scope="session")
def documents():
    """Rows of the smallest documents table, and its folder."""
    import duckdb
    sf = os.environ.get("LLM_TEST_DIR", "/root/testdata/sf0.001")
    return sf, duckdb.connect().execute(f"select doc_id, text, lang, source from '{sf}/documents.parquet' order by 1").fetchall()
