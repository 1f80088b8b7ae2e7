import os

import duckdb
import pytest

TABLES = ["documents", "embeddings", "labels"]
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables not present")
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text, lang, source, n_chars) to a documents table; missing fields are null."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def make(rows):
        full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        return spark.createDataFrame(full, schema)

    return make
