import duckdb
import pytest


@pytest.fixture(scope="session")
def rows():
    """The rows of a query that pandas-free Python can compare: a sorted list of tuples."""

    def of(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)

    return of


@pytest.fixture(scope="session")
def documents(small_dir):
    return duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{small_dir}/documents.parquet')").fetchall()
