"""Every text query with SQL against its SQL, on whole tables."""

import compare
import pytest

import __spark_entry__ as E
from gradeflow.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(small_dir):
    return compare.connect(small_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, small_dir, con, name):
    assert compare.difference(QUERIES[name](spark, small_dir), con, ORACLES[name]) is None


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in E.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(QUERIES) - set(ORACLES) == {"op1_best_fit_packing", "op6_simhash_near_dedup", "op7_mixing", "op9_token_counts", "op11_bpe"}


def odd_table(spark, name, rows, folder):
    """A table with clashing extra columns, nulls, blanks and repeated rows, as files."""
    path = f"{folder}/{name}.parquet"
    rows.write.parquet(path)
    return path


@pytest.mark.parametrize("name", ["op3_license_scan", "op4_substring_dedup", "op5_quality_rules", "op10_suffix_array_dedup"])
def test_odd_documents(spark, tmp_path, name):
    passage = " ".join(f"w{i}" for i in range(70))
    texts = [
        (1, None), (2, ""), (3, " \t\n\x0b "), (4, passage), (5, "before it " + passage + " and behind"), (6, "x " * 60),
        (7, passage[9:] + " " + passage), (8, "Licensed under CC BY-NC 4.0. MIT licence, mit  LICENSE"), (9, "Été apache license   gnu general PUBLIC license"),
        (10, "licensed under the really apache license version 2 0"), (11, "a\n a\na\n\na ** $$"), (12, "lone"), (13, "y" * 70000 + " z"),
        (14, " ".join(f"v{i}" for i in range(30000))),
    ]
    rows = spark.createDataFrame(
        [(i, t, "src", 0, 1.0) for i, t in texts], "doc_id long, text string, places string, n_words int, row double"
    )
    odd_table(spark, "documents", rows, tmp_path)
    con = __import__("duckdb").connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare.difference(QUERIES[name](spark, str(tmp_path)), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op3_license_scan", "op4_substring_dedup", "op5_quality_rules", "op10_suffix_array_dedup"])
def test_repeated_and_nameless_documents(spark, tmp_path, name):
    passage = " ".join(f"w{i}" for i in range(70))
    other = " ".join(f"v{i}" for i in range(80))
    texts = [(1, passage), (1, passage), (1, "mit license"), (None, passage + " x"), (None, None)]
    texts += [(None, other), (None, other), (None, "before " + other), (7, "y " + other), (7, "z " + other), (8, other + " lone " + other)]
    odd_table(spark, "documents", spark.createDataFrame(texts, "doc_id long, text string"), tmp_path)
    con = __import__("duckdb").connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare.difference(QUERIES[name](spark, str(tmp_path)), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op2_embedding_near_dedup", "op8_warc", "op12_centroid_clustering", "op13_vector_codes"}))
def test_empty_documents(spark, tmp_path, name):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0
