"""Many equal rows: work and memory in proportion, results as for one."""

import compare
import pytest

from gradeflow.llm import embeddings, simhash, substrings, suffixes, windows
from gradeflow.llm.queries import ORACLES


def words(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def equal_rows(spark, n):
    return spark.range(n).selectExpr("CAST(NULL AS long) AS doc_id", f"'{words('w', 120)}' AS text")


def places_gathered(df):
    return df.select("places").rdd.map(lambda r: sum(map(len, r.places or []))).sum()


@pytest.mark.parametrize("n", [500, 4000])
def test_places_grow_with_the_rows(spark, n):
    found = substrings.repeats(equal_rows(spark, n))
    assert found.count() == n
    assert places_gathered(found) == n * 86 * 4  # 86 windows of 35 words in 120


def test_twenty_thousand_equal_nameless_texts(spark):
    docs = equal_rows(spark, 20_000).repartition(16)
    digests = substrings.repeats(docs).select(substrings.digests(windows.F.col("text"), windows.F.col("places")).alias("d")).select("d.*")
    assert [(r.n_words, r.n_removed, r["count"]) for r in digests.groupBy("n_words", "n_removed").count().collect()] == [(120, 120, 20_000)]
    assert suffixes.spans(docs).collect() == []  # one document, however often
    assert suffixes.cleaned(docs).select("text").distinct().count() == 1
    more = docs.unionByName(spark.createDataFrame([(5, words("w", 120)), (None, "x " + words("w", 120))], docs.schema))
    assert [tuple(r) for r in suffixes.spans(more).orderBy("doc_id").collect()] == [(None, 0, 120, 120), (None, 1, 120, 120), (5, 0, 120, 0)]


def test_stage_keeps_every_distinct_document(spark, rows):
    a, b = words("a", 40), words("b", 40)
    docs = spark.createDataFrame(
        [(1, a, "x"), (1, b, "y"), (1, b, "x"), (2, a + " tail", "z"), (3, words("c", 40), "z"), (None, a, "p"), (None, a, "p"), (None, b, "q")],
        "doc_id long, text string, head string",
    )
    near = a.split()[:3]
    assert len(near) == 3
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    found = rows(kept, "doc_id", "text")
    assert (1, a) in found and (1, b) in found and (3, words("c", 40)) in found
    assert [t for i, t in found if i is None] == sorted([a, b]) and len([t for i, t in found if i == 1]) == 2


def test_vectors_that_share_an_id(spark, tmp_path):
    unit = [[1.0 if i == k else 0.0 for i in range(4)] for k in range(4)]
    near = [1.0, 0.05, 0.0, 0.0]
    data = [(1, unit[0], 1), (2, near, 1), (1, unit[1], 1), (3, unit[1], 1), (3, None, 1), (4, unit[2], 1), (4, unit[2], 2), (5, unit[2], 2), (2, unit[3], None), (6, unit[3], 1), (1, unit[0], 1)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    con = __import__("duckdb").connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert compare.difference(embeddings.near_duplicates(frame), con, ORACLES["op2_embedding_near_dedup"]) is None
