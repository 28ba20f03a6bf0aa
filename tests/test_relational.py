"""Upserts and tables in embedded databases."""

import sqlite3
import uuid

import pytest

from gradeflow.catalog.storage import database
from gradeflow.sources import relational as R
from gradeflow.sources import tables as T


def rows(spark, *data):
    return spark.createDataFrame(list(data), "id long, name string, college string, ts int")


@pytest.fixture
def sqlite_path(tmp_path):
    path = str(tmp_path / "t.db")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE t (id INTEGER PRIMARY KEY, name TEXT, college TEXT, ts INTEGER)")
    return path


def connector(path):
    def connect():
        import sqlite3

        return sqlite3.connect(path, timeout=60)

    return connect


def stored(path):
    with sqlite3.connect(path) as con:
        return con.execute("SELECT * FROM t ORDER BY id").fetchall()


def test_upsert_partitions(spark, sqlite_path):
    put = dict(table="t", keys=["id"], order=["ts"], placeholder="?", batch_size=2)
    first = rows(spark, (1, "a", "x", 1), (2, "b", "x", 1), (2, "b0", "x", 0), (3, "c", "x", 1))
    R.upsert_partitions(first, connector(sqlite_path), **put)
    second = rows(spark, (2, "b2", "y", 2), (4, "d", "y", 2))
    for _ in range(2):  # a repeat changes nothing
        R.upsert_partitions(second.repartition(3), connector(sqlite_path), connections=2, **put)
    assert stored(sqlite_path) == [
        (1, "a", "x", 1), (2, "b2", "y", 2), (3, "c", "x", 1), (4, "d", "y", 2),
    ]


def test_upsert_raises(spark, sqlite_path):
    with pytest.raises(Exception, match="no such table"):
        R.upsert_partitions(
            rows(spark, (1, "a", "x", 1)), connector(sqlite_path), "missing",
            keys=["id"], order=["ts"], placeholder="?",
        )


def test_stage_and_merge(spark):
    url, properties = database(spark)
    table = f"t{uuid.uuid4().hex[:8]}"
    execute = R.jvm_execute(spark, url, properties)
    first = rows(spark, (1, "a", "x", 1), (2, "b", "x", 1), (2, "b0", "x", 0))
    R.create_keyed_table(spark, url, table, properties, execute, first.schema, ["id"])
    second = rows(spark, (2, "b2", "y", 2), (4, None, "y", 2))
    for batch in (first, second, second):
        R.stage_and_merge(
            batch, url, table, properties, execute, keys=["id"], order=["ts"]
        )
    found = T.read_jdbc(spark, url, table, properties, partition_column="id", partitions=3)
    assert found.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, found.collect())) == [
        (1, "a", "x", 1), (2, "b2", "y", 2), (4, None, "y", 2),
    ]


def test_empty_table_reads_as_empty(spark):
    url, properties = database(spark)
    table = f"t{uuid.uuid4().hex[:8]}"
    T.write_jdbc(rows(spark).where("false"), url, table, properties, mode="overwrite")
    assert T.read_jdbc(spark, url, table, properties, partition_column="id", partitions=4).count() == 0


def test_conflict_statement_updates_every_other_column():
    text = R.conflict_statement("t", "s", ["id", "a", "college"], ["id"])
    assert 'ON CONFLICT ("id") DO UPDATE SET "a" = EXCLUDED."a", "college" = EXCLUDED."college"' in text
    assert R.conflict_statement("t", "s", ["id"], ["id"]).endswith("DO NOTHING")


def test_conflict_statement_runs(sqlite_path):
    with sqlite3.connect(sqlite_path) as con:
        con.execute("CREATE TABLE s (id INTEGER, name TEXT, college TEXT, ts INTEGER)")
        con.execute("INSERT INTO t VALUES (1, 'a', 'x', 1)")
        con.executemany("INSERT INTO s VALUES (?, ?, ?, ?)", [(1, "z", "y", 2), (2, "b", "y", 2)])
        con.execute(R.conflict_statement("t", "s", ["id", "name", "college", "ts"], ["id"]))
    assert stored(sqlite_path) == [(1, "z", "y", 2), (2, "b", "y", 2)]


def test_files_keep_spaces_nulls_and_quotes(spark, tmp_path):
    df = rows(spark, (1, " a ", None, 1), (2, 'say "hi", x', "y", None))
    T.write_csv(df, f"{tmp_path}/c", single_file=True)
    T.write_json(df, f"{tmp_path}/j")
    expected = sorted(map(tuple, df.collect()))
    assert sorted(map(tuple, T.read_csv(spark, f"{tmp_path}/c", df.schema).collect())) == expected
    assert sorted(map(tuple, T.read_json(spark, f"{tmp_path}/j", df.schema).collect())) == expected
    assert dict(T.read_csv(spark, f"{tmp_path}/c").dtypes)["id"] == "int"


def test_career_files_and_program_list(spark, tmp_path):
    (tmp_path / "A.json").write_text(
        '{\n "program": "A",\n "courses": [\n  {"course": "c", "careers": ["x", "y"]}\n ]\n}'
    )
    maps = T.read_career_maps(spark, str(tmp_path))
    assert maps.first()["courses"][0]["careers"] == ["x", "y"]
    (tmp_path / "p.csv").write_text("program_id,program\n1,Bachelor of  Arts\n")
    assert T.read_programs(spark, f"{tmp_path}/p.csv").collect() == [(1, "Bachelor of  Arts")]
