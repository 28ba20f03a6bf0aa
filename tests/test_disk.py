"""The disk holds the shuffles of one pass, and what is stored is compressed."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeflow.catalog import QUERIES, streams
from gradeflow.plans import careers as C
from gradeflow.plans import fixtures as X
from gradeflow.sources import scratch
from gradeflow.sources import versioned as V
from gradeflow.sources.keyed import KeyedTable
from gradeflow.streaming import batches as B
from gradeflow.streaming import messages as M

CAREERS = "srcode string, description string, grade_numeric double, career string, map_program string"


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in blocks.mkString("\n").split("\n") if "/shuffle_" in name}


def left_behind(spark, before, seconds=10):
    """How many shuffles are on disk that were not ``before``, once their deletion had its time.

    Spark deletes them in the background and, seldom, leaves one until its next collection.
    """
    until = time.time() + seconds
    while len(new := {name.rsplit("/shuffle_")[1].split("_")[0] for name in shuffle_files(spark) - before}) > 1 and time.time() < until:
        time.sleep(0.2)
    return len(new)


def rows_of(df):
    return sorted(map(str, df.collect()))


# -- F1 -----------------------------------------------------------------------
def test_careers_are_written_in_passes_that_leave_no_shuffle(spark, tmp_path, monkeypatch):
    students = [None, *(f"s{i}" for i in range(40))]
    rows = [(s, "c", 1.0, career, program) for s in students for career in "ab" for program in "PQ" for _ in range(2)]
    careers = spark.createDataFrame(rows, CAREERS)
    C.write_careers(careers, f"{tmp_path}/whole")
    monkeypatch.setattr(C, "ROWS_PER_PASS", 60)
    before, advisory = shuffle_files(spark), spark.conf.get(scratch.ADVISORY)
    C.write_careers(careers, f"{tmp_path}/passes")
    assert left_behind(spark, before) <= 1
    assert spark.conf.get(scratch.ADVISORY) == advisory
    assert rows_of(spark.read.parquet(f"{tmp_path}/passes")) == rows_of(spark.read.parquet(f"{tmp_path}/whole"))
    assert len(os.listdir(f"{tmp_path}/passes/map_program=P")) > len(os.listdir(f"{tmp_path}/whole/map_program=P"))
    C.write_careers(careers.where("false"), f"{tmp_path}/none")
    C.write_careers(careers.limit(1), f"{tmp_path}/passes")  # takes the old tables' place
    assert spark.read.parquet(f"{tmp_path}/passes").count() == 1


def test_passes_hold_every_row_once(spark):
    rows = spark.createDataFrame([(i % 7 or None, str(i % 3)) for i in range(100)], "a int, b string")
    found = [rows.where(scratch.in_pass(["a", "b"], n, 4)) for n in range(4)]
    assert sorted(map(str, (r for f in found for r in f.collect()))) == rows_of(rows)
    keys = [r for f in found for r in f.select("a", "b").distinct().collect()]
    assert len(keys) == len(set(keys)) == rows.distinct().count()
    assert [scratch.passes(x) for x in (0, scratch.BYTES_PER_PASS, scratch.BYTES_PER_PASS + 1)] == [1, 1, 2]


# -- F4 to F11, F13 to F17, F19 -----------------------------------------------
@pytest.mark.parametrize(
    "name",
    [
        "log_snapshot", "log_as_of", "log_incremental", "log_validity", "log_retain", "log_composite_key", "upsert_latest", "stream_append",
        "stream_append_losses", "stream_upsert", "batch_metrics", "stream_arrival_order", "stream_processed",
    ],
)
def test_several_passes_give_the_rows_of_one(spark, small_dir, monkeypatch, name):
    once = rows_of(QUERIES[name](spark, small_dir))
    monkeypatch.setattr(scratch, "BYTES_PER_PASS", X.source_bytes(spark, small_dir) // 3 + 1)
    monkeypatch.setattr(X, "_STORED", {k: v for k, v in X._STORED.items() if k[0] == "raw-grades"})
    assert X.passes(spark, small_dir) == 3
    before = shuffle_files(spark)
    several = QUERIES[name](spark, small_dir)
    assert left_behind(spark, before) <= 1
    assert once and rows_of(several) == once


def test_a_commit_in_passes_keeps_one_row_per_key(spark, tmp_path):
    batch = spark.createDataFrame([(i % 9 or None, i % 2, i) for i in range(60)], "a int, b int, ts int")
    for passes in (1, 4):
        V.write_commit(batch, f"{tmp_path}/{passes}", 0, "2024-01-01", keys=["a", "b"], order=["ts"], partition_by=["b"], passes=passes)
    logs = [V.read_log(spark, f"{tmp_path}/{p}", batch.schema) for p in (1, 4)]
    assert rows_of(logs[0]) == rows_of(logs[1]) and logs[1].count() == 18
    assert sorted(os.listdir(f"{tmp_path}/4")) == sorted(os.listdir(f"{tmp_path}/1"))  # no part stays behind
    V.write_commit(batch.where("false"), f"{tmp_path}/4", 1, "2024-01-02", keys=["a"], passes=4)
    assert V.read_log(spark, f"{tmp_path}/4", batch.schema).count() == 18


def test_a_keyed_table_takes_its_buckets_in_passes(spark, tmp_path):
    first = spark.createDataFrame([(i % 30, i, i) for i in range(90)], "id int, v int, ts int")
    second = spark.createDataFrame([(i, -i, 50 + i) for i in range(40)], first.schema)
    tables = [KeyedTable(f"{tmp_path}/{p}", first.schema, ["id"], ["ts", "v"], buckets=7) for p in (1, 3)]
    for table, passes in zip(tables, (1, 3)):
        assert table.merge(first, "s", 0, passes) and table.merge(second, "s", 1, passes)
        assert not table.merge(second, "s", 1, passes)
        assert table.merge(first.where("false"), "s", 2, passes)
    assert rows_of(tables[0].read(spark)) == rows_of(tables[1].read(spark))
    assert tables[1].read(spark).count() == 40


def test_a_large_batch_is_counted_once_and_its_rejects_are_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("".join(f'{{"id": {i}, "p": "{i % 3}"}}\n' for i in range(50)) + "spoilt\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("p", T.StringType())])
    routed = M.parse_json_payload(M.stream_source(spark, "text", {}, f"{tmp_path}/in"), schema)
    job = B.AppendJob(
        lambda d: d, f"{tmp_path}/out", partition_by=["p"], rejects_root=f"{tmp_path}/lost", metrics_root=f"{tmp_path}/m", passes=3
    )
    B.drain(B.start_batches(routed, job, f"{tmp_path}/checkpoint"))
    assert sorted(r.id for r in B.read_batches(spark, f"{tmp_path}/out", schema).collect()) == list(range(50))
    lost = T.StructType([T.StructField(M.CORRUPT, T.StringType())])
    assert [r[0] for r in B.read_batches(spark, f"{tmp_path}/lost", lost).collect()] == ["spoilt"]
    assert B.read_metrics(spark, f"{tmp_path}/m").select("input_rows", "output_rows", "rejected_rows").collect() == [(51, 50, 1)]
    assert not [d for d in os.listdir(tmp_path / "out") if d.startswith("_waiting")]


# -- F12, F18, and the messages of F7 to F9, F11, F14, F16, F17, F19 ----------
@pytest.mark.parametrize("name", ["csv_roundtrip", "json_roundtrip"])
def test_text_files_are_stored_small(spark, small_dir, name):
    rows = QUERIES[name](spark, small_dir)
    stored = [p.removeprefix("file:") for p in rows.inputFiles()]
    assert stored and all(p.endswith(".gz") for p in stored)
    assert sum(map(os.path.getsize, stored)) < rows.count() * 120


def test_messages_take_a_seventh_of_their_text(spark, small_dir, tmp_path):
    messages = M.to_messages(streams.records(spark, small_dir)).coalesce(1)
    streams.send(messages, f"{tmp_path}/in")
    size = sum(p.stat().st_size for p in (tmp_path / "in").glob("part-*"))
    assert size * 7 < messages.agg(F.sum(F.octet_length("value"))).first()[0]
    assert rows_of(spark.read.text(f"{tmp_path}/in")) == rows_of(messages)


def test_settings_are_put_back(spark):
    before = spark.conf.get(scratch.CLEANUP, None)
    with scratch.sized(spark, 1):
        assert spark.conf.get(scratch.CLEANUP) == "true"
    assert spark.conf.get(scratch.CLEANUP, None) == before
