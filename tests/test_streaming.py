"""Streams: parsing, micro-batches, replays, restarts, metrics."""

import sqlite3

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeflow.columns import EMPLOYEES
from gradeflow.operators import changelog as G
from gradeflow.sources import relational as R
from gradeflow.sources.versioned import read_log
from gradeflow.streaming import batches as B
from gradeflow.streaming import messages as M

SCHEMA = (
    T.StructType()
    .add("id", T.LongType())
    .add("v", T.StringType())
    .add("n", T.IntegerType())
    .add("ts", T.IntegerType())
)
LINES = [
    '{"id": 1, "v": "a", "n": 1, "ts": 1}',
    '{"id": 2, "v": "b", "ts": 1}',
    "not json",
    '{"id": 3, "v": "c", "n": "x", "ts": 1}',
    '{"id": 4, "extra": true, "ts": 1}',
]


def lines(spark, texts=LINES):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_readable_rows_stay(spark):
    rows = M.parse_json_payload(lines(spark), SCHEMA, "readable").collect()
    assert [(r["id"], r["n"]) for r in rows] == [(1, 1), (2, None), (3, None), (4, None)]


def test_drop(spark):
    rows = M.parse_json_payload(lines(spark), SCHEMA, "drop").collect()
    assert [r["id"] for r in rows] == [1, 2, 4]


def test_message_columns_pass_the_parser(spark):
    sent = lines(spark).selectExpr("value", "7 AS partition", "length(value) AS offset")
    routed = M.parse_json_payload(sent, SCHEMA, "route", keep=["partition", "offset"])
    assert routed.columns[:3] == ["partition", "offset", "id"]
    assert [tuple(r) for r in M.bad(routed, ["partition", "offset"]).collect()] == [(7, 8, "not json")]
    assert M.good(routed, ["partition", "offset"]).count() == 4


def test_keep_leaves_a_row_for_every_message(spark):
    rows = M.parse_json_payload(lines(spark), SCHEMA, "keep").collect()
    assert len(rows) == 5
    assert tuple(rows[2]) == (None, None, None, None)


def test_route(spark):
    routed = M.parse_json_payload(lines(spark), SCHEMA)
    assert [r["id"] for r in M.good(routed).collect()] == [1, 2, 3, 4]
    assert [r[0] for r in M.bad(routed).collect()] == [LINES[2]]
    with pytest.raises(ValueError):
        M.parse_json_payload(lines(spark), SCHEMA, "ignore")


def test_messages_are_parsed_once(spark):
    parsed = M.parse_json_payload(lines(spark), SCHEMA).where("v <> 'x' AND n > 0")
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_binary_value_and_round_trip(spark):
    df = spark.createDataFrame([("7", "Ann", "d", "s", "1", "2", "3", "4")], EMPLOYEES)
    sent = M.to_messages(df).select(F.col("value").cast("binary").alias("value"))
    assert M.parse_json_payload(sent, EMPLOYEES, "readable").collect() == df.collect()


def test_kafka_options():
    options = M.kafka_options("h:9092", "t", max_offsets_per_trigger=50000, extra={"kafka.retries": "3"})
    assert options["kafka.retries"] == "3"
    assert options["subscribe"] == "t"
    assert options["maxOffsetsPerTrigger"] == "50000"
    assert options["failOnDataLoss"] == "false"


# -- micro-batches -----------------------------------------------------------
ROWS = [(i % 7, f"v{i}", i, i) for i in range(40)]
NEWEST = sorted((i % 7, f"v{i}") for i in range(33, 40))


def deliver(spark, path, rows):
    M.to_messages(spark.createDataFrame(rows, SCHEMA)).coalesce(1).write.mode("append").text(path)


def make_job(root, **more):
    return B.BatchJob(
        transform=lambda d: d.where("n >= 0"),
        log_root=f"{root}/log",
        keys=["id"],
        order=["ts", "v"],
        instant=lambda n: f"2024-01-01 00:00:{n:02d}",
        **more,
    )


def run(spark, root, job):
    stream = M.stream_source(spark, "text", {"maxFilesPerTrigger": "1"}, f"{root}/in")
    parsed = M.parse_json_payload(stream, SCHEMA)
    query = B.start_batches(parsed, job, f"{root}/checkpoint")
    B.drain(query)
    return query


def newest(spark, root):
    log = read_log(spark, f"{root}/log", SCHEMA)
    return sorted((r["id"], r["v"]) for r in G.snapshot(log, order=["ts", "v"]).collect())


@pytest.mark.parametrize("parts", [[40], [10, 30], [13, 1, 26]])
def test_result_does_not_depend_on_batches(spark, tmp_path, parts):
    seen, start = [], 0
    job = make_job(tmp_path, on_metrics=seen.append)
    for size in parts:
        deliver(spark, f"{tmp_path}/in", ROWS[start : start + size])
        start += size
    run(spark, tmp_path, job)
    assert [m.input_rows for m in seen] == parts
    assert newest(spark, tmp_path) == NEWEST


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    seen = []
    job = make_job(tmp_path, on_metrics=seen.append)
    for part in (ROWS[:15], ROWS[15:]):
        deliver(spark, f"{tmp_path}/in", part)
        run(spark, tmp_path, job)
    run(spark, tmp_path, job)
    assert [m.batch_id for m in seen] == [0, 1]
    assert newest(spark, tmp_path) == NEWEST


def test_replayed_batch_changes_nothing(spark, tmp_path):
    job = make_job(tmp_path)
    batch = spark.createDataFrame(ROWS, SCHEMA)
    job(batch, 0)
    before = sorted(map(tuple, read_log(spark, f"{tmp_path}/log", SCHEMA).collect()))
    job(batch, 0)
    assert sorted(map(tuple, read_log(spark, f"{tmp_path}/log", SCHEMA).collect())) == before


def test_another_checkpoint_keeps_the_batches_of_the_first(spark, tmp_path):
    job = make_job(tmp_path, metrics_root=f"{tmp_path}/metrics")
    deliver(spark, f"{tmp_path}/in", ROWS[:20])
    run(spark, tmp_path, job)
    deliver(spark, f"{tmp_path}/in", ROWS[20:])
    stream = M.stream_source(spark, "text", {}, f"{tmp_path}/in")
    B.drain(B.start_batches(M.parse_json_payload(stream, SCHEMA), job, f"{tmp_path}/other"))
    log = read_log(spark, f"{tmp_path}/log", SCHEMA)
    assert log.select("stream").distinct().count() == 2
    assert newest(spark, tmp_path) == NEWEST
    assert sorted(r.input_rows for r in B.read_metrics(spark, f"{tmp_path}/metrics").collect()) == [20, 40]


def test_failed_replay_keeps_the_old_batch(spark, tmp_path):
    job = make_job(tmp_path)
    job(spark.createDataFrame(ROWS, SCHEMA), 0)
    broken = spark.createDataFrame(ROWS, SCHEMA).withColumn("n", F.when(F.col("id") < 6, F.col("n")).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        job(broken, 0)
    assert newest(spark, tmp_path) == NEWEST


def test_metrics_of_many_batches(spark, tmp_path):
    from gradeflow.catalog.streams import _instant

    for batch in (0, 99, 100, 101, 1001, 1001):
        B.write_metrics(spark, str(tmp_path), "s", B.BatchMetrics(batch, batch, 1, 0.5, 2, 3))
    found = B.read_metrics(spark, str(tmp_path)).orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows, r.rejected_rows, r.damaged_rows) for r in found] == [(n, n, 2, 3) for n in (0, 99, 100, 101, 1001)]
    instants = [G.parse_instant(_instant(n)) for n in (0, 999, 1000, 1001, 100_000)]
    assert instants == sorted(set(instants))


def test_routed_batches_count_what_they_lose(spark, tmp_path):
    seen, lost = [], []
    job = make_job(tmp_path, on_metrics=seen.append, rejects=lambda df: lost.extend(r[0] for r in df.collect()))
    job(M.parse_json_payload(lines(spark), SCHEMA, "route"), 0)
    assert [(m.input_rows, m.rejected_rows, m.damaged_rows) for m in seen] == [(5, 1, 1)]
    assert lost == ["not json"]


def test_empty_batch_is_skipped(spark, tmp_path):
    seen = []
    job = make_job(tmp_path, on_metrics=seen.append)
    job(spark.createDataFrame([], SCHEMA), 0)
    assert seen == []
    assert not (tmp_path / "log").exists()


def test_sink_gets_the_rows_and_metrics_count_them(spark, tmp_path):
    path = str(tmp_path / "t.db")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE t (id INTEGER PRIMARY KEY, v TEXT, n INTEGER, ts INTEGER)")

    def connect():
        import sqlite3

        return sqlite3.connect(path, timeout=60)

    def sink(df):
        R.upsert_partitions(df, connect, "t", keys=["id"], order=["ts", "v"], placeholder="?")

    seen = []
    job = make_job(tmp_path, sinks=[sink], on_metrics=seen.append)
    rows = ROWS + [(99, "gone", -1, 1)]
    job(spark.createDataFrame(rows, SCHEMA), 0)
    with sqlite3.connect(path) as con:
        assert con.execute("SELECT id, v FROM t ORDER BY id").fetchall() == NEWEST
    assert [(m.input_rows, m.output_rows) for m in seen] == [(41, 40)]
    assert seen[0].rows_per_second > 0


def test_failures_are_raised_after_the_log_is_written(spark, tmp_path):
    def broken(df):
        raise RuntimeError("sink is down")

    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    job = make_job(tmp_path, sinks=[broken])
    with pytest.raises(RuntimeError, match="sink is down"):
        job(spark.createDataFrame(ROWS, SCHEMA), 0)
    assert newest(spark, tmp_path) == NEWEST
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def append(spark, root, texts, store=None, **more):
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(f"{root}/in")
    stream = M.stream_source(spark, "text", {"maxFilesPerTrigger": "1"}, f"{root}/in")
    query = B.start_append(M.parse_json_payload(stream, SCHEMA), f"{root}/out", f"{root}/checkpoint", **more)
    if store is not None:
        store.settled(query)
    B.drain(query)
    return query


def test_append_stream_and_progress(spark, tmp_path):
    deliver(spark, f"{tmp_path}/in", ROWS)
    query = append(spark, tmp_path, LINES, partition_by=["id"])
    assert B.read_appended(spark, f"{tmp_path}/out", SCHEMA).count() == 44
    assert sum(m.input_rows for m in B.progress(query)) == 45


def test_append_stream_keeps_what_it_cannot_read(spark, tmp_path):
    append(spark, tmp_path, LINES)
    append(spark, tmp_path, ["{", '{"id": 9}'])
    found = B.read_appended(spark, f"{tmp_path}/out", SCHEMA)
    assert sorted(r["id"] for r in found.collect()) == [1, 2, 3, 4, 9]
    assert sorted(r[0] for r in B.read_rejects(spark, f"{tmp_path}/out", SCHEMA).collect()) == [LINES[2], "{"]
    assert all("readable=true" in path for path in found.inputFiles()) or "readable" in str(found._jdf.queryExecution().optimizedPlan())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(readable" in plan


def test_progress_of_an_append_stream_is_stored_once_per_batch(spark, tmp_path):
    from gradeflow.streaming.progress import ProgressStore

    with ProgressStore(spark, f"{tmp_path}/metrics") as store:
        for texts in (LINES, ["{", '{"id": 9}'], ['{"id": 8}']):
            query = append(spark, tmp_path, texts, store)
        again = [e for e in query.recentProgress if e.numInputRows]
        store.onQueryProgress(type("Again", (), {"progress": again[-1]}))
    found = B.read_metrics(spark, f"{tmp_path}/metrics").orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows, r.rejected_rows, r.damaged_rows) for r in found] == [(0, 5, 1, 1), (1, 2, 1, 0), (2, 1, 0, 0)]
    assert {r.stream for r in found} == {str(query.id)}


def test_progress_that_cannot_be_stored_is_raised(spark, tmp_path):
    from gradeflow.streaming.progress import ProgressStore

    (tmp_path / "metrics").write_text("a file, not a folder")
    with ProgressStore(spark, f"{tmp_path}/metrics") as store, pytest.raises(Exception):
        append(spark, tmp_path, LINES, store)


def append_job(root, **more):
    return B.AppendJob(lambda d: d.where("ts >= 0"), f"{root}/out", rejects_root=f"{root}/rejects", **more)


REJECTS = T.StructType().add("corrupt_record", T.StringType())


def test_append_job_parses_once_and_loses_nothing(spark, tmp_path):
    seen = []
    routed = M.parse_json_payload(lines(spark), SCHEMA)
    parsed_rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            parsed_rows.add(batch.num_rows)
            yield batch

    job = append_job(tmp_path, on_metrics=seen.append)
    job(routed.mapInArrow(counted, routed.schema).where("id IS NULL OR id < 99"), 0)
    once = parsed_rows.value
    assert sorted(r["id"] for r in B.read_batches(spark, f"{tmp_path}/out", SCHEMA).collect()) == [1, 2, 3, 4]
    assert [r[0] for r in B.read_batches(spark, f"{tmp_path}/rejects", REJECTS).collect()] == [LINES[2]]
    assert [(m.input_rows, m.output_rows, m.rejected_rows, m.damaged_rows) for m in seen] == [(5, 4, 1, 1)]
    assert once <= 10  # a look whether there are rows at all, and one pass


def test_replayed_append_batch_replaces_both_its_outputs(spark, tmp_path):
    job = append_job(tmp_path, stream="s")
    job(M.parse_json_payload(lines(spark), SCHEMA), 0)
    job(M.parse_json_payload(lines(spark, [LINES[0], LINES[3]]), SCHEMA), 0)
    job(M.parse_json_payload(lines(spark, ["x"]), SCHEMA), 1)
    assert sorted(r["id"] for r in B.read_batches(spark, f"{tmp_path}/out", SCHEMA).collect()) == [1, 3]
    assert [r[0] for r in B.read_batches(spark, f"{tmp_path}/rejects", REJECTS).collect()] == ["x"]


def test_interval_trigger(spark, tmp_path):
    deliver(spark, f"{tmp_path}/in", ROWS)
    stream = M.stream_source(spark, "text", {}, f"{tmp_path}/in")
    job = make_job(tmp_path)
    query = B.start_batches(
        M.parse_json_payload(stream, SCHEMA), job, f"{tmp_path}/checkpoint", every="0 seconds"
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert newest(spark, tmp_path) == NEWEST
