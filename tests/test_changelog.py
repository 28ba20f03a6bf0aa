"""The versioned table: instants, reads, replays, retention, storage."""

import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gradeflow.operators import changelog as G
from gradeflow.sources import versioned as V

DAYS = ("2024-01-01", "2024-02-01", "2024-03-01")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("20230919095758730", "20230919095758730"),
        ("20230919095758", "20230919095758000"),
        ("2023-09-19 09:57:58.730", "20230919095758730"),
        ("2023-09-19 09:57:58.7", "20230919095758700"),
        ("2023-09-19 09:57:58", "20230919095758000"),
        ("2023-09-20", "20230920000000000"),
    ],
)
def test_instants(text, expected):
    assert G.parse_instant(text) == expected


@pytest.mark.parametrize("text", ["", "yesterday", "2023-13-01", "2023091909575", "2023-09-19T09:57"])
def test_bad_instants(text):
    with pytest.raises(ValueError):
        G.parse_instant(text)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, v string, ts int")


@pytest.fixture
def batches(spark):
    return [
        batch(spark, (1, "a1", 1), (2, "b1", 1), (2, "b0", 0)),
        batch(spark, (2, "b2", 2), (3, "c2", 2)),
        batch(spark, (3, "c3", 3), (4, "d3", 3)),
    ]


@pytest.fixture
def root(tmp_path, batches):
    for number, (df, day) in enumerate(zip(batches, DAYS)):
        V.write_commit(df, f"{tmp_path}/log", number, day, keys=["id"], order=["ts"])
    return f"{tmp_path}/log"


@pytest.fixture
def log(spark, root, batches):
    return V.read_log(spark, root, batches[0].schema)


def values(df):
    return sorted(r["v"] for r in df.collect())


def test_reads(log):
    assert values(G.snapshot(log)) == ["a1", "b2", "c3", "d3"]
    assert values(G.snapshot_as_of(log, "2024-01-31")) == ["a1", "b1"]
    assert values(G.snapshot_as_of(log, "2024-02-01")) == ["a1", "b2", "c2"]
    assert values(G.snapshot_as_of(log, "2023-12-31")) == []
    assert values(G.snapshot_as_of(log, DAYS[-1])) == values(G.snapshot(log))
    assert values(G.changes_since(log, DAYS[1])) == ["c3", "d3"]
    assert values(G.changes_since_first(log)) == ["b2", "c3", "d3"]


def test_a_commit_holds_one_version_per_key(log):
    assert log.where("v = 'b0'").count() == 0


def test_replay_replaces_its_own_batch(spark, root, batches, log):
    before = sorted(map(tuple, log.collect()))
    V.write_commit(batches[1], root, 1, DAYS[1], keys=["id"], order=["ts"])
    again = V.read_log(spark, root, batches[0].schema)
    assert sorted(map(tuple, again.collect())) == before


def test_replay_with_another_instant_leaves_no_copy(spark, root, batches):
    V.write_commit(batches[2], root, 2, "2024-03-02", keys=["id"], order=["ts"])
    log = V.read_log(spark, root, batches[0].schema)
    assert {r[0] for r in log.where("batch_id = 2").select("commit_time").collect()} == {
        "20240302000000000"
    }


def test_retention_keeps_what_recent_reads_need(log):
    kept = G.retain_commits(log, 2)
    assert values(kept) == ["a1", "b2", "c2", "c3", "d3"]
    for day in DAYS[1:]:
        assert values(G.snapshot_as_of(kept, day)) == values(G.snapshot_as_of(log, day))
    assert values(G.retain_commits(log, 1)) == values(G.snapshot(log))
    assert values(G.retain_commits(log, 9)) == values(log)


def test_compaction_to_a_new_place(spark, tmp_path, log, batches):
    V.compact(spark, G.retain_commits(log, 2), f"{tmp_path}/new")
    moved = V.read_log(spark, f"{tmp_path}/new", batches[0].schema)
    assert values(G.snapshot(moved)) == values(G.snapshot(log))
    assert moved.count() == 5


def test_upsert_does_not_depend_on_the_split(spark, batches):
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2])
    empty = whole.where("false")
    expected = values(G.upsert(empty, whole, ["id"], ["ts"]))
    step = empty
    for df in batches:
        step = G.upsert(step, df, ["id"], ["ts"])
    assert values(step) == expected == ["a1", "b2", "c3", "d3"]


def test_scope_makes_keys_unique_per_partition(spark):
    log = spark.createDataFrame(
        [("k", "1", "2020", "x"), ("k", "2", "2021", "y")],
        "record_key string, commit_time string, schoolyear string, v string",
    )
    assert values(G.snapshot(log)) == ["y"]
    assert values(G.snapshot(log, scope=["schoolyear"])) == ["x", "y"]


def test_ensure_log_creates_once_and_never_overwrites(spark, tmp_path, batches):
    root, schema = f"{tmp_path}/fresh", batches[0].schema
    assert V.ensure_log(spark, root, schema).count() == 0
    V.write_commit(batches[0], root, 0, DAYS[0], keys=["id"], order=["ts"])
    assert V.ensure_log(spark, root, schema).count() == 2
    assert V.ensure_log(spark, root, schema).count() == 2


def test_ensure_log_raises_what_it_cannot_read(spark, tmp_path, batches):
    path = tmp_path / "broken" / "batch_id=0"
    path.mkdir(parents=True)
    (path / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        V.ensure_log(spark, str(tmp_path / "broken"), batches[0].schema).count()
    assert (path / "part-0.parquet").read_text() == "not parquet"


def test_partition_columns_keep_their_type(spark, tmp_path, batches):
    df = batches[0].withColumn("schoolyear", F.lit("2005"))
    V.write_commit(df, f"{tmp_path}/p", 0, DAYS[0], keys=["id"], partition_by=["schoolyear"])
    row = V.read_log(spark, f"{tmp_path}/p", df.schema).first()
    assert row["schoolyear"] == "2005"


def test_missing_log_is_an_error_for_readers(spark, tmp_path, batches):
    with pytest.raises(AnalysisException):
        V.read_log(spark, f"{tmp_path}/none", batches[0].schema)


def test_composite_keys_are_unambiguous(spark):
    rows = [("a:b", "c"), ("a", "b:c"), ("a", None), (None, "a"), (None, None), ("", ""), ("-", "-")]
    df = spark.createDataFrame(rows, "x string, y string")
    keys = [r.record_key for r in G.commit_rows(df, "2024-01-01", ["x", "y"]).collect()]
    assert len(set(keys)) == len(rows)
    assert {r.record_key for r in G.commit_rows(df, "2024-01-01", ["x"]).collect()} == {"a:b", "a", None, "", "-"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reads_of_a_stored_log_skip_commits(spark, small_dir):
    from gradeflow.catalog import storage

    log, known = storage.repeating_log(spark, small_dir)
    assert "PartitionFilters: [isnotnull(commit_time" in plan_of(G.snapshot_as_of(log, "2024-02-15"))
    plan = plan_of(G.retain_commits(log, 2, known=known))
    filters = [line.split("PartitionFilters: ")[1].split("]")[0] for line in plan.splitlines() if "PartitionFilters" in line]
    assert len(filters) == 3 and [f"> {known[1]}" in f for f in filters].count(True) == 1
    assert [f"<= {known[1]}" in f for f in filters].count(True) == 2


def test_reads_start_from_the_newest_base(spark, root, batches):
    schema, days = batches[0].schema, [G.parse_instant(d) for d in DAYS]
    expected = {d: values(V.read_as_of(spark, root, schema, d)) for d in (*DAYS, "2024-01-31", "2024-02-20", "2023-12-31")}
    assert V.write_base(spark, root, schema, "2023-12-31") is None
    assert V.write_base(spark, root, schema, "2024-02-15") == days[1]
    assert V.base_times(spark, root) == [days[1]]
    assert {d: values(V.read_as_of(spark, root, schema, d)) for d in expected} == expected
    plan = V.read_as_of(spark, root, schema, DAYS[2])._jdf.queryExecution().optimizedPlan().toString()
    assert f"> {days[1]})" in plan and f"<= {days[2]})" in plan
    for number in (0, 1):
        shutil.rmtree(f"{root}/stream=direct/batch_id={number}")  # what the base replaces is not read
    assert values(V.read_as_of(spark, root, schema, DAYS[1])) == expected[DAYS[1]]
    assert values(V.read_as_of(spark, root, schema)) == expected[DAYS[2]]
    assert V.write_base(spark, root, schema) == days[2]  # from the base before it
    shutil.rmtree(f"{root}/_bases/as_of={days[1]}")
    assert values(V.read_as_of(spark, root, schema)) == expected[DAYS[2]]


def test_late_and_replayed_commits_drop_the_bases_that_lack_them(spark, root, batches):
    schema, days = batches[0].schema, [G.parse_instant(d) for d in DAYS]
    for day in days:
        V.write_base(spark, root, schema, day)
    V.write_commit(batch(spark, (2, "late", 9)), root, 7, "2024-02-10", keys=["id"], order=["ts"])
    assert V.base_times(spark, root) == days[:2]
    assert values(V.read_as_of(spark, root, schema)) == ["a1", "c3", "d3", "late"]
    # batch 0 again, later: what stood at its old instant is no longer true
    V.write_commit(batches[0], root, 0, "2024-04-01", keys=["id"], order=["ts"])
    assert V.base_times(spark, root) == []
    assert values(V.read_as_of(spark, root, schema, "2024-02-01")) == ["b2", "c2"]


def test_commits_are_known_without_a_job(spark, root, log):
    context, times = spark.sparkContext, [G.parse_instant(d) for d in DAYS]
    context.setJobGroup("listing", "listing")
    assert V.commit_times(spark, root) == times
    G.retain_commits(log, 2, known=times)
    G.changes_since_first(log, known=times)
    assert list(context.statusTracker().getJobIdsForGroup("listing")) == []
    context.setLocalProperty("spark.jobGroup.id", None)
    assert V.commit_times(spark, f"{root}/none") == []
    assert values(G.changes_since_first(log, known=times)) == values(G.changes_since_first(log))
    assert values(G.retain_commits(log, 2, known=times)) == values(G.retain_commits(log, 2))


def test_retention_keeps_equal_rows(spark, tmp_path):
    root = f"{tmp_path}/log"
    days = [batch(spark, (1, "x", 1), (1, "x", 1), (2, "y", 1), (None, "n", 1)), batch(spark, (2, "z", 2), (2, "z", 2), (3, "w", 2)), batch(spark, (3, "q", 3), (3, "q", 3), (None, "m", 3))]
    for number, (df, day) in enumerate(zip(days, DAYS)):
        V.write_commit(df, root, number, day, keys=["id"])
    log = V.read_log(spark, root, days[0].schema)
    assert values(G.retain_commits(log, 2)) == ["m", "n", "q", "q", "w", "x", "x", "z", "z"]
    assert values(G.retain_commits(log, 1)) == ["m", "q", "q", "x", "x", "z", "z"]
    ends = {(r.v, r.valid_until) for r in G.with_end(log).collect()}
    second, third = G.parse_instant(DAYS[1]), G.parse_instant(DAYS[2])
    assert ends == {("x", None), ("y", second), ("n", third), ("z", None), ("w", third), ("q", None), ("m", None)}
    assert G.with_end(log).count() == log.count()


def test_what_is_replaced_goes_last(spark, tmp_path):
    from gradeflow.sources import folders

    for name in ("new", "old"):
        (tmp_path / name).mkdir()
        (tmp_path / name / name).write_text(name)
    folders.replace(spark, f"{tmp_path}/new", f"{tmp_path}/old")
    assert [p.name for p in tmp_path.iterdir()] == ["old"] and [p.name for p in (tmp_path / "old").iterdir() if not p.name.startswith(".")] == ["new"]
    with pytest.raises(OSError):
        folders.replace(spark, f"{tmp_path}/none", f"{tmp_path}/old")
