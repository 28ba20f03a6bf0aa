"""What is stored, shuffled and sorted keeps in step with the input."""

import os

import pytest

from gradeflow.catalog import streams
from gradeflow.operators import lookups as L
from gradeflow.plans import careers as C
from gradeflow.plans import fixtures as X
from gradeflow.sources.keyed import KeyedTable
from gradeflow.sources.scratch import BYTES_PER_PART, BYTES_PER_READ, sized
from gradeflow.streaming import messages as M

CAREERS = "map_program string, description string, career string"
GRADES = "srcode string, description string, grade_numeric double"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_follow_the_input_and_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError), sized(spark, 50 * BYTES_PER_PART - 1):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(BYTES_PER_READ)
        raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with sized(spark, 1):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_line_items_are_dealt_by_the_joins_alone(spark, small_dir):
    assert "REPARTITION_BY_NUM" not in plan(X.derive_raw_grades(spark, small_dir))


def test_messages_are_stored_compressed(spark, tmp_path):
    rows = [(i, "a text that many messages have") for i in range(2000)]
    sent = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    streams.send(M.to_messages(sent), f"{tmp_path}/in")
    stored = [f for f in os.listdir(f"{tmp_path}/in") if f.startswith("part-")]
    assert sum(os.path.getsize(f"{tmp_path}/in/{f}") for f in stored) < 2000 * 30
    read = M.parse_json_payload(spark.read.text(f"{tmp_path}/in"), sent.schema, "readable")
    assert sorted(map(tuple, read.collect())) == rows


def test_a_batch_meets_the_keyed_table_in_one_window(spark, tmp_path, monkeypatch):
    from gradeflow.sources import keyed

    plans = []
    real = keyed.write_parquet
    monkeypatch.setattr(keyed, "write_parquet", lambda df, *a, **k: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, *a, **k))
    batch = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id long, v string, ts long")
    table = KeyedTable(f"{tmp_path}/t", batch.schema, ["id"], ["ts"], buckets=4)
    table.merge(batch, "s", 0)
    table.merge(spark.createDataFrame([(1, "late", 0), (2, "d", 3), (2, "e", 2)], batch.schema), "s", 1)
    assert sorted(map(tuple, table.read(spark).collect())) == [(1, "b", 2), (2, "d", 3)]
    assert [p.count("Window [") for p in plans] == [1, 1]


def test_small_maps_are_broadcast_and_large_ones_joined(spark, monkeypatch):
    grades = spark.createDataFrame([("s", "c", 1.0), ("s", "x", 2.0), ("t", None, 1.0)], GRADES)
    maps = spark.createDataFrame([("P", "c", "a"), ("P", "c", "b"), ("Q", "c", "a"), ("Q", None, "a")], CAREERS).repartition(3)
    found = L.map_courses_to_careers(grades, maps)
    expected = [("s", "c", 1.0, "a", "P"), ("s", "c", 1.0, "a", "Q"), ("s", "c", 1.0, "b", "P")]
    assert sorted(map(tuple, found.collect())) == expected
    assert "Exchange hashpartitioning(description" not in plan(found)
    monkeypatch.setattr(L, "measured", lambda df: None)
    assert sorted(map(tuple, L.map_courses_to_careers(grades, maps).collect())) == expected


def test_career_keys_are_made_after_the_shuffle(spark, tmp_path, monkeypatch):
    made = []
    real = C.with_record_key
    monkeypatch.setattr(C, "with_record_key", lambda df, *a, **k: made.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, *a, **k))
    rows = spark.createDataFrame([("s", "c", 1.0, "a", "P"), ("s", "c", 1.0, "b", "Q")], f"{GRADES}, career string, map_program string")
    C.write_careers(rows, f"{tmp_path}/out")
    assert "RebalancePartitions" in made[0]
    assert spark.read.parquet(f"{tmp_path}/out").select("uuid").distinct().count() == 2
