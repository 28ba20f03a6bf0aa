"""Lookups and joins: right with hot keys, and split when keys are hot."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from gradeflow.operators import joins as J
from gradeflow.operators import lookups as L
from gradeflow.operators import students as S

HOT = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, some under NULL, the rest spread out."""
    return spark.range(3 * HOT).repartition(40).select(
        F.when(F.col("id") < HOT, F.lit("hot"))
        .when(F.col("id") < HOT + 500, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 700))
        .alias("program"),
        F.col("id").alias("n"),
    )


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.range(650).select(
        F.when(F.col("id") == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), F.col("id")))
        .alias("program"),
        F.col("id").cast("int").alias("program_id"),
    )


def counted(df):
    return Counter(tuple(r) for r in df.select("program", "n", "program_id").collect())


@pytest.mark.parametrize("how", ["left", "inner"])
def test_split_join_equals_plain_join(skewed, dimension, how):
    plain = counted(skewed.join(dimension, "program", how))
    split = J.split_join(skewed, dimension, ["program"], how, rows_per_split=100)
    assert counted(split) == plain


def test_split_join_spreads_the_hot_key(spark, skewed, dimension):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    adaptive = "spark.sql.adaptive.enabled"
    before = spark.conf.get(setting), spark.conf.get(adaptive)
    try:
        spark.conf.set(setting, "-1")
        spark.conf.set(adaptive, "false")
        split = J.split_join(skewed, dimension, ["program"], rows_per_split=100)
        per_task = (
            split.where("program = 'hot' OR program IS NULL")
            .groupBy("program", F.spark_partition_id().alias("task"))
            .count()
            .collect()
        )
    finally:
        spark.conf.set(setting, before[0])
        spark.conf.set(adaptive, before[1])
    assert len([r for r in per_task if r["program"] == "hot"]) >= 6
    assert max(r["count"] for r in per_task if r["program"] == "hot") < HOT / 2
    assert len([r for r in per_task if r["program"] is None]) >= 6


def test_split_join_separates_equal_rows(spark, dimension):
    rows = spark.range(20_000).repartition(40).select(F.lit("hot").alias("program"), F.lit(1).alias("n"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        split = J.split_join(rows, dimension.hint("merge"), ["program"], rows_per_split=1000)
        per_task = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sum(per_task) == 20_000 and len(per_task) >= 6 and max(per_task) < 10_000


@pytest.mark.parametrize("at_rest", [False, True])
def test_split_join_parts_a_key_that_one_partition_holds(spark, tmp_path, dimension, at_rest):
    """All rows of the hot key come out of one shuffle partition, or lie in one file."""
    rows = spark.range(20_000).select(F.lit("hot").alias("program"), F.col("id").alias("n")).repartition(8, "program")
    if at_rest:
        rows.where("n >= 0").coalesce(1).write.parquet(f"{tmp_path}/rows")
        rows = spark.read.parquet(f"{tmp_path}/rows")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        split = J.split_join(rows, dimension, ["program"], rows_per_split=1000, at_rest=at_rest)
        assert "__part" in split._jdf.queryExecution().executedPlan().toString()
        per_task = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
        assert split.select("n").distinct().count() == 20_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(per_task) == 20_000 and len(per_task) >= 6 and max(per_task) < 10_000


def test_wide_rows_are_not_fetched_to_be_measured(spark, monkeypatch):
    """Of a table far beyond the bound, the driver gets what fits and one row more."""
    fetched = []
    wide = spark.range(500).select("id", F.repeat(F.lit("x"), 10_000).alias("text"))
    real = type(wide).toArrow
    monkeypatch.setattr(type(wide), "toArrow", lambda df: fetched.append(real(df)) or fetched[-1])
    assert J.measured(wide, max_bytes=50_000) is None
    assert fetched[0].num_rows <= 6
    assert J.measured(wide.limit(3), max_bytes=50_000).count() == 3
    assert J.measured(wide.where("false")).count() == 0


def test_maps_of_one_program_are_told_apart_by_file(spark, tmp_path):
    from gradeflow.plans import careers as C
    from gradeflow.sources.tables import read_career_maps

    for name, career in (("BSIT-2018", "x"), ("BSIT-2022", "y")):
        (tmp_path / f"{name}.json").write_text(f'{{"program": "BSIT", "courses": [\n{{"course": "c", "careers": ["{career}", "z"]}}]}}')
    maps = read_career_maps(spark, str(tmp_path), by_file=True)
    found = sorted(map(tuple, L.explode_career_maps(maps).collect()))
    assert found == [("BSIT", f, "c", c) for f, c in (("BSIT-2018", "x"), ("BSIT-2018", "z"), ("BSIT-2022", "y"), ("BSIT-2022", "z"))]
    grades = spark.createDataFrame([("s1", "c", 1.0)], "srcode string, description string, grade_numeric double")
    C.write_careers(C.all_careers(grades, maps), f"{tmp_path}/out")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["map_file=BSIT-2018", "map_file=BSIT-2022"]
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.map_file, r.career) for r in stored.collect()) == [(f, c) for _, f, _, c in found]
    assert stored.groupBy("map_file", "uuid").count().where("count > 1").count() == 0
    assert C.program_careers(grades, maps, "BSIT").columns == ["srcode", "description", "grade_numeric", "career"]


def test_dimension_is_computed_once(spark, skewed, dimension):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            seen.add(1)
            yield row

    counting = spark.createDataFrame(dimension.rdd.mapPartitions(count), dimension.schema)
    J.lookup(skewed, counting, "program").collect()
    assert seen.value == 650


def test_measured_counts_nested_columns(spark):
    nested = spark.range(10).select(F.array_repeat(F.lit("x" * 100), 1000).alias("a"))
    assert not J.fits_broadcast(nested, max_bytes=500_000) and J.fits_broadcast(nested)


def test_split_join_refuses_other_joins(skewed, dimension):
    with pytest.raises(ValueError):
        J.split_join(skewed, dimension, ["program"], "full")


def test_lookup_measures_before_it_broadcasts(skewed, dimension):
    small = J.lookup(skewed, dimension, "program")
    large = J.lookup(skewed, dimension, "program", max_rows=10, rows_per_split=100)
    assert counted(small) == counted(large)
    assert J.fits_broadcast(dimension)
    assert not J.fits_broadcast(dimension, max_rows=649)
    assert not J.fits_broadcast(dimension, max_bytes=1000)


def test_program_ids(spark):
    programs = spark.createDataFrame(
        [(1, "A"), (2, "B"), (5, "M"), (9, None)], "program_id int, program string"
    )
    df = spark.createDataFrame([("A",), ("a",), ("Z",), (None,), ("M",), ("N",)], "program string")
    plain = {r["program"]: r["program_id"] for r in L.map_program_ids(df, programs).collect()}
    assert plain == {"A": 1, "a": None, "Z": None, None: None, "M": 5, "N": None}
    aliased = L.map_program_ids(df, programs, aliases={"M": 101, "N": 101})
    assert {r["program"]: r["program_id"] for r in aliased.collect()} == {
        "A": 1, "a": None, "Z": None, None: None, "M": 101, "N": 101,
    }


def test_repeated_course_keeps_its_last_careers(spark):
    documents = spark.createDataFrame(
        [("P", [("c1", ["x"]), ("c2", ["y", "y"]), ("c1", ["z", "w"])])],
        "program string, courses array<struct<course: string, careers: array<string>>>",
    )
    rows = Counter(tuple(r) for r in L.explode_career_maps(documents).collect())
    assert rows == Counter(
        [("P", "c1", "z"), ("P", "c1", "w"), ("P", "c2", "y"), ("P", "c2", "y")]
    )


# -- students ----------------------------------------------------------------
@pytest.fixture(scope="module")
def grades(spark):
    rows = [
        ("s1", "OLD", "2019-2020", "k1"), ("s1", "NEW", "2020-2021", "k2"),
        ("s1", "NEW", "2019-2020", "k3"), ("s2", "A", "2020-2021", "k4"),
        ("s3", None, "2021-2022", "k5"), ("s3", "A", "2020-2021", "k6"),
        ("s4", "A", "2020-2021", "k7"), ("s4", "B", "2020-2021", "k8"),
    ]
    return spark.createDataFrame(
        [(*r, 1.5 + i) for i, r in enumerate(rows)],
        "srcode string, program string, schoolyear string, row_key string, grade_numeric double",
    ).withColumn("year_sem", F.concat("schoolyear", F.lit("-FIRST")))


def test_latest_program(grades):
    kept = {r["row_key"] for r in S.latest_program(grades, ["schoolyear", "row_key"]).collect()}
    assert kept == {"k2", "k3", "k4", "k8"}


def test_latest_program_terms_is_the_same_choice(grades):
    order = ["schoolyear", "row_key"]
    direct = (
        S.latest_program(grades, order)
        .groupBy("srcode", "year_sem", "program")
        .agg(F.sum("grade_numeric").alias("total"), F.count("*").alias("graded"))
    )
    combined = S.latest_program_terms(grades, order).select(*direct.columns)
    assert sorted(map(tuple, combined.collect())) == sorted(map(tuple, direct.collect()))


def test_marking_keeps_every_row(grades):
    marked = S.mark_latest_program(grades, ["schoolyear", "row_key"]).collect()
    assert {r["row_key"] for r in marked if r["is_latest_program"]} == {"k2", "k3", "k4", "k8"}
    assert len(marked) == 8


def test_shifters_count_rows_or_programs(grades):
    rows = {r["srcode"]: r["program_count"] for r in S.shifters(grades).collect()}
    assert rows == {"s1": 3, "s4": 2}
    distinct = {r["srcode"]: r["program_count"] for r in S.shifters(grades, distinct=True).collect()}
    assert distinct == {"s1": 2, "s4": 2}


def test_common_semesters_maxima_are_independent(spark):
    lengths = {"a": 4, "b": 4, "c": 4, "d": 8}
    series = spark.createDataFrame(
        [(s, 1, n) for s, longest in lengths.items() for n in range(1, longest + 1)],
        "srcode string, program_id int, semester int",
    )
    names = spark.createDataFrame([("P", 1), ("Q", 1)], "program string, program_id int")
    rows = {tuple(r) for r in S.common_semesters(series, names).collect()}
    assert rows == {(1, 8, 3, "P"), (1, 8, 3, "Q")}
    assert [tuple(r) for r in S.common_semesters_mode(series).collect()] == [(1, 4, 3)]


def test_unknown_program_gets_no_maximum(spark):
    series = spark.createDataFrame(
        [("a", 1, 3), ("b", 1, 5), ("c", None, 9)], "srcode string, program_id int, semester int"
    )
    for limits in ({}, {"max_rows": 0, "rows_per_split": 1}):
        found = S.attach_program_max(series, **limits).collect()
        assert {r["srcode"]: r["program_max_semester"] for r in found} == {"a": 5, "b": 5, "c": None}


def test_record_key_is_repeatable_and_ignores_partitioning(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("a"), F.lit(None).alias("b"))
    one = S.with_record_key(df, ["a", "b"]).orderBy("a").collect()
    two = S.with_record_key(df.repartition(7), ["a", "b"]).orderBy("a").collect()
    assert one == two
    assert len({r["record_key"] for r in one}) == 100


def test_new_rows(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 1, 4, 2)], "id long")
    known = spark.createDataFrame([(1,), (4,)], "id long")
    assert {r["id"] for r in J.new_rows(df, known, "id").collect()} == {2, 3, 5}
    assert [r["id"] for r in J.new_rows(df, known, "id", 2).collect()] == [2, 3]


def test_semi_join_keeps_every_row_of_a_hot_member(skewed):
    members = skewed.where("program IN ('hot', 'k7')")
    kept = J.semi_join(skewed, members, "program")
    assert kept.count() == skewed.where("program IN ('hot', 'k7')").count()
    assert kept.columns == skewed.columns


def test_semi_join_drops_null_years(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "y string")
    assert [r["y"] for r in J.semi_join(df, df.where("y IS NULL OR y = 'a'"), "y").collect()] == ["a"]
