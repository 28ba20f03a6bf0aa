"""What the plans look like: pushed, pruned, combined before shuffles, split."""

import re

import pytest
from pyspark.sql import functions as F

from gradeflow.catalog import QUERIES
from gradeflow.operators import changelog as G
from gradeflow.operators import students as S
from gradeflow.plans import fixtures as X
from gradeflow.plans.cleaning import clean_grades
from gradeflow.plans.series import semester_series

SLOW = {"gwa_forecast", "gwa_forecast_metrics"}
STAGED = {
    "jdbc_roundtrip", "relational_upsert", "stream_ingest", "stream_corrupt", "stream_append",
    "stream_upsert", "batch_metrics", "log_snapshot", "csv_roundtrip", "json_roundtrip",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW - STAGED))
def test_no_python_and_no_cross_joins(spark, small_dir, name):
    text = plan(QUERIES[name](spark, small_dir))
    for unwanted in ("EvalPython", "PythonUDF", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert unwanted not in text


@pytest.fixture(scope="module")
def cleaned(spark, small_dir):
    return clean_grades(X.raw_grades(spark, small_dir), X.AS_OF_YEAR)


def test_cleaning_never_shuffles(cleaned):
    text = plan(cleaned)
    assert "Exchange" not in text and "Sort" not in text


def test_unused_columns_are_not_read(cleaned):
    text = formatted(cleaned.select("srcode", "semester"))
    read = re.search(r"ReadSchema: struct<(.*?)>", text)
    assert "instructor_name" not in read[1] and "fullname" not in read[1]


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_stored_columns_are_filtered_in_the_scan(spark, small_dir):
    text = formatted(QUERIES["filter_project"](spark, small_dir))
    assert "GreaterThan(l_quantity,20.0)" in text
    assert "EqualTo(l_returnflag,R)" in text
    read = re.search(r"ReadSchema: struct<(.*?)>", text)[1]
    assert {c.split(":")[0] for c in read.split(",")} == {
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
    }


def test_top_one_is_cut_before_the_shuffle(cleaned):
    text = plan(S.latest_record(cleaned, ["srcode"], X.NEWEST))
    partial, exchange = text.index("Partial"), text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text and partial > exchange  # printed from the top down


def test_series_reads_once_and_shuffles_groups(spark, small_dir, cleaned):
    text = plan(semester_series(cleaned, X.programs(spark, small_dir), order=X.NEWEST))
    main = text[: text.index("BroadcastExchange")]
    assert main.count("Exchange hashpartitioning") == 2
    assert main.count("FileScan") == 1
    assert "partial_sum" in main


def test_a_hot_student_is_split(spark):
    """Adaptive execution cuts up the hot student's rows in the latest-program join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("s"), F.col("id") % 900))
        .alias("srcode"),
        F.concat(F.lit("BS"), F.col("id") % 1).alias("program"),
        (F.lit(2000) + F.col("id") % 9).cast("string").alias("schoolyear"),
        F.sha2(F.col("id").cast("string"), 256).alias("row_key"),
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = S.latest_program(rows, X.NEWEST)
        assert len(joined.collect()) == 60_000
        text = plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "skew=true" in text.lower() or "skewed" in text.lower()


def test_commit_bounds_skip_folders(spark, tmp_path):
    from gradeflow.sources.versioned import read_log, write_commit

    df = spark.createDataFrame([(1, "a")], "id long, v string")
    for number, day in enumerate(("2024-01-01", "2024-02-01", "2024-03-01")):
        write_commit(df, str(tmp_path), number, day, keys=["id"])
    log = read_log(spark, str(tmp_path), df.schema)
    text = formatted(G.snapshot_as_of(log, "2024-02-01"))
    assert re.search(r"PartitionFilters: \[.*commit_time#\d+ <= 20240201000000000", text)


def test_generated_methods_stay_compilable(spark, small_dir):
    """The JVM only interprets methods of more than 8,000 bytes."""

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("cleaned_grades", "cleaned_grades_v2"):
            execution = QUERIES[name](spark, small_dir)._jdf.queryExecution()
            stages = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenStringSeq(execution.executedPlan())
            sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
