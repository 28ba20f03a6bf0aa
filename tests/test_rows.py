"""Row-level operators on hand-written rows: every branch, every trap."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gradeflow.columns import CURRICULUM_COLUMNS, ColumnMap
from gradeflow.functions import constants as K
from gradeflow.functions import grades as G
from gradeflow.operators import cleaning as C
from gradeflow.operators import curriculum as U
from gradeflow.operators import profiling as P
from gradeflow.plans.cleaning import clean_grades, clean_grades_mapped, clean_grades_stream


def column(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def results(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize(
    "final, reexam, expected",
    [
        ("2.00", None, "NORMAL"),
        ("2.00", "PASSED", "NORMAL"),
        ("2.00", "OG", "NORMAL"),
        ("-", "2.00", "NORMAL"),
        ("--", "2.00", "NORMAL"),
        ("INC", "2.00", "INC"),
        ("DRP", None, "DROP"),
        ("DRP", "2.00", "DROP"),
        ("2.00", "INC", "INC"),
        ("2.00", "-", "NORMAL"),
        ("2.00", "3", "NORMAL"),
        ("5.00", "3.00", "IMPROVED(REEXAM)"),
        ("3.00", "5.00", "FAILED(REEXAM)"),
        ("3.00", "3.00", "INVALID"),
        ("2", None, "INVALID"),
        ("INC", None, "INVALID"),
        ("INC", "2", "INVALID"),
        ("-", None, "INVALID"),
        ("X", "2.00", "INVALID"),
        (None, "2.00", "INVALID"),
        (None, None, "INVALID"),
    ],
)
def test_classification(spark, final, reexam, expected):
    row = spark.createDataFrame([(final, reexam)], "f string, r string")
    assert row.select(G.classify_grade(F.col("f"), F.col("r"))).first()[0] == expected


@pytest.mark.parametrize(
    "final, reexam, strict, loose",
    [
        ("1.25", None, 1.25, 1.25),
        ("5.00", "2.00", 2.0, 2.0),
        ("5.00", "2", 5.0, 2.0),
        ("2", None, 5.0, 2.0),
        ("2.", None, 5.0, 2.0),
        ("DRP", None, 0.0, 0.0),
        ("DRP", "3.00", 3.0, 3.0),
        ("INC", None, 5.0, 5.0),
        ("INC", "1.50", 1.5, 1.5),
        ("-", "P", 5.0, 5.0),
        (None, None, 5.0, 5.0),
        ("-1.25", None, 5.0, 5.0),
        ("1e5", None, 5.0, 5.0),
    ],
)
def test_numeric_grade(spark, final, reexam, strict, loose):
    row = spark.createDataFrame([(final, reexam)], "f string, r string")
    found = row.select(
        G.numeric_grade(F.col("f"), F.col("r")),
        G.numeric_grade(F.col("f"), F.col("r"), K.LOOSE_GRADE),
    ).first()
    assert tuple(found) == (strict, loose)


def test_only_scale_grades_stay(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, 3.5, 4.0, 5.0, 6.0)], "grade_numeric double")
    kept = [r[0] for r in C.filter_valid_grades(df).collect()]
    assert kept == [Decimal("0.00"), Decimal("1.00"), Decimal("4.00"), Decimal("5.00")]
    assert [r[0] for r in C.filter_valid_grades(df, zero=False).collect()] == kept[1:]


def test_null_text_and_null_both_go(spark):
    assert results(C.remove_null_strings(column(spark, ["NULL", None, "A"]), "v"), "v") == [("A",)]


def test_marks_and_nulls_go(spark):
    df = column(spark, ["P", None, "F", "2.00", "-"], "grade_final")
    assert results(C.filter_invalid_grades(df), "grade_final") == [("2.00",), ("-",)]


def test_semesters(spark):
    df = column(
        spark,
        ["FIRST", "SECOND_X", "SECOND SEMESTER", "SUMMER2", " FIRST ", "first", "MIDYEAR", None],
        "semester",
    )
    assert [r[0] for r in C.clean_semesters(df).collect()] == ["FIRST", "SECOND", "SECOND", "SUMMER2"]
    assert [r[0] for r in C.clean_semesters(df, trim_first=True).collect()].count("FIRST") == 2


def test_schoolyears(spark):
    df = column(
        spark, ["2021-2022", "2023-2024_X", "2004", None, "x2005-2006y", "12345-67890"], "schoolyear"
    )
    years = [r[0] for r in C.clean_schoolyear(df).collect()]
    assert years == ["2021-2022", "2023-2024", "2005-2006", "2345-6789"]
    kept = C.valid_schoolyears(C.clean_schoolyear(df))
    assert [r["start_year"] for r in kept.collect()] == [2021, 2023, 2345]


def test_start_year_of_odd_text_is_null(spark):
    df = column(spark, ["2021", "", "x-2022"], "schoolyear")
    rows = df.withColumn("y", C.S.start_year(F.col("schoolyear"))).collect()
    assert [r["y"] for r in rows] == [2021, None, None]


def test_incomplete_needs_the_year_given(spark):
    df = spark.createDataFrame(
        [("INC", None, "2008-2009"), ("INC", None, "2007-2008"), ("INC", None, "2009-2010"),
         ("INC", "2.00", "2008-2009"), ("2.00", None, "2008-2009")],
        "grade_final string, grade_reexam string, schoolyear string",
    )
    assert C.filter_incomplete(df, 2008).count() == 3
    assert C.filter_incomplete(df, 2030).count() == 5


def test_casts(spark):
    df = column(spark, ["1", "x", "3000000000"])
    assert [r[0] for r in C.cast_columns(df, [("v", "int")]).collect()] == [1, None, None]
    assert [r[0] for r in C.cast_columns(df, [("v", "bigint")]).collect()] == [1, None, 3000000000]
    with pytest.raises(ValueError, match="timestamp"):
        C.cast_columns(df, [("v", "timestamp")])


def test_trim_leaves_numbers_alone(spark):
    df = spark.createDataFrame([(" a ", 1)], "s string, n int")
    assert C.trim_all(df).collect() == [("a", 1)]
    assert dict(C.trim_all(df).dtypes)["n"] == "int"
    assert dict(C.clean_strings(df, ["s", "n"]).dtypes)["n"] == "int"


def test_status(spark):
    df = column(spark, [None, "-", "3.0", "2.99", "5", "inc"], "grade_final")
    found = df.transform(C.dash_to_null, ["grade_final"]).transform(C.with_status)
    assert [r["status"] for r in found.collect()] == [
        "PENDING", "PENDING", "FAILED", "PASSED", "FAILED", "PENDING",
    ]


def test_transmutation_has_no_band_for_four(spark):
    df = spark.createDataFrame([("1.00",), ("1.25",), ("4.00",), ("5.00",)], "g string").select(
        F.col("g").cast("decimal(5,2)").alias("grade_numeric")
    )
    bands = [tuple(map(str, r)) for r in C.transmute_grades(df).select("min", "mid", "max").collect()]
    assert bands == [
        ("98.00", "99.00", "100.00"),
        ("94.00", "95.50", "97.00"),
        ("None", "None", "None"),
        ("74.00", "74.00", "74.00"),
    ]


def test_shifted_rows(spark):
    good = tuple(f"c{i}" for i in range(16))
    bad = list(f"c{i}" for i in range(16))
    bad[3] = "Total Quality Management"
    df = spark.createDataFrame([good, tuple(bad)], list(CURRICULUM_COLUMNS))
    first, second = U.shift_columns(df).collect()
    assert tuple(first) == good
    assert tuple(second) == (*bad[:2], *bad[3:], None)


def test_curriculum_exclusions(spark):
    base = dict(
        code="IT 1", description="Databases", type="LEC", college="Engineering", program="p", major="m"
    )
    cases = [
        ({}, True),
        ({"code": "GEd 1"}, False),
        ({"code": "PE 104"}, False),
        ({"code": "PE 105"}, True),
        ({"code": None}, False),
        ({"code": "MATH 1"}, False),
        ({"code": "MATH 1", "program": K.MATH_PROGRAM, "major": K.MATH_MAJOR}, True),
        ({"description": None}, True),
        ({"description": "Senior Thesis"}, False),
        ({"type": "OJT"}, False),
        ({"type": None}, False),
        ({"college": "College of Law"}, False),
        ({"college": None}, False),
    ]
    rows = [(i, *{**base, **change}.values()) for i, (change, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "n int, " + ", ".join(f"{c} string" for c in base))
    kept = {r["n"] for r in U.exclude_courses(df).collect()}
    assert kept == {i for i, (_, stays) in enumerate(cases) if stays}


def test_units_without_value_go(spark):
    df = column(spark, ["3", "NON", "LAB", None], "units")
    assert results(U.exclude_units(df), "units") == [("3",)]


def test_retention_counts_cascade(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "a")], "n int, s string")
    report = P.retention(df, {"big": F.col("n") > 1, "is a": F.col("s") == "a"})
    found = [tuple(r) for r in report.orderBy("stage_no").collect()]
    assert found == [(0, "input", 4, 0, 100.0), (1, "big", 3, 1, 75.0), (2, "is a", 1, 2, 25.0)]
    empty = P.retention(df.where("false"), {"big": F.col("n") > 1}).collect()
    assert empty[0]["percent_of_input"] is None


def test_column_map(spark):
    names = ColumnMap(grade="g", grade_final="final", units="credits", schoolyear="sy")
    df = spark.createDataFrame(
        [("2", None, "3 ", "2020-2021_x", "first", "main")],
        "final string, grade_reexam string, credits string, sy string, semester string, campus string",
    )
    row = clean_grades_mapped(df, names).first()
    assert (row["g"], row["credits"], row["sy"], row["campus"]) == (
        Decimal("2.00"), 3, "2020-2021", "MAIN",
    )


RAW_ROW = dict(
    id=1, schoolyear="2020-2021", semester="first", code=" IT 1 ", description="Databases ", units=3,
    instructor_id="7", instructor_name="N", srcode="s1", fullname="F", campus="main", college="C",
    program="BS IT", major="M", yearlevel="1", curriculum="2018", class_section="A",
    grade_final="1.25", grade_reexam=None, status="ok",
)


def raw(spark, *changes):
    from gradeflow.columns import RAW_GRADES

    return spark.createDataFrame([{**RAW_ROW, **c} for c in changes], RAW_GRADES)


def test_dropped_course_with_reexam_stays(spark):
    df = raw(spark, {"grade_final": "drp", "grade_reexam": "3.00"}, {"grade_final": "drp"})
    found = clean_grades(df, 2030).collect()
    assert [(r["grade_classification"], r["grade_numeric"]) for r in found] == [
        ("DROP", Decimal("3.00"))
    ]


def test_cleaning_is_stable(spark):
    df = raw(spark, {}, {"grade_final": "inc", "grade_reexam": "2.00"}, {"semester": "second_x"})
    once = clean_grades(df, 2030)
    again = clean_grades(once.drop("grade_numeric", "grade_classification"), 2030)
    assert sorted(map(str, once.collect())) == sorted(
        map(str, again.select(*once.columns).collect())
    )


def test_stream_flow_is_narrow(spark):
    plan = clean_grades_stream(raw(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_profiles_of_several_columns(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None)], "p string, q string")
    found = {tuple(r) for r in P.profile_each(df, ["p", "q"]).collect()}
    assert found == {("p", "a", 2), ("q", "x", 1), ("q", None, 1)}
