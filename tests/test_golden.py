"""Row counts of the main flow at a fixed size, stage by stage."""

import pytest
from pyspark.sql import functions as F

from gradeflow.operators import cleaning as C
from gradeflow.operators.students import latest_program, latest_program_terms, semester_averages
from gradeflow.plans import fixtures as X
from gradeflow.plans.cleaning import CASED, TRIMMED, clean_grades

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def raw(spark):
    return X.raw_grades(spark, SF)


def test_stages(raw):
    counts = [raw.count()]
    steps = [
        lambda d: d.transform(C.standardize_case, CASED)
        .transform(C.clean_semesters)
        .transform(C.clean_strings, TRIMMED),
        C.clean_schoolyear,
        C.filter_invalid_grades,
        lambda d: d.transform(C.with_numeric_grade).transform(C.filter_valid_grades),
        lambda d: C.remove_null_strings(d.transform(C.with_classification), "program"),
        lambda d: C.filter_incomplete(C.numeric_or_null(d, "grade_reexam"), X.AS_OF_YEAR),
        C.filter_dropped,
        C.valid_schoolyears,
        C.year_semesters,
    ]
    for step in steps:
        raw = step(raw)
        counts.append(raw.count())
    assert counts == [60000, 58012, 56067, 51469, 49667, 48408, 47861, 46059, 24947, 23226]


def test_flagship_by_class(raw):
    cleaned = clean_grades(raw, X.AS_OF_YEAR)
    found = {
        r["grade_classification"]: (r["n"], float(r["total"]))
        for r in cleaned.groupBy("grade_classification")
        .agg(F.count("*").alias("n"), F.sum("grade_numeric").alias("total"))
        .collect()
    }
    assert found == {
        "NORMAL": (13579, 34831.00),
        "INVALID": (3632, 17296.00),
        "FAILED(REEXAM)": (2479, 10445.00),
        "INC": (2067, 5433.00),
        "IMPROVED(REEXAM)": (1245, 2490.00),
        "DROP": (224, 835.00),
    }


def test_latest_program_and_averages(raw):
    cleaned = clean_grades(raw, X.AS_OF_YEAR)
    latest = latest_program(cleaned, X.NEWEST)
    assert latest.count() == 21540
    averages = semester_averages(latest, ["srcode", "year_sem", "program"])
    assert averages.count() == 5827
    assert latest_program_terms(cleaned, X.NEWEST).count() == 5827


def test_classification_counts(raw):
    cased = C.with_classification(C.standardize_case(raw, ["grade_final"]))
    kept = (
        cased.transform(C.filter_invalid_grades)
        .transform(C.with_numeric_grade)
        .transform(C.filter_valid_grades)
    )
    found = {r[0]: r[1] for r in kept.groupBy("grade_classification").count().collect()}
    assert found == {
        "NORMAL": 20275 + 930 + 8115,
        "INC": 450 + 4034,
        "DROP": 2454,
        "IMPROVED(REEXAM)": 2689,
        "FAILED(REEXAM)": 5358,
        "INVALID": 8863,
    }
