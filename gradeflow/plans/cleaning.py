"""The four grade-cleaning flows.  Each is one chain of narrow operators, except
for the program lookup and, in the second, the latest-program join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from gradeflow.columns import NAMES, ColumnMap
from gradeflow.functions import constants as K
from gradeflow.operators import cleaning as C
from gradeflow.operators.lookups import map_program_ids
from gradeflow.operators.students import latest_program

# The columns that each flow standardises and trims.
CASED = ("grade_final", "campus", "semester", "schoolyear")
TRIMMED = (
    "schoolyear", "semester", "code", "description", "units", "instructor_id",
    "instructor_name", "srcode", "fullname", "campus", "program", "grade_final",
    "grade_reexam", "status", "major", "curriculum", "class_section",
)
TRIMMED_V2 = (
    "schoolyear", "semester", "code", "description", "units", "instructor_id",
    "instructor_name", "srcode", "fullname", "campus", "college", "program",
    "grade_final", "grade_reexam", "status",
)
TRIMMED_V4 = (
    "semester", "code", "description", "instructor_name", "fullname", "campus",
    "college", "program", "yearlevel", "class_section", "status",
)
CASED_V4 = ("semester", "campus", "college", "program", "yearlevel", "status")


def clean_grades(
    raw: DataFrame,
    as_of_year: int,
    *,
    programs: DataFrame | None = None,
    aliases: Mapping[str, int] | None = None,
    min_year: int = K.FIRST_YEAR,
    trim_first: bool = False,
) -> DataFrame:
    """The main flow: valid, classified grades per student and term.

    The order of the steps is part of the result: semesters are checked before
    trimming, grades are classified before the re-exam text is blanked out, and
    incomplete grades are judged after.  Dropped courses (grade 0) leave together
    with the grades that are off the scale.
    """
    cleaned = (
        raw.transform(C.standardize_case, CASED)
        .transform(C.clean_semesters, trim_first=trim_first)
        .transform(C.clean_strings, TRIMMED)
        .transform(C.clean_schoolyear)
        .transform(C.process_grades, zero=False)
        .transform(C.remove_null_strings, "program")
        .transform(C.numeric_or_null, "grade_reexam")
        .transform(C.cast_columns, [("units", "int"), ("grade_numeric", "decimal(5,2)")])
        .transform(C.filter_incomplete, as_of_year)
        .transform(C.valid_schoolyears, min_year)
        .transform(C.year_semesters)
    )
    if programs is None:
        return cleaned
    columns = [*cleaned.columns, "program_id"]
    return map_program_ids(cleaned, programs, aliases=aliases).select(*columns)


def clean_grades_latest(
    raw: DataFrame, as_of_year: int, *, order: Sequence[str] = ("schoolyear",)
) -> DataFrame:
    """The second flow: trims first, keeps the latest program, reads ``2`` as a grade."""
    return (
        raw.transform(C.standardize_case, CASED)
        .transform(C.clean_strings, TRIMMED_V2)
        .transform(C.remove_null_strings, "program")
        .transform(C.clean_semesters)
        .transform(C.clean_schoolyear)
        .transform(latest_program, order)
        .transform(C.process_grades, K.LOOSE_GRADE, zero=False)
        .transform(C.cast_columns, [("units", "int"), ("grade_numeric", "decimal(5,2)")])
        .transform(C.filter_incomplete, as_of_year)
        .transform(C.year_semesters, into="yearsem", ordinal=True)
    )


def clean_grades_mapped(raw: DataFrame, names: ColumnMap = NAMES) -> DataFrame:
    """The third flow: driven by column names, without classification."""
    cased = (names.grade_final, names.campus, names.semester, names.schoolyear)
    return (
        raw.transform(C.standardize_case, cased)
        .transform(C.clean_semesters, names=names)
        .transform(C.trim_all)
        .transform(C.clean_schoolyear, names=names)
        .transform(C.process_grades, K.LOOSE_GRADE, classify=False, names=names)
        .transform(C.numeric_or_null, names.grade_reexam, K.LOOSE_REEXAM)
        .transform(C.cast_columns, [(names.units, "int"), (names.grade, "decimal(5,2)")])
    )


def clean_grades_stream(raw: DataFrame, processing_time: Column | None = None) -> DataFrame:
    """The fourth flow: stateless, so it runs on a stream as on a table."""
    return (
        raw.transform(C.with_processing_time, processing_time)
        .transform(C.clean_strings, TRIMMED_V4)
        .transform(C.standardize_case, CASED_V4)
        .transform(C.clean_semesters)
        .transform(C.clean_schoolyear)
        .transform(C.dash_to_null, ["grade_final", "grade_reexam"])
        .transform(C.with_status)
    )
