"""Names of the columns the operators work on, and the schemas of their inputs.

Fixed values: field names and types are those of the records.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnMap:
    """Logical name -> physical column; override what a source names otherwise."""

    srcode: str = "srcode"
    schoolyear: str = "schoolyear"
    start_year: str = "start_year"
    semester: str = "semester"
    sem_order: str = "sem_order"
    yearsem: str = "yearsem"
    grade: str = "grade_numeric"
    grade_final: str = "grade_final"
    grade_reexam: str = "grade_reexam"
    grade_classification: str = "grade_classification"
    program: str = "program"
    description: str = "description"
    campus: str = "campus"
    units: str = "units"


NAMES = ColumnMap()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()

RAW_GRADES = _struct(
    ("id", _LONG),
    ("schoolyear", _TEXT),
    ("semester", _TEXT),
    ("code", _TEXT),
    ("description", _TEXT),
    ("units", _INT),
    ("instructor_id", _TEXT),
    ("instructor_name", _TEXT),
    ("srcode", _TEXT),
    ("fullname", _TEXT),
    ("campus", _TEXT),
    ("college", _TEXT),
    ("program", _TEXT),
    ("major", _TEXT),
    ("yearlevel", _TEXT),
    ("curriculum", _TEXT),
    ("class_section", _TEXT),
    ("grade_final", _TEXT),
    ("grade_reexam", _TEXT),
    ("status", _TEXT),
)

PROCESSED_GRADES = T.StructType(
    RAW_GRADES.fields
    + _struct(
        ("grade_numeric", T.DecimalType(5, 2)),
        ("grade_classification", _TEXT),
        ("start_year", _INT),
        ("year_sem", _TEXT),
        ("program_id", _INT),
        ("processing_time", T.TimestampType()),
    ).fields
)

PROGRAMS = _struct(("program_id", _INT), ("program", _TEXT))

CAREER_MAP = _struct(
    ("program", _TEXT),
    (
        "courses",
        T.ArrayType(_struct(("course", _TEXT), ("careers", T.ArrayType(_TEXT)))),
    ),
)

EMPLOYEES = _struct(
    *((n, _TEXT) for n in (
        "emp_id", "employee_name", "department", "state", "salary", "age", "bonus", "ts",
    ))
)

CURRICULUM_COLUMNS = (
    "id", "code", "description", "units", "type", "subtype", "program", "major", "college",
    "curriculum", "year_level", "semester", "lecture_hours", "lab_hours", "course_id",
    "curriculum_id",
)
