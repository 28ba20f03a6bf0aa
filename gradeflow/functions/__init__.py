"""Column builders: pure expressions, no DataFrame in sight."""

from gradeflow.functions.grades import (
    accuracy_band,
    classify_grade,
    grade_status,
    grade_trend,
    is_on_scale,
    numeric_grade,
    numeric_or_null,
    undash,
)
from gradeflow.functions.terms import (
    canonical_semester,
    has_schoolyear,
    is_semester,
    schoolyear_span,
    start_year,
    term_rank,
    year_semester,
)

__all__ = [
    "accuracy_band",
    "canonical_semester",
    "classify_grade",
    "grade_status",
    "grade_trend",
    "has_schoolyear",
    "is_on_scale",
    "is_semester",
    "numeric_grade",
    "numeric_or_null",
    "schoolyear_span",
    "start_year",
    "term_rank",
    "undash",
    "year_semester",
]
