"""Grades: reading, checking and naming them.

Spark runs in ANSI mode, so text is only ever read as a number with ``try_cast``
and only ever compared with text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeflow.functions import constants as K


def numeric_grade(final: Column, reexam: Column, pattern: str = K.STRICT_GRADE) -> Column:
    """The grade that counts, as a double.

    A numeric re-examination replaces the final grade, a dropped course is 0, and
    whatever cannot be read is a 5.  ``pattern`` says what reads as a number:
    strictly ``2.00`` only, loosely ``2`` as well.
    """
    text = (
        F.when(reexam.rlike(pattern), reexam)
        .when(final.rlike(pattern), final)
        .when(final == "DRP", F.lit(K.DROPPED_AS))
    )
    return F.coalesce(text.try_cast("double"), F.lit(K.UNGRADED_AS))


def is_on_scale(grade: Column, *, zero: bool = True) -> Column:
    """True for the values of the grading scale (3.50 is not one) and, with ``zero``, 0."""
    scale = [float(g) for g in K.GRADE_SCALE]
    return grade.isin(0.0, *scale) if zero else grade.isin(*scale)


def classify_grade(final: Column, reexam: Column) -> Column:
    """How a grade came about, from the upper-cased final and re-exam texts.

    The outcome depends on which of the two is numeric:

    * both: better, worse or (equal) invalid re-examination, lower being better
    * final only: ``INC`` when the re-exam says so, otherwise normal
    * re-exam only: normal after a dash, ``INC`` after an ``INC``
    * neither: invalid, except that ``DRP`` is always a drop
    """
    final_numeric, reexam_numeric = final.rlike(K.STRICT_GRADE), reexam.rlike(K.STRICT_GRADE)
    final_value, reexam_value = final.try_cast("double"), reexam.try_cast("double")
    both = (
        F.when(final_value > reexam_value, F.lit("IMPROVED(REEXAM)"))
        .when(final_value < reexam_value, F.lit("FAILED(REEXAM)"))
        .otherwise(F.lit("INVALID"))
    )
    final_only = F.when(reexam == "INC", F.lit("INC")).otherwise(F.lit("NORMAL"))
    reexam_only = (
        F.when(final.isin(*K.DASHES), F.lit("NORMAL"))
        .when(final == "INC", F.lit("INC"))
        .otherwise(F.lit("INVALID"))
    )
    return (
        F.when(final == "DRP", F.lit("DROP"))
        .when(final_numeric & reexam_numeric, both)
        .when(final_numeric, final_only)
        .when(reexam_numeric, reexam_only)
        .otherwise(F.lit("INVALID"))
    )


def numeric_or_null(text: Column, pattern: str = K.STRICT_GRADE) -> Column:
    """Keep text that reads as a number under ``pattern``, blank out the rest."""
    return F.when(text.rlike(pattern), text)


def undash(text: Column) -> Column:
    """A grade text as a double; a lone dash and unreadable text are NULL."""
    return F.nullif(text, F.lit("-")).try_cast("double")


def grade_status(grade: Column) -> Column:
    """PENDING without a grade, FAILED from exactly 3.0 up, PASSED below."""
    return (
        F.when(grade.isNull(), F.lit("PENDING"))
        .when(grade >= K.PASS_LIMIT, F.lit("FAILED"))
        .when(grade < K.PASS_LIMIT, F.lit("PASSED"))
        .otherwise(F.lit("UNKNOWN"))
    )


def accuracy_band(percentage_error: Column) -> Column:
    """Name a mean absolute percentage error: Excellent, Good, Fair or Poor."""
    bands = iter(K.ACCURACY_BANDS)
    below, name = next(bands)
    band = F.when(percentage_error < below, F.lit(name))
    for below, name in bands:
        band = band.when(percentage_error < below, F.lit(name))
    return band.when(percentage_error.isNotNull(), F.lit(K.ACCURACY_REST))


def grade_trend(last: Column, forecast: Column) -> Column:
    """Where a grade average is heading; lower averages are better."""
    return (
        F.when(forecast < last, F.lit("improve"))
        .when(forecast > last, F.lit("worsen"))
        .when(forecast == last, F.lit("same"))
    )
