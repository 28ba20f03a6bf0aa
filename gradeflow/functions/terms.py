"""School years and semesters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeflow.functions import constants as K


def is_semester(semester: Column) -> Column:
    """True for a known semester in any of its spellings."""
    return semester.isin(*K.SEMESTERS, *K.SEMESTER_SPELLINGS)


def canonical_semester(semester: Column) -> Column:
    """One of the four known semesters, or NULL for anything else."""
    known = F.when(semester.isin(*K.SEMESTERS), semester)
    spellings: dict[str, list[str]] = {}
    for odd, proper in K.SEMESTER_SPELLINGS.items():
        spellings.setdefault(proper, []).append(odd)
    for proper, odd in spellings.items():
        known = known.when(semester.isin(*odd), F.lit(proper))
    return known


def has_schoolyear(text: Column) -> Column:
    """True when the text contains a ``YYYY-YYYY``."""
    return text.rlike(K.SCHOOLYEAR_PATTERN)


def schoolyear_span(text: Column) -> Column:
    """The first ``YYYY-YYYY`` in the text, or the empty text."""
    return F.regexp_extract(text, K.SCHOOLYEAR_PATTERN, 1)


def start_year(schoolyear: Column) -> Column:
    """The year before the first dash as an int; NULL when it is not a number."""
    return F.substring_index(schoolyear, "-", 1).try_cast("int")


def term_rank(semester: Column) -> Column:
    """1, 2, 3 for the terms that count; NULL for the rest."""
    terms = iter(K.TERM_RANKS.items())
    name, rank = next(terms)
    ranked = F.when(semester == name, F.lit(rank))
    for name, rank in terms:
        ranked = ranked.when(semester == name, F.lit(rank))
    return ranked


def year_semester(schoolyear: Column, semester: Column) -> Column:
    """``2021-2022-FIRST``: sorts by time, because the term names happen to."""
    return F.concat_ws("-", schoolyear, semester)
