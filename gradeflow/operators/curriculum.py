"""Curriculum tables: repair shifted rows, drop what is not an academic course."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeflow.columns import CURRICULUM_COLUMNS
from gradeflow.functions import constants as K


def shift_columns(
    df: DataFrame,
    *,
    columns: Sequence[str] = CURRICULUM_COLUMNS[2:],
    marker: str = "units",
    titles: Sequence[str] = K.MISPLACED_TITLES,
) -> DataFrame:
    """Move each column one place left in rows where ``marker`` holds a title.

    ``columns`` names the run of neighbours that slipped; the last one of them
    has no right neighbour and becomes NULL.
    """
    slipped = F.col(marker).isin(*titles)
    sources: list[Column] = [F.col(c) for c in columns[1:]] + [F.lit(None)]
    moved = {
        name: F.when(slipped, source).otherwise(F.col(name))
        for name, source in zip(columns, sources, strict=True)
    }
    return df.withColumns(moved)


def exclude_units(df: DataFrame) -> DataFrame:
    """Drop courses that carry no units (and rows without a units value)."""
    return df.where(~F.col("units").isin(*K.UNITS_NOT_COUNTED))


def exclude_courses(df: DataFrame) -> DataFrame:
    """Keep the courses that a recommendation may draw on.

    A missing description is allowed; a missing code, type or college is not.
    """
    code, description = F.col("code"), F.col("description")
    math_allowed = (F.col("program") == K.MATH_PROGRAM) & (F.col("major") == K.MATH_MAJOR)
    return df.where(
        _has_none_of(code, K.CODE_PARTS_OUT)
        & ~code.isin(*K.CODES_OUT)
        & (~code.contains(K.MATH_CODE_PART) | math_allowed)
        & (description.isNull() | _has_none_of(description, K.DESCRIPTION_PARTS_OUT))
        & _has_none_of(F.col("type"), K.TYPE_PARTS_OUT)
        & _has_none_of(F.col("college"), K.COLLEGE_PARTS_OUT)
    )


def clean_curriculum(df: DataFrame) -> DataFrame:
    return df.transform(shift_columns).transform(exclude_units).transform(exclude_courses)


def _has_none_of(text: Column, parts: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (~text.contains(part) for part in parts))
