"""Row-level cleaning.  Every operator here is narrow: no shuffle, no sort.

Filters test a column before it is rewritten rather than the rewritten one after.
Spark moves filters below projections and repeats the projected expression in
them, so this is what keeps a long chain from matching the same pattern again and
again.

NULLs follow SQL: a row whose test is unknown is dropped, so ``drop_text_null``
and ``drop_marks`` remove true NULLs along with the texts they name.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeflow.columns import NAMES, ColumnMap
from gradeflow.functions import constants as K
from gradeflow.functions import grades as G
from gradeflow.functions import terms as S

GRADE_TYPE = T.DecimalType(5, 2)


# -- text --------------------------------------------------------------------
def standardize_case(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.upper(c) for c in columns})


def clean_strings(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Trim the listed text columns; columns of other types are left alone."""
    texts = _text_columns(df)
    return df.withColumns({c: F.trim(c) for c in columns if c in texts})


def trim_all(df: DataFrame) -> DataFrame:
    """Trim every text column; numbers keep their type."""
    return df.withColumns({c: F.trim(c) for c in df.columns if c in _text_columns(df)})


def remove_null_strings(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose column holds the text ``NULL`` (or is NULL)."""
    return df.where(F.col(column) != "NULL")


# -- terms -------------------------------------------------------------------
def clean_semesters(df: DataFrame, *, trim_first: bool = False, names: ColumnMap = NAMES) -> DataFrame:
    """Canonical semester names; rows with any other name go.

    Without ``trim_first`` a padded name counts as unknown.
    """
    given = F.col(names.semester)
    if trim_first:
        given = F.trim(given)
    return df.where(S.is_semester(given)).withColumn(names.semester, S.canonical_semester(given))


def clean_schoolyear(df: DataFrame, *, names: ColumnMap = NAMES) -> DataFrame:
    """Cut school years down to ``YYYY-YYYY``; rows without one go."""
    given = F.col(names.schoolyear)
    return df.where(S.has_schoolyear(given)).withColumn(names.schoolyear, S.schoolyear_span(given))


def valid_schoolyears(
    df: DataFrame, min_year: int = K.FIRST_YEAR, *, names: ColumnMap = NAMES
) -> DataFrame:
    """Add ``start_year`` and keep the years from ``min_year`` on."""
    return df.withColumn(names.start_year, S.start_year(F.col(names.schoolyear))).where(
        F.col(names.start_year) >= min_year
    )


def year_semesters(
    df: DataFrame, *, into: str = "year_sem", ordinal: bool = False, names: ColumnMap = NAMES
) -> DataFrame:
    """Keep graded rows of the three regular terms and name their point in time.

    Adds ``start_year`` and ``into``; with ``ordinal`` also the rank of the term.
    Rows are not sorted: order where the result leaves Spark.
    """
    semester, schoolyear = F.col(names.semester), F.col(names.schoolyear)
    added = {
        names.start_year: S.start_year(schoolyear),
        into: S.year_semester(schoolyear, semester),
    }
    if ordinal:
        added[names.sem_order] = S.term_rank(semester)
    return df.where(semester.isin(*K.TERM_RANKS) & F.col(names.grade).isNotNull()).withColumns(added)


# -- grades ------------------------------------------------------------------
def filter_invalid_grades(df: DataFrame, *, names: ColumnMap = NAMES) -> DataFrame:
    """Drop final grades that are a mark without a grade (or NULL)."""
    return df.where(~F.col(names.grade_final).isin(*K.MARKS_WITHOUT_GRADE))


def with_numeric_grade(
    df: DataFrame, pattern: str = K.STRICT_GRADE, *, names: ColumnMap = NAMES
) -> DataFrame:
    return df.withColumn(
        names.grade,
        G.numeric_grade(F.col(names.grade_final), F.col(names.grade_reexam), pattern),
    )


def filter_valid_grades(
    df: DataFrame, *, zero: bool = True, names: ColumnMap = NAMES
) -> DataFrame:
    """Keep the values of the scale and, with ``zero``, 0; as ``decimal(5,2)``."""
    return df.where(G.is_on_scale(F.col(names.grade), zero=zero)).withColumn(
        names.grade, F.col(names.grade).cast(GRADE_TYPE)
    )


def with_classification(df: DataFrame, *, names: ColumnMap = NAMES) -> DataFrame:
    return df.withColumn(
        names.grade_classification,
        G.classify_grade(F.col(names.grade_final), F.col(names.grade_reexam)),
    )


def process_grades(
    df: DataFrame,
    pattern: str = K.STRICT_GRADE,
    *,
    classify: bool = True,
    zero: bool = True,
    names: ColumnMap = NAMES,
) -> DataFrame:
    """Invalid marks out, numeric grade in, off-scale grades out, then the class.

    ``zero=False`` does the work of a later ``filter_dropped`` in the same test.
    """
    df = (
        df.transform(filter_invalid_grades, names=names)
        .transform(with_numeric_grade, pattern, names=names)
        .transform(filter_valid_grades, zero=zero, names=names)
    )
    return df.transform(with_classification, names=names) if classify else df


def numeric_or_null(df: DataFrame, column: str, pattern: str = K.STRICT_GRADE) -> DataFrame:
    return df.withColumn(column, G.numeric_or_null(F.col(column), pattern))


def filter_incomplete(df: DataFrame, as_of_year: int, *, names: ColumnMap = NAMES) -> DataFrame:
    """Drop ``INC`` without a re-exam in a school year that contains ``as_of_year``."""
    return df.where(~_open_incomplete(as_of_year, names))


def filter_dropped(df: DataFrame, *, names: ColumnMap = NAMES) -> DataFrame:
    """Drop rows graded 0."""
    return df.where(F.col(names.grade) != F.lit(0).cast(GRADE_TYPE))


def _open_incomplete(as_of_year: int, names: ColumnMap) -> Column:
    return (
        (F.col(names.grade_final) == "INC")
        & F.col(names.grade_reexam).isNull()
        & F.col(names.schoolyear).contains(str(as_of_year))
    )


def dash_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Grade texts to doubles, a dash and unreadable text to NULL."""
    return df.withColumns({c: G.undash(F.col(c)) for c in columns})


def with_status(df: DataFrame, *, into: str = "status", names: ColumnMap = NAMES) -> DataFrame:
    return df.withColumn(into, G.grade_status(F.col(names.grade_final)))


def transmute_grades(df: DataFrame, *, names: ColumnMap = NAMES) -> DataFrame:
    """Add ``min``, ``mid`` and ``max``: the percentage band of the grade.

    The ten-entry table becomes a map literal, so there is no join.  A grade that
    has no band (4.00) stays NULL.
    """
    grade = F.col(names.grade).cast(GRADE_TYPE)
    bands = {}
    for position, name in enumerate(("min", "mid", "max"), start=1):
        entries: list[Column] = []
        for row in K.PERCENT_BANDS:
            entries += [F.lit(row[0]).cast(GRADE_TYPE), F.lit(row[position]).cast(GRADE_TYPE)]
        bands[name] = F.try_element_at(F.create_map(*entries), grade)
    return df.withColumns(bands)


# -- types and shape ---------------------------------------------------------
CAST_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "decimal(5,2)": GRADE_TYPE,
}


def cast_columns(df: DataFrame, casts: Sequence[tuple[str, str]]) -> DataFrame:
    """Cast by ``(column, type name)``; a value that does not fit becomes NULL."""
    unknown = sorted({kind for _, kind in casts} - set(CAST_TYPES))
    if unknown:
        raise ValueError(f"unsupported types {unknown}; known types are {sorted(CAST_TYPES)}")
    return df.withColumns({c: F.col(c).try_cast(CAST_TYPES[kind]) for c, kind in casts})


def with_processing_time(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Stamp rows; pass ``at`` where the result must be repeatable."""
    return df.withColumn("processing_time", F.current_timestamp() if at is None else at)


def merge_year_sem(df: DataFrame, *, names: ColumnMap = NAMES) -> DataFrame:
    """The five columns of the year-semester report, in reading order.

    Membership of the year in the table's own list of years only ever removes
    NULL years, so it is written as that test.  The sort is the report's last
    step: a range partitioning on four keys, which splits a busy student.
    """
    return (
        df.where(F.col(names.schoolyear).isNotNull())
        .transform(year_semesters, into=names.yearsem, ordinal=True, names=names)
        .orderBy(names.srcode, names.start_year, names.sem_order, names.description)
        .select(names.srcode, names.yearsem, names.description, names.grade, names.program)
    )


def filter_project(df: DataFrame, condition: Column | str, columns: Sequence[str]) -> DataFrame:
    """Filter, then project; both reach the scan when the columns are stored ones."""
    return df.where(condition).select(*columns)


def _text_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
