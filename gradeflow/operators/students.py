"""Per-student and per-program results: latest program, semester series, summaries.

A student's *raw* rows are never gathered in one task: the top-1 operators keep
one row per student before the shuffle, aggregates combine map-side, and windows
run only over semester averages, of which a student has one per term and program.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeflow.columns import NAMES, ColumnMap
from gradeflow.operators.joins import (
    BROADCAST_ROWS,
    ROWS_PER_SPLIT,
    latest_first,
    lookup,
)


# -- latest record and program ----------------------------------------------
def latest_record(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key.  End ``order`` with a unique column.

    ``row_number() = 1`` lets Spark drop all but one row per key and task ahead of
    the shuffle, so a hot key costs one row per task.
    """
    newest = Window.partitionBy(*keys).orderBy(*latest_first(*order))
    return df.withColumn("__rank", F.row_number().over(newest)).where("__rank = 1").drop("__rank")


def latest_program(
    df: DataFrame, order: Sequence[str] = ("schoolyear",), *, names: ColumnMap = NAMES
) -> DataFrame:
    """Keep each student's rows of the program they were in last.

    A student whose newest row has no program is dropped.  The join is on student
    *and* program: neither side is yet partitioned that way, so both are shuffled
    and adaptive execution can split a hot student.
    """
    keys = [names.srcode, names.program]
    needed = list(dict.fromkeys([*keys, *order]))
    newest = df.select(*needed).transform(latest_record, [names.srcode], order).select(*keys)
    return df.join(newest, keys)


def mark_latest_program(
    df: DataFrame, order: Sequence[str] = ("schoolyear",), *, names: ColumnMap = NAMES
) -> DataFrame:
    """Keep all rows and add ``is_latest_program`` instead of dropping the others."""
    keys = [names.srcode, names.program]
    needed = list(dict.fromkeys([*keys, *order]))
    newest = (
        df.select(*needed)
        .transform(latest_record, [names.srcode], order)
        .select(*keys, F.lit(True).alias("is_latest_program"))
    )
    return df.join(newest, keys, "left").fillna({"is_latest_program": False})


def shifters(df: DataFrame, *, distinct: bool = False, names: ColumnMap = NAMES) -> DataFrame:
    """Students with more than one program (``distinct``) or program row."""
    program = F.col(names.program)
    count = F.count_distinct(program) if distinct else F.count(program)
    return (
        df.groupBy(names.srcode)
        .agg(count.alias("program_count"), F.max(program).alias("current_program"))
        .where("program_count > 1")
    )


# -- semester series ---------------------------------------------------------
def latest_program_terms(
    df: DataFrame,
    order: Sequence[str] = ("schoolyear",),
    *,
    term: str = "year_sem",
    names: ColumnMap = NAMES,
) -> DataFrame:
    """Grade totals per term of each student's latest program.

    Equals ``latest_program`` followed by an aggregate over student, term and
    program, but aggregates first: rows are read once and combined map-side, each
    group remembers its newest row, and the choice of the program is made among
    a student's groups.  Result: (srcode, term, program, total, graded).
    """
    grade = F.col(names.grade).cast("double")
    groups = df.groupBy(names.srcode, term, names.program).agg(
        F.sum(grade).alias("total"),
        F.count(grade).alias("graded"),
        F.max(F.struct(*order)).alias("__newest"),
    )
    newest_first = Window.partitionBy(names.srcode).orderBy(F.desc("__newest"))
    current = F.first(names.program).over(newest_first)
    return (
        groups.withColumn("__current", current)
        .where(F.col(names.program) == F.col("__current"))
        .drop("__current", "__newest")
    )


def term_averages(terms: DataFrame) -> DataFrame:
    """Totals to averages."""
    return terms.withColumn("sem_average", F.col("total") / F.col("graded")).drop("total", "graded")


def semester_averages(
    df: DataFrame,
    by: Sequence[str] = ("srcode", "yearsem", "program_id"),
    grade: str = "grade_numeric",
) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.col(grade).cast("double")).alias("sem_average"))


def semester_index(averages: DataFrame) -> DataFrame:
    """Number a student's terms 1, 2, ... in the order of time.

    Input is one row per student, term and program, so the window holds a
    student's terms, not a student's grades.
    """
    terms = Window.partitionBy("srcode").orderBy("yearsem")
    return averages.withColumn("semester", F.dense_rank().over(terms)).select(
        "srcode", "semester", "sem_average", "program_id"
    )


def student_max_semester(series: DataFrame) -> DataFrame:
    return series.groupBy("srcode", "program_id").agg(F.max("semester").alias("max_semester"))


def common_semesters(series: DataFrame, program_names: DataFrame) -> DataFrame:
    """Per program: the longest course of study and the largest group of students.

    The two maxima are taken independently, so they need not describe the same
    group; :func:`common_semesters_mode` gives the most frequent length.  An id
    with several names yields one row per name.
    """
    stats = (
        _semester_groups(series)
        .groupBy("program_id")
        .agg(
            F.max("max_semester").alias("common_max_semester"),
            F.max("semester_count").alias("student_count"),
        )
    )
    return stats.join(program_names.select("program", "program_id").distinct(), "program_id", "left")


def common_semesters_mode(series: DataFrame) -> DataFrame:
    """Per program: the most frequent course length; the longer one on a tie."""
    groups = _semester_groups(series)
    return (
        groups.groupBy("program_id")
        .agg(F.max(F.struct("semester_count", "max_semester")).alias("mode"))
        .select(
            "program_id",
            F.col("mode.max_semester").alias("common_max_semester"),
            F.col("mode.semester_count").alias("student_count"),
        )
    )


def _semester_groups(series: DataFrame) -> DataFrame:
    return (
        student_max_semester(series)
        .groupBy("program_id", "max_semester")
        .agg(F.count(F.lit(1)).alias("semester_count"))
    )


def program_max_semester(series: DataFrame) -> DataFrame:
    return series.groupBy("program_id").agg(F.max("semester").alias("program_max_semester"))


def attach_program_max(
    series: DataFrame,
    *,
    max_rows: int = BROADCAST_ROWS,
    rows_per_split: int = ROWS_PER_SPLIT,
    at_rest: bool = False,
) -> DataFrame:
    """Add each program's longest course of study; an unknown program gets NULL.

    The maxima are measured and broadcast if small; otherwise hot programs are split,
    from a stored copy unless ``series`` is ``at_rest`` in files. It is read twice.
    """
    maxima = program_max_semester(series)
    return lookup(series, maxima, "program_id", max_rows=max_rows, rows_per_split=rows_per_split, at_rest=at_rest)


def student_summary(series_with_max: DataFrame) -> DataFrame:
    return series_with_max.groupBy("srcode", "program_id", "program_max_semester").agg(
        F.avg("sem_average").alias("overall_average"),
        F.count("semester").alias("semesters_taken"),
    )


def gwa_scales(transmuted: DataFrame, by: Sequence[str] = ("srcode", "program", "year_sem")) -> DataFrame:
    """General average per student, program and term on the three percentage scales."""
    return transmuted.groupBy(*by).agg(
        *(F.avg(F.col(c).cast("double")).alias(f"{c}_avg") for c in ("min", "mid", "max"))
    )


def natural_key(columns: Sequence[str]) -> Column:
    """One text for several columns, different for different values: each part is its
    length, a colon and its text, or a dash if it is NULL."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat(*(F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def with_record_key(df: DataFrame, columns: Sequence[str], into: str = "record_key") -> DataFrame:
    """A key that stays the same when rows are recomputed: a hash of the natural key."""
    return df.withColumn(into, F.sha2(natural_key(columns), 256))
