"""Dimension lookups: program ids and course-to-career maps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeflow.functions import constants as K
from gradeflow.operators.joins import BROADCAST_ROWS, ROWS_PER_SPLIT, lookup, measured


def unique_programs(programs: DataFrame) -> DataFrame:
    """One id per program name; should a list repeat a name, the highest id wins."""
    return (
        programs.where(F.col("program").isNotNull())
        .groupBy("program")
        .agg(F.max("program_id").alias("program_id"))
    )


def with_aliases(programs: DataFrame, aliases: Mapping[str, int] = K.PROGRAM_ALIASES) -> DataFrame:
    """Force the alias names to their ids, whatever the list says about them."""
    if not aliases:
        return programs.select("program", "program_id")
    entries = [x for name, number in aliases.items() for x in (F.lit(name), F.lit(number))]
    extra = programs.sparkSession.range(1).select(
        F.explode(F.create_map(*entries)).alias("program", "program_id")
    )
    return (
        programs.where(~F.col("program").isin(*aliases))
        .select("program", "program_id")
        .unionByName(extra)
    )


def map_program_ids(
    df: DataFrame,
    programs: DataFrame,
    *,
    aliases: Mapping[str, int] | None = None,
    max_rows: int = BROADCAST_ROWS,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Add ``program_id`` by exact name; unknown names get NULL."""
    if aliases:
        programs = with_aliases(programs, aliases)
    dimension = unique_programs(programs)
    return lookup(df, dimension, "program", max_rows=max_rows, rows_per_split=rows_per_split)


def explode_career_maps(documents: DataFrame) -> DataFrame:
    """Career documents to rows (map_program, description, career), and map_file if there is one.

    A course listed twice in one document keeps its last list of careers.
    Documents are told apart by ``program``, and by ``map_file`` if they come with it.
    """
    document = [F.col("program").alias("map_program"), *([F.col("map_file")] if "map_file" in documents.columns else [])]
    courses = documents.select(*document, F.posexplode("courses").alias("position", "entry"))
    names = [c for c in courses.columns if c.startswith("map_")]
    return (
        courses.groupBy(*names, F.col("entry.course").alias("description"))
        .agg(F.max_by("entry.careers", "position").alias("careers"))
        .select(*names, "description", F.explode("careers").alias("career"))
    )


def map_courses_to_careers(grades: DataFrame, careers: DataFrame) -> DataFrame:
    """Pair each graded course with the careers it leads to.

    ``careers`` has (description, career) and may carry ``map_program`` and ``map_file``,
    which are then kept.  Maps that are measured and small are broadcast, so the grades are
    not shuffled by course, of which there are few; otherwise both inputs reach the join
    through their own shuffle and adaptive execution splits a hot course.
    """
    small = measured(careers)
    careers = careers if small is None else F.broadcast(small)
    kept = [c for c in ("map_program", "map_file") if c in careers.columns]
    return grades.join(careers, "description").select(
        "srcode", "description", "grade_numeric", "career", *kept
    )
