"""From cleaned grades to a student's semester series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeflow.operators import students as S
from gradeflow.operators.lookups import map_program_ids


def semester_series(
    cleaned: DataFrame,
    programs: DataFrame,
    *,
    order: Sequence[str] = ("schoolyear",),
    aliases: Mapping[str, int] | None = None,
) -> DataFrame:
    """Latest program -> average per term -> program id -> terms numbered.

    One scan and two shuffles, both of aggregated rows.  A student is left with
    one program here, hence with one row per term, so the lookup by name needs no
    second aggregate by id.
    """
    averages = cleaned.transform(S.latest_program_terms, order).transform(S.term_averages)
    return S.semester_index(
        map_program_ids(averages, programs, aliases=aliases).withColumnRenamed("year_sem", "yearsem")
    )


def grade_series(series: DataFrame) -> DataFrame:
    """Semester averages under the names the forecast operators use."""
    return series.select("srcode", "program_id", "semester", F.col("sem_average").alias("y"))
