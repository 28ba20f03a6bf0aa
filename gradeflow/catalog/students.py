"""Queries per student and program: latest program, lookups, series, careers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeflow.catalog import steps as S
from gradeflow.catalog.registry import query, view
from gradeflow.catalog.rows import _TRANSMUTED, cased, cleaned
from gradeflow.functions.terms import canonical_semester
from gradeflow.operators import cleaning as C
from gradeflow.operators import lookups as L
from gradeflow.operators import profiling as P
from gradeflow.operators import students as U
from gradeflow.plans import careers as careers_plan
from gradeflow.plans import fixtures as X
from gradeflow.plans.series import semester_series
from gradeflow.sources.scratch import scratch_path
from gradeflow.sources.tables import read_career_maps, write_json


def series(spark: SparkSession, sf: str) -> DataFrame:
    return semester_series(cleaned(spark, sf), X.programs(spark, sf), order=X.NEWEST)


# -- latest record and program ----------------------------------------------
@query(
    f"""SELECT srcode, row_key, schoolyear, program FROM (
          SELECT *, row_number() OVER (PARTITION BY srcode ORDER BY {S.NEWEST}) AS rn
          FROM raw_grades) ranked WHERE rn = 1"""
)
def latest_record(spark, sf):
    return U.latest_record(X.raw_grades(spark, sf), ["srcode"], X.NEWEST).select(
        "srcode", "row_key", "schoolyear", "program"
    )


@query("SELECT srcode, row_key, program, schoolyear, semester, grade_numeric FROM current_grades")
def latest_program(spark, sf):
    return (
        cleaned(spark, sf)
        .transform(U.latest_program, X.NEWEST)
        .select("srcode", "row_key", "program", "schoolyear", "semester", "grade_numeric")
    )


@query(
    """SELECT srcode, count(program) AS program_count, max(program) AS current_program
       FROM raw_grades GROUP BY srcode HAVING count(program) > 1"""
)
def shifters(spark, sf):
    return X.raw_grades(spark, sf).transform(U.shifters)


@query(
    """SELECT srcode, count(DISTINCT program) AS program_count, max(program) AS current_program
       FROM raw_grades GROUP BY srcode HAVING count(DISTINCT program) > 1"""
)
def shifters_distinct(spark, sf):
    return X.raw_grades(spark, sf).transform(U.shifters, distinct=True)


_KNOWN_TERM = """semester IN ('SECOND_X', 'SECOND SEMESTER', 'FIRST', 'SECOND', 'SUMMER', 'SUMMER2')"""
view("newest_cased", S.newest_programs("cased"))
view(
    "reached",
    f"""SELECT count(*) AS c0, count(*) FILTER (WHERE latest) AS c1,
          count(*) FILTER (WHERE latest AND {_KNOWN_TERM}) AS c2,
          count(*) FILTER (WHERE latest AND {_KNOWN_TERM} AND program <> 'NULL') AS c3
        FROM (SELECT c.program, c.semester, n.srcode IS NOT NULL AS latest FROM cased c
              LEFT JOIN newest_cased n ON c.srcode = n.srcode AND c.program = n.program) marked""",
)


@query(
    """SELECT stage_no, stage, rows, removed,
         round(100.0 * CAST(rows AS DOUBLE) / c0, 6) AS percent_of_input
       FROM (SELECT 0 AS stage_no, 'input' AS stage, c0 AS rows, c0 - c0 AS removed, c0 FROM reached
             UNION ALL SELECT 1, 'latest program', c1, c0 - c1, c0 FROM reached
             UNION ALL SELECT 2, 'known semester', c2, c1 - c2, c0 FROM reached
             UNION ALL SELECT 3, 'program given', c3, c2 - c3, c0 FROM reached) lines"""
)
def retention_report(spark, sf):
    marked = cased(spark, sf).transform(U.mark_latest_program, X.NEWEST)
    return marked.transform(
        P.retention,
        {
            "latest program": F.col("is_latest_program"),
            "known semester": canonical_semester(F.col("semester")).isNotNull(),
            "program given": F.col("program") != "NULL",
        },
    )


# -- program lookup ----------------------------------------------------------
@query("SELECT r.row_key, r.program, p.program_id FROM raw_grades r LEFT JOIN program_list p USING (program)")
def map_program_ids(spark, sf):
    raw, programs = X.raw_grades(spark, sf), X.programs(spark, sf)
    return L.map_program_ids(raw, programs).select("row_key", "program", "program_id")


@query("SELECT r.row_key, r.program, p.program_id FROM raw_grades r LEFT JOIN alias_list p USING (program)")
def map_program_ids_alias(spark, sf):
    raw, programs = X.raw_grades(spark, sf), X.programs(spark, sf)
    return L.map_program_ids(raw, programs, aliases=X.PROGRAM_ALIASES).select(
        "row_key", "program", "program_id"
    )


# -- semester series ---------------------------------------------------------
@query(
    """SELECT srcode, year_sem, program, round(avg(CAST(grade_numeric AS DOUBLE)), 6) AS sem_average
       FROM current_grades GROUP BY srcode, year_sem, program"""
)
def semester_averages(spark, sf):
    return (
        cleaned(spark, sf)
        .transform(U.latest_program_terms, X.NEWEST)
        .transform(U.term_averages)
        .withColumn("sem_average", F.round("sem_average", 6))
    )


@query("SELECT srcode, semester, round(sem_average, 6) AS sem_average, program_id FROM series")
def semester_index(spark, sf):
    return series(spark, sf).withColumn("sem_average", F.round("sem_average", 6))


@query("SELECT srcode, program_id, max_semester FROM student_maxima")
def student_max_semester(spark, sf):
    return series(spark, sf).transform(U.student_max_semester)


@query(
    """SELECT g.program_id, p.program, max(max_semester) AS common_max_semester,
         max(semester_count) AS student_count
       FROM semester_groups g LEFT JOIN program_list p ON g.program_id = p.program_id
       GROUP BY g.program_id, p.program"""
)
def common_semesters(spark, sf):
    return U.common_semesters(series(spark, sf), X.programs(spark, sf))


@query(
    """SELECT program_id, max_semester AS common_max_semester, semester_count AS student_count
       FROM (SELECT *, row_number() OVER (
               PARTITION BY program_id ORDER BY semester_count DESC, max_semester DESC) AS rn
             FROM semester_groups) ranked WHERE rn = 1"""
)
def common_semesters_mode(spark, sf):
    return series(spark, sf).transform(U.common_semesters_mode)


def stored_series(spark: SparkSession, sf: str) -> DataFrame:
    """The series as a written table, for what reads it more than once."""
    path = scratch_path(spark, "series")
    series(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


_WITH_MAX = """SELECT s.*, m.program_max_semester
    FROM series s LEFT JOIN program_maxima m ON s.program_id = m.program_id"""


@query(
    f"""SELECT srcode, program_id, semester, round(sem_average, 6) AS sem_average, program_max_semester
        FROM ({_WITH_MAX}) w"""
)
def program_max_semester(spark, sf):
    return (
        stored_series(spark, sf)
        .transform(U.attach_program_max)
        .withColumn("sem_average", F.round("sem_average", 6))
    )


@query(
    f"""SELECT srcode, program_id, program_max_semester, round(avg(sem_average), 6) AS overall_average,
          count(semester) AS semesters_taken
        FROM ({_WITH_MAX}) w GROUP BY srcode, program_id, program_max_semester"""
)
def student_summary(spark, sf):
    return (
        stored_series(spark, sf)
        .transform(U.attach_program_max)
        .transform(U.student_summary)
        .withColumn("overall_average", F.round("overall_average", 6))
    )


@query(
    f"""SELECT srcode, program, year_sem, round(avg(CAST(min AS DOUBLE)), 6) AS min_avg,
          round(avg(CAST(mid AS DOUBLE)), 6) AS mid_avg, round(avg(CAST(max AS DOUBLE)), 6) AS max_avg
        FROM ({_TRANSMUTED}) t GROUP BY srcode, program, year_sem"""
)
def gwa_scales(spark, sf):
    averages = cleaned(spark, sf).transform(C.transmute_grades).transform(U.gwa_scales)
    return averages.withColumns({c: F.round(c, 6) for c in ("min_avg", "mid_avg", "max_avg")})


@query(
    "SELECT row_key, sha256(concat("
    + ", ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(length({c}), ':', {c}) END"
        for c in ("srcode", "schoolyear", "semester", "trim(code)", "grade_reexam", "concat('a|', class_section)", "row_key")
    )
    + ")) AS record_key FROM raw_grades"
)
def surrogate_key(spark, sf):
    natural = ["srcode", "schoolyear", "semester", "code", "grade_reexam", "class_section", "row_key"]
    return (
        X.raw_grades(spark, sf)
        .transform(C.clean_strings, ["code"])
        .withColumn("class_section", F.concat(F.lit("a|"), "class_section"))
        .transform(U.with_record_key, natural)
        .select("row_key", "record_key")
    )


# -- careers -----------------------------------------------------------------
@query("SELECT map_program, description, career FROM career_list")
def career_map_explode(spark, sf):
    path = scratch_path(spark, "careers")
    write_json(X.career_documents(spark, sf), path)
    return L.explode_career_maps(read_career_maps(spark, path, multiline=False))


@query(
    """SELECT srcode, c.description, grade_numeric, career FROM cleaned c
       JOIN career_list m ON c.description = m.description WHERE m.map_program = 'PROMO'"""
)
def course_careers(spark, sf):
    return careers_plan.program_careers(
        cleaned(spark, sf), X.career_documents(spark, sf), "PROMO"
    )


@query(
    """SELECT srcode, c.description, grade_numeric, career, map_program FROM cleaned c
       JOIN career_list m ON c.description = m.description"""
)
def course_careers_all(spark, sf):
    return careers_plan.all_careers(cleaned(spark, sf), X.career_documents(spark, sf))


#: The second edition of a map leaves out careers that end so.
_LEFT_OUT = "1"


@query(
    """SELECT srcode, description, grade_numeric, career, map_program, sha256(concat("""
    + ", ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(length(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)) END"
        for c in ("map_program", *careers_plan.RECORD)
    )
    + f""")) AS uuid FROM (SELECT srcode, c.description, grade_numeric, career, map_program FROM cleaned c
       JOIN (SELECT * FROM career_list UNION ALL SELECT * FROM career_list WHERE career NOT LIKE '%{_LEFT_OUT}') m
         ON c.description = m.description) careers"""
)
def career_tables(spark, sf):
    """Career rows of two editions of every map, each file a map: written as one folder per file and read back."""
    path = scratch_path(spark, "career-tables")
    first = X.career_documents(spark, sf)
    shorter = F.transform(
        "courses", lambda entry: entry.withField("careers", F.filter(entry["careers"], lambda c: ~c.endswith(_LEFT_OUT)))
    )
    write_json(first, f"{path}/first")
    write_json(first.withColumn("courses", shorter), f"{path}/second")
    maps = read_career_maps(spark, [f"{path}/first", f"{path}/second"], multiline=False, by_file=True)
    careers_plan.write_careers(careers_plan.all_careers(cleaned(spark, sf), maps), f"{path}/tables")
    return spark.read.parquet(f"{path}/tables").select(*careers_plan.RECORD, "map_program", "uuid")
