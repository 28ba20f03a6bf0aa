"""The steps of the checks in SQL, and small text helpers to write them with."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from gradeflow.catalog.registry import view
from gradeflow.plans import fixtures as X

RAW = (
    "id", "row_key", "updated_at", "schoolyear", "semester", "code", "description", "units",
    "instructor_id", "instructor_name", "srcode", "fullname", "campus", "college", "program",
    "major", "yearlevel", "curriculum", "class_section", "grade_final", "grade_reexam", "status",
)
SHOWN = tuple(c for c in RAW if c != "updated_at")
MARKS = "('PASSED', 'P', 'OG', 'F')"
SCALE = "(0, 1.00, 1.25, 1.50, 1.75, 2.00, 2.25, 2.50, 2.75, 3.00, 4.00, 5.00)"


def rewrite(
    source: str,
    replace: Mapping[str, str] | None = None,
    add: Mapping[str, str] | None = None,
    where: str | None = None,
    columns: Sequence[str] = RAW,
) -> str:
    replace = dict(replace or {})
    items = [f"{replace[c]} AS {c}" if c in replace else c for c in columns]
    items += [f"{expression} AS {c}" for c, expression in (add or {}).items()]
    tail = f"\nWHERE {where}" if where else ""
    return f"SELECT {', '.join(items)}\nFROM {source}{tail}"


def upper(*columns: str) -> dict[str, str]:
    return {c: f"upper({c})" for c in columns}


def trim(*columns: str) -> dict[str, str]:
    return {c: f"trim({c})" for c in columns}


def strict(column: str) -> str:
    return f"regexp_matches({column}, '^[0-9]+[.][0-9]+$')"


def loose(column: str) -> str:
    return f"regexp_matches({column}, '^[0-9]+[.]?[0-9]*$')"


SEMESTER = """CASE WHEN semester IN ('SECOND_X', 'SECOND SEMESTER') THEN 'SECOND'
  WHEN semester IN ('FIRST', 'SECOND', 'SUMMER', 'SUMMER2') THEN semester END"""
SPAN = "regexp_extract(schoolyear, '([0-9]{4}-[0-9]{4})', 1)"
IS_SPAN = "regexp_matches(schoolyear, '^[0-9]{4}-[0-9]{4}$')"
START_YEAR = "TRY_CAST(split_part(schoolyear, '-', 1) AS INTEGER)"
SEM_ORDER = """CASE semester WHEN 'FIRST' THEN 1 WHEN 'SECOND' THEN 2 WHEN 'SUMMER' THEN 3 END"""
YEARSEM = "concat(schoolyear, '-', semester)"
IN_TERM = "semester IN ('FIRST', 'SECOND', 'SUMMER')"


def numeric(test) -> str:
    return f"""coalesce(CASE
    WHEN grade_reexam IS NOT NULL AND grade_reexam NOT IN {MARKS} AND {test('grade_reexam')}
      THEN TRY_CAST(grade_reexam AS DOUBLE)
    WHEN grade_final NOT IN ('DRP', 'INC') AND {test('grade_final')}
      THEN TRY_CAST(grade_final AS DOUBLE)
    WHEN grade_final = 'DRP' THEN 0.0 END, CAST(5 AS DOUBLE))"""


CLASS = f"""CASE
    WHEN {strict('grade_final')} AND (grade_reexam IS NULL OR grade_reexam IN {MARKS}) THEN 'NORMAL'
    WHEN grade_final IN ('-', '--') AND {strict('grade_reexam')} THEN 'NORMAL'
    WHEN grade_final = 'INC' AND {strict('grade_reexam')} THEN 'INC'
    WHEN grade_final = 'DRP' THEN 'DROP'
    WHEN {strict('grade_final')} AND grade_reexam = 'INC' THEN 'INC'
    WHEN {strict('grade_final')} AND NOT {strict('grade_reexam')} THEN 'NORMAL'
    WHEN {strict('grade_final')} AND {strict('grade_reexam')}
      AND TRY_CAST(grade_final AS DOUBLE) > TRY_CAST(grade_reexam AS DOUBLE) THEN 'IMPROVED(REEXAM)'
    WHEN {strict('grade_final')} AND {strict('grade_reexam')}
      AND TRY_CAST(grade_final AS DOUBLE) < TRY_CAST(grade_reexam AS DOUBLE) THEN 'FAILED(REEXAM)'
    ELSE 'INVALID' END"""
DECIMAL_GRADE = "CAST(grade_numeric AS DECIMAL(5, 2))"
CLOSED = (
    f"NOT (grade_final = 'INC' AND grade_reexam IS NULL "
    f"AND contains(schoolyear, '{X.AS_OF_YEAR}'))"
)

_FROM = """FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

# -- inputs ------------------------------------------------------------------
view("raw_grades", f"SELECT {X.RAW_COLUMNS} {_FROM}")
view("curriculum_courses", f"SELECT {X.CURRICULUM_FIELDS} FROM part")
view("program_list", X.PROGRAM_ROWS.format(customer="customer"))
view(
    "alias_list",
    "SELECT program, program_id FROM program_list WHERE program NOT IN ("
    + ", ".join(f"'{n}'" for n in X.PROGRAM_ALIASES)
    + ") UNION ALL SELECT * FROM (VALUES "
    + ", ".join(f"('{n}', {i})" for n, i in X.PROGRAM_ALIASES.items())
    + ") aliases(program, program_id)",
)
view(
    "career_list",
    "SELECT DISTINCT p_type AS map_program, p_name AS description, p_brand AS career FROM part",
)

# -- the main cleaning flow --------------------------------------------------
view("cased", rewrite("raw_grades", upper("grade_final", "campus", "semester", "schoolyear")))
view("termed", rewrite("cased", {"semester": SEMESTER}))
view(
    "trimmed",
    rewrite(
        "termed",
        trim(
            "schoolyear", "semester", "code", "description", "instructor_id", "instructor_name",
            "srcode", "fullname", "campus", "program", "grade_final", "grade_reexam", "status",
            "major", "curriculum", "class_section",
        ),
        where="semester IS NOT NULL",
    ),
)
view("spanned", rewrite("trimmed", {"schoolyear": SPAN}))
view(
    "numbered",
    rewrite(
        "spanned",
        add={"grade_numeric": numeric(strict)},
        where=f"{IS_SPAN} AND grade_final NOT IN {MARKS}",
    ),
)
view(
    "classified",
    rewrite(
        "numbered",
        {"grade_reexam": f"CASE WHEN {strict('grade_reexam')} THEN grade_reexam END"},
        {"grade_numeric": DECIMAL_GRADE, "grade_classification": CLASS},
        where=f"grade_numeric IN {SCALE} AND program <> 'NULL'",
    ),
)
CLEANED = (*RAW, "grade_numeric", "grade_classification", "start_year", "year_sem")
view(
    "cleaned",
    rewrite(
        "classified",
        add={"start_year": START_YEAR, "year_sem": YEARSEM},
        where=f"{CLOSED} AND grade_numeric <> 0 AND {START_YEAR} >= 2006 AND {IN_TERM} "
        "AND grade_numeric IS NOT NULL",
        columns=(*RAW, "grade_numeric", "grade_classification"),
    ),
)

# -- students ----------------------------------------------------------------
NEWEST = "schoolyear DESC NULLS LAST, row_key DESC NULLS LAST"
VERSION = "updated_at DESC NULLS LAST, row_key DESC NULLS LAST"


def newest_programs(source: str) -> str:
    return (
        f"SELECT srcode, program FROM (SELECT srcode, program, row_number() OVER "
        f"(PARTITION BY srcode ORDER BY {NEWEST}) AS rn FROM {source}) ranked WHERE rn = 1"
    )


view("newest", newest_programs("cleaned"))
view(
    "current_grades",
    "SELECT c.* FROM cleaned c JOIN newest n ON c.srcode = n.srcode AND c.program = n.program",
)
view(
    "averages",
    """SELECT srcode, year_sem AS yearsem, program_id,
         sum(CAST(grade_numeric AS DOUBLE)) / count(grade_numeric) AS sem_average
       FROM current_grades LEFT JOIN program_list USING (program)
       GROUP BY srcode, year_sem, program_id""",
)
view(
    "series",
    """SELECT srcode, program_id, sem_average,
         CAST(dense_rank() OVER (PARTITION BY srcode ORDER BY yearsem) AS INTEGER) AS semester
       FROM averages""",
)
view(
    "program_maxima",
    "SELECT program_id, max(semester) AS program_max_semester FROM series GROUP BY program_id",
)
view(
    "student_maxima",
    "SELECT srcode, program_id, max(semester) AS max_semester FROM series GROUP BY srcode, program_id",
)
view(
    "semester_groups",
    """SELECT program_id, max_semester, count(*) AS semester_count
       FROM student_maxima GROUP BY program_id, max_semester""",
)

# -- forecasts ---------------------------------------------------------------
view(
    "parts",
    """SELECT srcode, program_id, semester, sem_average AS y,
         count(*) OVER (PARTITION BY srcode, program_id) AS n,
         row_number() OVER (PARTITION BY srcode, program_id ORDER BY semester)
           <= greatest(1, floor(count(*) OVER (PARTITION BY srcode, program_id)
                                * CAST(0.8 AS DOUBLE))) AS is_train
       FROM series""",
)
view(
    "predicted",
    """SELECT t.srcode, t.program_id, t.semester, t.y AS actual,
         greatest(CAST(1 AS DOUBLE), least(CAST(5 AS DOUBLE), k.mean)) AS prediction
       FROM parts t JOIN (
         SELECT srcode, program_id, avg(y) AS mean FROM parts WHERE is_train
         GROUP BY srcode, program_id) k
       ON t.srcode = k.srcode AND t.program_id IS NOT DISTINCT FROM k.program_id
       WHERE NOT t.is_train AND t.n >= 2""",
)
view(
    "ahead",
    """SELECT srcode, program_id, CAST(count(*) + 1 AS INTEGER) AS semester,
         avg(sem_average) AS cumulative_gwa, arg_max(sem_average, semester) AS last_y
       FROM series GROUP BY srcode, program_id""",
)

# -- versions ----------------------------------------------------------------
INSTANTS = ("20240101000000000", "20240201000000500", "20240301000000000")
_COMMIT = (
    f"CASE WHEN year(updated_at) <= 1996 THEN '{INSTANTS[0]}' "
    f"WHEN year(updated_at) <= 1998 THEN '{INSTANTS[1]}' ELSE '{INSTANTS[2]}' END"
)
view(
    "change_log",
    f"""SELECT * FROM (
         SELECT *, row_number() OVER (
           PARTITION BY record_key, commit_time ORDER BY {VERSION}) AS version
         FROM (SELECT raw_grades.*, CAST(id AS VARCHAR) AS record_key, {_COMMIT} AS commit_time
               FROM raw_grades) stamped) versions
       WHERE version = 1""",
)


def latest_version(source: str) -> str:
    """A table of the newest version per record, to select from."""
    return (
        f"(SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY commit_time DESC) AS age "
        f"FROM {source}) newest_first WHERE age = 1"
    )
