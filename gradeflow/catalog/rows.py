"""Row-level queries: cleaning, curriculum, profiles, whole cleaning flows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeflow.catalog import steps as S
from gradeflow.catalog.registry import query
from gradeflow.functions import constants as K
from gradeflow.operators import cleaning as C
from gradeflow.operators import curriculum as U
from gradeflow.operators import profiling as P
from gradeflow.operators.joins import anti_join, new_rows, semi_join, union_batches
from gradeflow.plans import cleaning as plans
from gradeflow.plans import fixtures as X

GRADES = "row_key, grade_final, grade_reexam"
SHOWN = ", ".join(S.SHOWN)


def cased(spark: SparkSession, sf: str) -> DataFrame:
    return X.raw_grades(spark, sf).transform(C.standardize_case, plans.CASED)


def spanned(spark: SparkSession, sf: str) -> DataFrame:
    return cased(spark, sf).transform(C.clean_schoolyear)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return plans.clean_grades(X.raw_grades(spark, sf), X.AS_OF_YEAR)


# -- text and terms ----------------------------------------------------------
@query("SELECT row_key, grade_final, campus, semester, schoolyear FROM cased")
def standardize_case(spark, sf):
    return cased(spark, sf).select("row_key", "grade_final", "campus", "semester", "schoolyear")


@query("SELECT row_key, trim(code) AS code, trim(description) AS description, units FROM raw_grades")
def clean_strings(spark, sf):
    return (
        X.raw_grades(spark, sf)
        .transform(C.clean_strings, ["code", "description", "units"])
        .select("row_key", "code", "description", "units")
    )


@query(S.rewrite("raw_grades", S.trim(*(c for c in S.SHOWN if c not in ("id", "units"))), columns=S.SHOWN))
def trim_all(spark, sf):
    return X.raw_grades(spark, sf).transform(C.trim_all).select(*S.SHOWN)


@query("SELECT row_key, program FROM raw_grades WHERE program <> 'NULL'")
def remove_null_strings(spark, sf):
    return X.raw_grades(spark, sf).transform(C.remove_null_strings, "program").select("row_key", "program")


@query("SELECT row_key, semester FROM termed WHERE semester IS NOT NULL")
def clean_semesters(spark, sf):
    return cased(spark, sf).transform(C.clean_semesters).select("row_key", "semester")


@query(f"SELECT row_key, {S.SPAN} AS schoolyear FROM cased WHERE {S.SPAN} <> ''")
def clean_schoolyear(spark, sf):
    return spanned(spark, sf).select("row_key", "schoolyear")


@query(
    f"""SELECT row_key, schoolyear, {S.START_YEAR} AS start_year
        FROM (SELECT row_key, {S.SPAN} AS schoolyear FROM cased) years
        WHERE {S.START_YEAR} >= 2006"""
)
def valid_schoolyears(spark, sf):
    return (
        spanned(spark, sf)
        .transform(C.valid_schoolyears)
        .select("row_key", "schoolyear", "start_year")
    )


# -- grades ------------------------------------------------------------------
@query(f"SELECT {GRADES} FROM cased WHERE grade_final NOT IN {S.MARKS}")
def filter_invalid_grades(spark, sf):
    return (
        cased(spark, sf)
        .transform(C.filter_invalid_grades)
        .select("row_key", "grade_final", "grade_reexam")
    )


@query(f"SELECT {GRADES}, {S.numeric(S.strict)} AS grade_numeric FROM cased")
def grade_numeric_strict(spark, sf):
    return (
        cased(spark, sf)
        .transform(C.with_numeric_grade)
        .select("row_key", "grade_final", "grade_reexam", "grade_numeric")
    )


@query(f"SELECT {GRADES}, {S.numeric(S.loose)} AS grade_numeric FROM cased")
def grade_numeric_loose(spark, sf):
    return (
        cased(spark, sf)
        .transform(C.with_numeric_grade, K.LOOSE_GRADE)
        .select("row_key", "grade_final", "grade_reexam", "grade_numeric")
    )


@query(
    f"""SELECT {GRADES}, {S.DECIMAL_GRADE} AS grade_numeric
        FROM (SELECT {GRADES}, {S.numeric(S.strict)} AS grade_numeric FROM cased) g
        WHERE grade_numeric IN {S.SCALE}"""
)
def filter_valid_grades(spark, sf):
    return (
        cased(spark, sf)
        .transform(C.with_numeric_grade)
        .transform(C.filter_valid_grades)
        .select("row_key", "grade_final", "grade_reexam", "grade_numeric")
    )


@query(f"SELECT {GRADES}, {S.CLASS} AS grade_classification FROM cased")
def grade_classification(spark, sf):
    return (
        cased(spark, sf)
        .transform(C.with_classification)
        .select("row_key", "grade_final", "grade_reexam", "grade_classification")
    )


@query(
    f"""SELECT row_key, CASE WHEN {S.strict('grade_reexam')} THEN grade_reexam END AS grade_reexam,
          CASE WHEN regexp_matches(grade_reexam, '^[0-9]*[.]?[0-9]+$') THEN grade_reexam END AS loose
        FROM raw_grades"""
)
def numeric_or_null(spark, sf):
    return (
        X.raw_grades(spark, sf)
        .withColumn("loose", F.col("grade_reexam"))
        .transform(C.numeric_or_null, "grade_reexam")
        .transform(C.numeric_or_null, "loose", K.LOOSE_REEXAM)
        .select("row_key", "grade_reexam", "loose")
    )


@query(
    """SELECT row_key, TRY_CAST(grade_final AS DECIMAL(5, 2)) AS grade_final,
         TRY_CAST(grade_reexam AS DOUBLE) AS grade_reexam, TRY_CAST(yearlevel AS INTEGER) AS yearlevel,
         CAST(id AS VARCHAR) AS id
       FROM raw_grades"""
)
def cast_columns(spark, sf):
    return (
        X.raw_grades(spark, sf)
        .transform(
            C.cast_columns,
            [
                ("grade_final", "decimal(5,2)"),
                ("grade_reexam", "double"),
                ("yearlevel", "int"),
                ("id", "string"),
            ],
        )
        .select("row_key", "grade_final", "grade_reexam", "yearlevel", "id")
    )


@query(
    f"""SELECT row_key, schoolyear, grade_final, grade_reexam FROM (
          SELECT row_key, schoolyear, grade_final,
            CASE WHEN {S.strict('grade_reexam')} THEN grade_reexam END AS grade_reexam
          FROM numbered WHERE grade_numeric IN {S.SCALE} AND grade_numeric <> 0) n
        WHERE {S.CLOSED}"""
)
def filter_incomplete(spark, sf):
    return (
        cased(spark, sf)
        .transform(C.clean_semesters)
        .transform(C.clean_strings, plans.TRIMMED)
        .transform(C.clean_schoolyear)
        .transform(C.process_grades)
        .transform(C.numeric_or_null, "grade_reexam")
        .transform(C.filter_incomplete, X.AS_OF_YEAR)
        .transform(C.filter_dropped)
        .select("row_key", "schoolyear", "grade_final", "grade_reexam")
    )


@query(
    f"""SELECT row_key, grade_numeric, {S.START_YEAR} AS start_year, {S.YEARSEM} AS year_sem
        FROM (SELECT row_key, {S.SPAN} AS schoolyear, semester, {S.numeric(S.strict)} AS grade_numeric
              FROM cased) g WHERE schoolyear <> '' AND {S.IN_TERM}"""
)
def yearsem(spark, sf):
    return (
        spanned(spark, sf)
        .transform(C.with_numeric_grade)
        .transform(C.year_semesters)
        .select("row_key", "grade_numeric", "start_year", "year_sem")
    )


@query(
    f"""SELECT row_key, {S.START_YEAR} AS start_year, {S.SEM_ORDER} AS sem_order, {S.YEARSEM} AS yearsem
        FROM (SELECT row_key, {S.SPAN} AS schoolyear, semester FROM cased) g
        WHERE schoolyear <> '' AND {S.IN_TERM}"""
)
def yearsem_ordered(spark, sf):
    return (
        spanned(spark, sf)
        .transform(C.with_numeric_grade)
        .transform(C.year_semesters, into="yearsem", ordinal=True)
        .select("row_key", "start_year", "sem_order", "yearsem")
    )


_BANDS = ", ".join(f"({','.join(band)})" for band in K.PERCENT_BANDS)
_TRANSMUTED = f"""SELECT c.*, b.lo AS min, b.mi AS mid, b.hi AS max
    FROM cleaned c LEFT JOIN (
      SELECT CAST(g AS DECIMAL(5, 2)) AS g, CAST(lo AS DECIMAL(5, 2)) AS lo,
        CAST(mi AS DECIMAL(5, 2)) AS mi, CAST(hi AS DECIMAL(5, 2)) AS hi
      FROM (VALUES {_BANDS}) bands(g, lo, mi, hi)) b ON c.grade_numeric = b.g"""


@query(f"SELECT row_key, grade_numeric, min, mid, max FROM ({_TRANSMUTED}) t")
def transmute_grades(spark, sf):
    return (
        cleaned(spark, sf)
        .transform(C.transmute_grades)
        .select("row_key", "grade_numeric", "min", "mid", "max")
    )


_UNDASHED = """SELECT row_key, TRY_CAST(nullif(grade_final, '-') AS DOUBLE) AS grade_final,
    TRY_CAST(nullif(grade_reexam, '-') AS DOUBLE) AS grade_reexam FROM raw_grades"""
_STATUS = """CASE WHEN grade_final IS NULL THEN 'PENDING' WHEN grade_final >= 3.0 THEN 'FAILED'
    WHEN grade_final <= 3.0 THEN 'PASSED' ELSE 'UNKNOWN' END"""


@query(_UNDASHED)
def dash_to_null(spark, sf):
    return (
        X.raw_grades(spark, sf)
        .transform(C.dash_to_null, ["grade_final", "grade_reexam"])
        .select("row_key", "grade_final", "grade_reexam")
    )


@query(f"SELECT row_key, grade_final, {_STATUS} AS status FROM ({_UNDASHED}) g")
def grade_status(spark, sf):
    return (
        X.raw_grades(spark, sf)
        .transform(C.dash_to_null, ["grade_final"])
        .transform(C.with_status)
        .select("row_key", "grade_final", "status")
    )


# -- filters, set operations -------------------------------------------------
@query(
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
       WHERE l_quantity > 20.0 AND l_returnflag = 'R'"""
)
def filter_project(spark, sf):
    return C.filter_project(
        X.table(spark, sf, "lineitem"),
        (F.col("l_quantity") > 20.0) & (F.col("l_returnflag") == "R"),
        ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"],
    )


@query("SELECT DISTINCT schoolyear FROM raw_grades")
def distinct_years(spark, sf):
    return X.raw_grades(spark, sf).transform(P.distinct_values, "schoolyear")


@query(
    """SELECT row_key, schoolyear FROM cleaned
       WHERE schoolyear IN (SELECT schoolyear FROM raw_grades WHERE schoolyear IS NOT NULL)"""
)
def semi_join_years(spark, sf):
    raw = X.raw_grades(spark, sf)
    grades = plans.clean_grades(raw, X.AS_OF_YEAR)
    return semi_join(grades, raw, "schoolyear").select("row_key", "schoolyear")


_KNOWN = "SELECT id FROM raw_grades WHERE year(updated_at) < 1998"


@query(f"SELECT row_key, id FROM raw_grades WHERE id NOT IN ({_KNOWN})")
def anti_join_new(spark, sf):
    raw = X.raw_grades(spark, sf)
    return anti_join(raw, raw.where(F.year("updated_at") < 1998), "id").select("row_key", "id")


@query(f"SELECT row_key, id FROM raw_grades WHERE id NOT IN ({_KNOWN}) ORDER BY id, row_key LIMIT 500")
def next_batch(spark, sf):
    raw = X.raw_grades(spark, sf)
    known = raw.where(F.year("updated_at") < 1998)
    return new_rows(raw, known, "id", 500, F.col("row_key")).select("row_key", "id")


@query(
    "SELECT row_key, grade_final FROM raw_grades UNION ALL SELECT row_key, grade_final FROM cleaned",
    name="union_batches",
)
def stacked_batches(spark, sf):
    raw = X.raw_grades(spark, sf)
    columns = ["row_key", "grade_final"]
    return union_batches(
        raw.select(*columns), plans.clean_grades(raw, X.AS_OF_YEAR).select(*reversed(columns))
    )


# -- curriculum --------------------------------------------------------------
_COURSE = (
    "id", "code", "description", "units", "type", "subtype", "program", "major", "college",
    "curriculum", "year_level", "semester", "lecture_hours", "lab_hours", "course_id",
    "curriculum_id",
)
_SLIPPED = "units IN ('Total Quality Management', 'Inorganic and Organic Chemistry')"
_SHIFTED = S.rewrite(
    "curriculum_courses",
    {
        name: f"CASE WHEN {_SLIPPED} THEN {source} ELSE {name} END"
        for name, source in zip(_COURSE[2:], [*_COURSE[3:], "NULL"], strict=True)
    },
    columns=_COURSE,
)
_COUNTED = f"SELECT * FROM ({_SHIFTED}) shifted WHERE units NOT IN ('NON', 'LAB')"


def _excluded(source: str) -> str:
    codes = " AND ".join(f"code NOT LIKE '%{p}%'" for p in K.CODE_PARTS_OUT)
    texts = " AND ".join(f"description NOT LIKE '%{p}%'" for p in K.DESCRIPTION_PARTS_OUT)
    colleges = " AND ".join(f"college NOT LIKE '%{p}%'" for p in K.COLLEGE_PARTS_OUT)
    return f"""SELECT * FROM ({source}) courses WHERE {codes}
        AND code NOT IN ('ES 101', 'PE 101', 'PE 102', 'PE 103', 'PE 104')
        AND (code NOT LIKE '%MATH%'
             OR (program = 'Bachelor of Secondary Education' AND major = 'Mathematics'))
        AND (description IS NULL OR ({texts})) AND type NOT LIKE '%OJT%' AND {colleges}"""


@query(_SHIFTED)
def shift_columns(spark, sf):
    return X.curriculum_courses(spark, sf).transform(U.shift_columns)


@query(_COUNTED)
def exclude_units(spark, sf):
    return X.curriculum_courses(spark, sf).transform(U.shift_columns).transform(U.exclude_units)


@query(_excluded("SELECT * FROM curriculum_courses"))
def curriculum_exclusions(spark, sf):
    return X.curriculum_courses(spark, sf).transform(U.exclude_courses)


@query(_excluded(_COUNTED))
def curriculum_cleaned(spark, sf):
    return X.curriculum_courses(spark, sf).transform(U.clean_curriculum)


# -- whole flows -------------------------------------------------------------
_CLEANED_SHOWN = ", ".join(f"c.{c}" for c in S.CLEANED if c != "updated_at")


@query(
    f"""SELECT {_CLEANED_SHOWN}, p.program_id
        FROM cleaned c LEFT JOIN program_list p ON c.program = p.program"""
)
def cleaned_grades(spark, sf):
    raw = X.raw_grades(spark, sf)
    return plans.clean_grades(raw, X.AS_OF_YEAR, programs=X.programs(spark, sf)).drop("updated_at")


_V2_TRIM = S.trim(*(c for c in plans.TRIMMED_V2 if c != "units"))
_V2_TERMED = S.rewrite(
    f"({S.rewrite('cased', _V2_TRIM)}) t", {"semester": S.SEMESTER}, where="program <> 'NULL'"
)
_V2_SPANNED = S.rewrite(f"({_V2_TERMED}) t", {"schoolyear": S.SPAN}, where="semester IS NOT NULL")
_V2_VALID = f"SELECT * FROM ({_V2_SPANNED}) t WHERE {S.IS_SPAN}"
_V2_NUMBERED = S.rewrite(
    f"({_V2_VALID}) v",
    add={"grade_numeric": S.numeric(S.loose)},
    where=f"grade_final NOT IN {S.MARKS} AND (srcode, program) IN "
    f"({S.newest_programs(f'({_V2_VALID}) w')})",
)
_V2_SHOWN = [c for c in S.SHOWN if c not in ("instructor_id", "instructor_name", "fullname")]
_V2 = S.rewrite(
    f"({_V2_NUMBERED}) n",
    add={
        "grade_numeric": S.DECIMAL_GRADE,
        "grade_classification": S.CLASS,
        "start_year": S.START_YEAR,
        "sem_order": S.SEM_ORDER,
        "yearsem": S.YEARSEM,
    },
    where=f"grade_numeric IN {S.SCALE} AND grade_numeric <> 0 AND {S.CLOSED} AND {S.IN_TERM}",
    columns=_V2_SHOWN,
)


@query(_V2)
def cleaned_grades_v2(spark, sf):
    done = plans.clean_grades_latest(X.raw_grades(spark, sf), X.AS_OF_YEAR, order=X.NEWEST)
    added = ["grade_numeric", "grade_classification", "start_year", "sem_order", "yearsem"]
    return done.select(*_V2_SHOWN, *added)


_V3_TRIMMED = S.rewrite(
    "termed", S.trim(*(c for c in S.SHOWN if c not in ("id", "units"))), where="semester IS NOT NULL",
    columns=S.SHOWN,
)
_V3_NUMBERED = S.rewrite(
    f"({S.rewrite(f'({_V3_TRIMMED}) t', {'schoolyear': S.SPAN}, columns=S.SHOWN)}) s",
    add={"grade_numeric": S.numeric(S.loose)},
    where=f"schoolyear <> '' AND grade_final NOT IN {S.MARKS}",
    columns=S.SHOWN,
)
_V3 = S.rewrite(
    f"({_V3_NUMBERED}) n",
    {
        "grade_reexam": "CASE WHEN regexp_matches(grade_reexam, '^[0-9]*[.]?[0-9]+$') "
        "THEN grade_reexam END"
    },
    {"grade_numeric": S.DECIMAL_GRADE},
    where=f"grade_numeric IN {S.SCALE}",
    columns=S.SHOWN,
)


@query(_V3)
def cleaned_grades_v3(spark, sf):
    return plans.clean_grades_mapped(X.raw_grades(spark, sf)).drop("updated_at")


@query(
    f"""SELECT srcode, {S.YEARSEM} AS yearsem, description, grade_numeric, program
        FROM ({_V3}) v WHERE {S.IN_TERM}"""
)
def merge_year_sem(spark, sf):
    return plans.clean_grades_mapped(X.raw_grades(spark, sf)).transform(C.merge_year_sem)


_V4_TEXT = {c: f"trim({c})" for c in plans.TRIMMED_V4} | {
    c: f"upper(trim({c}))" for c in plans.CASED_V4
}
_V4_TERMED = S.rewrite(
    f"({S.rewrite('raw_grades', _V4_TEXT, columns=S.SHOWN)}) t", {"semester": S.SEMESTER},
    columns=S.SHOWN,
)
_V4_GRADED = S.rewrite(
    f"({_V4_TERMED}) t",
    {
        "schoolyear": S.SPAN,
        "grade_final": "TRY_CAST(nullif(grade_final, '-') AS DOUBLE)",
        "grade_reexam": "TRY_CAST(nullif(grade_reexam, '-') AS DOUBLE)",
    },
    where="semester IS NOT NULL",
    columns=S.SHOWN,
)
V4 = S.rewrite(
    f"({_V4_GRADED}) g", {"status": _STATUS}, where="schoolyear <> ''", columns=S.SHOWN
)


@query(V4)
def cleaned_grades_v4(spark, sf):
    return plans.clean_grades_stream(X.raw_grades(spark, sf)).drop("updated_at", "processing_time")


# -- profiles ----------------------------------------------------------------
@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS occurrences FROM cased GROUP BY {c}"
        for c in ("semester", "grade_final", "schoolyear", "campus")
    )
)
def profile_counts(spark, sf):
    return P.profile_each(cased(spark, sf), ["semester", "grade_final", "schoolyear", "campus"])


@query(
    """SELECT grade_final, grade_reexam, count(*) AS occurrences FROM cased
       WHERE grade_reexam = '-' OR grade_reexam = '--' OR grade_reexam = 'NULL' OR grade_reexam IS NULL
       GROUP BY grade_final, grade_reexam"""
)
def profile_pairs(spark, sf):
    blank = F.col("grade_reexam").isin("-", "--", "NULL") | F.col("grade_reexam").isNull()
    return P.profile(cased(spark, sf), ["grade_final", "grade_reexam"], where=blank)


@query(
    """SELECT grade_final, grade_reexam, grade_numeric, grade_classification, count(*) AS occurrences
       FROM cleaned GROUP BY grade_final, grade_reexam, grade_numeric, grade_classification"""
)
def profile_grades(spark, sf):
    columns = ["grade_final", "grade_reexam", "grade_numeric", "grade_classification"]
    return cleaned(spark, sf).transform(P.profile, columns)


@query(
    """SELECT grade_final, grade_reexam, count(*) AS occurrences FROM cased
       GROUP BY grade_final, grade_reexam
       ORDER BY occurrences DESC, grade_final DESC NULLS LAST, grade_reexam DESC NULLS LAST LIMIT 22"""
)
def top_profiles(spark, sf):
    counts = P.profile(cased(spark, sf), ["grade_final", "grade_reexam"])
    order = [F.col(c).desc_nulls_last() for c in ("occurrences", "grade_final", "grade_reexam")]
    return counts.transform(P.top, 22, *order)


@query("SELECT l_returnflag, sum(l_quantity) AS total_amount FROM lineitem GROUP BY l_returnflag")
def sum_by_category(spark, sf):
    return X.table(spark, sf, "lineitem").transform(P.sum_by, "l_returnflag", "l_quantity")


@query("SELECT grade_classification, count(*) AS n FROM cleaned GROUP BY grade_classification")
def count_by_class(spark, sf):
    return P.profile(cleaned(spark, sf), ["grade_classification"], into="n")
