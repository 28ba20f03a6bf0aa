"""Queries that write and read back: files, databases, the change log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeflow.catalog import steps as S
from gradeflow.catalog.registry import query
from gradeflow.columns import RAW_GRADES
from gradeflow.operators import changelog as G
from gradeflow.plans import fixtures as X
from gradeflow.sources import relational, tables, versioned
from gradeflow.sources.keyed import KeyedTable
from gradeflow.sources.scratch import TEXT_CODEC, configured, is_local, scratch_path, sized, stored_in_passes

SHOWN = ", ".join(S.SHOWN)
KEYED = T.StructType([*RAW_GRADES.fields, T.StructField("row_key", T.StringType())])


def keyed(spark: SparkSession, sf: str) -> DataFrame:
    return X.raw_grades(spark, sf).select(*KEYED.fieldNames())


# -- files -------------------------------------------------------------------
@query(
    f"""SELECT {SHOWN}, concat('line 1 of "', description, '"', chr(10), 'line, 2', chr(13), chr(10), 'back', chr(92), 'n') AS remark
        FROM raw_grades"""
)
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    remark = F.concat(F.lit('line 1 of "'), "description", F.lit('"\nline, 2\r\nback\\n'))
    rows = keyed(spark, sf).withColumn("remark", remark)
    tables.write_csv(rows, path, escaped=True, compression=TEXT_CODEC)
    return tables.read_csv(spark, path, rows.schema, escaped=True)


@query(f"SELECT {SHOWN} FROM raw_grades")
def json_roundtrip(spark, sf):
    path = scratch_path(spark, "json")
    tables.write_json(keyed(spark, sf), path, compression=TEXT_CODEC)
    return tables.read_json(spark, path, KEYED)


# -- relational --------------------------------------------------------------
JDBC_URL = "spark.gradeflow.jdbc.url"
JDBC_PROPERTIES = "spark.gradeflow.jdbc.property."

def database(spark: SparkSession) -> tuple[str, dict[str, str]]:
    """The database the session names, or an embedded one in a local session.

    An embedded database lives in one process, so executors elsewhere cannot
    reach it; a cluster must name a shared one.
    """
    url = configured(spark, JDBC_URL)
    if url:
        settings = spark.sparkContext.getConf().getAll()
        return url, {
            k.removeprefix(JDBC_PROPERTIES): v for k, v in settings if k.startswith(JDBC_PROPERTIES)
        }
    if not is_local(spark):
        raise ValueError(f"set {JDBC_URL} to a database that all executors can reach")
    spark.sparkContext._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    return (
        f"jdbc:derby:memory:g{uuid.uuid4().hex};create=true",
        {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"},
    )


@query(f"SELECT {SHOWN} FROM raw_grades")
def jdbc_roundtrip(spark, sf):
    url, properties = database(spark)
    name = f"grades_{uuid.uuid4().hex[:8]}"
    tables.write_jdbc(keyed(spark, sf), url, name, properties, mode="overwrite")
    return tables.read_jdbc(
        spark, url, name, properties, partition_column="id", partitions=8
    )


@query(
    f"""SELECT id, row_key, srcode, grade_final FROM (
          SELECT *, row_number() OVER (
            PARTITION BY id ORDER BY year(updated_at) >= 1998 DESC, {S.VERSION}) AS rn
          FROM raw_grades) ranked WHERE rn = 1"""
)
def relational_upsert(spark, sf):
    url, properties = database(spark)
    name = f"upserted_{uuid.uuid4().hex[:8]}"
    raw = X.raw_grades(spark, sf)
    columns = ["id", "row_key", "srcode", "grade_final"]
    execute = relational.jvm_execute(spark, url, properties)
    relational.create_keyed_table(
        spark, url, name, properties, execute, raw.select(*columns).schema, ["id"]
    )
    newer = F.year("updated_at") >= 1998
    first, second = raw.where(~newer), raw.where(newer)
    for batch in (first, second):
        relational.stage_and_merge(
            batch,
            url,
            name,
            properties,
            execute,
            keys=["id"],
            order=X.VERSION,
            columns=columns,
        )
    return tables.read_jdbc(spark, url, name, properties, partition_column="id", partitions=8)


# -- versioned table ---------------------------------------------------------
_LOG_COLUMNS = ["commit_time", "record_key", "row_key", "schoolyear", "srcode", "grade_final"]


def log_root(spark: SparkSession, sf: str) -> str:
    """A log of three commits, and the table as it stood at the second, written once per application."""

    def build(root: str) -> None:
        raw = X.raw_grades(spark, sf)
        for number, (instant, condition) in X.COMMITS.items():
            versioned.write_commit(
                raw.where(condition), root, number, instant, keys=["id"], order=X.VERSION, partition_by=["schoolyear"],
                passes=X.passes(spark, sf),
            )
        versioned.write_base(spark, root, raw.schema, "2024-02-15", passes=X.passes(spark, sf))

    return X.kept(spark, sf, "log", build)


def stored_log(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log; reads of it skip the commits that they exclude."""
    return versioned.read_log(spark, log_root(spark, sf), X.raw_grades(spark, sf).schema)


@query(
    f"SELECT {', '.join(_LOG_COLUMNS)}, batch FROM (SELECT *, CASE commit_time "
    f"WHEN '{S.INSTANTS[0]}' THEN 1 WHEN '{S.INSTANTS[1]}' THEN 2 ELSE 3 END AS batch "
    f"FROM {S.latest_version('change_log')}) snap"
)
def log_snapshot(spark, sf):
    """The current table: the stored base and the commit after it."""
    current = versioned.read_as_of(spark, log_root(spark, sf), X.raw_grades(spark, sf).schema)
    current = current.select(*_LOG_COLUMNS, F.col("batch_id").cast("int").alias("batch"))
    return stored_in_passes(current, [G.KEY], X.source_bytes(spark, sf), "snapshot")


@query(
    f"SELECT {', '.join(_LOG_COLUMNS)} FROM "
    + S.latest_version(f"(SELECT * FROM change_log WHERE commit_time <= '{S.INSTANTS[1]}') log")
)
def log_as_of(spark, sf):
    past = versioned.read_as_of(spark, log_root(spark, sf), X.raw_grades(spark, sf).schema, "2024-02-15")
    return stored_in_passes(past.select(*_LOG_COLUMNS), [G.KEY], X.source_bytes(spark, sf), "past")


@query(
    f"SELECT {', '.join(_LOG_COLUMNS)} FROM "
    + S.latest_version(f"(SELECT * FROM change_log WHERE commit_time <= '{S.INSTANTS[0]}') log")
)
def log_as_of_commits(spark, sf):
    """The table before its first base: from the commits alone."""
    past = versioned.read_as_of(spark, log_root(spark, sf), X.raw_grades(spark, sf).schema, "2024-01-31")
    return past.select(*_LOG_COLUMNS)


@query(
    f"SELECT {', '.join(_LOG_COLUMNS)} FROM "
    + S.latest_version(f"(SELECT * FROM change_log WHERE commit_time > '{S.INSTANTS[0]}') log")
)
def log_incremental(spark, sf):
    known = versioned.commit_times(spark, log_root(spark, sf))
    changed = G.changes_since_first(stored_log(spark, sf), known=known).select(*_LOG_COLUMNS)
    return stored_in_passes(changed, [G.KEY], X.source_bytes(spark, sf), "changes")


#: Records that a commit holds twice, where commits are not reduced by key.
_TWICE = "id % 13 = 0"


def _repeated(once: DataFrame) -> DataFrame:
    """Some rows twice, in one pass, unlike a union with itself."""
    times = F.when(F.expr(_TWICE), F.array_repeat(F.lit(0), 2)).otherwise(F.array(F.lit(0)))
    return once.withColumn("__time", F.explode(times)).drop("__time")


def repeating_log(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """The log with equal rows in its commits, and its commits."""

    def build(root: str) -> None:
        raw = X.raw_grades(spark, sf)
        for number, (instant, condition) in X.COMMITS.items():
            versioned.write_commit(
                raw.where(condition), root, number, instant, keys=["id"], order=X.VERSION, partition_by=["schoolyear"],
                passes=X.passes(spark, sf), shape=_repeated,
            )

    root = X.kept(spark, sf, "repeating-log", build)
    return versioned.read_log(spark, root, X.raw_grades(spark, sf).schema), versioned.commit_times(spark, root)


_REPEATING = f"(SELECT * FROM change_log UNION ALL SELECT * FROM change_log WHERE {_TWICE}) log"
_ENDS = """(SELECT record_key, commit_time, lead(commit_time) OVER (PARTITION BY record_key ORDER BY commit_time) AS valid_until
            FROM (SELECT DISTINCT record_key, commit_time FROM change_log) versions) ends"""


@query(
    f"""SELECT {", ".join(_LOG_COLUMNS)} FROM {_REPEATING} JOIN {_ENDS} USING (record_key, commit_time)
        WHERE valid_until IS NULL OR valid_until > '{S.INSTANTS[1]}'"""
)
def log_retain(spark, sf):
    """What the last two commits need of a log that holds some rows twice."""
    log, known = repeating_log(spark, sf)
    return G.retain_commits(log, 2, known=known).select(*_LOG_COLUMNS)


@query(f"SELECT {', '.join(_LOG_COLUMNS)}, valid_until FROM {_REPEATING} JOIN {_ENDS} USING (record_key, commit_time)")
def log_validity(spark, sf):
    """Every version, repeated ones included, with the commit that replaced it."""
    log, _ = repeating_log(spark, sf)
    versions = G.with_end(log).select(*_LOG_COLUMNS, "valid_until")
    return stored_in_passes(versions, [G.KEY], X.source_bytes(spark, sf), "validity")


@query(
    f"""SELECT id, row_key, srcode, grade_final FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY {S.VERSION}) AS rn
          FROM raw_grades) ranked WHERE rn = 1"""
)
def keyed_upsert(spark, sf):
    """Three batches brought into a keyed table, each by an object of its own, one of them twice."""
    root = scratch_path(spark, "keyed")
    raw = X.raw_grades(spark, sf).select("id", "row_key", "srcode", "grade_final", "updated_at")
    for number, (_, condition) in [*X.COMMITS.items(), (2, X.COMMITS[2])]:
        table = KeyedTable(root, raw.schema, ["id"], X.VERSION, buckets=16)
        with sized(spark, X.source_bytes(spark, sf)):
            table.merge(raw.where(condition), "batches", number)
    return KeyedTable(root, raw.schema, ["id"], X.VERSION, buckets=16).read(spark).drop("updated_at")


@query(
    f"""SELECT {SHOWN} FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY {S.VERSION}) AS rn
          FROM raw_grades) ranked WHERE rn = 1"""
)
def upsert_latest(spark, sf):
    raw = X.raw_grades(spark, sf)
    newer = F.year("updated_at") >= 1998
    merged = G.upsert(raw.where(~newer), raw.where(newer), ["id"], X.VERSION)
    return stored_in_passes(merged, ["id"], X.source_bytes(spark, sf), "upserted").drop("updated_at")


_COMPOSITE = {
    "part_one": "CASE WHEN id % 4 = 0 THEN NULL WHEN id % 4 = 1 THEN concat(srcode, ':') ELSE srcode END",
    "part_two": "CASE WHEN id % 4 = 1 THEN 'x' WHEN id % 4 = 2 THEN ':x' WHEN id % 4 = 3 THEN NULL ELSE srcode END",
}


@query(
    f"""SELECT part_one, part_two, row_key FROM (
          SELECT *, row_number() OVER (PARTITION BY part_one, part_two ORDER BY {S.VERSION}) AS rn
          FROM (SELECT *, {", ".join(f"{sql} AS {name}" for name, sql in _COMPOSITE.items())} FROM raw_grades) parts
        ) ranked WHERE rn = 1"""
)
def log_composite_key(spark, sf):
    """Records of two key columns with NULLs and separators in them."""
    root = scratch_path(spark, "composite")
    rows = X.raw_grades(spark, sf).withColumns({name: F.expr(sql) for name, sql in _COMPOSITE.items()})
    with sized(spark, X.source_bytes(spark, sf)):
        versioned.write_commit(
            rows, root, 0, "2024-01-01", keys=list(_COMPOSITE), order=X.VERSION, passes=X.passes(spark, sf)
        )
    log = versioned.read_log(spark, root, rows.schema)
    return G.snapshot(log).select("part_one", "part_two", "row_key")
