"""Batch sources and sinks: Parquet, CSV, JSON, JDBC, literal rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeflow.columns import CAREER_MAP, PROGRAMS
from gradeflow.functions import constants as K
from gradeflow.sources.scratch import STORED_CODEC

Properties = Mapping[str, str]


# -- files -------------------------------------------------------------------
def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    header: bool = True,
    escaped: bool = False,
) -> DataFrame:
    """Read CSV.  Without a schema Spark reads the file twice to infer one.

    Line breaks inside texts are read back from the escapes that :func:`write_csv` puts
    in their place (``escaped``), so a file stays one row a line and can be split. With a
    schema only: an inferred one does not tell which columns are texts.
    """
    reader = spark.read.option("header", header).option("escape", '"')
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    rows = reader.csv(path)
    return rows.select(*(_unescaped(f) for f in rows.schema.fields)) if escaped else rows


def read_programs(spark: SparkSession, path: str) -> DataFrame:
    """The program list: program_id, program."""
    return read_csv(spark, path, PROGRAMS)


def read_json(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, *, multiline: bool = False
) -> DataFrame:
    reader = spark.read.option("multiLine", multiline)
    return (reader if schema is None else reader.schema(schema)).json(path if isinstance(path, str) else list(path))


def read_career_maps(
    spark: SparkSession, path: str | Sequence[str], *, multiline: bool = True, by_file: bool = False
) -> DataFrame:
    """Career documents; pretty-printed files need ``multiline``.

    ``by_file`` adds ``map_file``, the file's name without its ending, so that two files of
    one program remain two maps.
    """
    documents = read_json(spark, path, CAREER_MAP, multiline=multiline)
    if not by_file:
        return documents
    return documents.select("*", F.regexp_replace("_metadata.file_name", r"\.json(\.\w+)?$", "").alias("map_file"))


def write_csv(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    single_file: bool = False,
    escaped: bool = False,
    compression: str | None = None,
) -> None:
    """Write CSV with a header, spaces and quotes kept.

    ``escaped`` writes line breaks as ``\\n`` and ``\\r`` and a backslash as two.
    ``single_file`` sends everything through one task: for small results only. Readers know the
    ``compression`` by the files' names.
    """
    if escaped:
        df = df.select(*(_escaped(f) for f in df.schema.fields))
    _few(df, single_file).write.mode(mode).option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).option("escape", '"').option("emptyValue", '""').csv(path, compression=compression)


#: Stands in for an escaped backslash while line breaks are put back.
_MARK = "\x00"


def _escaped(field: T.StructField) -> Column:
    text = F.col(f"`{field.name}`")
    if not isinstance(field.dataType, T.StringType):
        return text
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text.alias(field.name)


def _unescaped(field: T.StructField) -> Column:
    text = F.col(f"`{field.name}`")
    if not isinstance(field.dataType, T.StringType):
        return text
    for written, plain in (("\\\\", _MARK), ("\\n", "\n"), ("\\r", "\r"), (_MARK, "\\")):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text.alias(field.name)


def write_json(
    df: DataFrame, path: str, *, mode: str = "overwrite", single_file: bool = False, compression: str | None = None
) -> None:
    """Write JSON lines; readers know the ``compression`` by the files' names."""
    _few(df, single_file).write.mode(mode).json(path, compression=compression)


def write_parquet(
    df: DataFrame, path: str, *, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write Parquet.  Partition folders get evenly sized files: adaptive execution
    gathers each folder's rows and splits the folders that are large."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path, compression=STORED_CODEC)


def _few(df: DataFrame, single_file: bool) -> DataFrame:
    return df.coalesce(1) if single_file else df


# -- literal rows ------------------------------------------------------------
def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def literal_frame(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str | Sequence[str]
) -> DataFrame:
    """A frame of a few rows written in code."""
    return spark.createDataFrame(list(rows), schema)


# -- relational --------------------------------------------------------------
def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Properties,
    *,
    partition_column: str | None = None,
    partitions: int = 1,
    quote: str = '"',
) -> DataFrame:
    """Read a relational table, in parallel when given a numeric ``partition_column``.

    The bounds come from the database's own minimum and maximum; they only set the
    stride, so rows outside them, and NULLs, are read all the same.
    """
    properties = {"fetchsize": str(K.JDBC_FETCH_SIZE), **properties}
    if partition_column is None or partitions <= 1:
        return spark.read.jdbc(url, table, properties=properties)
    column = f"{quote}{partition_column}{quote}"
    extent = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) extent"
    low, high = spark.read.jdbc(url, extent, properties=properties).first()
    if low is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=int(low),
        upperBound=int(high) + 1,
        numPartitions=partitions,
        properties=properties,
    )


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Properties,
    *,
    mode: str = "append",
    batch_size: int = K.JDBC_BATCH_SIZE,
    connections: int | None = None,
    column_types: str | None = None,
) -> None:
    """Write to a relational table, one connection per task and at most ``connections``."""
    writer = df.write.mode(mode).option("batchsize", batch_size)
    if connections:
        writer = writer.option("numPartitions", connections)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.jdbc(url, table, properties=dict(properties))
