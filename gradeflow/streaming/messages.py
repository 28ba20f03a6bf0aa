"""Unbounded sources of JSON messages in one ``value`` column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Corrupt = Literal["readable", "drop", "keep", "route"]
CORRUPT = "corrupt_record"


def stream_source(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    path: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Open a stream.  ``kafka`` needs its connector on the class path.

    A file source stands in for it: ``text`` gives the same ``value`` column, and
    ``maxFilesPerTrigger`` limits a batch as ``maxOffsetsPerTrigger`` does.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load() if path is None else reader.load(path)


def kafka_options(
    servers: str,
    topic: str,
    *,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    include_headers: bool = False,
    security_protocol: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a Kafka subscription, for :func:`stream_source`; ``extra`` ones are passed as given."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "includeHeaders": str(include_headers).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if security_protocol is not None:
        options["kafka.security.protocol"] = security_protocol
    return options | dict(extra or {})


def parse_json_payload(
    messages: DataFrame,
    schema: T.StructType,
    corrupt: Corrupt = "route",
    payload: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Messages to typed columns, with the message columns that ``keep`` names.

    A field of the wrong type is NULL and the rest of its message stays. A message of
    which nothing can be read is kept with its text in ``corrupt_record``, for sinks, or
    :func:`good` and :func:`bad`, to tell apart (``route``). The others lose rows or texts
    uncounted: ``readable`` leaves such messages out, ``keep`` leaves a row for every message,
    ``drop`` only those without any fault.
    """
    value = F.col("value").cast("string") if payload is None else payload
    with_text = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # As a generator the parser runs once per message: filters on its columns stay
    # above it instead of repeating it.
    parsed = messages.select(*keep, F.inline(F.array(F.from_json(value, with_text, options))))
    match corrupt:
        case "readable":
            return good(parsed, keep)
        case "route":
            return parsed
        case "keep":
            return parsed.drop(CORRUPT)
        case "drop":
            return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        case _:
            raise ValueError(f"corrupt must be readable, drop, keep or route, not {corrupt!r}")


def unreadable(routed: DataFrame, keep: Sequence[str] = ()) -> Column:
    """True for a faulty message of which no field could be read."""
    nothing = [F.col(c).isNull() for c in routed.columns if c != CORRUPT and c not in keep]
    return reduce(and_, nothing, F.col(CORRUPT).isNotNull())


def good(routed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return routed.where(~unreadable(routed, keep)).drop(CORRUPT)


def bad(routed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return routed.where(unreadable(routed, keep)).select(*keep, CORRUPT)


def to_messages(df: DataFrame) -> DataFrame:
    """Rows to JSON messages in one ``value`` column."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
