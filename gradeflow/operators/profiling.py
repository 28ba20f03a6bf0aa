"""Data-quality profiles and simple aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profile(
    df: DataFrame,
    columns: Sequence[str],
    *,
    where: Column | str | None = None,
    into: str = "occurrences",
) -> DataFrame:
    """How often each combination of values occurs."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(into))


def profile_each(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts of several columns in one scan: (column, value, occurrences)."""
    pairs = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        )
    )
    return df.select(F.inline(pairs)).transform(profile, ["column", "value"])


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of a report.  End ``order`` with a unique key."""
    return df.orderBy(*order).limit(n)


def sum_by(df: DataFrame, category: str, amount: str, into: str = "total_amount") -> DataFrame:
    return df.groupBy(category).agg(F.sum(amount).alias(into))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def retention(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """How many rows survive each of a run of filters, counted in one pass.

    A row reaches a stage when it satisfies that stage's condition and all those
    before it.  Result: (stage_no, stage, rows, removed, percent_of_input).
    """
    counts, reached = [F.count(F.lit(1)).alias("0")], F.lit(True)
    for number, condition in enumerate(stages.values(), start=1):
        reached = reached & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(reached).alias(str(number)))
    labels = ["input", *stages]
    lines = F.array(
        *(
            F.struct(
                F.lit(number).alias("stage_no"),
                F.lit(label).alias("stage"),
                F.col(str(number)).alias("rows"),
                (F.col(str(max(number - 1, 0))) - F.col(str(number))).alias("removed"),
                F.round(
                    100.0 * F.col(str(number)).cast("double") / F.nullif(F.col("0"), F.lit(0)), 6
                ).alias("percent_of_input"),
            )
            for number, label in enumerate(labels)
        )
    )
    return df.agg(*counts).select(F.inline(lines))
