"""Queries over grade-average series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeflow.catalog.registry import query
from gradeflow.catalog.students import series
from gradeflow.operators import forecast as O
from gradeflow.plans.series import grade_series
from gradeflow.sources.scratch import scratch_path


def grades(spark: SparkSession, sf: str) -> DataFrame:
    return grade_series(series(spark, sf))


@query(
    """SELECT srcode, program_id, semester, round(sem_average, 6) AS y, round(avg(sem_average) OVER (
         PARTITION BY srcode, program_id ORDER BY semester
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cumulative_gwa
       FROM series"""
)
def cumulative_gwa(spark, sf):
    return _rounded(grades(spark, sf).transform(O.cumulative_gwa), "y", "cumulative_gwa")


@query(
    """SELECT srcode, program_id, round(sem_average, 6) AS y, semester, round(avg(sem_average) OVER (
         PARTITION BY srcode, program_id ORDER BY semester
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS cumulative_gwa
       FROM series"""
)
def cumulative_gwa_lagged(spark, sf):
    return _rounded(
        grades(spark, sf).transform(O.cumulative_gwa, lagged=True), "y", "cumulative_gwa"
    )


@query(
    """SELECT srcode, program_id, round(last_y, 6) AS last_y, round(cumulative_gwa, 6) AS cumulative_gwa,
         CAST(semester + step AS INTEGER) AS semester
       FROM ahead, (VALUES (0), (1), (2)) steps(step)"""
)
def forecast_features(spark, sf):
    return _rounded(
        grades(spark, sf).transform(O.forecast_features, 3), "last_y", "cumulative_gwa"
    )


@query("SELECT srcode, program_id, semester, round(y, 6) AS y, n, is_train FROM parts")
def temporal_split(spark, sf):
    return _rounded(grades(spark, sf).transform(O.temporal_split), "y")


_METRICS = """SELECT srcode, program_id, count(*) AS n_test,
      avg((actual - prediction) * (actual - prediction)) AS mse,
      avg(abs(actual - prediction)) AS mae,
      avg(abs((actual - prediction) / actual)) * 100 AS mape,
      avg((actual - prediction) / actual) * 100 AS pe
    FROM predicted GROUP BY srcode, program_id"""


@query(
    f"""SELECT srcode, program_id, n_test, round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse,
          round(mae, 6) AS mae, round(mape, 6) AS mape, round(pe, 6) AS pe,
          CASE WHEN mape < 5 THEN 'Excellent' WHEN mape < 10 THEN 'Good' WHEN mape < 20 THEN 'Fair'
               ELSE 'Poor' END AS indicator
        FROM ({_METRICS}) m"""
)
def forecast_metrics(spark, sf):
    predictions = grades(spark, sf).transform(O.naive_forecast)
    return _rounded(predictions.transform(O.forecast_metrics), "mse", "rmse", "mae", "mape", "pe")


@query(
    """SELECT srcode, program_id, semester, round(last_y, 6) AS last_y,
         round(cumulative_gwa, 6) AS prediction,
         CASE WHEN cumulative_gwa < last_y THEN 'improve' WHEN cumulative_gwa > last_y THEN 'worsen'
              ELSE 'same' END AS trend
       FROM ahead"""
)
def forecast_trend(spark, sf):
    trend = O.forecast_trend(
        grades(spark, sf).transform(O.forecast_features), O.clip("cumulative_gwa")
    )
    return _rounded(trend.drop("cumulative_gwa"), "last_y", "prediction")


def stored_grades(spark: SparkSession, sf: str) -> DataFrame:
    """The series as a written table: a forest reads its input several times."""
    path = scratch_path(spark, "series")
    grades(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


@query()
def gwa_forecast(spark, sf):
    known = stored_grades(spark, sf)
    return O.forest_forecast(O.fit_forest(known), known)


@query(
    """SELECT srcode, program_id, semester, round(last_y, 6) AS last_y, true AS within_bounds, true AS trend_fits
       FROM ahead"""
)
def gwa_forecast_shape(spark, sf):
    """What holds of a forest's forecast whatever its values: rows, bounds and trend."""
    known = stored_grades(spark, sf)
    found = O.forest_forecast(O.fit_forest(known), known)
    trend = F.when(F.col("prediction") < F.col("last_y"), "improve").when(F.col("prediction") > F.col("last_y"), "worsen")
    return found.select(
        "srcode",
        "program_id",
        "semester",
        F.round("last_y", 6).alias("last_y"),
        F.col("prediction").between(1, 5).alias("within_bounds"),
        (F.col("trend") == F.coalesce(trend, F.lit("same"))).alias("trend_fits"),
    )


@query(
    """SELECT srcode, program_id, count(*) AS n_test, true AS consistent FROM parts
       WHERE NOT is_train AND n >= 2 GROUP BY srcode, program_id"""
)
def gwa_forecast_metrics_shape(spark, sf):
    """Who is evaluated on how many terms, and relations between the metrics."""
    found = O.forest_evaluation(stored_grades(spark, sf))
    close = F.abs(F.col("rmse") * F.col("rmse") - F.col("mse")) < 1e-9
    ordered = (F.col("mae") <= F.col("rmse") + 1e-9) & (F.abs("pe") <= F.col("mape") + 1e-9)
    return found.select("srcode", "program_id", "n_test", (close & ordered).alias("consistent"))


@query()
def gwa_forecast_metrics(spark, sf):
    return O.forest_evaluation(stored_grades(spark, sf))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})
