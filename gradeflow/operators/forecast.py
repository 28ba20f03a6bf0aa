"""Grade-average series: features, splits, forecasts and their accuracy.

A series is (srcode, program_id, semester, y) with one row per term.  Windows run
over a student's terms only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeflow.functions import constants as K
from gradeflow.functions import grades as G

SERIES = ("srcode", "program_id")
FEATURES = ("program_index", "semester", "cumulative_gwa")
#: Thresholds that a forest tries per feature, if there are not more programs than that.
BINS = 32


def cumulative_gwa(
    series: DataFrame, by: Sequence[str] = SERIES, *, lagged: bool = False
) -> DataFrame:
    """Add the mean of the series so far.

    It includes the current term, as the model was defined; ``lagged`` leaves the
    current term out (NULL in the first), so that the feature does not contain
    its own target.
    """
    so_far = Window.partitionBy(*by).orderBy("semester").rowsBetween(
        Window.unboundedPreceding, -1 if lagged else Window.currentRow
    )
    return series.withColumn("cumulative_gwa", F.avg("y").over(so_far))


def forecast_features(
    series: DataFrame, horizon: int = 1, by: Sequence[str] = SERIES
) -> DataFrame:
    """Rows for the next ``horizon`` terms, carrying the last cumulative mean.

    The last cumulative mean is the plain mean, so one map-side combined
    aggregate per student is enough; no window.
    """
    ends = series.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("y").alias("cumulative_gwa"),
        F.max_by("y", "semester").alias("last_y"),
    )
    terms = F.col("n").cast("int")
    ahead = F.sequence(terms + 1, terms + F.lit(horizon))
    return ends.select(*by, "last_y", "cumulative_gwa", F.explode(ahead).alias("semester"))


def temporal_split(
    series: DataFrame, test_share: float = K.TEST_SHARE, by: Sequence[str] = SERIES
) -> DataFrame:
    """Mark the earliest terms as training rows; at least one, in time order."""
    ordered = Window.partitionBy(*by).orderBy("semester")
    whole = Window.partitionBy(*by)
    cut = F.greatest(
        F.lit(1), F.floor(F.count(F.lit(1)).over(whole) * F.lit(1.0 - test_share))
    )
    return series.withColumns(
        {
            "n": F.count(F.lit(1)).over(whole),
            "is_train": F.row_number().over(ordered) <= cut,
        }
    )


def naive_forecast(
    series: DataFrame, test_share: float = K.TEST_SHARE, by: Sequence[str] = SERIES
) -> DataFrame:
    """Predict every test term as the mean of the training terms.

    Series of fewer than two terms have no test rows and give none.
    """
    whole = Window.partitionBy(*by)
    return (
        temporal_split(series, test_share, by)
        .withColumn("prediction", F.avg(F.when(F.col("is_train"), F.col("y"))).over(whole))
        .where(~F.col("is_train") & (F.col("n") >= 2))
        .select(*by, "semester", F.col("y").alias("actual"), clip("prediction").alias("prediction"))
    )


def forecast_metrics(predictions: DataFrame, by: Sequence[str] = SERIES) -> DataFrame:
    """MSE, RMSE, MAE, MAPE and PE of (actual, prediction), and the accuracy band."""
    error = F.col("actual") - F.col("prediction")
    relative = error / F.nullif(F.col("actual"), F.lit(0.0))
    return (
        predictions.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_test"),
            F.avg(error * error).alias("mse"),
            F.avg(F.abs(error)).alias("mae"),
            (F.avg(F.abs(relative)) * 100.0).alias("mape"),
            (F.avg(relative) * 100.0).alias("pe"),
        )
        .withColumns({"rmse": F.sqrt("mse"), "indicator": G.accuracy_band(F.col("mape"))})
    )


def forecast_trend(features: DataFrame, prediction: Column) -> DataFrame:
    """Say whether the next term is forecast better, worse or the same."""
    return features.withColumn("prediction", prediction).withColumn(
        "trend", G.grade_trend(F.col("last_y"), F.col("prediction"))
    )


def clip(column: str) -> Column:
    low, high = K.GRADE_BOUNDS
    return F.greatest(F.lit(low), F.least(F.lit(high), F.col(column)))


# -- random forest -----------------------------------------------------------
def fit_forest(
    series: DataFrame, trees: int = K.FOREST_TREES, seed: int = K.FOREST_SEED
) -> PipelineModel:
    """One forest over all students: program, term and cumulative mean -> y.

    A single distributed fit takes the place of one model per student, so its
    values differ from per-student models by design. A program is a category: splits
    part the programs into two sets, and ids mean nothing by their size. Programs that
    training has not seen, and the lack of one, are a category of their own. The list of
    programs is held by the driver.
    """
    training = (
        cumulative_gwa(series)
        .withColumn("program", _program())
        .where(F.col("y").isNotNull())
        .select("program", "semester", "cumulative_gwa", F.col("y").alias("label"))
    )
    programs = StringIndexer(inputCol="program", outputCol="program_index", handleInvalid="keep").fit(training)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    bins = max(BINS, len(programs.labels) + 1)
    forest = RandomForestRegressor(numTrees=trees, seed=seed, maxBins=bins, predictionCol="yhat")
    return Pipeline(stages=[programs, assembler, forest]).fit(training)


def forest_forecast(
    model: PipelineModel, series: DataFrame, horizon: int = 1, by: Sequence[str] = SERIES
) -> DataFrame:
    """Forecast the next ``horizon`` terms of every student, clipped to [1, 5]."""
    ahead = forecast_features(series, horizon, by).withColumn("program", _program())
    return forecast_trend(model.transform(ahead), clip("yhat")).select(
        *by, "semester", "last_y", "prediction", "trend"
    )


def forest_evaluation(
    series: DataFrame,
    test_share: float = K.TEST_SHARE,
    trees: int = K.FOREST_TREES,
    seed: int = K.FOREST_SEED,
    by: Sequence[str] = SERIES,
) -> DataFrame:
    """Hold out each student's last terms, fit on the rest, report the metrics."""
    known = F.avg(F.when(F.col("is_train"), F.col("y"))).over(Window.partitionBy(*by))
    parts = (
        temporal_split(series, test_share, by)
        .withColumn("cumulative_gwa", known)
        .where("n >= 2")
    )
    model = fit_forest(parts.where("is_train").select(*by, "semester", "y"), trees, seed)
    rows = parts.where(~F.col("is_train")).withColumn("program", _program())
    predicted = model.transform(rows).select(
        *by, "semester", F.col("y").alias("actual"), clip("yhat").alias("prediction")
    )
    return forecast_metrics(predicted, by)


def _program() -> Column:
    """Program id as the name of a category; NULL where there is none."""
    return F.col("program_id").cast("string")
