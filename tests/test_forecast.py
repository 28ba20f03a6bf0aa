"""Series, splits, metrics and forests against plain arithmetic."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeflow.functions import grades as G
from gradeflow.operators import forecast as O

KNOWN = [1.72, 2.11, 2.06, 2.13, 1.25, 2.00]


def frame(spark, **students):
    rows = [
        (s, 21 if s != "u" else None, i, float(y))
        for s, ys in students.items()
        for i, y in enumerate(ys, start=1)
    ]
    return spark.createDataFrame(rows, "srcode string, program_id int, semester int, y double")


def column(df, name):
    return [r[name] for r in df.orderBy("srcode", "semester").collect()]


def test_cumulative(spark):
    df = frame(spark, a=KNOWN)
    means = np.cumsum(KNOWN) / np.arange(1, 7)
    assert column(O.cumulative_gwa(df), "cumulative_gwa") == pytest.approx(means)
    lagged = column(O.cumulative_gwa(df, lagged=True), "cumulative_gwa")
    assert lagged[0] is None and lagged[1:] == pytest.approx(means[:-1])


def test_features_carry_the_last_mean(spark):
    rows = O.forecast_features(frame(spark, a=KNOWN, u=[3.0]), 2).orderBy("srcode", "semester").collect()
    assert [(r["srcode"], r["semester"]) for r in rows] == [("a", 7), ("a", 8), ("u", 2), ("u", 3)]
    assert rows[0]["cumulative_gwa"] == rows[1]["cumulative_gwa"] == pytest.approx(np.mean(KNOWN))
    assert rows[0]["last_y"] == 2.0


@pytest.mark.parametrize("n, train", [(1, 1), (2, 1), (3, 2), (4, 3), (5, 4), (6, 4), (10, 8)])
def test_split(spark, n, train):
    assert train == max(1, int(n * (1 - 0.2)))
    flags = column(O.temporal_split(frame(spark, a=range(1, n + 1))), "is_train")
    assert flags == [True] * train + [False] * (n - train)


def test_metrics(spark):
    predictions = O.naive_forecast(frame(spark, a=KNOWN, b=[2.0], u=[2.0, 1.0]))
    rows = {r["srcode"]: r for r in O.forecast_metrics(predictions).collect()}
    assert set(rows) == {"a", "u"}  # one term is not enough
    actual, guess = np.array(KNOWN[4:]), np.mean(KNOWN[:4])
    error = actual - guess
    assert rows["a"]["mse"] == pytest.approx(np.mean(error**2))
    assert rows["a"]["rmse"] == pytest.approx(math.sqrt(np.mean(error**2)))
    assert rows["a"]["mae"] == pytest.approx(np.mean(np.abs(error)))
    assert rows["a"]["mape"] == pytest.approx(np.mean(np.abs(error / actual)) * 100)
    assert rows["a"]["pe"] == pytest.approx(np.mean(error / actual) * 100)
    assert rows["u"]["mape"] == pytest.approx(100.0) and rows["u"]["indicator"] == "Poor"


@pytest.mark.parametrize(
    "mape, band",
    [(0.0, "Excellent"), (4.99, "Excellent"), (5.0, "Good"), (10.0, "Fair"), (20.0, "Poor"), (None, None)],
)
def test_bands(spark, mape, band):
    row = spark.createDataFrame([(mape,)], "m double").select(G.accuracy_band(F.col("m"))).first()
    assert row[0] == band


def test_trend(spark):
    features = O.forecast_features(frame(spark, a=[3, 2], b=[1, 2], c=[2, 2]))
    found = O.forecast_trend(features, O.clip("cumulative_gwa")).collect()
    assert {r["srcode"]: r["trend"] for r in found} == {"a": "worsen", "b": "improve", "c": "same"}


def test_clip(spark):
    df = spark.createDataFrame([(0.2,), (3.0,), (9.0,)], "p double")
    assert [r[0] for r in df.select(O.clip("p")).collect()] == [1.0, 3.0, 5.0]


def test_forest(spark):
    students = {f"s{i}": [1 + (i + j) % 5 * 0.5 for j in range(3 + i % 4)] for i in range(30)}
    series = frame(spark, u=[2.0, 3.0], **students)
    model = O.fit_forest(series, trees=5)
    found = O.forest_forecast(model, series, 2).collect()
    assert len(found) == 2 * 31
    assert all(1.0 <= r["prediction"] <= 5.0 for r in found)
    again = O.forest_forecast(O.fit_forest(series, trees=5), series, 2).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    metrics = O.forest_evaluation(series, trees=5).collect()
    assert len(metrics) == 31
    assert all(r["rmse"] == pytest.approx(math.sqrt(r["mse"])) for r in metrics)


def test_program_is_a_category(spark):
    """Good and bad programs alternate by id, so no threshold on the id parts them; one of many has no id."""
    programs = [*range(100, 160), None]
    rows = [
        (f"s{p}-{k}", p, i, 1.5 if (p or 1) % 2 else 4.5) for p in programs for k in range(4) for i in range(1, 4)
    ]
    series = spark.createDataFrame(rows, "srcode string, program_id int, semester int, y double")
    model = O.fit_forest(series, trees=20)
    forest = model.stages[-1]
    assert forest.getMaxBins() >= 61
    assert "in {" in forest.toDebugString  # splits by sets of programs
    ahead = spark.createDataFrame([(f"n{p}", p, 1, 3.0) for p in (101, 102, 999, None)], series.schema)
    found = {r.srcode: r.prediction for r in O.forest_forecast(model, ahead).collect()}
    assert len(found) == 4 and found["n101"] < found["n102"]


def test_forest_is_not_worse_than_the_naive_forecast(spark):
    """Held-out mean absolute error over all students at sf0.01."""
    from gradeflow.catalog.forecasts import stored_grades

    series = stored_grades(spark, "/root/testdata/sf0.01")
    error = F.sum(F.col("mae") * F.col("n_test")) / F.sum("n_test")
    forest = O.forest_evaluation(series).agg(error).first()[0]
    naive = O.forecast_metrics(O.naive_forecast(series)).agg(error).first()[0]
    assert forest <= naive
