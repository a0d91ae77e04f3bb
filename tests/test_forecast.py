"""Forecast model on demand that can be learned, and the pieces around it."""

from datetime import date

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from rideloom.operators import forecast, grid
from rideloom.operators import quantile_trees as qt

COLUMNS = ("zone", "hour", "weekday", "lag_1", "lag_7", "lag7mean", "neighbor_lag1_mean", "temperature_2m")


@pytest.fixture(scope="module")
def split(spark):
    """8 zones x 24 hours x 60 days with a daily and weekly pattern and missing weather."""
    day, hour, zone = F.col("date"), F.col("hour"), F.col("zone")
    cells = spark.range(8).select(F.col("id").cast("int").alias("zone")).withColumn(
        "hour", F.explode(F.sequence(F.lit(0), F.lit(23)))
    ).withColumn("date", F.explode(F.sequence(F.lit(date(2024, 1, 1)), F.lit(date(2024, 2, 29)), F.expr("interval 1 day"))))
    n = 5 + (hour * 3) % 17 + F.when(F.weekday(day) >= 5, 6).otherwise(0) + zone % 5 + (
        zone * 31 + hour * 17 + F.dayofyear(day) * 7) % 4
    demand = cells.withColumn("trips", n.cast("long"))
    edges = spark.createDataFrame([(a, b) for a in range(8) for b in range(8) if abs(a - b) == 1], "zone int, neighbor int")
    table = grid.trailing_mean_7(grid.lag_features(grid.dense_grid(demand)))
    table = grid.neighbor_mean(table, edges).filter("lag_7 IS NOT NULL").withColumns({
        "weekday": F.weekday(day),
        "temperature_2m": F.when(F.dayofmonth(day) % 3 > 0, (F.dayofmonth(day) % 20).cast("double")),
    })
    labelled = grid.temporal_split(table, date(2024, 2, 8), date(2024, 2, 18)).persist()
    yield {name: labelled.filter(F.col("split") == name) for name in ("train", "valid", "test")}
    labelled.unpersist()


def test_model_beats_last_week(split):
    model = forecast.fit_demand_gbt(split["train"], split["valid"], COLUMNS, max_iter=15, max_depth=5, step_size=0.3)
    scored = forecast.predict_demand(model, split["test"])
    error = forecast.error_metrics(scored).first()["rmse"]
    naive = forecast.error_metrics(split["test"], pred="lag_7").first()["rmse"]
    assert error < naive
    assert 3 < model.stages[-1].getNumTrees <= 15
    assert scored.filter("pred < 0").isEmpty() and scored.count() == split["test"].count()

    band = forecast.quantile_band(forecast.predict_demand(model, split["valid"]), scored)
    assert band.filter("q_lo < 0 OR q_hi < q_lo").isEmpty()
    assert 55 < forecast.interval_coverage(band).first()["coverage_pct"] < 98

    top = forecast.importance_top_k(model, COLUMNS, 4).collect()
    weights = [r["importance"] for r in top]
    assert len(top) == 4 and weights == sorted(weights, reverse=True)


def test_ablation_has_both_variants(split):
    rows = forecast.ablation(
        split["train"], split["valid"], split["test"], COLUMNS[:5], ["neighbor_lag1_mean"], max_iter=4, max_depth=4
    ).collect()
    assert {r["variant"] for r in rows} == {"base", "with_extra"} and all(r["rmse"] > 0 for r in rows)


def test_neighbor_mean_uses_the_neighbours(spark):
    rows = [(1, 0, date(2024, 1, 2), 10), (2, 0, date(2024, 1, 2), 20), (3, 0, date(2024, 1, 2), 60), (4, 0, date(2024, 1, 2), 7)]
    df = spark.createDataFrame(rows, "zone int, hour int, date date, lag_1 long")
    edges = spark.createDataFrame([(1, 2), (2, 1), (1, 3), (3, 1)], "zone int, neighbor int")
    got = {r["zone"]: r["neighbor_lag1_mean"] for r in grid.neighbor_mean(df, edges).collect()}
    assert got == {1: 40.0, 2: 10.0, 3: 10.0, 4: 7.0}


def test_residual_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(int(h), int(a), float(p)) for h, a, p in zip(rng.integers(0, 3, 600), rng.integers(0, 30, 600), rng.normal(15, 5, 600))]
    df = spark.createDataFrame(rows, "hour int, trips long, pred double")
    for r in forecast.residual_quantiles(df, 0.1, 0.9).collect():
        residuals = [a - p for h, a, p in rows if h == r["hour"]]
        assert abs(r["r_lo"] - np.quantile(residuals, 0.1)) < 2e-3
        assert abs(r["r_hi"] - np.quantile(residuals, 0.9)) < 2e-3


def test_errors_skip_what_cannot_be_scored(spark):
    df = spark.createDataFrame([(4, 2.0), (0, 1.0), (9, float("nan")), (9, None)], "trips long, pred double")
    row = forecast.error_metrics(df).first()
    assert row["mae"] == 1.5 and row["mape_pct"] == 75.0 and row["mape_high_pct"] is None
    assert row["rmse"] == pytest.approx(2.5**0.5)


def test_zone_without_trips_has_error_zero(spark):
    df = spark.createDataFrame([(1, 0, 3.0), (2, 10, 12.0)], "zone int, trips long, pred double")
    zones = spark.createDataFrame([(1, "A", "X")], "id int, name string, borough string")
    got = {r["zone"]: (r["error_pct"], r["name"]) for r in forecast.zone_forecast_error(df, zones).collect()}
    assert got == {1: (0.0, "A"), 2: (20.0, "2")}


def test_weather_buckets(spark):
    rows = [
        (date(2024, 1, 1), 0, 10, 0.0, 0.0, -5.0), (date(2024, 1, 1), 0, 20, 0.0, 0.0, -5.0),
        (date(2024, 1, 1), 1, 4, 0.5, 0.5, -20.0), (date(2024, 1, 2), 1, 6, 0.5, 0.0, 0.0),
    ]
    df = spark.createDataFrame(rows, "date date, hour int, trips long, precipitation double, snowfall double, temperature_2m double")
    got = {r["bucket"]: (r["cells"], r["mean_trips"], r["hours"], r["days"]) for r in forecast.weather_effect(df).collect()}
    assert got == {
        "dry": (2, 15.0, 1, 1), "wet": (2, 5.0, 2, 2), "snow": (1, 4.0, 1, 1),
        "-20..0": (3, 34 / 3, 2, 1), "0..10": (1, 6.0, 1, 1),
    }


def test_cut_ensemble_equals_a_shorter_fit(split):
    rows = split["train"].select("hour", "lag_1", "lag_7", F.col("trips").cast("double").alias("label"))
    vectors = VectorAssembler(inputCols=["hour", "lag_1", "lag_7"], outputCol="features").transform(rows).cache()
    trees = GBTRegressor(maxIter=6, maxDepth=3, subsamplingRate=0.8, seed=7)
    full, short = trees.fit(vectors), trees.copy({trees.maxIter: 3}).fit(vectors)
    cut = forecast.first_rounds(full, 3)
    assert cut.getNumTrees == 3
    a = [r["prediction"] for r in short.transform(vectors).orderBy("hour", "lag_1", "lag_7", "label").collect()]
    b = [r["prediction"] for r in cut.transform(vectors).orderBy("hour", "lag_1", "lag_7", "label").collect()]
    assert a == b and a != [r["prediction"] for r in full.transform(vectors).orderBy("hour", "lag_1", "lag_7", "label").collect()]
    with pytest.raises(ValueError):
        forecast.first_rounds(full, 7)


def test_quantile_trees_cover_four_of_five(split):
    model = qt.fit_quantile_trees(split["train"], split["valid"], COLUMNS, rounds=8, depth=3, step=0.4)
    band = qt.predict_band(model, split["test"]).collect()
    share = sum(r["q_lo"] <= r["trips"] <= r["q_hi"] for r in band) / len(band)
    assert all(0 <= r["q_lo"] <= r["q_hi"] for r in band) and len(band) == split["test"].count()
    assert 0.65 < share < 0.95
    assert sum(map(len, model.trees)) > 4


def test_first_tree_by_hand(spark):
    """One stump: the split with the greatest gain of pinball gradients, the residuals' quantile in its leaves."""
    rng = np.random.default_rng(8)
    rows = [(float(x), None if x % 7 == 0 else float(z), int(5 + (x > 11) * 20 + rng.integers(0, 6))) for x, z in zip(
        rng.integers(0, 20, 400), rng.integers(0, 5, 400))]
    df = spark.createDataFrame([*rows, (1.0, 1.0, None)], "x double, z double, trips int")
    model = qt.fit_quantile_trees(df, df.limit(0), ["x", "z"], quantiles=(0.1, 0.5), rounds=1, depth=1, step=1.0, least_rows=5)
    assert [len(t) for t in model.trees] == [0, 0]  # no validation rows: nothing shows that a tree helps
    model = qt.fit_quantile_trees(df, df, ["x", "z"], quantiles=(0.1, 0.5), rounds=1, depth=1, step=1.0, least_rows=5)
    y = np.log1p([r[2] for r in rows])
    for q, alpha in enumerate((0.1, 0.5)):
        g = np.where(abs(y - model.first[q]) < 1e-9, 0, alpha - (y < model.first[q]))
        gains = {}
        for column in (0, 1):
            bins = np.array([0 if r[column] is None else 1 + sum(r[column] > t for t in model.limits[column]) for r in rows])
            for b in range(bins.max()):
                left = bins <= b
                if 5 <= left.sum() <= len(rows) - 5:
                    gains[column, b] = g[left].sum() ** 2 / left.sum() + g[~left].sum() ** 2 / (~left).sum() - g.sum() ** 2 / len(g)
        tree = model.trees[q][0]
        assert gains[tree.splits[1]] == pytest.approx(max(gains.values()))
        column, b = tree.splits[1]
        left = np.array([(0 if r[column] is None else 1 + sum(r[column] > t for t in model.limits[column])) <= b for r in rows])
        for leaf, part in ((2, left), (3, ~left)):
            assert tree.values[leaf] == pytest.approx(np.quantile(y[part] - model.first[q], alpha, method="inverted_cdf"))
