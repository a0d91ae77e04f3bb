"""Demand forecast: boosted trees, prediction bands, error metrics, weather effects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.functions.measures import ratio_or_zero
from rideloom.operators.dimension import enrich_zone
from rideloom.operators.grid import DAILY_WEATHER, HOURLY_WEATHER
from rideloom.workspace import cut_lineage

# Temperature bins [lo, hi) of the weather report.
TEMPERATURE_BINS = ((-20, 0), (0, 10), (10, 20), (20, 30), (30, 50))


def _assembly(cols: Sequence[str]) -> list:
    """Vector of the feature columns; missing weather is filled with the training median."""
    weather = [c for c in cols if c in HOURLY_WEATHER or c in DAILY_WEATHER]
    filled = {c: f"{c}__filled" for c in weather}
    stages = []
    if weather:
        stages.append(Imputer(inputCols=weather, outputCols=list(filled.values()), strategy="median"))
    stages.append(VectorAssembler(inputCols=[filled.get(c, c) for c in cols], outputCol="features"))
    return stages


def fit_demand_gbt(
    train: DataFrame,
    valid: DataFrame,
    cols: Sequence[str],
    max_iter: int = 60,
    max_depth: int = 6,
    step_size: float = 0.1,
    subsample: float = 0.85,
    seed: int = 42,
) -> PipelineModel:
    """Boosted trees on log1p(trips), as many as serve the validation rows best.

    The library stops at the first round without gain; the full ensemble is scored round by round on the validation
    rows instead and cut after the best round. Rounds do not depend on later ones, so the result is that of a fit
    with so many rounds.
    """
    def labelled(df: DataFrame) -> DataFrame:
        return df.withColumn("label", F.log1p(F.col("trips").cast("double")))

    fit_rows = cut_lineage(labelled(train).select(*cols, "label"), "train")
    check_rows = cut_lineage(labelled(valid).select(*cols, "label"), "valid")
    trees = GBTRegressor(
        maxIter=max_iter, maxDepth=max_depth, stepSize=step_size, subsamplingRate=subsample, seed=seed
    )
    prepared = Pipeline(stages=_assembly(cols)).fit(fit_rows)
    vectors = prepared.transform(fit_rows).select("features", "label")
    full = trees.fit(vectors)
    losses = full.evaluateEachIteration(prepared.transform(check_rows).select("features", "label"), "squared")
    best = min(range(len(losses)), key=losses.__getitem__) + 1
    return PipelineModel(stages=[*prepared.stages, first_rounds(full, best)])


def first_rounds(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The ensemble of the first ``rounds`` trees of a fitted one."""
    if not 1 <= rounds <= model.getNumTrees:
        raise ValueError(f"rounds must be 1..{model.getNumTrees}")
    spark = SparkSession.getActiveSession()
    regression, gateway = spark._jvm.org.apache.spark.ml.regression, spark.sparkContext._gateway
    trees = gateway.new_array(regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(spark._jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(model.trees[:rounds], model.treeWeights, strict=False)):
        trees[i], weights[i] = tree._java_obj, weight
    return GBTRegressionModel(regression.GBTRegressionModel(model.uid, trees, weights, model.numFeatures))


def predict_demand(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``pred``: expected trips, never negative."""
    scored = model.transform(df)
    pred = F.greatest(F.expm1("prediction"), F.lit(0.0)).alias("pred")
    return scored.select(*[c for c in df.columns if c != "pred"], pred)


def importance_top_k(model: PipelineModel, features: Sequence[str], k: int) -> DataFrame:
    """The k most important features, largest first."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    ranked = sorted(zip(features, weights), key=lambda pair: (-pair[1], pair[0]))[:k]
    rows = [(name, weight, rank) for rank, (name, weight) in enumerate(ranked, start=1)]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double, rank int")


def residual_quantiles(df: DataFrame, lo: float, hi: float, actual: str = "trips", pred: str = "pred") -> DataFrame:
    """Exact residual quantiles per hour: hour, r_lo, r_hi.

    Residuals, cut to thousandths, are counted first; the quantile then works on (value, count)
    pairs, whose number is bounded by the value range and not by the rows of an hour.
    """
    residual = (F.rint((F.col(actual) - F.col(pred)) * F.lit(1000.0)) / F.lit(1000.0)).alias("residual")
    counts = df.select("hour", residual).groupBy("hour", "residual").agg(F.count("*").alias("n"))
    return counts.groupBy("hour").agg(
        F.percentile("residual", F.lit(lo), F.col("n")).alias("r_lo"),
        F.percentile("residual", F.lit(hi), F.col("n")).alias("r_hi"),
    )


def quantile_band(pred_valid: DataFrame, pred_test: DataFrame, lo: float = 0.1, hi: float = 0.9) -> DataFrame:
    """Split-conformal band: the point forecast plus the validation residuals' quantiles of its hour.

    0 <= q_lo <= q_hi; hours without validation rows keep the point forecast as a band of width 0.
    """
    offsets = residual_quantiles(pred_valid, lo, hi)
    q_lo = F.greatest(F.lit(0.0), F.col("pred") + F.coalesce("r_lo", F.lit(0.0)))
    q_hi = F.greatest(q_lo, F.col("pred") + F.coalesce("r_hi", F.lit(0.0)))
    return pred_test.join(offsets, "hour", "left").select(*pred_test.columns, q_lo.alias("q_lo"), q_hi.alias("q_hi"))


def _finite(col: Column) -> Column:
    return col.isNotNull() & ~F.isnan(col) & (F.abs(col) != float("inf"))


def _error_columns(actual: str, pred: str) -> list[Column]:
    a, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    gap = F.abs(a - p)
    relative = gap / F.greatest(a, F.lit(1.0))
    return [
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(gap).alias("mae"),
        (F.avg(relative) * 100).alias("mape_pct"),
        (F.avg(F.when(a >= 5, relative)) * 100).alias("mape_high_pct"),
    ]


def _scorable(df: DataFrame, actual: str, pred: str) -> DataFrame:
    return df.filter(_finite(F.col(actual).cast("double")) & _finite(F.col(pred).cast("double")))


def error_metrics(df: DataFrame, actual: str = "trips", pred: str = "pred") -> DataFrame:
    """One row: rmse, mae, mape and mape where the actual is 5 or more (null without such cells)."""
    return _scorable(df, actual, pred).agg(*_error_columns(actual, pred))


def metrics_by_year(df: DataFrame, actual: str = "trips", pred: str = "pred") -> DataFrame:
    return _scorable(df, actual, pred).groupBy(F.year("date").alias("year")).agg(
        F.count("*").alias("cells"), *_error_columns(actual, pred)
    )


def interval_coverage(df: DataFrame, actual: str = "trips") -> DataFrame:
    """Share of actuals within [q_lo, q_hi] in percent, and the mean width."""
    inside = F.col(actual).between(F.col("q_lo"), F.col("q_hi"))
    return df.agg(
        (F.avg(inside.cast("double")) * 100).alias("coverage_pct"),
        F.avg(F.col("q_hi") - F.col("q_lo")).alias("mean_width"),
    )


def zone_forecast_error(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Per zone: actual and predicted totals and their difference in percent (0 where nothing happened)."""
    sums = df.groupBy("zone").agg(F.sum("trips").alias("actual"), F.sum("pred").alias("predicted"))
    error = ratio_or_zero((F.col("predicted") - F.col("actual")) * F.lit(100.0), F.col("actual"))
    return enrich_zone(sums.withColumn("error_pct", error), zones)


def forecast_curve(df: DataFrame) -> DataFrame:
    """The busiest zone hour by hour: time label, actual, prediction and band if there is one."""
    totals = df.groupBy("zone").agg(F.sum("trips").alias("total"))
    best = totals.agg(F.max_by("zone", F.struct("total", -F.col("zone"))).alias("zone")).scalar()
    label = F.concat(
        F.date_format("date", "yyyy-MM-dd"), F.lit("T"), F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00")
    )
    band = [F.round(c, 1).alias(c) for c in ("q_lo", "q_hi") if c in df.columns]
    return (
        df.filter(F.col("zone") == best)
        .select("zone", label.alias("at"), "trips", F.round("pred", 1).alias("pred"), *band)
        .orderBy("at")
    )


def weather_effect(df: DataFrame, bins: Sequence[tuple[int, int]] = TEMPERATURE_BINS) -> DataFrame:
    """Demand by weather in long form: bucket, cells, mean_trips, hours, days.

    Buckets are dry, wet, snow and one per temperature bin; hours counts distinct (date, hour).
    One pre-aggregation per hour of the calendar feeds all of them.
    """
    rain, snow, temp = F.col("precipitation"), F.col("snowfall"), F.col("temperature_2m")
    tags = [
        F.when(rain == 0, "dry").when(rain > 0, "wet"),
        F.when(snow > 0, "snow"),
        F.coalesce(*[F.when((temp >= lo) & (temp < hi), f"{lo}..{hi}") for lo, hi in bins]),
    ]
    hourly = df.groupBy("date", "hour", rain, snow, temp).agg(
        F.sum("trips").alias("trips"), F.count("*").alias("cells")
    )
    tagged = hourly.select("date", "trips", "cells", F.explode(F.array_compact(F.array(*tags))).alias("bucket"))
    daily = tagged.groupBy("bucket", "date").agg(
        F.sum("trips").alias("trips"), F.sum("cells").alias("cells"), F.count("*").alias("hours")
    )
    return daily.groupBy("bucket").agg(
        F.sum("cells").alias("cells"),
        (F.sum("trips") / F.sum("cells")).alias("mean_trips"),
        F.sum("hours").alias("hours"),
        F.count("*").alias("days"),
    )


def ablation(
    train: DataFrame, valid: DataFrame, test: DataFrame, base_cols: Sequence[str], extra: Sequence[str], **fit: object
) -> DataFrame:
    """Test error of the model without and with the extra features."""
    def scored(variant: str, cols: Sequence[str]) -> DataFrame:
        model = fit_demand_gbt(train, valid, cols, **fit)
        return error_metrics(predict_demand(model, test)).select(F.lit(variant).alias("variant"), "rmse")

    return scored("base", base_cols).unionByName(scored("with_extra", [*base_cols, *extra]))
