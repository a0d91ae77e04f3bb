"""Queries: demand grid, weather, forecast evaluation and the fitted model."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideloom.functions.measures import clip_error, improvement_pct
from rideloom.operators import forecast, grid, quantile_trees
from rideloom.operators.geo import distance_join
from rideloom.plans.catalog import query, r6
from rideloom.plans.sql import with_views
from rideloom.plans.tables import Tables
from rideloom.workspace import cut_lineage

TRAIN_END, VALID_END = date(2024, 1, 21), date(2024, 1, 25)
# Small trees: the pattern in the data is simple.
FIT = {"max_iter": 12, "max_depth": 5, "step_size": 0.3}

_KEY = "zone, hour, CAST(date AS VARCHAR) AS date"


@query("dense_grid", with_views("grid", body=f"SELECT {_KEY}, trips FROM grid"))
def _(t: Tables) -> DataFrame:
    return t.grid


@query("join_hourly_weather", with_views("grid", "weather_h", body="""
  SELECT zone, g.hour, CAST(g.date AS VARCHAR) AS date, trips, coalesce(temperature_2m, -99) AS temperature_2m,
    coalesce(precipitation, -99) AS precipitation
  FROM grid g LEFT JOIN weather_h w ON g.date = w.date AND g.hour = w.hour"""))
def _(t: Tables) -> DataFrame:
    columns = ("temperature_2m", "precipitation")
    return grid.join_hourly_weather(t.grid, t.weather_h, columns).fillna(-99.0, list(columns))


@query("join_daily_weather", with_views("grid", "weather_d", body="""
  SELECT zone, hour, CAST(g.date AS VARCHAR) AS date, trips, temperature_2m_max, precipitation_sum, sunshine_duration
  FROM grid g LEFT JOIN weather_d w ON g.date = w.date"""))
def _(t: Tables) -> DataFrame:
    return grid.join_daily_weather(
        t.grid, t.weather_d, ("temperature_2m_max", "precipitation_sum", "sunshine_duration")
    )


@query("lag_features", with_views("lagged", body=f"""
  SELECT {_KEY}, trips, coalesce(lag_1, -1) AS lag_1, coalesce(lag_7, -1) AS lag_7 FROM lagged"""))
def _(t: Tables) -> DataFrame:
    return grid.lag_features(t.grid).fillna(-1, ["lag_1", "lag_7"])


@query("trailing_mean_7", with_views("lagged", body=f"""
  SELECT {_KEY}, trips, round(coalesce(lag7mean, -1), 6) AS lag7mean FROM lagged"""))
def _(t: Tables) -> DataFrame:
    return grid.trailing_mean_7(t.grid).fillna(-1.0, ["lag7mean"]).select("zone", "hour", "date", "trips", r6("lag7mean"))


@query("seasonal_naive", with_views("lagged", body=f"""
  SELECT {_KEY}, trips, CAST(coalesce(lag_7, -1) AS DOUBLE) AS pred FROM lagged"""))
def _(t: Tables) -> DataFrame:
    return grid.seasonal_naive(t.grid).fillna(-1.0, ["pred"])


# Zones 0..24 lie on a 5 x 5 lattice; their boxes are 840 m apart east-west and 1.1 km north-south.
@query("neighbor_mean", with_views("lagged", body="""
  SELECT f.zone, f.hour, CAST(f.date AS VARCHAR) AS date, f.trips,
    round(coalesce(avg(n.lag_1), f.lag_1, -1), 6) AS neighbor_lag1_mean
  FROM lagged f LEFT JOIN lagged n ON n.date = f.date AND n.hour = f.hour AND n.zone // 5 = f.zone // 5 AND abs(n.zone - f.zone) = 1
  GROUP BY f.zone, f.hour, f.date, f.trips, f.lag_1"""))
def _(t: Tables) -> DataFrame:
    edges = distance_join(t.zone_geom, 900.0)
    features = t.lagged.select("zone", "hour", "date", "trips", "lag_1")
    return grid.neighbor_mean(features, edges).fillna(-1.0, ["neighbor_lag1_mean"]).select(
        "zone", "hour", "date", "trips", r6("neighbor_lag1_mean")
    )


_FEATURES = f"""{_KEY}, trips, weekday, month, is_weekend, lag_1, lag_7, round(lag7mean, 6) AS lag7mean, temperature_2m,
  precipitation, cloud_cover, temperature_2m_max, snowfall_sum, sunshine_duration"""
_FEATURE_COLUMNS = (
    "zone", "hour", "date", "trips", "weekday", "month", "is_weekend", "lag_1", "lag_7", r6, "temperature_2m",
    "precipitation", "cloud_cover", "temperature_2m_max", "snowfall_sum", "sunshine_duration",
)


def features(t: Tables, source: DataFrame | None = None) -> DataFrame:
    return grid.feature_table(t.grid if source is None else source, t.weather_h, t.weather_d, date(2024, 1, 8))


@query("feature_table", with_views("features", body=f"SELECT {_FEATURES} FROM features"))
def _(t: Tables) -> DataFrame:
    return features(t).select(*[r6("lag7mean") if c is r6 else c for c in _FEATURE_COLUMNS])


@query("temporal_split", with_views("features", body="""
  SELECT CASE WHEN date < DATE '2024-01-22' THEN 'train' WHEN date < DATE '2024-01-26' THEN 'valid' ELSE 'test' END AS split,
    CAST(count(*) AS BIGINT) AS cells, CAST(sum(trips) AS BIGINT) AS trips FROM features GROUP BY 1"""))
def _(t: Tables) -> DataFrame:
    return grid.temporal_split(features(t), TRAIN_END, VALID_END).groupBy("split").agg(
        F.count("*").alias("cells"), F.sum("trips").alias("trips")
    )


def naive(t: Tables) -> DataFrame:
    scored = grid.seasonal_naive(t.grid).filter("pred IS NOT NULL")
    return grid.temporal_split(scored, TRAIN_END, VALID_END)


_ERRORS = """round(sqrt(avg((trips - pred) ** 2)), 6) AS rmse, round(avg(abs(trips - pred)), 6) AS mae,
  round(100 * avg(abs(trips - pred) / greatest(trips, 1)), 6) AS mape_pct,
  round(coalesce(100 * avg(abs(trips - pred) / trips) FILTER (WHERE trips >= 5), -1), 6) AS mape_high_pct"""
_ERROR_COLUMNS = ("rmse", "mae", "mape_pct", "mape_high_pct")


def rounded_errors(df: DataFrame) -> list:
    return [r6(F.coalesce(name, F.lit(-1.0))).alias(name) for name in _ERROR_COLUMNS]


@query("error_metrics", with_views("naive", body=f"SELECT {_ERRORS} FROM naive WHERE split = 'test'"))
def _(t: Tables) -> DataFrame:
    errors = forecast.error_metrics(naive(t).filter("split = 'test'"))
    return errors.select(*rounded_errors(errors))


@query("metrics_by_year", with_views("shipments", body=f"""
  SELECT CAST(year(date) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS cells, {_ERRORS} FROM
    (SELECT day AS date, zone, count(*) AS trips, sum(seconds) / 2400 AS pred FROM shipments GROUP BY 1, 2) GROUP BY 1"""))
def _(t: Tables) -> DataFrame:
    cells = t.shipments.groupBy(F.col("day").alias("date"), "zone").agg(
        F.count("*").alias("trips"), (F.sum("seconds") / F.lit(2400.0)).alias("pred")
    )
    errors = forecast.metrics_by_year(cells)
    return errors.select("year", "cells", *rounded_errors(errors))


@query("residual_quantiles", with_views("residual_q", body="""
  SELECT hour, round(r_lo, 6) AS r_lo, round(r_hi, 6) AS r_hi FROM residual_q"""))
def _(t: Tables) -> DataFrame:
    return forecast.residual_quantiles(naive(t).filter("split = 'valid'"), 0.1, 0.9).select("hour", r6("r_lo"), r6("r_hi"))


def banded(t: Tables) -> DataFrame:
    scored = naive(t)
    return forecast.quantile_band(scored.filter("split = 'valid'"), scored.filter("split = 'test'"))


@query("quantile_band", with_views("banded", body=f"""
  SELECT zone, hour, CAST(date AS VARCHAR) AS date, trips, pred, round(q_lo, 6) AS q_lo, round(q_hi, 6) AS q_hi
  FROM (SELECT * FROM banded)"""))
def _(t: Tables) -> DataFrame:
    return banded(t).select("zone", "hour", "date", "trips", "pred", r6("q_lo"), r6("q_hi"))


@query("interval_coverage", with_views("banded", body="""
  SELECT round(100 * avg(CASE WHEN trips >= q_lo AND trips <= q_hi THEN 1 ELSE 0 END), 6) AS coverage_pct,
    round(avg(q_hi - q_lo), 6) AS mean_width FROM banded"""))
def _(t: Tables) -> DataFrame:
    return forecast.interval_coverage(banded(t)).select(r6("coverage_pct"), r6("mean_width"))


_ZONE_ERROR = """SELECT n.zone, CAST(sum(trips) AS BIGINT) AS actual, sum(pred) AS predicted, name, borough,
  CASE WHEN sum(trips) = 0 THEN 0 ELSE 100 * (sum(pred) - sum(trips)) / sum(trips) END AS error_pct
  FROM naive n JOIN zones ON zone = id WHERE split = 'test' GROUP BY n.zone, name, borough"""


@query("zone_forecast_error", with_views("naive", "zones", body=f"""
  SELECT zone, actual, predicted, round(error_pct, 6) AS error_pct, name, borough FROM ({_ZONE_ERROR})"""))
def _(t: Tables) -> DataFrame:
    return forecast.zone_forecast_error(naive(t).filter("split = 'test'"), t.zones).select(
        "zone", "actual", "predicted", r6("error_pct"), "name", "borough"
    )


@query("clip_error", with_views("naive", "zones", body=f"""
  SELECT zone, round(least(greatest(error_pct, -5.0::DOUBLE), 5.0::DOUBLE), 6) AS clipped FROM ({_ZONE_ERROR})"""))
def _(t: Tables) -> DataFrame:
    errors = forecast.zone_forecast_error(naive(t).filter("split = 'test'"), t.zones)
    return errors.select("zone", r6(clip_error(F.col("error_pct"), -5, 5)).alias("clipped"))


@query("forecast_curve", with_views("banded", body="""
  SELECT zone, CAST(date AS VARCHAR) || 'T' || lpad(CAST(hour AS VARCHAR), 2, '0') || ':00' AS "at", trips,
    round(pred, 1) AS pred, round(q_lo, 1) AS q_lo, round(q_hi, 1) AS q_hi FROM (SELECT * FROM banded)
  WHERE zone = (SELECT zone FROM banded GROUP BY zone ORDER BY sum(trips) DESC, zone LIMIT 1)"""))
def _(t: Tables) -> DataFrame:
    return forecast.forecast_curve(banded(t))


_BUCKETS = """SELECT date, hour, trips, unnest(list_filter([
    CASE WHEN precipitation = 0 THEN 'dry' ELSE 'wet' END, CASE WHEN snowfall > 0 THEN 'snow' END,
    CASE WHEN temperature_2m >= -20 AND temperature_2m < 0 THEN '-20..0' WHEN temperature_2m < 10 THEN '0..10'
      WHEN temperature_2m < 20 THEN '10..20' WHEN temperature_2m < 30 THEN '20..30' WHEN temperature_2m < 50 THEN '30..50' END
  ], lambda b: b IS NOT NULL)) AS bucket FROM features"""


@query("weather_effect", with_views("features", body=f"""
  SELECT bucket, CAST(count(*) AS BIGINT) AS cells, round(avg(trips), 6) AS mean_trips,
    CAST(count(DISTINCT date * 24 + hour) AS BIGINT) AS hours, CAST(count(DISTINCT date) AS BIGINT) AS days
  FROM (SELECT bucket, trips, hour, date - DATE '2024-01-01' AS date FROM ({_BUCKETS})) GROUP BY bucket"""))
def _(t: Tables) -> DataFrame:
    return forecast.weather_effect(features(t)).select("bucket", "cells", r6("mean_trips"), "hours", "days")


@query("improvement_pct", with_views("lagged", body="""
  SELECT round(100 * (1 - sqrt(avg((trips - lag7mean) ** 2)) / sqrt(avg((trips - lag_7) ** 2))), 6) AS improvement_pct
  FROM lagged WHERE lag_7 IS NOT NULL"""))
def _(t: Tables) -> DataFrame:
    scored = t.lagged.filter("lag_7 IS NOT NULL")
    base = forecast.error_metrics(scored, pred="lag_7").select("rmse").scalar()
    return forecast.error_metrics(scored, pred="lag7mean").select(
        r6(improvement_pct(F.col("rmse"), base)).alias("improvement_pct")
    )


# -- fitted models -------------------------------------------------------------------------------


def _model_rows(t: Tables) -> dict[str, DataFrame]:
    rows = cut_lineage(grid.temporal_split(features(t, t.signal), TRAIN_END, VALID_END), "features")
    return {name: rows.filter(F.col("split") == name) for name in ("train", "valid", "test")}


_TEST_ROWS = "(SELECT CAST(count(*) AS BIGINT) AS n FROM features WHERE date > DATE '2024-01-25')"


@query("fit_demand_gbt", with_views("features", body=f"""
  SELECT variant, n, TRUE AS not_negative, TRUE AS beats_lag FROM {_TEST_ROWS} CROSS JOIN (VALUES ('model'), ('lag_7')) v(variant)"""))
def _(t: Tables) -> DataFrame:
    """What must hold of any sound fit: every test row is scored, none below zero, better than the last week's value."""
    rows = _model_rows(t)
    model = forecast.fit_demand_gbt(rows["train"], rows["valid"], grid.FEATURES, **FIT)
    scored = cut_lineage(forecast.predict_demand(model, rows["test"]), "scored")
    lag = forecast.error_metrics(rows["test"], pred="lag_7").select("rmse").scalar()

    def facts(variant: str, pred: str) -> DataFrame:
        told = scored.agg(F.count(pred).alias("n"), F.bool_and(F.col(pred) >= 0).alias("not_negative"))
        rmse = forecast.error_metrics(scored, pred=pred).select("rmse").scalar()
        return told.select(F.lit(variant).alias("variant"), "n", "not_negative", (rmse <= lag).alias("beats_lag"))

    return facts("model", "pred").unionByName(facts("lag_7", "lag_7"))


@query("model_band", with_views("features", body=f"""
  SELECT n, TRUE AS ordered, TRUE AS covers_some FROM {_TEST_ROWS}"""))
def _(t: Tables) -> DataFrame:
    rows = _model_rows(t)
    model = forecast.fit_demand_gbt(rows["train"], rows["valid"], grid.FEATURES, **FIT)
    band = forecast.quantile_band(
        forecast.predict_demand(model, rows["valid"]), forecast.predict_demand(model, rows["test"])
    )
    inside = F.col("trips").between(F.col("q_lo"), F.col("q_hi"))
    return band.agg(
        F.count("*").alias("n"), F.bool_and((F.col("q_lo") <= F.col("q_hi")) & (F.col("q_lo") >= 0)).alias("ordered"),
        (F.count_if(inside) * 2 > F.count("*")).alias("covers_some"),
    )


@query("quantile_trees", with_views("features", body=f"""
  SELECT n, TRUE AS ordered, TRUE AS near_eighty, TRUE AS beats_constant_lo, TRUE AS beats_constant_hi FROM {_TEST_ROWS}"""))
def _(t: Tables) -> DataFrame:
    """What must hold of the 10 % and 90 % trees: ordered, four rows of five inside, closer than one value for all."""
    rows = _model_rows(t)
    model = quantile_trees.fit_quantile_trees(rows["train"], rows["valid"], grid.FEATURES, rounds=7, depth=3, step=0.4)
    band = quantile_trees.predict_band(model, rows["test"])
    fixed = rows["train"].agg(F.percentile("trips", F.array(F.lit(0.1), F.lit(0.9)))).first()[0]

    def loss(pred, alpha: float):
        rest = F.col("trips") - pred
        return F.avg(F.greatest(rest * alpha, rest * (alpha - 1)))

    inside = F.avg(F.col("trips").between(F.col("q_lo"), F.col("q_hi")).cast("int"))
    return band.agg(
        F.count("*").alias("n"), F.bool_and((F.col("q_lo") <= F.col("q_hi")) & (F.col("q_lo") >= 0)).alias("ordered"),
        inside.between(0.6, 0.95).alias("near_eighty"),
        (loss(F.col("q_lo"), 0.1) < loss(F.lit(fixed[0]), 0.1)).alias("beats_constant_lo"),
        (loss(F.col("q_hi"), 0.9) < loss(F.lit(fixed[1]), 0.9)).alias("beats_constant_hi"))


@query("importance_top_k", f"""
  SELECT CAST(range + 1 AS INTEGER) AS rank, TRUE AS falling, TRUE AS total_is_one FROM range({len(grid.FEATURES)})""")
def _(t: Tables) -> DataFrame:
    rows = _model_rows(t)
    model = forecast.fit_demand_gbt(rows["train"], rows["valid"], grid.FEATURES, **FIT)
    ranked = forecast.importance_top_k(model, grid.FEATURES, len(grid.FEATURES))
    before = ranked.select((F.col("rank") + 1).alias("rank"), F.col("importance").alias("before"))
    total = ranked.agg(F.sum("importance").alias("total")).scalar()
    return ranked.join(before, "rank", "left").select(
        "rank", F.coalesce(F.col("before") >= F.col("importance"), F.lit(True)).alias("falling"),
        (F.abs(total - 1) < 1e-6).alias("total_is_one"),
    )


@query("ablation", """
  SELECT variant, TRUE AS finite FROM (VALUES ('base'), ('with_extra')) v(variant)""")
def _(t: Tables) -> DataFrame:
    edges = distance_join(t.zone_geom, 900.0)
    table = grid.neighbor_mean(features(t, t.signal), edges)
    rows = cut_lineage(grid.temporal_split(table, TRAIN_END, VALID_END), "features")
    train, valid, test = (rows.filter(F.col("split") == name) for name in ("train", "valid", "test"))
    told = forecast.ablation(train, valid, test, grid.FEATURES, ["neighbor_lag1_mean"], **FIT)
    return told.select("variant", (~F.isnan("rmse") & (F.col("rmse") > 0)).alias("finite"))
