"""Forecasts per group, all with the same output contract.

Columns: the group, last_train_date and forecast_month (`yyyy-MM`), month (date),
step, forecast (double), forecasted_count, lower_ci, upper_ci, arima_order (a label of
the model). All models are SQL expressions over joins and aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placestats.constants import HORIZON, MIN_MONTHS, SEASON_LENGTH
from placestats.operators.order_search import forecast_steps, order_search
from placestats.operators.series import backtest, horizon_months

Z95 = 1.96


def _keys(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def _contract(df: DataFrame, keys: list[str], value: Column, half: Column, order: Column) -> DataFrame:
    """Round half-even, floor at zero and name the columns of the contract."""

    def count(c: Column) -> Column:
        return F.greatest(F.bround(c, 0), F.lit(0.0)).cast("int")

    return df.select(
        *keys,
        F.date_format("last_month", "yyyy-MM").alias("last_train_date"),
        F.date_format("month", "yyyy-MM").alias("forecast_month"),
        "month",
        "step",
        value.alias("forecast"),
        count(value).alias("forecasted_count"),
        count(value - half).alias("lower_ci"),
        count(value + half).alias("upper_ci"),
        order.alias("arima_order"),
    )


def long_enough(series: DataFrame, group: str | Sequence[str], min_months: int = MIN_MONTHS) -> DataFrame:
    keys = _keys(group)
    sizes = series.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_months)
    return series.join(sizes.select(*keys), keys, "left_semi")


def forecast_snaive(series: DataFrame, group: str | Sequence[str], horizon: int = HORIZON, lag: int = SEASON_LENGTH) -> DataFrame:
    """The value one season ago, with the spread of past seasonal changes."""
    keys = _keys(group)
    ago = series.select(*keys, F.add_months("month", lag).alias("month"), F.col("y").alias("_ago"))
    change = series.join(ago, [*keys, "month"]).groupBy(*keys).agg(F.stddev_samp(F.col("y") - F.col("_ago")).alias("_sd"))
    ahead = horizon_months(series, keys, horizon).withColumn(
        "_from", F.add_months("month", F.lit(-lag) * F.ceil(F.col("step") / F.lit(lag)).cast("int"))
    )
    base = series.select(*keys, F.col("month").alias("_from"), F.col("y").cast("double").alias("_y"))
    rows = ahead.join(base, [*keys, "_from"]).join(change, keys, "left")
    half = F.coalesce(F.col("_sd"), F.lit(0.0)) * Z95 * F.sqrt(F.ceil(F.col("step") / F.lit(lag)))
    return _contract(rows, keys, F.col("_y"), half, F.lit("snaive"))


def forecast_trend(series: DataFrame, group: str | Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """Least-squares line over the months, with the residual spread."""
    keys = _keys(group)
    for k in keys:
        series = series.where(F.col(k).isNotNull())
    # one pass: with a join for the start and another for the last month the dense rows would be sorted three times
    t = F.months_between("month", "_start")
    fit = series.withColumn("_start", F.min("month").over(W.partitionBy(*keys))).groupBy(*keys).agg(
        F.regr_slope(F.col("y"), t).alias("_b"),
        F.regr_intercept(F.col("y"), t).alias("_a"),
        F.regr_syy(F.col("y"), t).alias("_syy"),
        F.regr_sxy(F.col("y"), t).alias("_sxy"),
        F.count(F.lit(1)).alias("_n"),
        F.first("_start").alias("_start"),
        F.max("month").alias("last_month"),
    )
    rows = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    rows = rows.withColumn("month", F.add_months("last_month", F.col("step")))
    value = F.col("_a") + F.col("_b") * F.months_between("month", "_start")
    residual = F.greatest(F.col("_syy") - F.col("_b") * F.col("_sxy"), F.lit(0.0)) / F.nullif(F.col("_n") - 2, F.lit(0))
    return _contract(rows, keys, value, F.coalesce(F.sqrt(residual), F.lit(0.0)) * Z95, F.lit("trend"))


def forecast_seasonal(series: DataFrame, group: str | Sequence[str], horizon: int = HORIZON, lag: int = SEASON_LENGTH) -> DataFrame:
    """Last season plus a first-order autoregression of the change against the season before.

    d(t) = y(t) - y(t - lag) follows d(t) = a + b d(t - 1), fitted by least squares over a
    lag join; b is held within +-0.99. Groups with fewer than three such pairs, or none that
    differ, repeat the season (a = b = 0). The interval comes from the residual spread.
    """
    if horizon > lag:
        raise ValueError("the horizon must not exceed one season")
    keys = _keys(group)
    y = F.col("y").cast("double")
    ago = series.select(*keys, F.add_months("month", lag).alias("month"), y.alias("_ago"))
    change = series.join(ago, [*keys, "month"]).select(*keys, "month", (y - F.col("_ago")).alias("_d"))
    before = change.select(*keys, F.add_months("month", 1).alias("month"), F.col("_d").alias("_p"))
    fit = change.join(before, [*keys, "month"]).groupBy(*keys).agg(
        F.regr_slope("_d", "_p").alias("_slope"), F.avg("_d").alias("_md"), F.avg("_p").alias("_mp"),
        F.regr_syy("_d", "_p").alias("_syy"), F.regr_sxx("_d", "_p").alias("_sxx"), F.regr_sxy("_d", "_p").alias("_sxy"),
        F.count(F.lit(1)).alias("_n"),
    )
    usable = (F.col("_n") >= 3) & F.col("_slope").isNotNull()
    slope = F.when(usable, F.least(F.greatest(F.col("_slope"), F.lit(-0.99)), F.lit(0.99)))
    fit = fit.withColumn("_b", slope)
    residual = F.col("_syy") - 2 * F.col("_b") * F.col("_sxy") + F.col("_b") * F.col("_b") * F.col("_sxx")
    fit = fit.select(
        *keys, "_b", F.when(usable, F.col("_md") - F.col("_b") * F.col("_mp")).alias("_a"),
        F.when(usable, F.sqrt(F.greatest(residual, F.lit(0.0)) / F.greatest(F.col("_n") - 2, F.lit(1)))).alias("_s"),
    )
    last = series.groupBy(*keys).agg(F.max("month").alias("month"))
    newest = change.join(last, [*keys, "month"]).select(*keys, F.col("_d").alias("_last"))
    ahead = horizon_months(series, keys, horizon).withColumn("_from", F.add_months("month", -lag))
    base = series.select(*keys, F.col("month").alias("_from"), y.alias("_y"))
    rows = ahead.join(base, [*keys, "_from"]).join(fit, keys, "left").join(newest, keys, "left")
    b, h = F.coalesce("_b", F.lit(0.0)), F.col("step").cast("double")
    power = F.pow(b, h)
    drift = F.coalesce("_a", F.lit(0.0)) * (1 - power) / (1 - b) + power * F.coalesce(F.when(F.col("_b").isNotNull(), F.col("_last")), F.lit(0.0))
    half = F.coalesce("_s", F.lit(0.0)) * F.sqrt((1 - power * power) / (1 - b * b)) * Z95
    return _contract(rows, keys, F.col("_y") + drift, half, F.lit("seasonal_ar1"))


def forecast_order_search(series: DataFrame, group: str | Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """The seasonal autoregressive moving-average model of the order that fits each group best."""
    keys = _keys(group)
    rows = forecast_steps(order_search(series, keys), keys, horizon)
    return _contract(rows, keys, F.col("value"), F.col("deviation") * Z95, F.col("order"))


MODELS = {"seasonal": forecast_seasonal, "snaive": forecast_snaive, "trend": forecast_trend, "search": forecast_order_search}


def forecast(series: DataFrame, group: str | Sequence[str], horizon: int = HORIZON, model: str = "seasonal") -> DataFrame:
    """Forecast with the holdout error of the same model beside it."""
    keys = _keys(group)
    gated = long_enough(series, keys)
    ahead = MODELS[model](gated, keys, horizon)
    error = backtest(gated, keys, MODELS[model])
    return ahead.join(error, keys, "left")


def forecast_report(series: DataFrame, forecasted: DataFrame, group: str | Sequence[str], min_months: int = MIN_MONTHS) -> DataFrame:
    """Per group: `ok`, `short` (too few months) or `failed` (no model)."""
    keys = _keys(group)
    sizes = series.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_months"))
    done = forecasted.select(*keys).distinct().withColumn("_ok", F.lit(True))
    status = (
        F.when(F.col("_ok"), F.lit("ok")).when(F.col("n_months") < min_months, F.lit("short")).otherwise(F.lit("failed"))
    )
    return sizes.join(done, keys, "left").select(*keys, "n_months", status.alias("status"))
