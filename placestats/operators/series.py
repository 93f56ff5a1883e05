"""Monthly series: dense counts, trends, calendars and holdouts.

A series has the columns of its group, `month` (first day, date) and `y`. Counting
comes first, so every later step sees one row per group and month and the size of a
group is bounded by the calendar, not by its number of events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placestats.constants import HORIZON, MAPE_CAP, MIN_MONTHS
from placestats.functions.dates import month_of
from placestats.functions.numbers import clamp
from placestats.functions.rules import trend_class
from placestats.session import observed, spread


def _keys(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def monthly_counts(df: DataFrame, group: str | Sequence[str], ts: str) -> DataFrame:
    return df.groupBy(*_keys(group), month_of(F.col(ts)).alias("month")).agg(F.count(F.lit(1)).alias("y"))


def fill_months(counts: DataFrame, group: str | Sequence[str]) -> DataFrame:
    """Zero-fill each group from its own first to its own last month.

    The counted months of a group, bounded by the calendar, get the missing ones beside
    them before they become rows, so the dense rows meet in no join.
    """
    keys = _keys(group)
    seen = F.collect_list(F.when(F.col("month").isNotNull(), F.struct("month", F.col("y").cast("bigint").alias("y"))))
    spans = counts.groupBy(*keys).agg(F.min("month").alias("_lo"), F.max("month").alias("_hi"), seen.alias("_seen"))
    gaps = F.array_except(F.sequence("_lo", "_hi", F.expr("interval 1 month")), F.col("_seen.month"))
    empty = F.transform(gaps, lambda m: F.struct(m.alias("month"), F.lit(0).cast("bigint").alias("y")))
    rows = spans.select(*keys, F.explode(F.concat("_seen", empty)).alias("_m"))
    return rows.select(*keys, "_m.month", F.coalesce("_m.y", F.lit(0)).cast("bigint").alias("y"))


def monthly_series(df: DataFrame, group: str | Sequence[str], ts: str) -> DataFrame:
    """Dense monthly counts. They become many more rows than were counted, so the counts are
    dealt by their number: bytes would pack the series of a large table into a few tasks."""
    counts, told = observed(monthly_counts(df, group, ts), rows=F.count(F.lit(1)))
    return fill_months(spread(counts, told["rows"], *_keys(group), per_task=100_000), group)


def with_reverse_position(series: DataFrame, group: str | Sequence[str]) -> DataFrame:
    """Adds `back`: 1 for the last month of a group, 2 for the one before ..."""
    w = W.partitionBy(*_keys(group)).orderBy(F.desc("month"))
    return series.withColumn("back", F.row_number().over(w))


def yoy_recent(series: DataFrame, group: str | Sequence[str], recent: int = 3, lag: int = 12) -> DataFrame:
    """Mean of the last months against the same months a year earlier, with its trend.

    Series shorter than `recent + lag` compare with themselves and count as stable.
    Also gives the length, total and last month of each series.
    """
    back = F.col("back")
    agg = with_reverse_position(series, group).groupBy(*_keys(group)).agg(
        F.avg(F.when(back <= recent, F.col("y"))).alias("recent_avg"),
        F.avg(F.when(back.between(lag + 1, lag + recent), F.col("y"))).alias("_year_ago"),
        F.count(F.lit(1)).alias("n_months"),
        F.sum("y").alias("total"),
        F.max("month").alias("last_month"),
    )
    known = F.col("n_months") >= recent + lag
    return agg.withColumns(
        {
            "prev_year_avg": F.when(known, F.col("_year_ago")).otherwise(F.col("recent_avg")),
            "recent_trend": F.when(known, trend_class(F.col("recent_avg"), F.col("_year_ago"))).otherwise(F.lit("stable")),
        }
    ).drop("_year_ago")


def horizon_months(series: DataFrame, group: str | Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """The months to forecast: step 1..horizon after each group's last month."""
    last = series.groupBy(*_keys(group)).agg(F.max("month").alias("last_month"))
    steps = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.withColumn("month", F.add_months("last_month", F.col("step")))


def split_holdout(series: DataFrame, group: str | Sequence[str], holdout: int = HORIZON) -> tuple[DataFrame, DataFrame]:
    """(training part, last `holdout` months)."""
    placed = with_reverse_position(series, group)
    return (
        placed.where(F.col("back") > holdout).drop("back"),
        placed.where(F.col("back") <= holdout).drop("back"),
    )


def mape(actual: Column, predicted: Column, cap: float = MAPE_CAP) -> Column:
    """Aggregate: mean absolute percentage error, capped, two digits half-even."""
    err = F.avg(F.abs((actual - predicted) / (actual + F.lit(1e-9)))) * 100
    return F.bround(clamp(err, hi=cap), 2)


def backtest(series: DataFrame, group: str | Sequence[str], model, holdout: int = HORIZON, min_months: int = MIN_MONTHS) -> DataFrame:
    """Holdout error per group: fit on all but the last months, compare with those.

    `model(train, group, horizon)` returns group, month and `forecast`. Groups whose
    training part is shorter than `min_months` get a null error.
    """
    keys = _keys(group)
    train, test = split_holdout(series, keys, holdout)
    enough = train.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_months).select(*keys)
    predicted = model(train.join(enough, keys, "left_semi"), keys, holdout).select(*keys, "month", "forecast")
    joined = test.join(predicted, [*keys, "month"], "left")
    return joined.groupBy(*keys).agg(mape(F.col("y"), F.col("forecast")).alias("train_mape"))


def history_with_forecast(history: DataFrame, forecast: DataFrame, group: str | Sequence[str]) -> DataFrame:
    """One long table of counted and forecast months, tagged by `type`."""
    keys = _keys(group)
    past = history.select(*keys, "month", F.col("y").cast("bigint").alias("y"), F.lit("Historical").alias("type"))
    ahead = forecast.select(
        *keys, "month", F.col("forecasted_count").cast("bigint").alias("y"), F.lit("Forecast").alias("type")
    )
    return past.unionByName(ahead)


def first_forecast(forecast: DataFrame, group: str | Sequence[str]) -> DataFrame:
    """The earliest forecast row of each group."""
    keys = _keys(group)
    rest = [c for c in forecast.columns if c not in keys]
    return forecast.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col("month")).alias("_f")).select(*keys, "_f.*")
