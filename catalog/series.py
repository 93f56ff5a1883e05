"""Monthly series and forecasts."""

from pyspark.sql import functions as F

from catalog import query
from placestats.fixtures import Tables
from placestats.functions.rules import direction, reliability, reversal
from placestats.operators.forecast import (
    forecast, forecast_report, forecast_seasonal, forecast_snaive, forecast_trend,
)
from placestats.operators.series import (
    backtest, fill_months, first_forecast, history_with_forecast, horizon_months, monthly_series, yoy_recent,
)

DENSE = {
    "span": "SELECT location_id, min(month) AS lo, max(month) AS hi FROM fx_monthly GROUP BY location_id",
    "grid": "SELECT location_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM span",
    "dense": """SELECT g.location_id, g.month, CAST(coalesce(m.y, 0) AS BIGINT) AS y FROM grid g
LEFT JOIN fx_monthly m ON g.location_id = m.location_id AND g.month = m.month""",
    "placed": "SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY month DESC) AS back FROM dense",
}
NEEDS = ["fx_monthly"]


def orders_by_area(t: Tables):
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), (F.col("c_nationkey") + 1).alias("location_id"))
    return t.orders.join(customers, "o_custkey")


def series(t: Tables):
    return monthly_series(orders_by_area(t), "location_id", "o_orderdate")


@query("monthly_series", "SELECT location_id, month, y FROM dense", NEEDS, DENSE)
def _(t):
    return series(t)


@query(
    "monthly_series_sparse",
    """SELECT g.user_id, g.month, CAST(coalesce(m.y, 0) AS BIGINT) AS y FROM (
         SELECT user_id, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM shifted GROUP BY user_id) g
       LEFT JOIN (SELECT user_id, month, count(*) AS y FROM shifted GROUP BY user_id, month) m ON g.user_id = m.user_id AND g.month = m.month""",
    [],
    {"shifted": "SELECT user_id, CAST(date_trunc('month', CAST(ts AS DATE) + to_months(CAST(event_id % 40 AS INTEGER))) AS DATE) AS month FROM events"},
)
def _(t):
    """Events pushed up to 40 months ahead, so most users have gaps."""
    ahead = F.add_months(F.col("ts").cast("date"), (F.col("event_id") % 40).cast("int"))
    return monthly_series(t.events.withColumn("ts", ahead), "user_id", "ts")


YOY = {
    **DENSE,
    "recent": """
SELECT location_id, avg(y) FILTER (back <= 3) AS recent_avg, avg(y) FILTER (back BETWEEN 13 AND 15) AS ago, count(*) AS n_months,
  CAST(sum(y) AS BIGINT) AS total, max(month) AS last_month FROM placed GROUP BY location_id""",
    "yoy": """
SELECT location_id, recent_avg, n_months, total, last_month, CASE WHEN n_months >= 15 THEN ago ELSE recent_avg END AS prev_year_avg,
  CASE WHEN n_months < 15 THEN 'stable' WHEN ago = 0 THEN CASE WHEN recent_avg > 0 THEN 'increasing' ELSE 'stable' END
       WHEN recent_avg > ago * 1.05::DOUBLE THEN 'increasing' WHEN recent_avg < ago * 0.95::DOUBLE THEN 'decreasing' ELSE 'stable' END AS recent_trend
FROM recent""",
}


@query("yoy_trend", "SELECT * FROM yoy", NEEDS, YOY)
def _(t):
    return yoy_recent(series(t), "location_id")


SNAIVE = {
    **DENSE,
    "change": """SELECT a.location_id, stddev_samp(a.y - b.y) AS sd FROM dense a JOIN dense b
ON a.location_id = b.location_id AND a.month = b.month + INTERVAL 12 MONTH GROUP BY a.location_id""",
    "step": "SELECT location_id, hi, CAST(unnest(range(1, 7)) AS INTEGER) AS step FROM span",
    "snaive": """
SELECT s.location_id, strftime(s.hi, '%Y-%m') AS last_train_date, strftime(s.hi + to_months(s.step), '%Y-%m') AS forecast_month,
  CAST(s.hi + to_months(s.step) AS DATE) AS month, s.step, d.y::DOUBLE AS forecast, CAST(greatest(d.y, 0) AS INTEGER) AS forecasted_count,
  CAST(greatest(round_even(d.y - coalesce(c.sd, 0) * 1.96, 0), 0) AS INTEGER) AS lower_ci,
  CAST(greatest(round_even(d.y + coalesce(c.sd, 0) * 1.96, 0), 0) AS INTEGER) AS upper_ci, 'snaive' AS arima_order
FROM step s JOIN dense d ON s.location_id = d.location_id AND d.month = s.hi + to_months(s.step - 12) LEFT JOIN change c ON c.location_id = s.location_id""",
    "train_end": "SELECT location_id, max(month) AS hi, count(*) AS n FROM placed WHERE back > 6 GROUP BY location_id HAVING count(*) >= 12",
    "mape": """
SELECT p.location_id, CASE WHEN e.n IS NULL THEN NULL ELSE round_even(least(avg(abs((p.y - f.y) / (p.y + 1e-9))) * 100, 999.0), 2) END AS train_mape
FROM placed p LEFT JOIN train_end e ON p.location_id = e.location_id LEFT JOIN dense f ON f.location_id = p.location_id AND f.month = p.month - INTERVAL 12 MONTH
WHERE p.back <= 6 GROUP BY p.location_id, e.n""",
}


@query("forecast_snaive", "SELECT * FROM snaive", NEEDS, SNAIVE)
def _(t):
    return forecast_snaive(series(t), "location_id")


@query("backtest_mape", "SELECT * FROM mape", NEEDS, SNAIVE)
def _(t):
    return backtest(series(t), "location_id", forecast_snaive)


@query(
    "forecast_with_error",
    "SELECT s.*, m.train_mape FROM snaive s LEFT JOIN mape m ON s.location_id = m.location_id",
    NEEDS,
    SNAIVE,
)
def _(t):
    return forecast(series(t), "location_id", model="snaive")


@query(
    "forecast_trend",
    """SELECT s.location_id, strftime(s.hi, '%Y-%m') AS last_train_date, strftime(s.hi + to_months(s.step), '%Y-%m') AS forecast_month, s.step,
       CAST(greatest(round_even(a + b * (n - 1 + s.step), 0), 0) AS INTEGER) AS forecasted_count,
       CAST(greatest(round_even(a + b * (n - 1 + s.step) - half, 0), 0) AS INTEGER) AS lower_ci,
       CAST(greatest(round_even(a + b * (n - 1 + s.step) + half, 0), 0) AS INTEGER) AS upper_ci, 'trend' AS arima_order
       FROM step s JOIN (SELECT location_id, count(*) AS n, regr_slope(y, t) AS b, regr_intercept(y, t) AS a,
         sqrt(greatest(regr_syy(y, t) - regr_slope(y, t) * regr_sxy(y, t), 0) / (count(*) - 2)) * 1.96 AS half
         FROM (SELECT d.*, CAST(datediff('month', lo, month) AS DOUBLE) AS t FROM dense d JOIN span s ON d.location_id = s.location_id) GROUP BY location_id) f
       ON s.location_id = f.location_id""",
    NEEDS,
    SNAIVE,
)
def _(t):
    return forecast_trend(series(t), "location_id").drop("month", "forecast")


@query("horizon_months", "SELECT location_id, hi AS last_month, step, CAST(hi + to_months(step) AS DATE) AS month FROM step", NEEDS, SNAIVE)
def _(t):
    return horizon_months(series(t), "location_id")


@query(
    "first_forecast",
    "SELECT location_id, forecast_month, forecasted_count FROM snaive WHERE step = 1",
    NEEDS,
    SNAIVE,
)
def _(t):
    first = first_forecast(forecast_snaive(series(t), "location_id"), "location_id")
    return first.select("location_id", "forecast_month", "forecasted_count")


@query(
    "history_with_forecast",
    """SELECT location_id, month, y, 'Historical' AS type FROM dense
       UNION ALL SELECT location_id, month, CAST(forecasted_count AS BIGINT), 'Forecast' FROM snaive""",
    NEEDS,
    SNAIVE,
)
def _(t):
    past = series(t)
    return history_with_forecast(past, forecast_snaive(past, "location_id"), "location_id")


@query(
    "forecast_direction",
    """SELECT y.location_id, recent_trend, outlook, coalesce((recent_trend = 'decreasing' AND outlook = 'rising') OR (recent_trend = 'increasing' AND outlook = 'falling'), FALSE) AS is_reversal,
       CASE WHEN m.train_mape > 50 OR n_months < 12 OR total < 500 THEN 'LOW' ELSE 'HIGH' END AS reliability_flag
       FROM (SELECT y.*, CASE WHEN s.forecasted_count > recent_avg * 1.05::DOUBLE THEN 'rising' WHEN s.forecasted_count < recent_avg * 0.95::DOUBLE THEN 'falling' ELSE 'flat' END AS outlook
             FROM yoy y JOIN snaive s ON y.location_id = s.location_id AND s.step = 1) y JOIN mape m ON y.location_id = m.location_id""",
    NEEDS,
    {**SNAIVE, **YOY},
)
def _(t):
    past = series(t)
    first = first_forecast(forecast(past, "location_id", model="snaive"), "location_id")
    rows = yoy_recent(past, "location_id").join(first.select("location_id", "forecasted_count", "train_mape"), "location_id")
    rows = rows.withColumn("outlook", direction(F.col("forecasted_count"), F.col("recent_avg")))
    return rows.select(
        "location_id", "recent_trend", "outlook",
        reversal(F.col("recent_trend"), F.col("outlook")).alias("is_reversal"),
        reliability(F.col("train_mape") > 50, F.col("n_months") < 12, F.col("total") < 500).alias("reliability_flag"),
    )


def seasonal_ctes(p: str, dense: str, key: str = "location_id") -> dict[str, str]:
    """Season a year ago plus a first-order autoregression of the yearly change; ends in `{p}seasonal` (key, hi, month, step, v, half)."""
    ctes = {
        f"{p}chg": f"""SELECT a.location_id, a.month, CAST(a.y - b.y AS DOUBLE) AS d FROM {dense} a JOIN {dense} b
ON a.location_id = b.location_id AND a.month = b.month + INTERVAL 12 MONTH""",
        f"{p}sums": f"""SELECT a.location_id, regr_slope(a.d, b.d) AS sl, avg(a.d) AS md, avg(b.d) AS mp, regr_syy(a.d, b.d) AS syy, regr_sxx(a.d, b.d) AS sxx,
regr_sxy(a.d, b.d) AS sxy, count(*) AS n FROM {p}chg a JOIN {p}chg b ON a.location_id = b.location_id AND a.month = b.month + INTERVAL 1 MONTH GROUP BY a.location_id""",
        f"{p}slope": f"SELECT *, least(greatest(sl, -0.99::DOUBLE), 0.99::DOUBLE) AS b FROM {p}sums WHERE n >= 3 AND sl IS NOT NULL",
        f"{p}fit": f"SELECT location_id, b, md - b * mp AS a, sqrt(greatest(syy - 2 * b * sxy + b * b * sxx, 0) / greatest(n - 2, 1)) AS sd FROM {p}slope",
        f"{p}ahead": f"SELECT location_id, hi, CAST(unnest(range(1, 7)) AS INTEGER) AS step FROM (SELECT location_id, max(month) AS hi FROM {dense} GROUP BY location_id)",
        f"{p}seasonal": f"""SELECT s.location_id, s.hi, s.step, CAST(s.hi + to_months(s.step) AS DATE) AS month,
  d.y + CASE WHEN f.b IS NULL THEN 0 ELSE f.a * (1 - pow(f.b, s.step)) / (1 - f.b) + pow(f.b, s.step) * coalesce(c.d, 0) END AS v,
  CASE WHEN f.b IS NULL THEN 0 ELSE f.sd * sqrt((1 - pow(f.b, s.step) * pow(f.b, s.step)) / (1 - f.b * f.b)) * 1.96 END AS half
FROM {p}ahead s JOIN {dense} d ON d.location_id = s.location_id AND d.month = s.hi + to_months(s.step - 12)
LEFT JOIN {p}fit f ON f.location_id = s.location_id LEFT JOIN {p}chg c ON c.location_id = s.location_id AND c.month = s.hi""",
    }
    return {name: text.replace("location_id", key) for name, text in ctes.items()}


SEASONAL = {
    **DENSE,
    **seasonal_ctes("a_", "dense"),
    "train": """SELECT location_id, month, y FROM placed WHERE back > 6 AND location_id IN
(SELECT location_id FROM placed WHERE back > 6 GROUP BY location_id HAVING count(*) >= 12)""",
    **seasonal_ctes("t_", "train"),
    "seasonal_mape": """SELECT p.location_id, round_even(least(avg(abs((p.y - f.v) / (p.y + 1e-9))) * 100, 999.0), 2) AS train_mape
FROM placed p LEFT JOIN t_seasonal f ON f.location_id = p.location_id AND f.month = p.month WHERE p.back <= 6 GROUP BY p.location_id""",
}
_seasonal = """SELECT s.location_id, strftime(hi, '%Y-%m') AS last_train_date, strftime(month, '%Y-%m') AS forecast_month, step, CAST(greatest(round_even(v, 0), 0) AS INTEGER) AS forecasted_count,
CAST(greatest(round_even(v - half, 0), 0) AS INTEGER) AS lower_ci, CAST(greatest(round_even(v + half, 0), 0) AS INTEGER) AS upper_ci, 'seasonal_ar1' AS arima_order"""


@query("forecast_seasonal", f"{_seasonal} FROM a_seasonal s", NEEDS, SEASONAL)
def _(t):
    return forecast_seasonal(series(t), "location_id").drop("month", "forecast")


@query(
    "forecast_seasonal_error",
    f"{_seasonal}, m.train_mape FROM a_seasonal s LEFT JOIN seasonal_mape m ON m.location_id = s.location_id",
    NEEDS,
    SEASONAL,
)
def _(t):
    return forecast(series(t), "location_id").drop("month", "forecast")


@query(
    "forecast_report",
    """SELECT c_custkey, count(*) AS n_months, CASE WHEN count(*) < 12 THEN 'short' WHEN c_custkey % 3 = 0 THEN 'failed' ELSE 'ok' END AS status
       FROM filled GROUP BY c_custkey""",
    [],
    {
        "spans": "SELECT o_custkey AS c_custkey, min(date_trunc('month', o_orderdate)) AS lo, max(date_trunc('month', o_orderdate)) AS hi FROM orders GROUP BY o_custkey",
        "filled": "SELECT c_custkey, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS month FROM spans",
    },
)
def _(t):
    """One series per customer: many are too short, and a model that gives no answer for every third fails there."""
    rows = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    past = monthly_series(rows, "c_custkey", "o_orderdate")
    long = past.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= 12)
    ahead = forecast_trend(past.join(long.select("c_custkey"), "c_custkey", "left_semi"), "c_custkey")
    return forecast_report(past, ahead.where(F.col("c_custkey") % 3 != 0), "c_custkey")


@query(
    "fill_months",
    "SELECT location_id, count(*) AS n_months, count(*) FILTER (y = 0) AS n_empty FROM dense GROUP BY location_id",
    NEEDS,
    DENSE,
)
def _(t):
    dense = fill_months(t.fx_monthly, "location_id")
    return dense.groupBy("location_id").agg(F.count(F.lit(1)).alias("n_months"), F.count_if(F.col("y") == 0).alias("n_empty"))
