"""Seasonal autoregressive moving-average models: unit-root decision, order search, forecast.

All groups are fitted side by side by joins, windows and aggregates; nothing loops over
groups. A group is as long as the calendar, so its months fit one row.

Order search per group (series of at least two seasons use the seasonal parts, D = 1):

1. the series is differenced by a season, and once more (d = 1) unless a unit-root
   regression rejects the unit root at 5 per cent;
2. centred changes c are regressed on a long list of their own lags, which gives
   innovations e (first stage of Hannan and Rissanen);
3. every order p, q <= 2 and P, Q <= 1 is a least-squares fit of c on its lags 1..p and
   12 (P) and on lags 1..q and 12 (Q) of e, all from one matrix of moments per group;
   seasonal terms are additive, months before the first count as the mean;
4. the least information criterion among stationary fits wins, ties to fewer terms.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placestats.constants import HORIZON, MIN_MONTHS_SEASONAL, SEASON_LENGTH
from placestats.operators.linear import cholesky, dot, moments, pick, pick_vector, residual, solve
from placestats.session import materialize

UNIT_ROOT_LAGS = 2
LONG_LAGS = (1, 2, 3, 4, SEASON_LENGTH)
TERMS = (("c", 1), ("c", 2), ("c", SEASON_LENGTH), ("e", 1), ("e", 2), ("e", SEASON_LENGTH))
ROWS_PER_TERM = 3  # months a fitted number needs
# fixed values: MacKinnon's response surface, constant without trend, 5 per cent
CRITICAL = (-2.86154, -2.8903, -4.234, -40.04)


def _keys(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def differenced(series: DataFrame, group: str | Sequence[str], lag: int = SEASON_LENGTH, min_seasonal: int = MIN_MONTHS_SEASONAL) -> DataFrame:
    """Adds `n`, `seasonal` and `z`, the change against the season before, or `y` itself in series too short for seasons."""
    keys = _keys(group)
    whole, ordered = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("month")
    y = F.col("y").cast("double")
    out = series.select(*keys, "month", y.alias("y"), F.count(F.lit(1)).over(whole).alias("n"), F.lag(y, lag).over(ordered).alias("_ago"))
    out = out.withColumn("seasonal", F.col("n") >= min_seasonal)
    return out.where(~F.col("seasonal") | F.col("_ago").isNotNull()).withColumn("z", F.when(F.col("seasonal"), F.col("y") - F.col("_ago")).otherwise(F.col("y"))).drop("_ago")


def unit_root(series: DataFrame, group: str | Sequence[str], value: str = "y", max_lag: int = UNIT_ROOT_LAGS) -> DataFrame:
    """Per group `lags`, `statistic`, `critical` and `stationary`: a unit-root regression with a constant.

    The change is regressed on the level before and on 0 to `max_lag` earlier changes, all
    on the same months; the number of changes with the least information criterion counts.
    The t statistic of the level is held against the 5 per cent value for that many months.
    Groups that are constant, fitted exactly or too short are not stationary and have no statistic.
    """
    keys = _keys(group)
    whole, ordered = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("month")
    rows = series.select(*keys, "month", (F.col(value) - F.avg(value).over(whole)).cast("double").alias("_v"))
    rows = rows.withColumn("_l", F.lag("_v", 1).over(ordered)).withColumn("_d", F.col("_v") - F.col("_l"))
    rows = rows.select("*", *[F.lag("_d", i).over(ordered).alias(f"_d{i}") for i in range(1, max_lag + 1)])
    all_there = F.col("_l").isNotNull()
    for i in range(1, max_lag + 1):
        all_there &= F.col(f"_d{i}").isNotNull()
    regressors = [F.col("_l"), F.lit(1.0), *[F.col(f"_d{i}") for i in range(1, max_lag + 1)]]
    fit = moments(rows.where(all_there), keys, regressors, F.col("_d"))
    fit = fit.withColumn("lags", F.explode(F.sequence(F.lit(0), F.lit(max_lag)))).withColumn("k", F.col("lags") + 2).where(F.col("rows") > F.col("k"))
    index = F.sequence(F.lit(0), F.col("k") - 1)
    fit = fit.withColumn("_i", index).withColumn("_factor", cholesky(pick(F.col("xx"), F.col("_i")))).withColumn("_xy", pick_vector(F.col("xy"), F.col("_i")))
    fit = fit.withColumn("_beta", solve(F.col("_factor"), F.col("_xy")))
    first = F.transform(F.col("_i"), lambda i: F.when(i == 0, 1.0).otherwise(0.0))
    fit = fit.withColumn("_rss", residual(F.col("yy"), F.col("_beta"), F.col("_xy"))).withColumn("_spread", F.get(solve(F.col("_factor"), first), F.lit(0)))
    fit = fit.where(F.col("_rss") > F.col("yy") * 1e-6)
    criterion = F.col("rows") * F.log(F.col("_rss") / F.col("rows")) + 2 * F.col("k")
    statistic = F.get("_beta", F.lit(0)) / F.sqrt(F.col("_rss") / (F.col("rows") - F.col("k")) * F.col("_spread"))
    best = fit.groupBy(*keys).agg(F.min_by(F.struct("lags", statistic.alias("statistic"), "rows"), F.struct(criterion.alias("c"), "lags")).alias("_b"))
    n = F.col("_b.rows").cast("double")
    critical = F.lit(CRITICAL[0]) + CRITICAL[1] / n + CRITICAL[2] / (n * n) + CRITICAL[3] / (n * n * n)
    best = best.select(*keys, "_b.lags", "_b.statistic", critical.alias("critical"))
    out = series.select(*keys).distinct().join(best, keys, "left")
    return out.withColumn("stationary", F.coalesce(F.col("statistic") < F.col("critical"), F.lit(False)))


def _changes(series: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, month, y, y_before, n, seasonal, z, d, mean, c): centred changes, differenced as often as the unit-root decision says."""
    ordered, whole = Window.partitionBy(*keys).orderBy("month"), Window.partitionBy(*keys)
    rows = differenced(series, keys)
    decided = unit_root(rows, keys, "z").select(*keys, F.when(F.col("stationary"), 0).otherwise(1).alias("d"))
    rows = rows.withColumns({"_before": F.lag("z", 1).over(ordered), "y_before": F.lag("y", 1).over(ordered)}).join(decided, keys)
    rows = rows.withColumn("_w", F.when(F.col("d") == 1, F.col("z") - F.col("_before")).otherwise(F.col("z"))).where(F.col("_w").isNotNull())
    rows = rows.withColumn("mean", F.avg("_w").over(whole))
    return rows.withColumn("c", F.col("_w") - F.col("mean")).drop("_w", "_before")


def _lagged(keys: list[str], name: str, lag: int) -> Column:
    """A lag that counts as the mean, 0, before the first month; seasonal lags are 0 in series without seasons."""
    value = F.lag(name, lag, 0.0).over(Window.partitionBy(*keys).orderBy("month"))
    return F.when(F.col("seasonal"), value).otherwise(0.0) if lag == SEASON_LENGTH else value


def _orders(max_p: int, max_q: int) -> Column:
    """All orders with the places of their terms in `TERMS`."""
    out = []
    for p, q, sp, sq in product(range(max_p + 1), range(max_q + 1), (0, 1), (0, 1)):
        places = [*range(p), *([2] if sp else []), *range(3, 3 + q), *([5] if sq else [])]
        index = F.array(*[F.lit(i) for i in places]) if places else F.array().cast("array<int>")
        out.append(F.struct(F.lit(p).alias("p"), F.lit(q).alias("q"), F.lit(sp).alias("sp"), F.lit(sq).alias("sq"), index.alias("index")))
    return F.array(*out)


def order_search(series: DataFrame, group: str | Sequence[str], max_p: int = 2, max_q: int = 2) -> DataFrame:
    """The chosen model per group: orders, `beta` by `TERMS`, `sigma2`, `criterion` and the last months it continues from.

    `series` has every month of a group (see `fill_months`). Groups without a change, of one month say, have no row.
    """
    if max_p > 2 or max_q > 2:
        raise ValueError("orders go up to 2")
    keys = _keys(group)
    # a row a month: written once, so that what counted the months runs once only
    rows = _changes(materialize(series.select(*keys, "month", "y")), keys)
    long = [_lagged(keys, "c", lag).alias(f"_l{lag}") for lag in LONG_LAGS]
    rows = rows.select("*", *long)
    first = moments(rows, keys, [F.col(f"_l{lag}") for lag in LONG_LAGS], F.col("c"))
    first = first.withColumn("_factor", cholesky(F.col("xx"))).select(*keys, solve(F.col("_factor"), F.col("xy")).alias("_long"))
    rows = rows.join(first, keys)
    explained = dot(F.col("_long"), F.array(*[F.col(f"_l{lag}") for lag in LONG_LAGS]))
    rows = rows.withColumn("e", F.col("c") - explained)
    rows = rows.select("*", *[_lagged(keys, name, lag).alias(f"_{name}_{lag}") for name, lag in TERMS])
    history = F.array_sort(F.collect_list(F.struct("month", "y", "y_before", "z", "c", "e")))
    same = [F.first(c).alias(c) for c in ("n", "seasonal", "d", "mean")]
    fit = moments(rows, keys, [F.col(f"_{name}_{lag}") for name, lag in TERMS], F.col("c"), F.max("month").alias("last_month"), history.alias("history"), *same)

    fit = materialize(fit)
    tried = fit.select(*keys, "xx", "xy", "yy", "rows", "seasonal", F.explode(_orders(max_p, max_q)).alias("o")).select("*", "o.*").drop("o")
    tried = tried.withColumn("k", F.size("index")).where((F.col("seasonal") | (F.col("sp") + F.col("sq") == 0)) & ((F.col("k") == 0) | (ROWS_PER_TERM * (F.col("k") + 1) <= F.col("rows"))))
    tried = tried.withColumn("_factor", cholesky(pick(F.col("xx"), F.col("index")))).withColumn("_xy", pick_vector(F.col("xy"), F.col("index")))
    tried = tried.withColumn("_part", solve(F.col("_factor"), F.col("_xy"))).withColumn("rss", residual(F.col("yy"), F.col("_part"), F.col("_xy")))
    beta = [F.coalesce(F.get("_part", F.array_position("index", F.lit(i)).cast("int") - 1), F.lit(0.0)) for i in range(len(TERMS))]
    tried = tried.withColumn("beta", F.array(*beta))
    a, b, s = (F.get("beta", F.lit(i)) for i in range(3))
    stationary = F.when(F.col("sp") == 1, F.abs(a) + F.abs(b) + F.abs(s) < 1).otherwise((a + b < 1) & (b - a < 1) & (F.abs(b) < 1))
    criterion = F.col("rows") * F.log(F.greatest(F.col("rss"), F.lit(1e-9)) / F.col("rows")) + 2 * (F.col("k") + 1)
    tried = tried.where(stationary).withColumn("criterion", criterion)
    by = F.struct("criterion", "k", "p", "q", "sp", "sq")
    best = tried.groupBy(*keys).agg(F.min_by(F.struct("p", "q", "sp", "sq", "beta", "rss", "k", "criterion"), by).alias("_b"))
    sigma2 = F.col("rss") / F.greatest(F.col("rows") - F.col("k") - 1, F.lit(1))
    chosen = best.select(*keys, "_b.*").join(fit.select(*keys, "rows", "last_month", "history", "n", "seasonal", "d", "mean"), keys)
    return chosen.withColumn("sigma2", sigma2)


def order_label() -> Column:
    """(p,d,q)(P,D,Q,season) of a row of `order_search`."""
    season = F.when(F.col("seasonal"), SEASON_LENGTH).otherwise(1)
    return F.format_string("(%d,%d,%d)(%d,%d,%d,%d)", "p", "d", "q", "sp", F.col("seasonal").cast("int"), "sq", season)


def _tail(name: str, count: int) -> Column:
    """The last `count` values of the history, led by zeros where it is shorter; differencing may have cost `y` its first month."""
    known = F.transform("history", lambda h: h[name])
    if name == "y":
        known = F.concat(F.array(F.coalesce(F.get("history", F.lit(0))["y_before"], F.lit(0.0))), known)
    return F.slice(F.concat(F.array_repeat(F.lit(0.0), count), known), -count, count)


def forecast_steps(chosen: DataFrame, group: str | Sequence[str], horizon: int = HORIZON, lag: int = SEASON_LENGTH) -> DataFrame:
    """(keys, last_month, step, month, value, deviation, order): the chosen models continued month by month."""
    if not 1 <= horizon <= lag:
        raise ValueError("the horizon must be 1 to one season")
    keys = _keys(group)
    b = [F.get("beta", F.lit(i)) for i in range(len(TERMS))]
    steps = F.sequence(F.lit(1), F.lit(horizon))
    rows = chosen.withColumns({"_c": _tail("c", lag), "_e": _tail("e", lag), "_y": _tail("y", lag), "_z": F.element_at("history", -1)["z"]})

    def noise(h: Column, back: int) -> Column:
        return F.coalesce(F.get("_e", (h + lag - 1 - back).cast("int")), F.lit(0.0))

    def move(done: Column, h: Column) -> Column:
        own = b[0] * F.element_at(done, -1) + b[1] * F.element_at(done, -2) + b[2] * F.element_at(done, -lag)
        return F.array_append(done, own + b[3] * noise(h, 1) + b[4] * noise(h, 2) + b[5] * noise(h, lag))

    ahead = F.slice(F.aggregate(steps, F.col("_c"), move), lag + 1, horizon)
    rows = rows.withColumn("_w", F.transform(ahead, lambda x: x + F.col("mean")))
    total = lambda values, count: F.aggregate(F.slice(values, 1, count), F.lit(0.0), lambda s, x: s + x)

    def weight(done: Column, j: Column) -> Column:
        before = F.when(j >= 2, b[1] * F.element_at(done, -2)).otherwise(0.0)
        return F.array_append(done, b[0] * F.element_at(done, -1) + before + F.when(j == 1, b[3]).when(j == 2, b[4]).otherwise(0.0))

    # the last weight is one too many; a list of two keeps element -2 in reach
    weights = F.slice(F.aggregate(steps, F.array(F.lit(0.0), F.lit(1.0)), weight), 2, horizon)
    rows = rows.withColumn("_psi", weights)
    rows = rows.withColumn("_sum", F.transform("_psi", lambda x, i: F.when(F.col("d") == 1, total(F.col("_psi"), i + 1)).otherwise(x)))
    rows = rows.withColumn("step", F.explode(steps))
    change = F.get("_w", F.col("step") - 1)
    level = F.when(F.col("d") == 1, F.col("_z") + total(F.col("_w"), F.col("step"))).otherwise(change)
    ago = F.when(F.col("seasonal"), F.get("_y", F.col("step") - 1)).otherwise(0.0)
    squares = F.aggregate(F.slice("_sum", 1, F.col("step")), F.lit(0.0), lambda s, x: s + x * x)
    return rows.select(
        *keys, "last_month", "step", F.add_months("last_month", F.col("step")).alias("month"), (level + ago).alias("value"),
        F.sqrt(F.col("sigma2") * squares).alias("deviation"), order_label().alias("order"),
    )
